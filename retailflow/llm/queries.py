"""Queries and their SQL over the supplied tables for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, new_path, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    from .bpe_stream import encode_documents

    coded = encode_documents(docs.select("doc_id", "text"), tokenizer_file())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS r(i) WHERE len(ws) > 0),
sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS k FROM grams GROUP BY doc_id),
classes AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY k) AS class_id FROM sets),
own AS (
  SELECT g.doc_id, g, n FROM grams g JOIN classes c ON c.doc_id = g.doc_id AND c.class_id = c.doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS n_common FROM own a JOIN own b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs WHERE 5 * n_common >= 4 * (nx + ny - n_common)),
reach AS (
  SELECT DISTINCT x AS node, x AS root FROM links UNION SELECT y, root FROM reach JOIN links ON x = node),
groups AS (
  SELECT node, min(root) AS group_id FROM reach GROUP BY node),
counts AS (
  SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(group_id, class_id, w.doc_id) AS group_id
FROM w LEFT JOIN classes USING (doc_id) LEFT JOIN counts ON counts.x = class_id LEFT JOIN groups ON node = class_id
"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar

    return similar(table(spark, sf_dir, "documents"))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is the chosen one of a pair. The rejected one has the same turns up to the last assistant turn,
    and there the last answer of another conversation (2k and 2k + 1 lend each other theirs; without one, an empty
    answer). Masks are joined as 'start-end' texts."""
    from .preferences import format_preferences

    turns = table(spark, sf_dir, "conversations").filter("conv_id is not null").select("conv_id", "turn", "role", "text").distinct()
    answers = turns.filter("role = 'assistant' and turn is not null").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = F.when(F.col("conv_id") % 2 == 0, F.col("conv_id") + 1).otherwise(F.col("conv_id") - 1)
    side = lambda df, conv, chosen: df.select(F.col("conv_id").alias("pair"), F.lit(chosen).alias("chosen"), conv.alias("conv_id"), "turn", "role", "text")
    before = turns.join(answers, "conv_id").filter("turn is null or turn < last.turn")
    lent = answers.select(other.alias("conv_id"), F.col("last.text").alias("text"))
    instead = answers.join(lent, "conv_id", "left").select("conv_id", "last.turn", F.lit("assistant").alias("role"), "text")
    rows = side(turns, F.col("conv_id"), True).unionAll(side(before, other, False)).unionAll(side(instead, other, False))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), " ").alias(c)
    pairs = format_preferences(rows, "pair", "chosen")
    return pairs.select("pair_id", "chosen_id", "rejected_id", "n_prefix_turns", "prompt", "chosen", mask("chosen_mask"), "rejected", mask("rejected_mask"))


OP2_SQL = r"""
WITH c AS (
  SELECT DISTINCT conv_id, turn, role, text, CASE WHEN conv_id % 2 = 0 THEN conv_id + 1 ELSE conv_id - 1 END AS other FROM conversations WHERE conv_id IS NOT NULL),
last_turn AS (
  SELECT conv_id, max(turn) AS turn FROM c WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id),
answers AS (
  SELECT c.conv_id, c.turn, other, max(text) AS text FROM c JOIN last_turn l ON c.conv_id = l.conv_id AND c.turn = l.turn WHERE role = 'assistant' GROUP BY ALL),
turns AS (
  SELECT conv_id AS pair_id, 0 AS side, conv_id, turn, role, text FROM c
  UNION SELECT c.conv_id, 1, other, c.turn, role, text FROM c JOIN last_turn l ON c.conv_id = l.conv_id WHERE c.turn IS NULL OR c.turn < l.turn
  UNION SELECT a.conv_id, 1, a.other, a.turn, 'assistant', b.text FROM answers a LEFT JOIN answers b ON b.conv_id = a.other),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' || chr(10) AS body
  FROM turns),
prefix AS (
  SELECT pair_id, least(coalesce(max(k) FILTER (side = 0), 0), coalesce(max(k) FILTER (side = 1), 0)) AS shortest,
    min(k) FILTER (differs) AS first_other
  FROM (SELECT *, count(*) OVER (PARTITION BY pair_id, k) = 2
      AND (min(head) OVER (PARTITION BY pair_id, k) <> max(head) OVER (PARTITION BY pair_id, k)
        OR min(body) OVER (PARTITION BY pair_id, k) <> max(body) OVER (PARTITION BY pair_id, k)) AS differs
    FROM numbered)
  GROUP BY pair_id),
cut AS (
  SELECT pair_id, coalesce(first_other - 1, shortest) AS n FROM prefix),
placed AS (
  SELECT t.*, c.n, sum(CASE WHEN k > n THEN length(head) + length(body) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY k) AS stop
  FROM numbered t JOIN cut c USING (pair_id))
SELECT pair_id, min(conv_id) FILTER (side = 0) AS chosen_id, min(conv_id) FILTER (side = 1) AS rejected_id, any_value(n) AS n_prefix_turns,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 0 AND k <= n), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 0 AND k > n), '') AS chosen,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ' ' ORDER BY k) FILTER (side = 0 AND k > n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 1 AND k > n), '') AS rejected,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ' ' ORDER BY k) FILTER (side = 1 AND k > n AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id
"""


def op3_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .string_kernel import fit, held_out, predict

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_blocks import extract, fit

    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), fit(pages))


OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS t FROM w, unnest(range(1, len(ws) - 48)) AS r(i) WHERE len(ws) >= 50),
least_id AS (
  SELECT t, min(doc_id) AS lo FROM win GROUP BY t),
gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS js FROM win JOIN least_id USING (t), range(50) AS r(k) WHERE doc_id > lo GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(js), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE [ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(js, j)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import dedup_substrings

    kept = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import default_patterns, filter_urls, host_rule

    hosts = [host_rule(r, v) for r, v in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))]
    found = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), hosts, default_patterns())
    return found.select("page_id", "host", "path", "rule", "verdict", "pattern")


OP7_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
    list_filter(['adult', 'bets', 'casino', 'pills', 'porn', 'spam', 'track', 'viagra', 'warez'],
      lambda w: list_contains(regexp_split_to_array(host, '[.-]'), w)) AS words
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END
    WHEN len(words) > 0 THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN rule WHEN len(words) > 0 THEN '*' || list_max(words) || '*' END AS pattern
FROM ruled
"""


def _op8_sql() -> str:
    """Exact quantiles in place of sketched ones: the limits are as good as equal, and no document lies near one."""
    from .quality_rules import LEAST_GROUP, LEAST_WORDS, MOST_REPEATED_PERCENT, RATIOS, TAIL

    value = {"symbol_share": "n_symbols / word_chars", "word_length": "word_chars / n_words", "dup_line_share": "n_dup_lines / n_lines", "repeat_share": "n_repeat_words / n_words"}
    quantiles = ", ".join(f"quantile_disc({r.name}, {q}) AS {r.name}_{k}" for r in RATIOS for k, q in (("a", 0.25), ("b", 0.5), ("c", 0.75), ("t", TAIL)))
    pick = lambda c: f"CASE WHEN s.n >= {LEAST_GROUP} THEN s.{c} WHEN l.n >= {LEAST_GROUP} THEN l.{c} ELSE o.{c} END"
    spread = lambda r: f"{pick(r.name + '_t')} - {pick(r.name + '_b')}" if r.tail else f"{pick(r.name + '_b')} - {pick(r.name + '_a')}"
    beyond = " OR ".join(
        [f"d.{r.name} > {pick(r.name + '_b')} + {r.spreads} * greatest({spread(r)}, {r.least_spread})" for r in RATIOS]
        + [f"d.{r.name} < {pick(r.name + '_b')} - {r.spreads} * greatest({pick(r.name + '_c')} - {pick(r.name + '_b')}, {r.least_spread})" for r in RATIOS if r.low]
    )
    return rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
tri AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM w, unnest(range(1, len(ws) - 1)) AS r(i) WHERE len(ws) >= 3),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS t(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
d AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed, {', '.join(f"{value[r.name]} AS {r.name}" for r in RATIOS)} FROM m),
p AS (
  SELECT * FROM d WHERE NOT base_failed),
s AS (SELECT lang, source, count(*) AS n, {quantiles} FROM p GROUP BY ALL),
l AS (SELECT lang, count(*) AS n, {quantiles} FROM p GROUP BY lang),
o AS (SELECT count(*) AS n, {quantiles} FROM p)
SELECT d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({beyond}, false) AS kept
FROM d LEFT JOIN s ON d.lang IS NOT DISTINCT FROM s.lang AND d.source IS NOT DISTINCT FROM s.source LEFT JOIN l ON d.lang IS NOT DISTINCT FROM l.lang CROSS JOIN o
"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judged, limits, measured, sketches

    measures = cut(measured(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("text"), "measured")
    kept = judged(measures, limits(sketches(measures)))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    path = new_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return read_token_files(spark, path).select(
        "doc_id",
        "start",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op11_sql() -> str:
    """The least (cost, audit) of each state of the grammar, turn by turn; each is kept as one text that sorts by cost."""
    add = lambda x, k, letter: f"CASE WHEN {x} IS NOT NULL THEN lpad(CAST(CAST(left({x}, 9) AS BIGINT) + {k} AS VARCHAR), 9, '0') || substr({x}, 10) || '{letter}' END"
    stay = lambda x: add(x, 2, "D")
    go = lambda sources, initial: f"CASE WHEN must THEN NULL ELSE least({', '.join(f'''CASE WHEN i = '{initial}' THEN {add(x, 'extra', 'K')} ELSE {add(x, '1 + extra', 'R')} END''' for x in sources)}) END"
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT k, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM (SELECT DISTINCT k FROM src), tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src JOIN kinds USING (k), range(2) AS r(again) WHERE kind <> 0 AND (again = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER w AS n, lag(left(role, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (
  SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM placed),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000' AS st, CAST(NULL AS VARCHAR) AS s, '000000005I' AS u, '000000010II' AS a FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, n, st, s, least(u, {add('least(st, s, a)', 5, 'I')}) AS u, least(a, {add('u', 5, 'I')}, {add('least(st, s, a)', 10, 'II')}) AS a
  FROM (SELECT w.conv_id, f.n, {stay('w.st')} AS st, least({stay('w.s')}, CASE WHEN i = 's' AND NOT must THEN {add('w.st', 'extra', 'K')} END) AS s,
      least({stay('w.u')}, {go(('w.st', 'w.s', 'w.a'), 'u')}) AS u, least({stay('w.a')}, {go(('w.u',), 'a')}) AS a
    FROM walk w JOIN (SELECT *, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS extra FROM faults) f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1)),
sums AS (
  SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
least_cost AS (
  SELECT w.conv_id, CAST(left(least(st, a), 9) AS BIGINT) AS cost, substr(least(st, a), 10) AS audit FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n),
letters AS (
  SELECT conv_id, k, audit[k] AS letter, length(replace(left(audit, k), 'I', '')) AS n FROM least_cost, unnest(range(1, length(audit) + 1)) AS r(k)),
kept AS (
  SELECT l.conv_id, k, letter, CASE WHEN letter = 'K' THEN role END AS role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY l.conv_id ORDER BY k) AS place
  FROM letters l JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.n = greatest(l.n, 1) WHERE letter <> 'D'),
systems AS (
  SELECT conv_id, count(*) FILTER (place = 1 AND left(role, 1) = 's') AS has_s FROM kept GROUP BY conv_id),
hashed AS (
  SELECT k.conv_id, sha256(string_agg(coalesce(role, CASE WHEN (place - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k)) AS repaired_sha256
  FROM kept k JOIN systems s ON s.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY k.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN least_cost c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .turn_repair import repair

    return repair(table(spark, sf_dir, "conversations"))


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe_tree import encode_documents

    ranks = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
firsts AS (
  SELECT t, min(doc_id) AS lo FROM d GROUP BY t),
said AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN d.doc_id > lo THEN 16 ELSE 0 END AS mask
  FROM d JOIN firsts USING (t) LEFT JOIN said USING (doc_id)),
letters(letter, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
walk AS (
  SELECT '' AS filter_order, 0 AS applied UNION ALL SELECT filter_order || letter, applied + bit FROM walk, letters WHERE applied & bit = 0),
steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, bit, (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE contains(left(filter_order, k - 1), b.letter)) AS before
  FROM (SELECT filter_order FROM walk WHERE length(filter_order) = 5), range(1, 6) AS r(k), letters WHERE letter = filter_order[k]),
counted AS (
  SELECT part, filter_order, step, bit,
    count(*) FILTER (mask & (CAST(before AS INTEGER) | bit) = 0) AS kept, count(*) FILTER (mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0) AS removed,
    count(*) FILTER (mask & CAST(before AS INTEGER) <> 0 AND mask & bit <> 0) AS redundant, count(*) FILTER (mask = bit) AS unique_fails,
    count(*) FILTER (good = 1 AND mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0) AS good_lost,
    count(*) FILTER (toxic = 1 AND mask & CAST(before AS INTEGER) = 0 AND mask & bit <> 0) AS toxic_lost
  FROM m, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit_documents

    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_preferences": op2_preferences,
    "op3_string_kernel": op3_string_kernel,
    "op4_html_blocks": op4_html_blocks,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_bpe_stream": op6_bpe_stream,
    "op7_url_filter": op7_url_filter,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_files": op9_token_files,
    "op10_decontaminate": op10_decontaminate,
    "op11_turn_repair": op11_turn_repair,
    "op12_bpe_tree": op12_bpe_tree,
    "op13_filter_audit": op13_filter_audit,
}

SQL: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op2_preferences": OP2_SQL,
    "op7_url_filter": OP7_SQL,
    "op8_quality_rules": _op8_sql(),
    "op11_turn_repair": _op11_sql(),
    "op13_filter_audit": OP13_SQL,
}
