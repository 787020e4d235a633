"""URL filters: rules found by their rarest literal token, then decided by regular expressions.

Every rule names literal tokens that any URL it matches must hold as whole tokens. The rule is filed under the one
of them that is rarest among all URLs, counted over the whole table. A URL's own tokens fetch candidate rules from
that index, and only those run their regular expression. The index is a hash table in one literal of the plan, its
size set by the rules alone, so URLs are judged where they are read: no shuffle and no Python. Longer lists of rules
are a table of tokens and rules, which the tokens of distinct URLs are joined with; the result is the same.

Rules may share a name. Of those that match, the one with the greatest priority wins, then the one with the greatest
name, verdict and pattern; a host rule's priority is above 1000 and grows with its length.

Rows: a null URL, or one without '://', has an empty host and path and matches no host rule. Repeated URLs get
the same verdict each. Columns of the input are kept; those with the names of new columns are replaced.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace
from re import _constants, _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to which the index is a literal of the plan; more of them are a table that URLs are joined with.
LITERAL_RULES = 20_000
#: Rules of such a table up to which it is broadcast (some 200 bytes each); more are shuffled.
BROADCAST_RULES = 200_000
NOT_TOKEN = "[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INDEX = "array<map<string, array<struct<priority: int, rule: string, verdict: string, pattern: string>>>>"


@dataclass(frozen=True)
class Rule:
    """pattern: a regular expression over 'host' + 'path'; tokens: literals that it can't match without."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int = 0


def host_rule(rule: str, verdict: str) -> Rule:
    """A rule like 'example.net/en/': this host and its subdomains, paths that start so. The longest wins."""
    host, slash, path = rule.partition("/")
    # the last token of the path may go on in a URL, unless the rule ends it
    ended = [t for t in re.split(NOT_TOKEN, path.lower())[:-1] if t] if path == path.lower() else []
    tokens = [t for t in re.split(NOT_TOKEN, host.lower()) if t] + ended
    return Rule(rule, verdict, rf"^(?:[^/]*\.)?{_quoted(host.lower())}{_quoted(slash + path)}" if slash else rf"^(?:[^/]*\.)?{_quoted(host.lower())}(?:/|$)", tuple(tokens), 1_000 + len(rule))


def label_rule(word: str, verdict: str = "block") -> Rule:
    """A rule for hosts with a word between dots or hyphens."""
    return Rule(f"*{word}*", verdict, rf"^(?:[^/]*[.-])?{_quoted(word)}(?:[.-][^/]*)?(?:/|$)", (word,))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """host: after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path: then up to '?', '#' or the end."""
    at = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(F.col(url), at, k), F.lit(""))
    return df.withColumns({"host": F.translate(part(1), UPPER, LOWER), "path": part(2)})


def _tokens(df_host: Column, df_path: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.concat(df_host, F.lit("/"), df_path)), NOT_TOKEN), lambda t: t != ""))


def rarest_tokens(df: DataFrame, rules: list[Rule]) -> list[str]:
    """The token that each rule is filed under, '' for one without. df: host and path of all URLs.

    A row for each token of the rules reaches the driver, so as many as the rules themselves have there.
    """
    spark = df.sparkSession
    literals = spark.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens})], "token string")
    if literals.isEmpty():
        return [""] * len(rules)
    counted = df.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token")).groupBy("token").count().join(F.broadcast(literals), "token", "left_semi")
    count = {r.token: r["count"] for r in counted.collect()}
    return [min(r.tokens, key=lambda t: (count.get(t, 0), t)) if r.tokens else "" for r in rules]


def build_index(df: DataFrame, rules: list[Rule]) -> Column:
    """Buckets of token -> rules, as one literal. Rules without a token are filed under '' and run for every URL."""
    under = rarest_tokens(df, rules)
    names = sorted(set(under))
    size = max(2 * len(names), 1)
    spark = df.sparkSession
    placed = {r.t: r.b for r in spark.createDataFrame([(t,) for t in names] or [("",)], "t string").select("t", F.expr(f"int(pmod(xxhash64(t), {size}))").alias("b")).collect()}
    buckets: list[dict[str, list[dict[str, object]]]] = [{} for _ in range(size)]
    for token, r in zip(under, rules, strict=True):
        buckets[placed[token]].setdefault(token, []).append({"priority": r.priority, "rule": r.name, "verdict": r.verdict, "pattern": r.pattern})
    return F.from_json(F.lit(json.dumps(buckets)), _INDEX)


def _best_of_literal(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """parts with __best: of the rules in the plan's literal that match, the one with the greatest priority and name."""
    index = build_index(parts.select("host", "path"), rules)
    size = F.size(index)
    tokens = F.concat(_tokens(F.col("host"), F.col("path")), F.array(F.lit("")))
    place = lambda t: F.pmod(F.xxhash64(t), size).cast("int")
    fetched = F.flatten(F.filter(F.transform(tokens, lambda t: F.try_element_at(F.get(index, place(t)), t)), lambda r: r.isNotNull()))
    text = F.concat(F.col("host"), F.col("path"))
    return parts.withColumn("__best", F.array_max(F.filter(fetched, lambda r: F.regexp_like(text, r["pattern"]))))


def _best_of_table(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same by a join of the tokens of distinct URLs with the table of rules."""
    spark = parts.sparkSession
    filed = zip(rarest_tokens(parts.select("host", "path"), rules), rules, strict=True)
    index = spark.createDataFrame([(t, r.priority, r.name, r.verdict, r.pattern) for t, r in filed], "token string, priority int, rule string, verdict string, pattern string")
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    tokens = F.explode(F.concat(_tokens(F.col("host"), F.col("path")), F.array(F.lit("")))).alias("token")
    urls = parts.select("host", "path").distinct().select("host", "path", tokens)
    hits = urls.join(index, "token").filter(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
    best = hits.groupBy("host", "path").agg(F.max(F.struct("priority", "rule", "verdict", "pattern")).alias("__best"))
    return parts.join(best, ["host", "path"], "left")


def filter_urls(df: DataFrame, host_rules: list[Rule], patterns: list[Rule], default: str = "allow", url: str = "url", literal_rules: int = LITERAL_RULES) -> DataFrame:
    """df with host, path, rule (of the host rules, or null), pattern (the name of what decided) and verdict."""
    # a host rule's name may be a pattern's too, so what kind a rule is goes with its name
    rules = [*(replace(r, name="h" + r.name) for r in host_rules), *(replace(r, name="p" + r.name) for r in patterns)]
    parts = with_host_and_path(df.drop("host", "path", "rule", "pattern", "verdict"), url)
    found = (_best_of_literal if len(rules) <= literal_rules else _best_of_table)(parts, rules)
    name = F.substring("__best.rule", 2, 1 << 30)
    found = found.withColumns({"rule": F.when(F.startswith(F.col("__best.rule"), F.lit("h")), name), "pattern": name, "verdict": F.coalesce(F.col("__best.verdict"), F.lit(default))})
    return found.select(*df.drop("host", "path", "rule", "pattern", "verdict").columns, "host", "path", "rule", "pattern", "verdict")


def literal_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens that every text which the pattern matches holds as whole tokens: runs of small letters and digits,
    outside of branches, repeats and groups, with another literal character on both sides. () if there is none."""
    try:
        parsed = _parser.parse(pattern)
    except re.error:  # Java knows forms that Python does not
        return ()
    if parsed.state.flags & re.IGNORECASE:
        return ()
    found, run, open_ = [], "", False
    for kind, value in parsed:
        c = chr(value) if kind is _constants.LITERAL else None
        if c is not None and re.fullmatch("[a-z0-9]", c):
            run += c
            continue
        if c is not None and not c.isalnum():
            if run and open_:
                found.append(run)
            run, open_ = "", True
        else:  # what stands here may begin or end with a letter
            run, open_ = "", False
    return tuple(dict.fromkeys(found))


def rules_of(table: DataFrame, verdict: str = "block") -> list[Rule]:
    """Rules from a table with `pattern`, and `name`, `verdict` and `priority` where it has them. All rows reach the
    driver, as a list of rules is what a caller hands in; rows without a pattern are left out."""
    has = lambda c, other: F.coalesce(F.col(c), other) if c in table.columns else other
    rows = table.filter(F.col("pattern").isNotNull()).select("pattern", has("name", F.col("pattern")).alias("name"), has("verdict", F.lit(verdict)).alias("verdict"), has("priority", F.lit(0)).cast("int").alias("priority"))
    return [Rule(r.name, r.verdict, r.pattern, literal_tokens(r.pattern), r.priority) for r in rows.collect()]


#: Words in host names that the default pattern rules block.
BLOCKED_WORDS = ("adult", "bets", "casino", "pills", "porn", "spam", "track", "viagra", "warez")


def default_patterns() -> list[Rule]:
    return [label_rule(w) for w in BLOCKED_WORDS]
