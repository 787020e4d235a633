"""Ordered rules in the JVM: rules are fetched by a literal that a text must hold, and only those run their pattern.

A rule is filed under its host (and so holds for its subdomains) or, without one, under a token of the text; a rule with
neither is tried for every text. Of a rule with both, the token is looked for before its pattern runs. A text's lookup keys are all endings of its host, cut at dots, and its tokens. The rules
are a hash table in one literal of the plan, so texts are judged where they are read, without a shuffle or Python; beyond
LITERAL_RULES they are a table that the keys are joined with, with the same result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from dataclasses import asdict, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to which the index is a literal of the plan (some 300 bytes each).
LITERAL_RULES = 5_000
#: Bytes of a table of rules up to which it is broadcast.
BROADCAST_BYTES = 16 << 20


def host_of(text: Column) -> Column:
    return F.regexp_extract(F.lower(text), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def lookup_keys(text: Column, prefix: str = "") -> Column:
    """'h:' and each ending of the host, 't:' and each token, all with a prefix that tells several texts apart."""
    # within the outer transform the labels are computed once, and not for each of them
    of_labels = lambda labels: F.transform(labels, lambda _, i: F.concat(F.lit(f"{prefix}h:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    endings = F.flatten(F.transform(F.array(F.split(host_of(text), r"\.", -1)), of_labels))
    tokens = F.transform(F.split(F.lower(text), "[^a-z0-9]+", -1), lambda t: F.concat(F.lit(f"{prefix}t:"), t))
    return F.array_distinct(F.concat(endings, tokens))


def filed_under(host: str, token: str, prefix: str = "") -> tuple[str, str]:
    """The key that a rule is filed under ('': every text), and another that its texts have as well ('': none)."""
    keys = [f"{prefix}h:{host.lower()}"] * bool(host) + [f"{prefix}t:{token.lower()}"] * bool(token)
    return tuple([*keys, "", ""][:2])


def checked(rules: list) -> None:
    """Raises for patterns that can't be read, positions that they don't have, and names that repeat."""
    names = [r.name for r in rules]
    if len({*names}) != len(names):
        raise ValueError(f"rules of one name: {sorted(n for n in {*names} if names.count(n) > 1)[:5]}")
    for r in rules:
        groups = {p: re.compile(p).groups for p in (getattr(r, c) for c in r.PATTERNS) if p}
        for position, pattern in r.POSITIONS.items():
            if getattr(r, position) > groups.get(getattr(r, pattern), 0) and getattr(r, pattern):
                raise ValueError(f"rule {r.name}: its pattern has no group {getattr(r, position)}")


def _kinds(rule: type) -> str:
    return ", ".join(["no: int", "filed: string", "also: string", *(f"{f.name}: {'int' if f.type in ('int', int) else 'boolean' if f.type in ('bool', bool) else 'string'}" for f in fields(rule))])


def _rows(rules: list, filed: list[tuple[str, str]]) -> list[dict]:
    return [{"no": no, "filed": key, "also": also} | asdict(r) for no, (r, (key, also)) in enumerate(zip(rules, filed, strict=True), 1)]


def with_candidates(df: DataFrame, keys: Column, rules: list, filed: list[tuple[str, str]], literal_rules: int | None = None) -> DataFrame:
    """df with `candidates`: the rules (with `no` in the order of the list) that one of the row's keys fetches, and whose
    other key the row has. filed: filed_under() of each rule. A longer list is joined on distinct rows of df.
    """
    kind = f"array<struct<{_kinds(type(rules[0]))}>>"
    named = Counter(key for pair in filed for key in pair)
    rows = _rows(rules, [(b, a) if b and named[b] < named[a] else (a, b) for a, b in filed])  # under the rarer one
    if len(rules) <= (LITERAL_RULES if literal_rules is None else literal_rules):
        size = 8 * len({row["filed"] for row in rows}) + 1
        buckets: list[list[dict]] = [[] for _ in range(size)]
        for row in rows:
            buckets[zlib.crc32(row["filed"].encode()) % size].append(row)
        index = F.from_json(F.lit(json.dumps(buckets)), f"array<{kind}>")
        places = F.array_distinct(F.transform(F.concat("__keys", F.array(F.lit(""))), lambda k: (F.crc32(k) % size).cast("int")))
        fetched = F.flatten(F.transform(places, lambda b: F.get(index, b)))
        has = lambda key: (key == "") | F.array_contains(F.col("__keys"), key)
        mine = F.filter(fetched, lambda r: has(r["filed"]) & has(r["also"]))
        return df.withColumn("__keys", keys).withColumn("candidates", mine).drop("__keys")
    names = df.columns
    table = df.sparkSession.createDataFrame([(json.dumps([row]), row["filed"]) for row in rows], "rule string, filed string")
    if sum(len(json.dumps(row)) for row in rows) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    keyed = df.distinct().withColumn("__keys", keys).withColumn("filed", F.explode(F.concat("__keys", F.array(F.lit("")))))
    found = keyed.join(table, "filed").withColumn("rule", F.from_json("rule", kind)[0])
    found = found.filter((F.col("rule.also") == "") | F.expr("array_contains(__keys, rule.also)"))
    per_row = found.groupBy(*[F.col(c).alias(f"__{c}") for c in names]).agg(F.collect_list("rule").alias("candidates"))
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    none = F.from_json(F.lit("[]"), kind)
    return df.join(per_row, on, "left").select(*names, F.coalesce("candidates", none).alias("candidates"))


def matches(text: Column, pattern: Column) -> Column:
    """Whether a pattern of a rule is in the text, whatever the case."""
    return F.regexp_like(text, F.concat(F.lit("(?i)"), pattern))


def group(text: Column, pattern: Column, position: Column) -> Column:
    """A group of a rule's pattern; '' for position 0 and for a group that is absent."""
    found = F.call_function("regexp_extract", text, F.concat(F.lit("(?i)"), pattern), position)
    return F.when(position > 0, found).otherwise("")
