"""Quality rules with adaptive limits: quantile sketches for each language and source in place of fixed cutoffs.

Each document gets a few measures. For each (language, source) a mergeable quantile sketch of each measure is
built over all documents that pass the base rules: counts of values in buckets that grow by a fixed factor, so that
a quantile is off by at most 0.02 % of itself, merging is adding, and no chance and no order of rows has a part in it.
Two runs over the same documents keep the same ones. A limit lies some spreads beyond the median. For measures that
most documents have, a spread is the distance from the median to the quartile on the other side, so that up to half of
a group may be odd without moving it; for repetition, which most documents have none of, it is the distance to the
quantile of 0.99. Groups with few documents use the sketches merged over their language, or else over all documents.
Limits are joined back by (language, source), and documents beyond one are rejected.

Everything runs in Spark's own functions. A document's word windows are compared inside its row, so texts aren't
shuffled; sketches are summed map-side first, so a group with a third of the documents is no heavier than others.

Rows: a null text counts as an empty one (no words: it fails the base rules). Null languages and sources are groups
of their own. Repeated rows are judged each. Other columns are kept; those with the names of measures are replaced
in `measured`, and kept by `filter_documents`. Windows are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, GAP_CHARS, cut

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: How far a quantile may be off, as a share of itself, and the factor from bucket to bucket that keeps it so.
ACCURACY = 0.0002
GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
#: Values up to this count as 0, in a bucket of their own before all others.
TINY, NONE = 1e-12, -1_000_000
#: Rows of limits up to which they are broadcast.
BROADCAST_ROWS = 50_000


@dataclass(frozen=True)
class Ratio:
    """What is limited: a ratio of measures, how wide a spread is at least, which sides are limited, and whether the spread
    is told by the tail instead of the quartiles."""

    name: str
    value: Callable[[], Column]
    least_spread: float
    low: bool = False
    tail: bool = False

    @property
    def spreads(self) -> float:
        return TAIL_SPREADS if self.tail else SPREADS


def _over(a: str, b: str) -> Callable[[], Column]:
    return lambda: F.try_divide(F.col(a).cast("double"), F.col(b))


RATIOS = (
    Ratio("symbol_share", _over("n_symbols", "word_chars"), 0.0025),
    Ratio("word_length", _over("word_chars", "n_words"), 0.07, low=True),
    Ratio("dup_line_share", lambda: F.try_divide(F.col("n_dup_lines").cast("double"), F.col("__lines")), 0.01, tail=True),
    Ratio("repeat_share", _over("n_repeat_words", "n_words"), 0.01, tail=True),
)
#: Spreads from the median to a limit, by quartiles and by the quantile of TAIL.
SPREADS, TAIL_SPREADS, TAIL = 16.0, 4.0, 0.99
#: Documents that a group needs to have limits of its own: ten beyond the tail's quantile.
LEAST_GROUP = 1_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text holds at least twice."""

    def covered(marked: Column) -> Column:
        last = F.size(marked) - 1
        twice = F.filter(marked, lambda x, i: ((i > 0) & (F.get(marked, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(marked, i + 1)["h"] == x["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        grow = lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"))
        return F.aggregate(starts, none, grow, lambda a: a["n"])

    def of_hashes(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(marked, covered))

    hashes = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(words) < 3, 0).otherwise(_let(hashes(words), of_hashes))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measures of each whole text, and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.trim(t, F.lit(GAP_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x, F.lit(GAP_CHARS))) > 0)
    of_words = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    out = docs.drop(*MEASURES, "base_failed", "__w", "__l", "__lines").withColumns(
        {
            "__w": of_words,
            "__l": of_lines,
            "word_chars": F.length(F.translate(t, GAP_CHARS, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        }
    )
    out = out.withColumns({"n_words": F.col("__w.n").cast("long"), "n_repeat_words": F.col("__w.r").cast("long"), "n_dup_lines": F.col("__l.d").cast("long"), "__lines": F.col("__l.n")})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("__w", "__l")


def bucket_of(value: Column) -> Column:
    """The bucket of a value: 0 for 0 and below, else its logarithm in steps of GROWTH, rounded up."""
    return F.when(value <= TINY, F.lit(NONE)).otherwise(F.ceil(F.ln(value) / math.log(GROWTH)).cast("int"))


def value_of(bucket: Column) -> Column:
    """The middle of a bucket, by which no value of it is off by more than ACCURACY of itself."""
    return F.when(bucket == NONE, 0.0).otherwise(F.pow(F.lit(GROWTH), bucket) * (2 / (GROWTH + 1)))


def sketches(measures: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The quantile sketch of each ratio, for each language and source: how many values (n) lie in each bucket.

    Adding the counts merges two sketches, in any order, so the same documents give the same sketch in every run.
    """
    # null where a base rule fails, as a filter would be pushed below the measures and compute them again
    entry = lambda k, r: F.struct(F.lit(k).alias("ratio"), bucket_of(F.when(~F.col("base_failed"), r.value())).alias("bucket"))
    entries = F.inline(F.array(*[entry(k, r) for k, r in enumerate(RATIOS)]))
    rows = measures.select(F.col(lang).alias("lang"), F.col(source).alias("source"), entries)
    return rows.groupBy("lang", "source", "ratio", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("bucket is not null")


def _quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """n, and the quartiles and the tail of each ratio, for each group of keys. A window holds the buckets of one sketch: as
    many as a ratio can have values, some tens of thousands at most, however many documents there are."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*keys, "ratio")
    ranked = merged.withColumns({"upto": F.sum("n").over(own.orderBy("bucket")), "all": F.sum("n").over(own)})
    at = lambda q, k: F.min(F.when((F.col("upto") >= q * F.col("all")) & (F.col("ratio") == k), F.col("bucket")))
    found = [value_of(at(q, k)).alias(f"{r.name}_{name}") for k, r in enumerate(RATIOS) for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("tail", TAIL))]
    return ranked.groupBy(*keys).agg(F.max("all").alias("n"), *found)


def limits(groups: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """Limits for each language and source, from the sketches of the smallest group around it with enough documents."""
    by_lang, overall = _quartiles(groups, "lang"), _quartiles(groups)
    found = (
        _quartiles(groups, "lang", "source").alias("g")
        .join(by_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")))
        .join(F.broadcast(overall.alias("o")), F.lit(True))  # one row
    )
    columns: list[Column] = [F.col("g.lang").alias("lang"), F.col("g.source").alias("source")]
    for r in RATIOS:
        pick = lambda q: F.when(F.col("g.n") >= least, F.col(f"g.{r.name}_{q}")).when(F.col("l.n") >= least, F.col(f"l.{r.name}_{q}")).otherwise(F.col(f"o.{r.name}_{q}"))  # noqa: B023, E731
        q25, q50, q75 = pick("q25"), pick("q50"), pick("q75")
        spread = pick("tail") - q50 if r.tail else q50 - q25
        columns.append((q50 + r.spreads * F.greatest(spread, F.lit(r.least_spread))).alias(f"{r.name}_most"))
        if r.low:
            columns.append((q50 - r.spreads * F.greatest(q75 - q50, F.lit(r.least_spread))).alias(f"{r.name}_least"))
    return found.select(*columns)


def judged(measures: DataFrame, bounds: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """measures with `kept`: false where a base rule fails or a ratio lies beyond its limit."""
    bounds = cut(bounds)
    names = [c for c in bounds.columns if c not in ("lang", "source")]
    renamed = bounds.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[F.col(c).alias(f"__{c}") for c in names])
    if bounds.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    beyond = F.lit(False)
    for r in RATIOS:
        beyond = beyond | F.coalesce(r.value() > F.col(f"__{r.name}_most"), F.lit(False))
        if r.low:
            beyond = beyond | F.coalesce(r.value() < F.col(f"__{r.name}_least"), F.lit(False))
    joined = measures.join(renamed, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left")
    # one condition over both sides: its first half alone would be pushed below the measures and compute them again
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~beyond)
    return joined.withColumn("kept", kept).drop("__lang", "__source", "__lines", *[f"__{c}" for c in names])


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their own columns. Measures are computed once, into a table with the texts beside them."""
    own = docs.columns
    # clashing columns of the input ride along under other names
    renamed = docs.select(*[F.col(c).alias(f"own_{k}") for k, c in enumerate(own)])
    at = {c: f"own_{k}" for k, c in enumerate(own)}
    measures = cut(measured(renamed, at[text]), "measured")
    kept = judged(measures, limits(sketches(measures, at[lang], at[source])), at[lang], at[source]).filter("kept")
    return kept.select(*[F.col(at[c]).alias(c) for c in own])
