"""How filters interact: what each of them removes in every order in which they can be applied.

Documents are reduced to cells: a part of the corpus, a mask of the filters that a document fails, and counts. A recursive
CTE then extends prefixes of filter letters by each unused letter, carrying the bits that are applied so far beside every
mask; each of its levels gives that step's outcome for each mask. Cells join with the outcomes on the mask, so that the
recursion has as many rows whatever the size of the corpus and the number of its parts: 2^n masks times the prefixes of n
letters (10,432 rows for five filters).

Rows: a null text counts as '', a null source as the part ''. A document without a doc_id is never a copy of another and
never makes one; rows that repeat a doc_id count each, and none is a copy of the other. A doc_id that labels name several
times is good or toxic if one of the rows says so; labels without a doc_id count for none. Columns beyond those named are not read, so names that
clash do no harm. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP, GAP_CHARS, cut

#: Outcomes that are broadcast; with more filters than that allows, the join is left to Spark.
MOST_BROADCAST = 200_000


@dataclass(frozen=True)
class Filter:
    """A letter and what a document fails by; `fails` reads the columns of `measured`."""

    letter: str
    fails: Column


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, a digest of each text, and what the filters look at, in one pass over the texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), whole.alias("text"))
    bare = F.btrim("text", F.lit(GAP_CHARS))
    words = F.split(bare, GAP, -1)
    none = (bare == "").cast("int")  # splitting '' gives one empty word
    return own.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size(words) - none).alias("n_words"),
        (F.size(F.array_distinct(words)) - none).alias("n_distinct"),
        F.length("text").alias("n_chars"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_capitals"),
        F.col("text").rlike("[#$%&*|]").alias("has_symbol"),
    )


def standard_filters() -> list[Filter]:
    """Short texts, few distinct words, many capitals, symbols, and copies of a smaller doc_id's text."""
    n = {c: F.col(c).cast("bigint") for c in ("n_words", "n_distinct", "n_chars", "n_capitals")}
    return [
        Filter("A", n["n_words"] < 200),
        Filter("B", 100 * n["n_distinct"] < 50 * n["n_words"]),
        Filter("C", 100 * n["n_capitals"] > 2 * n["n_chars"]),
        Filter("D", F.col("has_symbol")),
        Filter("E", F.col("is_copy")),
    ]


def with_copies(measures: DataFrame) -> DataFrame:
    """is_copy: whether a smaller doc_id has the same text. Only digests and ids are shuffled, and only digests that are
    there more than once are joined with; rows of one such digest are split by Spark if they are many."""
    first = measures.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    joined = measures.join(first.select("digest", "least"), "digest", "left")
    return joined.withColumn("is_copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).drop("least", "digest")


def cells(measures: DataFrame, labels: DataFrame, filters: list[Filter]) -> DataFrame:
    """part, mask (bit k for filter k), n documents, and how many are labelled good and toxic."""
    is_one = lambda c: F.max((F.col(c) == 1).cast("int"))
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    mask = F.lit(0)
    for k, f in enumerate(filters):
        mask = mask.bitwiseOR(F.when(f.fails, 1 << k).otherwise(0))
    masked = with_copies(measures).select("doc_id", "part", mask.alias("mask")).join(said, "doc_id", "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return masked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count("good"), count("toxic"))


def outcomes(spark: SparkSession, letters: str) -> DataFrame:
    """prefix, step, letter, mask, and what becomes there of a document with that mask: kept, removed or redundant."""
    named = ", ".join(f"('{letter}', {1 << k})" for k, letter in enumerate(letters))
    return spark.sql(
        f"""
        WITH RECURSIVE letters(letter, bit) AS (VALUES {named}),
        walk(prefix, step, letter, bit, before, applied, mask) AS (
          SELECT CAST('' AS STRING), 0, CAST('' AS STRING), 0, 0, 0, CAST(id AS INT) FROM range({1 << len(letters)})
          UNION ALL
          SELECT concat(w.prefix, l.letter), w.step + 1, l.letter, l.bit, w.applied, w.applied | l.bit, w.mask
          FROM walk w JOIN letters l ON (w.applied & l.bit) = 0)
        SELECT prefix, step, letter, mask, (mask & applied) = 0 AS kept, (mask & before) = 0 AND (mask & bit) <> 0 AS removed,
          (mask & before) <> 0 AND (mask & bit) <> 0 AS redundant, mask = bit AS alone
        FROM walk WHERE step > 0"""
    )


def audit(found: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley for all orders.

    found: what cells() returns. shapley: documents that the step's filter removes, summed over all orders.
    """
    n = len(letters)
    steps = cut(outcomes(found.sparkSession, letters), "outcomes")
    rows = sum(math.perm(n, k) for k in range(1, n + 1)) << n
    small = F.broadcast(steps) if rows <= MOST_BROADCAST else steps
    total = lambda c, flag, name: F.sum(F.when(F.col(flag), F.col(c)).otherwise(0)).alias(name)
    by_prefix = (
        found.join(small, "mask")
        .groupBy("part", "prefix", "step", "letter")
        .agg(total("n", "kept", "kept"), total("n", "removed", "removed"), total("n", "redundant", "redundant"), total("n", "alone", "unique_fails"), total("good", "removed", "good_lost"), total("toxic", "removed", "toxic_lost"))
    )
    by_prefix = cut(by_prefix, "by_prefix")
    orders = F.factorial(F.lit(n) - F.col("step"))  # as many orders begin with a prefix
    shares = by_prefix.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = steps.filter((F.col("step") == n) & (F.col("mask") == 0)).select(F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    whole = whole.withColumn("prefix", F.expr("left(filter_order, step)"))
    out = by_prefix.join(shares, ["part", "letter"]).join(F.broadcast(whole) if rows <= MOST_BROADCAST else whole, ["prefix", "step"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame, filters: list[Filter] | None = None) -> DataFrame:
    """audit() of the documents under some filters, the standard ones unless others are named."""
    filters = filters or standard_filters()
    letters = "".join(f.letter for f in filters)
    if len({*letters}) != len(filters):
        raise ValueError("each filter needs a letter of its own")
    return audit(cells(cut(measured(docs), "measured"), labels, filters), letters)
