"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

The turns that both conversations of a pair begin with alike are rendered once, as the prompt. The rest of each is a
completion with its mask: spans of characters, from the completion's start, that a model is trained on. These are the
texts of assistant turns and their end marks; role lines and other turns are masked.

One grouping by pair, with Spark's own functions. A pair's rows are two conversations, so groups are as large as
conversations are and no larger.

Rows: turns go by number, then role, then text, nulls first; equal rows of one conversation count once. A null text
is rendered as an empty one, a null role as 'unknown'. Rows without a conversation or pair id are left out. A pair
with one conversation alone has the other's side empty, and its prompt is empty. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, LINE, CLOSE, TRAINED = "<|", "|>\n", "<|end|>\n", "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(LINE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _spans(turns: Column) -> Column:
    """[start, end) of what is trained on."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"))

    def grow(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(_head(t))
        end = begin + F.length(t["text"]) + len(CLOSE)
        span = F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        return F.struct(end.cast("bigint").alias("at"), F.when(t["role"] == TRAINED, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, start, grow, lambda a: a["spans"])


def format_preferences(turns: DataFrame, pair_id: str, chosen: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each pair. chosen: a boolean column, true for turns of the chosen conversation."""
    t = F.struct(F.col(turn).alias("turn"), F.col(role).alias("r"), F.col(text).alias("t"), F.coalesce(F.col(role), F.lit("unknown")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = turns.filter(F.col(pair_id).isNotNull() & F.col(conv_id).isNotNull()).select(F.col(pair_id).alias("pair_id"), F.coalesce(F.col(chosen), F.lit(False)).alias("c"), F.col(conv_id).alias("conv"), t.alias("t"))
    side = lambda is_chosen: F.sort_array(F.array_distinct(F.collect_list(F.when(F.col("c") == is_chosen, F.col("t")))))
    pairs = rows.groupBy("pair_id").agg(
        F.min(F.when(F.col("c"), F.col("conv"))).alias("chosen_id"),
        F.min(F.when(~F.col("c"), F.col("conv"))).alias("rejected_id"),
        side(True).alias("a"),
        side(False).alias("b"),
    )
    same = lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])
    shortest = F.least(F.size("a"), F.size("b"))
    differ = F.filter(F.sequence(F.lit(1), shortest), lambda i: ~same(F.element_at("a", i), F.element_at("b", i)))
    prefix = F.when(shortest == 0, 0).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, shortest))
    after = lambda x: F.slice(x, F.col("n") + 1, F.size(x))
    pairs = pairs.withColumn("n", prefix)
    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n").cast("bigint").alias("n_prefix_turns"),
        _rendered(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(after("a")).alias("chosen"),
        _spans(after("a")).alias("chosen_mask"),
        _rendered(after("b")).alias("rejected"),
        _spans(after("b")).alias("rejected_mask"),
    )
