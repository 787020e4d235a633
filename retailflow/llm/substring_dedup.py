"""Substring deduplication by level-wise doubling of repeated word windows.

A word goes if a window of `window` consecutive words that covers it also starts in a document with a smaller id.
Level one looks at windows of a quarter of that length. Of these it takes, from each full window, the one with the
least hash (the anchor): equal windows have equal anchors, so no repeat is lost, and one place in ten or so is looked
at. Anchors that occur in one document only are done with. Those that survive are extended to twice their length, and
judged again, level by level, until none survives or the full length is reached. Windows with the same anchors that
follow each other form a segment, and equal segments are settled as a whole. Only where one anchor lies in different
segments are single windows of the full length compared, one segment for each text. Longer repeats are unions of
windows of that length, so there the doubling ends.

Windows are counted by grouping with map-side sums and joined back, so a passage that a third of the documents share
is no group that one task must hold. Keys have 128 bits at each level that decides.

Rows: words are `[^\\x20\\x09-\\x0D]+`; a null text has none. Rows without an id are kept whole and remove nothing.
Rows with one id do not remove each other's words. Repeated rows get the same result each. Other columns are kept;
the names of new columns replace those of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begun, discard, discard_since, written

#: Odd multipliers of the two rolling hashes, and what the avalanche step multiplies by.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []  # bytes split at ASCII white space only


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any run of words, from prefix sums of word hash times a power of the base, modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, words: list[bytes], which: int = 0, hashes: np.ndarray | None = None) -> None:
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) if hashes is None else hashes
        n = len(self.hashes)
        self.up, self.down = self.powers(which, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * self.up[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in cls._powers or len(cls._powers[which][0]) < n:
            size = 1 << max(n, 1 << 14).bit_length()
            base = BASES[which]
            cls._powers[which] = tuple(np.cumprod(np.array([1] + [b] * (size - 1), np.uint64), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        return cls._powers[which]

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.hashes) - length + 1
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def lengths(window: int) -> list[int]:
    """The lengths of the levels before the last: each is half of the next, about."""
    return sorted({max(1, window >> 2), max(1, window >> 1)})


def segments(words: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Of each segment: the hash of all its words, its first window, its number of windows, and its anchor at each level.

    The anchor of a window at the first level is the part of that length with the least hash. At the next level it is
    doubled to the right or, where that would leave the window, to the left. Windows with the same anchors that follow
    each other are a segment.
    """
    first = Rolling(words)
    least, *longer = lengths(window)
    here = np.arange(len(words) - window + 1)
    at = np.lib.stride_tricks.sliding_window_view(first.windows(least), window - least + 1).argmin(axis=1) + here
    anchors, begin, size = [(at, least)], at, least
    for length in longer:
        begin = np.where(begin + length <= here + window, begin, begin + size - length)
        size = length
        anchors.append((begin, length))
    new = np.zeros(len(here), bool)
    new[0] = True
    for a, _ in anchors:
        new[1:] |= a[1:] != a[:-1]
    start = np.flatnonzero(new)
    n = np.diff(start, append=len(here))
    second = Rolling(words, 1, first.hashes)
    whole = second.runs(start, start + n + window - 1) ^ mixed((at[start] - start + (n << 16)).astype(np.uint64) + np.uint64(1))
    return whole, start, n, *(first.runs(a[start], a[start] + length) for a, length in anchors)


def _segments_of(docs: DataFrame, window: int) -> DataFrame:
    """g, doc, tk, s, n, and h0, h1, ... for the anchors of the levels."""
    names = ["g", "doc", "tk", "s", "n", *(f"h{k}" for k in range(len(lengths(window))))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in names]
            size = 0
            for row in range(batch.num_rows):
                words = words_of(batch.column(2)[row].as_py())
                if len(words) >= window:
                    g, s, n, *hashes = segments(words, window)
                    doc, tk = (np.full(len(g), batch.column(k)[row].as_py(), np.int64) for k in (0, 1))
                    for part, x in zip(parts, (g.view(np.int64), doc, tk, s, n, *(h.view(np.int64) for h in hashes)), strict=True):
                        part.append(x)
                    size += len(g)
                if size > 1 << 17 or (size and row == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], names=names)
                    parts, size = [[] for _ in names], 0

    return docs.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _windows_of(segment_lists: DataFrame, window: int) -> DataFrame:
    """Single windows, by two hashes, of the segments listed for each document."""
    names = ["w1", "w2", "doc", "h", "g", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = words_of(batch.column(1)[row].as_py())
                doc, listed = batch.column(0)[row].as_py(), batch.column(2)[row].values
                h, g, s, n = (np.asarray(listed.field(k), np.int64) for k in range(4))
                one = Rolling(words)
                two = Rolling(words, 1, one.hashes)
                of = np.repeat(np.arange(len(n)), n)
                offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = s[of] + offset
                w1, w2 = (x.runs(start, start + window).view(np.int64) for x in (one, two))
                columns = (w1, w2, np.full(len(of), doc, np.int64), h[of], g[of], offset)
                for k in range(0, len(of), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + (1 << 17)]) for c in columns], names=names)

    return segment_lists.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _without(rows: DataFrame, window: int, rest_text: bool) -> DataFrame:
    """rows (text, then `ranges` of first windows and counts, then the rest) with the covered words gone."""
    rest = [c for c in rows.columns if c not in ("text", "ranges")]
    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed, start, size = [], [], [], 0, 0
            for row in range(batch.num_rows):
                words, ranges = words_of(batch.column(0)[row].as_py()), batch.column(1)[row].values
                gone = 0
                kept = words
                if ranges is not None and len(ranges):
                    s, n = (np.asarray(ranges.field(k), np.int64) for k in range(2))
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, s, 1)
                    np.add.at(change, s + n + window - 1, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    gone = int(len(words) - stays.sum())
                    kept = [words[i] for i in np.flatnonzero(stays)]
                texts.append(b" ".join(kept).decode())
                counts.append(len(words))
                removed.append(gone)
                size += len(texts[-1])
                if size > 1 << 23 or row == batch.num_rows - 1:
                    own = [c.slice(start, row + 1 - start) for c in [*batch.columns[2:], *batch.columns[:1] * rest_text]]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*rest, *["text"] * rest_text, "kept_text", "n_words", "n_removed"])
                    texts, counts, removed, start, size = [], [], [], row + 1, 0

    return rows.select("text", "ranges", *rest).mapInArrow(run, ", ".join([*fields, *["text string"] * rest_text, "kept_text string, n_words bigint, n_removed bigint"]))


def repeated_ranges(docs: DataFrame, window: int) -> DataFrame:
    """For each document (doc, tk): the runs of windows that also start in a document with a smaller id."""
    spark = docs.sparkSession
    mark = begun()
    alive, path = written(_segments_of(docs.filter(F.col("doc").isNotNull()).select("doc", "tk", "text"), window), "segments")
    # sums are tables of their own before they are joined back: only then can Spark split the rows of a hot key
    in_two = lambda df, *keys: df.groupBy(*keys).agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi")
    for level in range(len(lengths(window))):
        key = f"h{level}"
        shared, shared_at = written(in_two(alive, key).select(key), "shared")
        longer, longer_at = written(alive.join(shared, key, "left_semi").drop(*[key] * (level < len(lengths(window)) - 1)), "alive")
        discard(spark, path, shared_at)
        alive, path = longer, longer_at
        if alive.isEmpty():
            discard_since(spark, mark)
            return spark.createDataFrame([], "doc bigint, tk bigint, ranges array<struct<s: bigint, n: bigint>>")
    alive = alive.withColumnRenamed(key, "h")

    # the last level: the same segment in a smaller document settles it
    least = F.min(F.struct("doc", "tk", "s", "n")).alias("first")
    texts, _ = written(alive.groupBy("h", "g").agg(least, F.max("doc").alias("hi")), "texts")
    several, _ = written(texts.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h"), "several")
    odd = texts.join(several, "h", "left_semi").select("h", "g", "first.*")
    # single windows of segments whose anchor has others
    lists = odd.groupBy("doc", "tk").agg(F.collect_list(F.struct("h", "g", "s", "n")).alias("listed"))
    windows, _ = written(_windows_of(docs.select("doc", "tk", "text").join(lists, ["doc", "tk"]).select("doc", "text", "listed"), window), "windows")
    smaller, _ = written(in_two(windows, "w1", "w2").select("w1", "w2", "lo"), "smaller")
    hit = windows.join(smaller, ["w1", "w2"]).filter("doc > lo").groupBy("h", "g").agg(F.collect_set("offset").alias("offsets"))
    # occurrences in the segment's first document have the windows found alone; in others all of them
    known = texts.select("h", "g", F.col("first.doc").alias("lo"), "hi").join(hit, ["h", "g"], "left").filter("lo < hi or offsets is not null")
    known, _ = written(known.select("h", "g", "lo", "offsets"), "known")
    one = F.transform("offsets", lambda o: F.struct((F.col("s") + o).alias("s"), F.lit(1).cast("bigint").alias("n")))
    whole = F.array(F.struct("s", "n"))
    runs = alive.join(known, ["h", "g"]).select("doc", "tk", F.when(F.col("doc") > F.col("lo"), whole).otherwise(one).alias("runs"))
    ranges, ranges_at = written(runs.filter(F.col("runs").isNotNull()).groupBy("doc", "tk").agg(F.flatten(F.collect_list("runs")).alias("ranges")), "ranges")
    discard_since(spark, mark, ranges_at)
    return ranges


def dedup_substrings(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text", rest_text: bool = False) -> DataFrame:
    """docs with kept_text (the words that stay, one space between them), n_words and n_removed; with rest_text, text too."""
    new = ("kept_text", "n_words", "n_removed")
    rest = [c for c in docs.columns if c not in new and c != text]
    key = F.hash(F.col(text)).cast("bigint")  # tells rows with the same id apart
    keyed = docs.select(F.col(doc_id).cast("bigint").alias("doc"), key.alias("tk"), F.col(text).alias("text"))
    ranges = repeated_ranges(keyed, window)
    own = docs.select(*[F.col(c).alias(f"own_{c}") for c in rest], F.col(text).alias("text"), F.col(doc_id).cast("bigint").alias("doc"), key.alias("tk"))
    # a merge join at every size: how much of the documents repeats, and so how large the ranges are, is not known before
    out = _without(own.join(ranges.hint("merge"), ["doc", "tk"], "left").drop("doc", "tk"), window, rest_text)
    return out.select(*[F.col(f"own_{c}").alias(c) for c in rest], *[F.col("text").alias(text)] * rest_text, *new)
