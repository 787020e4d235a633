"""N-gram Jaccard join: MinHash bands find candidate pairs, full n-gram sets verify them.

1. Each text becomes its set of five-word n-grams (64-bit hashes). Texts with equal sets form a class, stood for by
   its least doc_id, so copies cost one row each from there on.
2. Each class gets `bands` keys, each of `rows` minimum hashes, as many as the wanted recall at the threshold takes.
   Keys that two classes or more share are buckets.
3. Buckets are dealt out to tasks. One with more members than a block is split: a task gets two blocks and compares
   those pairs only, so no task holds a whole hot bucket. Members bring their full n-gram sets. A pair is compared in
   the first of its common buckets alone. Tasks return, for each member, the number of its links and the least member
   it hangs together with; pairs themselves never become rows, however large a group of near copies is.
   Before that, members of a bucket with more than a block's are compared with a pivot each. Those that lie so near to
   one that they must be linked to each other form a ball: their links are counted, not compared, and within a ball no
   blocks meet. So a cluster of near copies is shuffled about once, however large it is.
   Members of hot buckets that share much without being near copies, such as pages of one template, would still meet in
   every pair of blocks. Where that sends more sets, they are filed under their rarest n-grams instead: of a set of n,
   the n - 0.8 n + 1 rarest must hold one of any partner's. Only members under one n-gram are compared, so texts that
   have the template alone in common never meet. Both ways find every pair; the cheaper one is taken by counts.
4. Groups are the connected components of the links, found by rounds of joins on these star-shaped links.

Rows: a text with one to four words is one n-gram of all its words; one without words has none, and no links. Rows
without an id are in no class. Repeated rows are copies of each other; rows with the same id and other texts share
links. Only the id and the text are read; the result has its own columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, new_path
from .substring_dedup import Rolling, mixed, words_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Members of a bucket, and n-grams of them, that one side of a comparison has, about.
BLOCK = 256
BLOCK_GRAMS = 500_000
#: Copies of a member's set, on average, beyond which another way than blocks is weighed for the members of a pivot.
COPIES = 8
#: Counters of n-grams, by hash: 4 MB in each task. n-grams that share one are taken for equally common.
COUNTERS = 1 << 20
#: Stands for a ball in buckets: members that are compared under their rarest n-grams. No pivot has this id.
FILED = -(1 << 63)
#: Members of a bucket that its pivot's n-grams are taken from; what is linked does not depend on them.
PIVOT_SAMPLE = 16
SEED = 20240229


def bands_and_rows(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """The least number of bands of that many rows that finds pairs at the threshold with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def ngrams(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams."""
    own = words_of(text)
    if not own:
        return np.empty(0, np.uint64)
    return np.unique(Rolling(own).windows(min(words, len(own))) ^ np.uint64(len(own) if len(own) < words else 0))


class MinHash:
    def __init__(self, bands: int, rows: int) -> None:
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """One key for each band."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(grams), 2048):
            np.minimum(least, (grams[i : i + 2048, None] * self.a + self.b).min(axis=0), out=least)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            key = mixed((key ^ column) * np.uint64(0x9E3779B97F4A7C15))
        return key


def _signatures(docs: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    """doc, the hash of its n-gram set in two halves, its band keys and its n-grams' number; not for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(bands, rows)
        for batch in batches:
            out: list[tuple[int, int, int, np.ndarray, int]] = []
            for row in range(batch.num_rows):
                grams = ngrams(batch.column(1)[row].as_py(), words)
                if len(grams):
                    one, two = (int(mixed(grams * np.uint64(m)).sum(dtype=np.uint64)) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
                    out.append((batch.column(0)[row].as_py(), one, two, minhash.keys(grams), len(grams)))
            doc, one, two = ([o[k] for o in out] for k in range(3))
            keys = np.concatenate([o[3] for o in out]).view(np.int64) if out else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * bands, pa.int32()), pa.array(keys))
            halves = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), *halves, lists, pa.array([o[4] for o in out], pa.int64())], names=["doc", "k1", "k2", "keys", "n"])

    return docs.mapInArrow(run, "doc bigint, k1 bigint, k2 bigint, keys array<bigint>, n bigint")


def rarest(grams: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """A set's rarest n-grams, the rarest first: so many that of two sets at the threshold both hold the rarest common one."""
    order = np.lexsort((grams, counts[_counter(grams, len(counts))]))
    return grams[order[: len(grams) - math.ceil(threshold * len(grams) - 1e-6) + 1]]


def _counter(grams: np.ndarray, counters: int) -> np.ndarray:
    return (mixed(grams) % np.uint64(counters)).astype(np.int64)


def _with_grams(members: DataFrame, words: int, counts: np.ndarray, threshold: float) -> DataFrame:
    """One row for each place of a class: its full n-gram set goes along, and its n-grams rarer than the place's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "p", "q", "side", "doc", "band", "ball", "keys", "grams", "rarer"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for row in range(batch.num_rows):
                doc, text, keys, places = (c[row].as_py() for c in batch.columns)
                found = ngrams(text, words)
                grams, own = found.tobytes(), np.array(keys, np.int64).tobytes()
                rare = rarest(found, counts, threshold) if any(place["band"] < 0 for place in places) else found[:0]
                at = {gram: k for k, gram in enumerate(rare.view(np.int64).tolist())}
                for place in places:
                    if place["band"] < 0 and place["bucket"] not in at:  # another text of this id is filed there
                        continue
                    rarer = rare[: at[place["bucket"]]].tobytes() if place["band"] < 0 else b""
                    out.append((place["bucket"], place["p"], place["q"], place["side"], doc, place["band"], place["ball"], own, grams, rarer))
                    if (size := size + len(grams) + len(own) + len(rarer)) > 1 << 23:
                        yield _batch(out, names, kinds)
                        out, size = [], 0
            yield _batch(out, names, kinds)

    return members.mapInArrow(run, "bucket bigint, p int, q int, side int, doc bigint, band int, ball bigint, keys binary, grams binary, rarer binary")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements the sets of each pair of left x right have in common."""
    both = np.zeros((len(left), len(right)), np.float32)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    if not len(ids):
        return both
    column = np.cumsum(counts > 1) - 1  # columns: n-grams that two sets or more have
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    use = counts[ids] > 1
    ids, owner = column[ids[use]], owner[use]
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    width = 4096
    for first in range(0, int(ids[-1]) + 1 if len(ids) else 0, width):
        lo, hi = np.searchsorted(ids, [first, first + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[lo:hi], ids[lo:hi] - first] = 1
        both += has[left] @ has[right].T
    return both


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of left x right have a Jaccard similarity of at least the threshold; exact."""
    sizes = np.array([len(s) for s in sets])
    both = common(sets, left, right)
    union = sizes[left][:, None] + sizes[right][None, :] - both
    return both >= threshold * union - 1e-6


def _compared(rows: DataFrame, threshold: float) -> DataFrame:
    """Of each bucket's blocks: for each member with links their number, and the least member it hangs together with."""
    names, kinds = ["doc", "n", "root"], [pa.int64(), pa.int64(), pa.int64()]

    def group(members: list[tuple], p: int, q: int, band: int) -> list[tuple[int, int, int]]:
        if len(members) < 2:
            return []
        docs = np.array([m[1] for m in members])
        side = np.array([m[0] for m in members])
        keys = np.stack([np.frombuffer(m[2], np.int64) for m in members])
        sets = [np.frombuffer(m[3], np.uint64) for m in members]
        left, right = (np.arange(len(docs)),) * 2 if p == q else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if not len(left) or not len(right):
            return []
        hit = linked(sets, left, right, threshold)
        inside = np.array([m[4] is not None for m in members])  # links within a ball are known
        ball = np.array([m[4] or 0 for m in members])
        hit &= ~((ball[left][:, None] == ball[right][None, :]) & inside[left][:, None] & inside[right][None, :])
        if band < 0:  # filed under n-grams: such pairs are compared under a rarer one
            hit &= common([np.frombuffer(m[5], np.uint64) for m in members], left, right) == 0
        for k in range(band):  # such pairs are compared in an earlier bucket
            hit &= keys[left, k][:, None] != keys[right, k][None, :]
        hit &= docs[left][:, None] != docs[right][None, :]
        n = np.bincount(left, hit.sum(axis=1), len(docs)).astype(np.int64)
        if p != q:
            n += np.bincount(right, hit.sum(axis=0), len(docs)).astype(np.int64)
        root = docs.copy()
        while True:  # least members by rounds over the matrix; few rounds, as near copies lie close
            before = root.copy()
            big = np.iinfo(np.int64).max
            root[left] = np.minimum(root[left], np.where(hit, root[right][None, :], big).min(axis=1))
            root[right] = np.minimum(root[right], np.where(hit, root[left][:, None], big).min(axis=0))
            if (root == before).all():
                break
        return [(int(d), int(k), int(r)) for d, k, r in zip(docs, n, root, strict=True) if k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, out = None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for bucket, p, q, side, doc, band, ball, keys, grams, rarer in zip(*columns, strict=True):
                if (bucket, band, p, q) != at:
                    if at:
                        out += group(members, at[2], at[3], at[1])
                    at, members, seen = (bucket, band, p, q), [], set()
                if (doc, hash(grams)) not in seen:  # a repeated row counts once
                    seen.add((doc, hash(grams)))
                    members.append((side, doc, keys, grams, ball, rarer))
            yield _batch(out, names, kinds)
            out = []
        if at:
            yield _batch(group(members, at[2], at[3], at[1]), names, kinds)

    placed = rows.repartition("bucket", "band", "p", "q").sortWithinPartitions("bucket", "band", "p", "q", "side", "doc")
    return placed.mapInArrow(run, "doc bigint, n bigint, root bigint")


def _pivots(hot: DataFrame) -> DataFrame:
    """rep, pivot for members of hot buckets (rep, bucket). A bucket's pivot is its member with the least hash; a member
    takes the least pivot of its buckets, so that near copies agree on one."""
    mine = F.struct(F.xxhash64("rep").alias("h"), "rep")
    pivots = cut(hot.filter(F.col("rep") != F.lit(FILED)).groupBy("bucket").agg(F.min(mine).alias("p")), "pivots")
    return cut(hot.join(pivots, "bucket").groupBy("rep").agg(F.min("p").alias("p")).select("rep", F.col("p.rep").alias("pivot")), "pivot_of")


def _balls(pairs: DataFrame, of: DataFrame, threshold: float, words: int) -> DataFrame:
    """rep, ball, n_ball, root for members of hot buckets (rep, pivot) that lie so near to one set of n-grams that they
    are linked to each other: which ball, how many members it has, and the least of them.

    The pivot's set are the n-grams that more than half of some members have (PIVOT_SAMPLE of
    them; any set would do, a central one gives larger balls). Let p be its size, n a member's, a the n-grams of the
    pivot that it lacks. Two members share p - a - a' n-grams at least, so they reach the threshold t if t n + (1 + t) a
    is at most (1 + t) p / 2 for both. One comparison a member settles what would take one for each pair of them.
    """
    texts = pairs.select(F.col("doc").alias("rep"), "text")
    place = F.row_number().over(Window.partitionBy("pivot").orderBy(F.xxhash64("rep", F.lit(1)), "rep"))
    some = of.withColumn("place", place).filter(F.col("place") <= PIVOT_SAMPLE).join(texts, "rep")
    sampled = some.groupBy("pivot").agg(F.slice(F.collect_list("text"), 1, PIVOT_SAMPLE).alias("texts"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own in batch.column(1).to_pylist():
                grams, counts = np.unique(np.concatenate([ngrams(t, words) for t in own]), return_counts=True)
                out.append(grams[2 * counts > len(own)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["pivot", "mark"])

    marks = cut(sampled.mapInArrow(mark, "pivot bigint, mark binary"), "marks")
    rows = of.join(texts, "rep").join(marks, "pivot").select("rep", "pivot", "text", "mark")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bool] = []
            for row in range(batch.num_rows):
                mark, own = np.frombuffer(batch.column(3)[row].as_py(), np.uint64), ngrams(batch.column(2)[row].as_py(), words)
                missing = len(mark) - len(np.intersect1d(own, mark, assume_unique=True))
                out.append(bool(2 * (threshold * len(own) + (1 + threshold) * missing) <= (1 + threshold) * len(mark) - 1e-6))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.bool_())], names=["rep", "ball", "near"])

    inside = cut(rows.mapInArrow(near, "rep bigint, ball bigint, near boolean").groupBy("rep", "ball").agg(F.bool_and("near").alias("near")).filter("near").drop("near"), "inside")
    sizes = cut(inside.groupBy("ball").agg(F.count(F.lit(1)).alias("n_ball"), F.min("rep").alias("root")).filter("n_ball > 1"), "balls")
    return inside.join(sizes, "ball")


def _layout(members: DataFrame) -> DataFrame:
    """For each bucket of members (rep, n, bucket, ball): its groups of blocks, and the number of blocks. A ball with a
    block's members or more there has blocks of its own, which are not compared with each other; all other members share
    the rest. A bucket of one member or one ball is left out."""
    sizes = members.groupBy("bucket", "ball").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"))
    own = F.when(F.col("m") >= BLOCK, F.col("ball")).alias("g")
    several = F.when(F.col("ball").isNull(), F.col("m")).otherwise(1).alias("sets")
    groups = sizes.select("bucket", own, "m", "grams", several).groupBy("bucket", "g").agg(F.sum("m").alias("m"), F.sum("grams").alias("grams"), F.sum("sets").alias("sets"))
    listed = groups.select("bucket", "sets", F.struct("g", _blocks().alias("k")).alias("group")).groupBy("bucket").agg(F.sort_array(F.collect_list("group")).alias("groups"), F.sum("sets").alias("sets"))
    return _numbered(listed.filter("sets > 1"))


def _numbered(layout: DataFrame) -> DataFrame:
    """The groups (g, k) of each bucket with their first block's number, and the number of all blocks."""
    upto = lambda i: F.aggregate(F.slice("groups", F.lit(1), i), F.lit(0), lambda n, x: n + x["k"])
    return layout.select("bucket", F.transform("groups", lambda x, i: F.struct(x["g"].alias("g"), x["k"].alias("k"), upto(i).alias("first"))).alias("groups"), upto(F.size("groups")).alias("all"))


def _placed(members: DataFrame, layout: DataFrame) -> DataFrame:
    """members (rep, bucket, ball) with mine, the group of blocks they are in there, and copies, how many blocks they meet."""
    among = lambda test: F.get(F.filter("groups", test), F.lit(0))
    mine = F.coalesce(among(lambda x: x["g"] == F.col("ball")), among(lambda x: x["g"].isNull()))
    apart = F.when(F.col("mine.g").isNotNull(), F.col("mine.k")).otherwise(0)
    return members.join(layout, "bucket").withColumn("mine", mine).withColumn("copies", F.col("all") - apart)


def _places(placed: DataFrame) -> DataFrame:
    """rep, place: one row for each block that a member meets. placed has its band, too."""
    blocks = placed.withColumn("own", F.col("mine.first") + F.pmod(F.xxhash64("rep", "bucket"), F.col("mine.k")).cast("int"))
    known = lambda o: F.col("mine.g").isNotNull() & (o >= F.col("mine.first")) & (o < F.col("mine.first") + F.col("mine.k"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("all") - 1), lambda o: ~known(o))).alias("other")
    split = blocks.select("rep", "bucket", "band", "ball", "own", other)
    return split.select("rep", F.struct("bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "band", "ball").alias("place"))


def _counts(members: DataFrame, words: int) -> np.ndarray:
    """How often n-grams of members (text) occur, by COUNTERS counters: what reaches the driver has that bound."""
    counters = COUNTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(counts, _counter(ngrams(text.as_py(), words), counters), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    rows = members.select("text").mapInArrow(run, "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(counters, np.uint32)
    counts[rows["counter"].to_numpy(np.int64)] = np.minimum(rows["n"].to_numpy(np.int64), np.iinfo(np.uint32).max)
    return counts


def _filed(pairs: DataFrame, of: DataFrame, balls: DataFrame, hot: DataFrame, threshold: float, words: int) -> tuple[DataFrame, DataFrame, np.ndarray] | None:
    """Members of hot buckets (rep, n, bucket, ball) to compare under their rarest n-grams and not in blocks: their ids
    (rep), their places, and the counts that rank n-grams. None if blocks cost less everywhere.

    All members of a pivot go one way. Pairs of two such members are compared under n-grams alone, in whatever buckets
    they are, so each is still compared once.
    """
    met = _placed(hot, _layout(hot)).join(of, "rep").groupBy("pivot").agg(F.sum("copies").alias("blocks"))
    wide = cut(of.groupBy("pivot").count().join(met, "pivot").filter(F.col("blocks") > COPIES * F.col("count")).select("pivot", "blocks"), "wide")
    if wide.isEmpty():
        return None
    # tables of their own: few members are then broadcast to the texts, and texts are shuffled once at most
    ids = cut(of.join(wide.select("pivot"), "pivot"), "wide_members")
    members = cut(ids.join(pairs.select(F.col("doc").alias("rep"), "text"), "rep"), "wide_texts")
    counts = _counts(members, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for rep, pivot, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = ngrams(text, words)
                rare = rarest(grams, counts, threshold)
                rare = rare[counts[_counter(rare, len(counts))] > 1]  # those that no other member has are left out
                out.append((np.full((3, len(rare)), [[rep], [pivot], [len(grams)]], np.int64), rare.view(np.int64)))
                if (size := size + len(rare)) > 1 << 18:
                    yield listed(out)
                    out, size = [], 0
            if out:
                yield listed(out)

    def listed(out: list[tuple]) -> pa.RecordBatch:
        columns = [*np.concatenate([o[0] for o in out], axis=1), np.concatenate([o[1] for o in out])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rep", "pivot", "n", "bucket"])

    filed = members.select("rep", "pivot", "text").mapInArrow(run, "rep bigint, pivot bigint, n bigint, bucket bigint")
    filed = cut(filed.join(balls.select("rep", "ball"), "rep", "left"), "filed")
    placed = cut(_placed(filed, _layout(filed)).select("rep", "pivot", "bucket", "ball", "mine", "all", "copies"), "placed")
    cost = placed.groupBy("pivot").agg(F.sum("copies").alias("grams"))
    chosen = cut(wide.join(cost, "pivot", "left").filter(F.coalesce("grams", F.lit(0)) < F.col("blocks")).select("pivot"), "chosen")
    if chosen.isEmpty():
        return None
    return cut(of.join(chosen, "pivot").select("rep"), "filed_reps"), placed.join(chosen, "pivot").withColumn("band", F.lit(-1)), counts


def _blocks() -> Column:
    """How many blocks m members with so many n-grams take."""
    return F.ceil(F.greatest(F.col("m") / BLOCK, F.col("grams") / BLOCK_GRAMS)).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """The least node of each node's connected component, by alternate large-star and small-star rounds.

    edges: doc, root. Nodes without edges are not in the result. Each round keeps the number of edges or lowers it,
    and takes least neighbours by a grouped minimum that is joined back, so a node with many edges is no hot group.
    """
    edges = cut(edges.select("doc", "root").filter("doc <> root").distinct())
    while True:
        both = edges.union(edges.select(F.col("root").alias("doc"), F.col("doc").alias("root")))
        least = cut(both.groupBy("doc").agg(F.least(F.min("root"), F.col("doc")).alias("least")))  # cut: so that hot nodes can be split
        large = both.filter("root > doc").join(least, "doc").select(F.col("root").alias("doc"), F.col("least").alias("root")).filter("doc <> root").distinct()
        down = cut(large.select(F.greatest("doc", "root").alias("doc"), F.least("doc", "root").alias("root")))
        least = cut(down.groupBy("doc").agg(F.min("root").alias("least")))
        small = down.join(least, "doc")
        small = small.filter("root <> least").select(F.col("root").alias("doc"), F.col("least").alias("root")).union(least.select("doc", F.col("least").alias("root"))).distinct()
        new = cut(small)
        changed = new.join(edges, ["doc", "root"], "left_anti").count() + edges.join(new, ["doc", "root"], "left_anti").count()
        edges = new
        if not changed:
            return edges


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (least id with the same n-gram set), n_links (other classes
    at the threshold or above) and group_id (least id of its connected component)."""
    spark = docs.sparkSession
    bands, rows = bands_and_rows(threshold, recall)
    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    path = new_path(spark, "signatures")
    _signatures(pairs.filter(F.col("doc").isNotNull()), bands, rows, words).write.parquet(path)
    signed = spark.read.parquet(path)
    classes = cut(signed.groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.first("keys").alias("keys"), F.first("n").alias("n")))

    place = classes.select("rep", "n", F.posexplode("keys").alias("band", "bucket"))
    # tables of their own before they are joined back: only then can Spark split the rows of a hot bucket
    crowded = cut(place.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams")).filter("m > 1"), "crowded")
    k = _blocks()
    hot = cut(place.join(crowded.filter(k > 1).select("bucket"), "bucket", "left_semi").select("rep", "n", "bucket"), "hot")
    of = _pivots(hot.select("rep", "bucket"))
    balls = cut(_balls(pairs, of, threshold, words), "inside_balls")
    apart, counts = balls.select("rep", "ball"), np.zeros(1, np.uint32)
    filed = _filed(pairs, of, balls, hot.join(apart, "rep", "left"), threshold, words)
    if filed:
        apart = cut(apart.join(filed[0], "rep", "left_anti").unionByName(filed[0].withColumn("ball", F.lit(FILED))), "apart")
        counts = filed[2]
    of_hot = _layout(hot.join(apart, "rep", "left"))
    one = F.array(F.struct(F.lit(None).cast("bigint").alias("g"), k.alias("k")))
    layout = cut(_numbered(crowded.filter(k == 1).select("bucket", one.alias("groups"))).unionByName(of_hot), "layout")
    place = classes.select("rep", "n", "keys").join(apart, "rep", "left").select("rep", "ball", F.posexplode("keys").alias("band", "bucket"))
    split = _places(_placed(place, layout))
    if filed:
        split = split.unionByName(_places(filed[1]))
    places = split.groupBy("rep").agg(F.collect_list("place").alias("places"))
    members = pairs.join(places, pairs["doc"] == places["rep"]).join(classes.select("rep", "keys"), "rep")
    rows = _compared(_with_grams(members.select("doc", "text", "keys", "places"), words, counts, threshold), threshold)
    rows = rows.unionByName(balls.select(F.col("rep").alias("doc"), (F.col("n_ball") - 1).alias("n"), "root"))
    found = cut(rows.groupBy("doc", "root").agg(F.sum("n").alias("n")))

    links = found.groupBy(F.col("doc").alias("rep")).agg(F.sum("n").alias("n_links"))
    groups = components(found).select(F.col("doc").alias("rep"), F.col("root").alias("group"))
    of_class = classes.select("k1", "k2", "rep").join(links, "rep", "left").join(groups, "rep", "left")
    of_doc = signed.select("doc", "k1", "k2").distinct().join(of_class, ["k1", "k2"]).groupBy("doc").agg(F.min("rep").alias("rep"), F.max("n_links").alias("n_links"), F.min("group").alias("group"))
    every = pairs.select("doc").join(of_doc, "doc", "left")
    rep = F.coalesce("rep", "doc")
    return every.select(F.col("doc").alias("doc_id"), rep.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("group", rep).alias("group_id"))


#: Documents to drop up to which their ids are broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that have a smaller id in their group. Rows without an id stay; rows with one id share its fate."""
    drop = cut(similar(docs, doc_id, text).filter("doc_id <> group_id").select(F.col("doc_id").alias("__drop")).distinct())
    if drop.count() <= BROADCAST_IDS:
        drop = F.broadcast(drop)
    return docs.join(drop, F.col(doc_id) == F.col("__drop"), "left_anti")
