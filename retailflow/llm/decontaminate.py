"""Benchmark decontamination: BM25 over an inverted index of the test items, searched with block-max WAND.

Each passage of each document (two strides of words, from each stride on) is a query against the test items. Impacts
are divided by the score of the item's own words, so a score is the share of an item that a passage holds, and one
threshold fits items of any length. Items are in blocks; each term's posting list is cut into runs, one for each block
that it occurs in, with the greatest impact there. The search is WAND's, for many passages side by side: of a passage's
terms, in order of their greatest impact, the first ones that together stay below half the threshold are passed over;
the runs of the others open blocks. Only blocks whose sum of maxima, with what was passed over, reaches the threshold
are looked at with all terms, by skips into the sorted runs, and only those whose full bound reaches it have their
postings scored. So the work follows the runs that are touched, not the number of blocks. All items at or above the
threshold are retrieved. Each is verified: its question (all sentences but the last) and its answer (the last) must
both have most of their word n-grams near the passage.

An index holds INDEX_CHARS of items at most and is sent to all tasks; more items make more indexes and as many rounds
over the documents. Scores depend on the statistics of all items, so the result is the same with one index or many.
Documents are judged where they are read, without a shuffle.

Rows: a null text, of a document or an item, has no words and matches nothing, nor does an item of fewer than five words
(`least_terms`). Items with the same id are one each.
Repeated rows are judged each. Other columns are kept by `clean`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_stream import rows_at_once
from .common import cut

#: Characters of test items in one index (some six bytes of memory each); a round over the documents for each such part.
INDEX_CHARS = 10_000_000
K1, B = 1.2, 0.75
_MARKS = re.compile(r"\W+")


def term(chunk: str) -> str:
    """A word as the index has it: lower case, letters, digits and underscores only."""
    return _MARKS.sub("", chunk.lower().replace("ς", "σ"))


def terms_of(chunks: pa.Array) -> pa.Array:
    """The same for many words; '' for a chunk without a letter or digit."""
    return pc.replace_substring_regex(pc.replace_substring(pc.utf8_lower(chunks), "ς", "σ"), r"[^\pL\pN_]+", "")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The terms of all sentences but the last, and of the last; of one sentence, its last third is the answer."""
    sentences = [s for s in ([t for t in map(term, s.split()) if t] for s in re.split(r"(?<=[.?!])\s+", text)) if s]
    if len(sentences) > 1:
        return [t for s in sentences[:-1] for t in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


@dataclass(frozen=True)
class Settings:
    stride: int = 32
    threshold: float = 0.6
    overlap: float = 0.6
    ngram: int = 5
    block: int = 8
    least_terms: int = 5  # an item of fewer words says too little to tell that a text holds it


@dataclass(frozen=True)
class Statistics:
    """What scores depend on beyond an item's own words: of all items, also those of other indexes."""

    entries: int
    words: int
    df: dict[str, int]  # entries that hold a term


def entries_of(text: str, settings: Settings) -> tuple[list[str], list[str], list[list[str]]]:
    """The question's terms, the answer's, and both in entries no longer than a stride; no entries for too short an item."""
    question, answer = question_and_answer(text)
    words, stride = question + answer, settings.stride
    if len(words) < settings.least_terms:
        return question, answer, []
    n = -(-len(words) // stride)
    ends = [len(words) * k // n for k in range(n + 1)] if n else [0]
    return question, answer, [words[a:b] for a, b in zip(ends, ends[1:], strict=False)]


class TestItems:
    """Inverted index of items, cut into entries no longer than a stride."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings, of_all: Statistics | None = None) -> None:
        self.settings = settings
        self.terms: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray, np.ndarray]] = []
        entries: list[tuple[int, np.ndarray]] = []
        ids = lambda words: np.array([self.terms.setdefault(t, len(self.terms)) for t in words], np.int64)
        for item_id, text in items:
            question, answer, pieces = entries_of(text, settings)
            if pieces:
                self.items.append((item_id, ids(question), ids(answer)))
                entries += [(len(self.items) - 1, ids(piece)) for piece in pieces]
        common = np.bincount(np.concatenate([*(np.unique(e[1]) for e in entries), np.empty(0, np.int64)]).astype(np.int64), minlength=len(self.terms))
        entries.sort(key=lambda e: tuple(sorted(set(e[1].tolist()), key=lambda t: (-common[t], t))[:4]))  # like items share blocks: tighter bounds
        self.item_of = np.array([e[0] for e in entries], np.int64)
        self.n_terms, self.blocks = len(self.terms), -(-len(entries) // settings.block)
        self.names = pa.array([*self.terms], pa.string())
        self._postings([e[1] for e in entries], of_all)

    def _postings(self, entries: list[np.ndarray], of_all: Statistics | None) -> None:
        sizes = np.array([len(e) for e in entries], np.int64)
        of = np.repeat(np.arange(len(entries)), sizes)
        pair, tf = np.unique(np.concatenate([*entries, np.empty(0, np.int64)]) * max(len(entries), 1) + of, return_counts=True)
        word, entry = pair // max(len(entries), 1), pair % max(len(entries), 1)
        if of_all:
            df, n, mean = np.array([of_all.df[t] for t in self.terms], np.int64), of_all.entries, of_all.words / of_all.entries
        else:
            df, n, mean = np.bincount(word, minlength=self.n_terms), len(entries), sizes.mean() if len(sizes) else 1
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        impact = idf[word] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[entry] / max(mean, 1)))
        impact /= np.bincount(entry, impact, max(len(entries), 1))[entry]
        self.entry, self.impact = entry, impact  # by term, then entry
        block = entry // self.settings.block
        first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (block[1:] != block[:-1])])) if len(word) else np.empty(0, np.int64)
        self.run_key, self.run_start = word[first] * self.blocks + block[first], np.append(first, len(word))
        self.run_most = np.maximum.reduceat(impact, first) if len(first) else impact
        self.runs = np.searchsorted(word[first], np.arange(self.n_terms + 1))
        self.term_most = np.maximum.reduceat(impact, self.run_start[self.runs[:-1]]) if self.n_terms else impact
        self.by_impact = np.argsort(self.term_most, kind="stable")  # terms in the order in which a passage's are passed over
        self.place_of = np.argsort(self.by_impact)

    def retrieved(self, ids: np.ndarray, begins: np.ndarray | None = None) -> list[tuple[int, int, float]]:
        """(item, first word of the passage, score) of all passages and items at or above the threshold.

        ids: the term of each word, -1 for words that no item has. begins: which strides begin a passage; all but
        the last, if not given.
        """
        stride = self.settings.stride
        strides = -(-len(ids) // stride)
        if begins is None:
            begins = np.arange(strides) < max(strides - 1, 1)
        known = np.flatnonzero(ids >= 0)
        found: list[tuple[int, int, float]] = []
        at_once = 1 << 14  # strides; the last one is seen again, so that no passage is lost
        for low in range(0, strides, at_once - 1):
            high = min(low + at_once, strides)
            here = known[np.searchsorted(known, low * stride) : np.searchsorted(known, high * stride)]
            # a term counts once in a passage, which is two strides
            part, place = here // stride, self.place_of[ids[here]]
            both = np.sort(np.concatenate([part * self.n_terms + place, (part[part > low] - 1) * self.n_terms + place[part > low]]))
            passage, place = np.divmod(both[np.diff(both, prepend=-1) > 0], max(self.n_terms, 1))
            use = begins[passage] & ((passage < high - 1) | (high == strides))
            found += self._reached(passage[use], self.by_impact[place[use]])
        return sorted(found, key=lambda f: f[1])

    def _reached(self, passage: np.ndarray, word: np.ndarray) -> list[tuple[int, int, float]]:
        """The same for pairs of passage and term; passages ascend, and within each the greatest impacts of its terms."""
        if not len(passage):
            return []
        least = self.settings.threshold - 1e-9
        most = self.term_most[word]
        # Terms of little impact, together below half the threshold, open no block: their lists, the longest, stay shut.
        first = np.flatnonzero(np.diff(passage, prepend=-1))
        upto = np.cumsum(most)
        upto -= np.repeat((upto - most)[first], np.diff(first, append=len(passage)))
        shut = upto < least / 2
        rest = np.bincount(passage, np.where(shut, most, 0))
        p, w = passage[~shut], word[~shut]
        count = self.runs[w + 1] - self.runs[w]
        run = np.arange(int(count.sum())) + np.repeat(self.runs[w] - (np.cumsum(count) - count), count)
        opened = np.repeat(p, count) * self.blocks + self.run_key[run] % self.blocks
        order = np.argsort(opened)
        opened = opened[order]
        first = np.flatnonzero(np.diff(opened, prepend=-1))
        bound = np.add.reduceat(self.run_most[run[order]], first) if len(first) else np.empty(0)
        place = opened[first]
        place = place[bound + rest[place // self.blocks] >= least]
        found: list[tuple[int, int, float]] = []
        for k in range(0, len(place), 1 << 12):
            found += self._scored(passage, word, place[k : k + (1 << 12)], least)
        return found

    def _scored(self, passage: np.ndarray, word: np.ndarray, place: np.ndarray, least: float) -> list[tuple[int, int, float]]:
        """Entries at or above the threshold in some blocks that may hold one: bounds with all terms, then postings."""
        at, block = np.divmod(place, self.blocks)
        lo, hi = np.searchsorted(passage, at), np.searchsorted(passage, at, "right")
        n = hi - lo
        of = np.repeat(np.arange(len(place)), n)
        wanted = word[np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)] * self.blocks + block[of]
        run = np.minimum(np.searchsorted(self.run_key, wanted), len(self.run_key) - 1)
        hit = self.run_key[run] == wanted
        run, of = run[hit], of[hit]
        good = (np.bincount(of, self.run_most[run], len(place)) >= least)[of]
        run, of = run[good], of[good]
        first, many = self.run_start[run], (self.run_start[1:] - self.run_start[:-1])[run]
        posting = np.arange(int(many.sum())) + np.repeat(first - (np.cumsum(many) - many), many)
        size = self.settings.block
        score = np.bincount(np.repeat(of, many) * size + self.entry[posting] % size, self.impact[posting], len(place) * size)
        hits = np.flatnonzero(score >= least)
        return [(int(self.item_of[block[h // size] * size + h % size]), int(at[h // size]) * self.settings.stride, float(score[h])) for h in hits]

    def contaminating(self, ids: np.ndarray) -> dict[int, tuple[float, float, float, int]]:
        """item id -> score, question overlap, answer overlap and first word of the passage, of verified items."""
        return self.contaminating_all([ids])[0]

    def contaminating_all(self, documents: list[np.ndarray]) -> list[dict[int, tuple[float, float, float, int]]]:
        """The same for many documents at once: one after the other, each with an empty stride behind it."""
        stride = self.settings.stride
        strides = np.array([-(-len(ids) // stride) for ids in documents], np.int64)
        first = np.cumsum(strides + 1) - strides - 1
        stream = np.full(int((strides + 1).sum()) * stride, -1, np.int64)
        begins = np.zeros(int((strides + 1).sum()), bool)
        for at, n, ids in zip(first, strides, documents, strict=True):
            stream[at * stride : at * stride + len(ids)] = ids
            begins[at : at + max(n - 1, 1)] = True
        best: list[dict[int, tuple[float, float, float, int]]] = [{} for _ in documents]
        for item, start, score in self.retrieved(stream, begins):
            k = int(np.searchsorted(first, start // stride, "right")) - 1
            ids, start = documents[k], start - int(first[k]) * stride
            item_id, question, answer = self.items[item]
            near = ids[max(0, start - len(question) - len(answer)) : start + 2 * stride + len(question) + len(answer)]
            shares = [self._share(part, near) for part in (question, answer)]
            known = best[k].get(item_id)
            # rounded, as sums in another order differ in their last digits; of equal passages the first counts
            if min(shares) >= self.settings.overlap and (known is None or (round(score, 9), -start) > (round(known[0], 9), -known[3])):
                best[k][item_id] = (score, *shares, start)
        return best

    def _share(self, part: np.ndarray, near: np.ndarray) -> float:
        n = min(self.settings.ngram, len(part))
        if not n:
            return 1.0
        own, there = (set(zip(*(x[k : len(x) - n + 1 + k].tolist() for k in range(n)), strict=True)) for x in (part, near))
        return len(own & there) / len(own)

    def ids_of(self, texts: pa.Array) -> list[np.ndarray]:
        """The terms of each text, -1 for words that no item has; null has none. Distinct chunks are looked up once."""
        lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        chunks = lists.flatten().dictionary_encode()
        terms = terms_of(chunks.dictionary)
        known = pc.fill_null(pc.index_in(terms, self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known[pc.equal(terms, "").to_numpy(zero_copy_only=False)] = -2  # no word at all
        ids = known[chunks.indices.to_numpy(zero_copy_only=False)]
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return [x[x != -2] for x in np.split(ids, ends[1:-1])] if len(texts) else []


def _indexes(benchmark: DataFrame, item_id: str, text: str, settings: Settings) -> Iterator[tuple[TestItems, bool]]:
    """An index of all items or, where these are too long for one, one for each part, with the statistics of all; and
    whether it is one of several. A part's items come to the driver when its turn comes."""
    items = benchmark.filter(F.col(text).isNotNull()).select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t"))
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    rounds = max(1, -(-chars // INDEX_CHARS))
    if rounds == 1:
        yield TestItems(sorted(((r.i, r.t) for r in items.distinct().collect()), key=str), settings), False
        return
    # by id and text, so that items of one id, or of none, are spread as well
    parts = items.distinct().withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(rounds)).cast("int"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                entries = entries_of(t, settings)[2]
                df = Counter(w for e in entries for w in set(e))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part] * (len(df) + 1), pa.int32()), "term": [None, *df], "n": pa.array([len(entries), *df.values()], pa.int64()), "words": pa.array([sum(map(len, entries))] + [0] * len(df), pa.int64())})

    counts = cut(parts.select("t", "part").mapInArrow(count, "part int, term string, n bigint, words bigint"), "item_terms")
    total = counts.filter("term is null").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    df = cut(counts.filter("term is not null").groupBy("term").agg(F.sum("n").alias("n")), "item_df")
    for k in range(rounds):
        own = counts.filter((F.col("part") == k) & F.col("term").isNotNull()).select("term").distinct()
        stats = Statistics(total.n, total.words, {r.term: r.n for r in own.join(df, "term").collect()})
        rows = parts.filter(F.col("part") == k).collect()  # INDEX_CHARS of text, about
        yield TestItems(sorted(((r.i, r.t) for r in rows), key=str), settings, stats), True


def _judge(docs: DataFrame, items: TestItems, text: str, schema: str | None, several: bool) -> DataFrame:
    """Rows of contaminated documents and items, or, without a schema, docs without the contaminated. With several indexes
    the rows are written, and the index is dropped before the next one is built."""
    index = docs.sparkSession.sparkContext.broadcast(items)
    where = docs.columns.index(text)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
        for batch in batches:
            for start, end in rows_at_once(batch.column(where), 1 << 20):
                part = batch.slice(start, end - start)
                yield part, index.value.contaminating_all(index.value.ids_of(part.column(where)))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
        for part, found in judged(batches):
            doc_ids = part.column(1 - where).to_pylist()
            out = [(d, item, *facts) for d, own in zip(doc_ids, found, strict=True) for item, facts in own.items()]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in judged(batches):
            yield part.filter(pa.array([not own for own in found], pa.bool_()))

    out = docs.mapInArrow(pairs if schema else clean_rows, schema or docs.schema)
    if several:
        out = cut(out, "judged")
        index.destroy()
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap and first_word for each document and item that it holds."""
    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double, first_word bigint"
    out = None
    for items, several in _indexes(benchmark, item_id, item_text, settings):
        found = _judge(pairs, items, "text", schema, several)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the documents that hold a test item."""
    for items, several in _indexes(benchmark, item_id, item_text, settings):
        docs = _judge(docs, items, text, None, several)
    return docs
