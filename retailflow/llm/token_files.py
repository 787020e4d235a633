"""Token files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

Documents are encoded once, into a table in the shared folder. Each task also counts its ids; the sums (a row for
each id reaches the driver, so they are bounded by the vocabulary) rank them, the most frequent first, so that
frequent ids need one byte. Then the documents are sorted by id into ranges, and each range is written as blocks. A block holds the ranks of whole documents: two bits for each rank's length, four
to a control byte, apart from the data bytes. Readers look up lengths by control byte and gather all ranks with
numpy. Blocks and the rank table are columns of Parquet files, so Spark's committers and retries apply to them.

Rows: a null text counts as an empty one and has just the end id. Documents are in ascending order of doc_id,
null ids first; rows with the same id follow the hash of their text. Nothing else of a row is kept.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_stream import _SIMPLE, LONG_CHUNK, SLICES, by_distinct_chunk, byte_alphabet, parts_of, rows_at_once
from .common import discard, written

IDS = np.dtype("<u4")
#: Ids to a block, about: a block ends with the document that fills it.
BLOCK = 1 << 18
LAYOUT = "part int, block int, before bigint, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary"


class _Chunks(dict):
    """Ids of the first chunks that are met, up to so many bytes of them; others are encoded anew each time."""

    def __init__(self, encode: Callable[[str], bytes], keep_bytes: int) -> None:
        self.encode, self.left = encode, keep_bytes

    def __missing__(self, chunk: str) -> bytes:
        found = self.encode(chunk)
        if self.left > 0 and len(chunk) <= LONG_CHUNK:
            self.left -= 160 + len(chunk) + len(found)
            self[chunk] = found
        return found


class LibraryCodec:
    """The tokenizers library's ids of whole texts, each distinct chunk between white space encoded once for some
    megabytes of text. Short chunks, and pieces of others, are remembered, up to `keep_bytes` of each.

    No piece of this tokenizer reaches over white space, so a text's ids are those of its chunks, one after the
    other. Chunks of Latin letters and marks go straight to the library's model, all others through all its steps.
    """

    def __init__(self, path: str, keep_bytes: int = 96 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        alphabet = byte_alphabet()
        self.letters = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(256)}
        self.keep_bytes, self.held = keep_bytes, 0
        self.pieces: dict[str, bytes] = {}
        self.chunks = _Chunks(self._chunk, keep_bytes)

    def forget(self) -> None:
        self.pieces, self.held = {}, 0

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin and the last one's end."""
        if len(texts) == 1 and len(texts[0].as_buffer()) > SLICES:
            found = [by_distinct_chunk(pa.array([part], pa.string()), self.chunks.__getitem__, IDS)[0] for part in parts_of(texts[0].as_py())]
            ids = np.concatenate(found)
            return ids, np.array([0, len(ids)])
        return by_distinct_chunk(texts, self.chunks.__getitem__, IDS)

    def _chunk(self, chunk: str) -> bytes:
        m = _SIMPLE.fullmatch(chunk) if len(chunk) <= LONG_CHUNK else None
        if m:
            word, marks = m.groups()
            return (self._piece(word.lower()) if word else b"") + (self._piece(marks) if marks else b"")
        return np.asarray(self.tokenizer.encode(chunk, add_special_tokens=False).ids, IDS).tobytes()

    def _piece(self, piece: str) -> bytes:
        if (found := self.pieces.get(piece)) is None:
            found = array("I", [t.id for t in self.model.tokenize(piece.translate(self.letters))]).tobytes()
            self.held += 160 + len(piece) + len(found)  # a key, a value and their place, about
            if self.held > self.keep_bytes:
                self.forget()
            self.pieces[piece] = found
        return found


_codecs: dict[str, LibraryCodec] = {}


def codec(path: str) -> LibraryCodec:
    if path not in _codecs:
        _codecs[path] = LibraryCodec(path)
    return _codecs[path]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    size = 1 + (ranks >= 1 << 8).astype(np.int64) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    at = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    for k in range(4):
        has = size > k
        data[at[has] + k] = (ranks[has] >> np.uint32(8 * k)) & np.uint32(255)
    return control.tobytes(), data.tobytes()


#: The four lengths that each control byte stands for.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of control and data bytes."""
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in range(1, 4):
        has = np.flatnonzero(size > k)
        ranks[has] |= raw[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def encoded(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """docs (doc_id, text) as ids, two bytes each where the vocabulary allows; and a row of id counts for each task."""
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    names = ["doc_id", "tie", "ids", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = codec(tokenizer), np.zeros(vocabulary, np.int64)
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            for start, end in rows_at_once(texts, 1 << 22):
                ids, ends = own.ids(texts.slice(start, end - start))
                ids = np.insert(ids, ends[1:], end_id)
                ends = ends + np.arange(len(ends))
                counts += np.bincount(ids, minlength=vocabulary)
                narrow = ids.astype(width)
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - start, [None, pa.py_buffer(ends * narrow.itemsize), pa.py_buffer(narrow)]).cast(pa.binary())
                own_ids = [batch.column(k).slice(start, end - start) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own_ids, binary, pa.nulls(end - start, pa.binary())], names=names)
        yield pa.RecordBatch.from_pylist([{"counts": counts.tobytes()}], pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())]))

    return docs.mapInArrow(run, "doc_id bigint, tie bigint, ids binary, counts binary")


def id_counts(coded: DataFrame) -> DataFrame:
    """How often each id occurs in all documents: at most one row for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                counts = np.frombuffer(value.as_py(), np.int64)
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], names=["id", "n"])

    return coded.filter(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes every whole text and writes the ids, in ascending order of doc_id, to files under path."""
    spark = docs.sparkSession
    vocabulary = max(codec(tokenizer).tokenizer.get_vocab_size(), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("text"))
    coded, held_at = written(encoded(pairs, tokenizer, end_id, vocabulary), "encoded", "zstd")
    counted = {r.id: r.n for r in id_counts(coded).collect()}
    by_rank = sorted(range(vocabulary), key=lambda i: (-counted.get(i, 0), i))
    spark.createDataFrame([*enumerate(by_rank)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.empty(vocabulary, np.uint32)
    ranks[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, before, size = 0, 0, 0
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []

        def take() -> pa.RecordBatch:
            nonlocal block, before, size, held, doc_ids
            control, data = pack(shared.value[np.concatenate(held)])
            lengths = [len(h) for h in held]
            row = {"part": part, "block": block, "before": before, "doc_ids": doc_ids, "lengths": lengths, "control": control, "data": data}
            block, before, size, held, doc_ids = block + 1, before + sum(lengths), 0, [], []
            return pa.RecordBatch.from_pylist([row], _arrow_layout())

        for batch in batches:
            for row in range(batch.num_rows):
                held.append(np.frombuffer(batch.column(1)[row].as_py(), width))
                doc_ids.append(batch.column(0)[row].as_py())
                if (size := size + len(held[-1])) >= BLOCK:
                    yield take()
        if held:
            yield take()

    order = (F.col("doc_id").asc_nulls_first(), F.col("tie"))
    rows = coded.filter(F.col("ids").isNotNull()).select("doc_id", "ids", "tie")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, LAYOUT).write.parquet(f"{path}/blocks")
    discard(spark, held_at)


def _arrow_layout() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("doc_ids", longs), ("lengths", longs), ("control", pa.binary()), ("data", pa.binary())])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit) of each document."""
    blocks = spark.read.schema(LAYOUT).parquet(f"{path}/blocks")
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    n_ids = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = blocks.groupBy("part").agg(F.sum(n_ids).alias("n")).collect()  # a row for each range
    starts, total = {}, 0
    for r in sorted(sizes):
        starts[r.part], total = total, total + r.n
    shared = spark.sparkContext.broadcast((by_rank, starts))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, first = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                part, _, before, doc_ids, lengths, control, data = (column[row] for column in batch.columns)
                sizes = np.asarray(lengths.values, np.int64)
                ids = ids_of[unpack(control.as_py(), data.as_py(), int(sizes.sum()))].view(np.uint8)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)]).cast(pa.binary())
                start = pa.array(first[part.as_py()] + before.as_py() + ends[:-1])
                yield pa.RecordBatch.from_arrays([doc_ids.values, start, binary], names=["doc_id", "start", "ids"])

    return blocks.select("part", "block", "before", "doc_ids", "lengths", "control", "data").mapInArrow(read, "doc_id bigint, start bigint, ids binary")
