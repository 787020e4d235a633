"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of presences: the distinct character n-grams of one to three letters
that both hold, over the root of the product of how many each holds. Landmarks (training texts, as many of each
language) give every text a row of kernel values; Nyström features whiten these with the landmarks' own kernel
matrix, and one-versus-rest kernel ridge regression is solved on them. A batch of texts is scored with two matrix
products: n-gram presences by the landmarks' presences, and the scaled rows by the coefficients.

Training takes a bounded sample: of each of the `most_langs` most frequent languages the `per_lang` rows with the
least hash of id and text, of at most `most_chars` characters. No more rows reach the driver, also if ids are equal.
Everything else runs over all rows and whole texts, where the rows are.

Rows: a null text, or one without a letter, is 'und' with score 0. Repeated rows get the same result each. Rows
without an id or a language are never learned from. If there is nothing to learn from, all texts are 'und'.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 18
NGRAMS = (1, 2, 3)
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass(frozen=True)
class Settings:
    per_lang: int = 400
    most_chars: int = 20_000
    landmarks: int = 48  # of each language
    most_landmarks: int = 512
    most_langs: int = 128
    ridge: float = 0.1
    sharpness: float = 6.0


def presences(text: str | None, table: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that a text holds. table: zeros, one for each bucket; left as it was."""
    letters = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), "<u4") * _STEPS[0]
    grams = np.zeros(len(codes), np.uint32)
    for n in NGRAMS:
        if len(codes) < n:
            break
        grams = (grams[: len(codes) - n + 1] ^ codes[n - 1 :]) * _STEPS[1]
        mixed = (grams ^ (grams >> np.uint32(15)) ^ np.uint32(n)) * _STEPS[2]
        table[mixed >> np.uint32(32 - BITS)] = 1
    found = np.flatnonzero(table)
    table[found] = 0
    return found


class Model:
    """Landmarks' presences by column, and the coefficients of each language."""

    def __init__(self, texts: list[str], langs: list[str], settings: Settings) -> None:
        table = np.zeros(1 << BITS, np.uint8)
        rows = [(p, lang) for p, lang in ((presences(t, table), lang) for t, lang in zip(texts, langs, strict=True)) if len(p)]
        self.langs = sorted({lang for _, lang in rows})
        self.sharpness = settings.sharpness
        if not self.langs:
            return
        each = max(1, min(settings.landmarks, settings.most_landmarks // len(self.langs)))
        marks = [p for lang in self.langs for p in [p for p, own in rows if own == lang][:each]]
        used = np.unique(np.concatenate(marks))
        self.column = np.full(1 << BITS, -1, np.int32)
        self.column[used] = np.arange(len(used))
        self.marks = np.zeros((len(used), len(marks)), np.float32)
        for k, p in enumerate(marks):
            self.marks[self.column[p], k] = 1
        self.roots = np.sqrt(self.marks.sum(axis=0))
        own = (self.marks.T @ self.marks / np.outer(self.roots, self.roots)).astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        whiten = vectors / np.sqrt(np.maximum(values, 1e-6 * values[-1]))
        features = np.hstack([self.kernel([p for p, _ in rows]) @ whiten, np.ones((len(rows), 1))])
        wanted = np.array([[1.0 if own == lang else -1.0 for lang in self.langs] for _, own in rows])
        weight = 1 / np.array([sum(o == lang for _, o in rows) for _, lang in rows])  # languages count alike
        gram = features.T @ (features * weight[:, None]) + settings.ridge / len(rows) * np.eye(features.shape[1])
        solved = np.linalg.solve(gram, features.T @ (wanted * weight[:, None]))
        self.coefficients, self.offset = (whiten @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32)

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts (by their presences) and landmarks."""
        out = np.empty((len(rows), self.marks.shape[1]), np.float32)
        for start in range(0, len(rows), 64):
            some = rows[start : start + 64]
            has = np.zeros((len(some), len(self.marks)), np.float32)
            for k, p in enumerate(some):
                columns = self.column[p]
                has[k, columns[columns >= 0]] = 1
            sizes = np.sqrt([max(len(p), 1) for p in some])
            out[start : start + 64] = has @ self.marks / np.outer(sizes, self.roots)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and a score from 0 to 1."""
        table = np.zeros(1 << BITS, np.uint8)
        rows = [presences(t, table) for t in texts]
        if not self.langs:
            return ["und"] * len(rows), np.zeros(len(rows))
        scores = (self.kernel(rows) @ self.coefficients + self.offset).astype(np.float64)
        share = np.exp(self.sharpness * (scores - scores.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        empty = np.array([not len(p) for p in rows], bool)
        langs = ["und" if e else self.langs[b] for b, e in zip(best, empty, strict=True)]
        return langs, np.where(empty, 0.0, share[np.arange(len(rows)), best])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: the crc32 of the id, as text, leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages of docs, from a bounded sample of their distinct texts: those of each language with the
    least hashes. Repeats of a text count once, so that they crowd out no other text and no language."""
    usable = docs.filter(F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= settings.most_chars))
    usable = usable.select(F.pmod(F.xxhash64(text), F.lit(1 << 31)).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("distinct")).orderBy(F.desc("n"), "lang").limit(settings.most_langs).collect()
    if not counts:
        return Model([], [], settings)
    # about twice as many texts of a language have a hash below its bound, whatever the number of tasks; then exactly so many
    bounds = F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(min(1 << 31, -(-2 * settings.per_lang * (1 << 31) // max(r.distinct, 1)))).cast("bigint"))])
    near = usable.filter(F.col("h") < F.try_element_at(bounds, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = near.withColumn("place", place).filter(F.col("place") <= settings.per_lang)
    rows = sorted((r.lang, r.place, r.text) for r in sample.select("lang", "place", "text").collect())
    return Model([t for _, _, t in rows], [k for k, _, _ in rows], settings)


def predict(docs: DataFrame, model: Model, text: str = "text", at_once: int = 256) -> DataFrame:
    """docs with lang_pred and score; other columns of these names are replaced."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "__text")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is set by the settings
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                langs, scores = shared.value.predict(part.column(len(rest)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(langs, pa.string()), pa.array(scores)], names=[*rest, "lang_pred", "score"])

    return docs.select(*rest, F.col(text).alias("__text")).mapInArrow(run, schema)
