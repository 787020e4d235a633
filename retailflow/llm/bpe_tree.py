"""Byte-level BPE by tree reduction: halves are encoded apart and joined by mending what lies at their boundary.

Two monoids are reduced. Tokens of a piece: bytes are halved down to single ones, and two neighbouring token lists are
joined by encoding a window around the boundary anew, which grows until the tokens outside are proven not to change: a
list of tokens is the encoding of its bytes exactly if each two neighbours are the encoding of theirs. (The first merge to
cross a boundary, if there were one, would cross it in the encoding of the two tokens alone, as what happens within two
neighbours depends on nothing outside until then.) So a window is wide enough once its ends fit the tokens next to them.
Pieces of a text: a text is halved down to leaves, which are cut into pieces by the pattern, and neighbours are joined by
matching anew from the last piece that the boundary cannot have touched, until a match begins where one of the right half
does; a piece that the boundary cuts is joined as tokens are.

Texts without runs of blanks, which most are, need no such mending where a blank stands before a word: no piece goes over
that place, whatever is around it. They are cut there, and each distinct chunk of some megabytes of text is encoded once. The trees of all pieces that are new
among them are reduced together, level by level: a level's boundaries are mended at once, as arrays, and those whose window
has to grow one by one.

Decoding concatenates the bytes of both halves of a list of ids, down to leaves that a table gives at once.

Rows: a null text counts as an empty one, which has no ids and decodes to no bytes. Repeated rows give repeated results.
Columns of the input are carried along; if they clash with the names of the new columns, the new ones replace them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_stream import rows_at_once

#: Characters of a leaf of a text, ids of a leaf when decoding.
LEAF_CHARS, LEAF_IDS = 1 << 14, 1 << 14
#: Characters that a match may have looked at beyond its end: the pattern's longest contraction less its first letter.
LOOKED_AT = 3
#: Texts longer than this many bytes are reduced as trees, whatever is in them.
LONG_TEXT = 1 << 20
#: Bytes of a leaf of a piece where many pieces are encoded at once.
LEAF_BYTES = 4
_SHIFT, _NONE = 24, 1 << 62


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of some ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Ranks:
    """A vocabulary of byte strings by rank, as in a file with a base64 text and a rank on each line."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            rows = (line.split() for line in f if line.strip())
            self.rank = {base64.b64decode(text): int(rank) for text, rank in rows}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for text, rank in self.rank.items():
            self.bytes_of[rank] = text
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.single = [self.rank[bytes([b])] for b in range(256)]
        sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)


def merged(data: bytes, rank: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a short byte string: the neighbours whose joint bytes have the least rank are merged first, leftmost first."""
    parts = [data[i : i + 1] for i in range(len(data))]
    ranks = [rank.get(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
    while ranks and (least := min(ranks)) < _NONE:
        at = ranks.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = rank.get(parts[at] + parts[at + 1], _NONE)
        if at:
            ranks[at - 1] = rank.get(parts[at - 1] + parts[at], _NONE)
    return tuple([rank[p] for p in parts])


class TokenTree:
    """The token monoid: encode() halves bytes, join() mends boundaries. Encodings of two neighbours are remembered."""

    def __init__(self, ranks: Ranks, most_pairs: int = 250_000, most_halves: int = 200_000) -> None:
        self.ranks, self.most_pairs, self.most_halves = ranks, most_pairs, most_halves
        self.pairs: dict[int, tuple[int, ...]] = {}
        self.halves: dict[bytes, tuple[int, ...]] = {}

    def forget(self) -> None:
        self.pairs, self.halves = {}, {}

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        """The encoding of the bytes of two tokens."""
        key = (a << _SHIFT) | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs = {}
            found = self.pairs[key] = merged(self.ranks.bytes_of[a] + self.ranks.bytes_of[b], self.ranks.rank)
        return found

    def fits(self, a: int, b: int) -> bool:
        return self.pair(a, b) == (a, b)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of two encodings, one after the other. The window takes in a token of the right side at
        a time, and as many of the left as it changes; once its last token fits the next one, nothing more can change."""
        if not left or not right:
            return left or right
        if self.pair(left[-1], right[0]) == (left[-1], right[0]):
            return left + right
        out = [*left]
        for n, token in enumerate(right):
            if self.pair(out[-1], token) == (out[-1], token):
                return (*out, *right[n:])
            k, window = 1, self.pair(out[-1], token)
            while k < len(out) and not self.fits(out[-k - 1], window[0]):
                k += 1
                window = merged(b"".join([self.ranks.bytes_of[t] for t in out[-k:]]) + self.ranks.bytes_of[token], self.ranks.rank)
            out[len(out) - k :] = window
        return tuple(out)

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of a byte string by merges alone."""
        n = len(data)
        if n > 8:
            return self.join(self.encode(data[: n // 2]), self.encode(data[n // 2 :]))
        found = self.halves.get(data)
        if found is None:
            if n < 2:
                return (self.ranks.single[data[0]],) if data else ()
            if len(self.halves) >= self.most_halves:
                self.halves = {}
            found = self.halves[data] = self.join(self.encode(data[: n // 2]), self.encode(data[n // 2 :]))
        return found

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some byte strings by merges alone, one after the other, and how many each has. A piece's leaves are
        numbered; at each level a node with an odd number is joined with the node before it."""
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        leaves = -(-n // LEAF_BYTES)
        firsts = np.cumsum(leaves) - leaves
        padded = np.zeros(int(leaves.sum()) * LEAF_BYTES, np.uint8)
        padded[spread(firsts * LEAF_BYTES, n)] = np.frombuffer(b"".join(pieces), np.uint8)
        number = spread(np.zeros(len(pieces), np.int64), leaves)
        length = np.minimum(np.repeat(n, leaves) - number * LEAF_BYTES, LEAF_BYTES)
        kinds, kind = np.unique(padded.view("<u4").astype(np.int64) * 8 + length, return_inverse=True)
        coded = [self.encode((k >> 3).to_bytes(LEAF_BYTES, "little")[: k & 7]) for k in kinds.tolist()]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.array([t for ids in coded for t in ids], np.int64)
        ids, counts = ids[spread((np.cumsum(size) - size)[kind], size[kind])], size[kind]
        while number.any():
            ids, counts = self._joined(ids, counts, np.flatnonzero(number & 1))
            number = number[number & 1 == 0] >> 1
        of_piece = np.zeros(len(pieces), np.int64)
        of_piece[n > 0] = counts
        return ids, of_piece

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[int, ...]], np.ndarray]:
        """The encodings of distinct pairs of tokens, and the number of each pair's."""
        keys, kind = np.unique((a << _SHIFT) | b, return_inverse=True)
        return [self.pairs.get(k) or self.pair(k >> _SHIFT, k & ((1 << _SHIFT) - 1)) for k in keys.tolist()], kind

    def _all_fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        windows, kind = self._pairs(a, b)
        size = np.array([len(w) for w in windows], np.int64)[kind]
        return (size == 2) & (np.array([w[0] for w in windows], np.int64)[kind] == a) & (np.array([w[-1] for w in windows], np.int64)[kind] == b)

    def _joined(self, ids: np.ndarray, counts: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes after those at `right` are joined with the ones before them: their ids, and how many each has."""
        starts = np.cumsum(counts) - counts
        at = starts[right] - 1  # the last token of the left side
        windows, kind = self._pairs(ids[at], ids[at + 1])
        size = np.array([len(w) for w in windows], np.int64)
        flat = np.array([t for w in windows for t in w], np.int64)
        head, tail = flat[(begin := np.cumsum(size) - size)][kind], flat[begin + size - 1][kind]
        same = (size[kind] == 2) & (head == ids[at]) & (tail == ids[at + 1])
        # the window is wide enough where its ends fit the tokens next to them; elsewhere it has to grow
        grows = np.zeros(len(right), bool)
        k = np.flatnonzero(~same & (counts[right - 1] > 1))
        grows[k] = ~self._all_fit(ids[at[k] - 1], head[k])
        k = np.flatnonzero(~same & ~grows & (counts[right] > 1))
        grows[k] = ~self._all_fit(tail[k], ids[at[k] + 2])
        becomes = np.ones(len(ids), np.int64)
        mended = np.flatnonzero(~same & ~grows)
        becomes[at[mended]], becomes[at[mended] + 1] = size[kind[mended]], 0
        anew = []
        for r in right[grows].tolist():
            a, b, c = int(starts[r - 1]), int(starts[r]), int(starts[r] + counts[r])
            anew.append(self.join(tuple(ids[a:b].tolist()), tuple(ids[b:c].tolist())))
            becomes[a:c] = 0
            becomes[a] = len(anew[-1])
        out, to = np.repeat(ids, becomes), np.cumsum(becomes) - becomes
        out[spread(to[at[mended]], size[kind[mended]])] = flat[spread(begin[kind[mended]], size[kind[mended]])]
        if anew:
            first = to[starts[right[grows] - 1]]
            out[spread(first, np.fromiter(map(len, anew), np.int64, len(anew)))] = np.array([t for ids in anew for t in ids], np.int64)
        left = np.ones(len(counts), bool)
        left[right] = False
        return out, np.add.reduceat(becomes, starts[left])

    def piece(self, data: bytes) -> tuple[int, ...]:
        """Ids of a piece: the token that it is, or else its merges."""
        whole = self.ranks.rank.get(data)
        return (whole,) if whole is not None else self.encode(data)


@dataclass
class Pieces:
    """An element of the text monoid: where each piece begins, how many ids it has, and all ids."""

    starts: np.ndarray
    counts: np.ndarray
    ids: np.ndarray

    def ids_of(self, k: int) -> tuple[int, ...]:
        at = int(self.counts[:k].sum()) if k >= 0 else len(self.ids) - int(self.counts[k:].sum())
        return tuple(self.ids[at : at + int(self.counts[k])].tolist())


class TextTree:
    """Encodes texts of any kind as trees of halves."""

    def __init__(self, ranks: Ranks, pattern: str, leaf: int = LEAF_CHARS) -> None:
        self.ranks, self.tokens, self.leaf = ranks, TokenTree(ranks), leaf
        self.pattern = regex.compile(pattern)

    def encode(self, text: str) -> np.ndarray:
        return self._node(text).ids

    def _node(self, text: str) -> Pieces:
        if len(text) <= self.leaf:
            return self._pieces(text, self.pattern.finditer(text))
        mid = len(text) // 2
        return self.joined(text, mid, self._node(text[:mid]), self._node(text[mid:]))

    def _pieces(self, text: str, matches, known: dict[tuple[int, int], tuple[int, ...]] | None = None) -> Pieces:
        starts, counts, ids = [], [], []
        for m in matches:
            found = (known or {}).get(m.span())
            if found is None:
                found = self.tokens.piece(m[0].encode("utf-8", "surrogatepass"))
            starts.append(m.start())
            counts.append(len(found))
            ids += found
        return Pieces(np.array(starts, np.int64), np.array(counts, np.int64), np.array(ids, np.int64))

    def joined(self, text: str, mid: int, left: Pieces, right: Pieces) -> Pieces:
        """The pieces of a text from those of its two halves."""
        if not len(left.starts) or not len(right.starts):
            return self._pieces(text, self.pattern.finditer(text))
        # the pieces before `kept` end so early that no match of theirs has looked beyond the middle
        kept = int(np.searchsorted(left.starts, mid - LOOKED_AT, side="right")) - 1
        kept = max(kept, 0)
        begun = right.starts + mid
        anew, sync = [], len(begun)
        for m in self.pattern.finditer(text, int(left.starts[kept])):
            at = int(np.searchsorted(begun, m.start()))
            if at < len(begun) and begun[at] == m.start():
                sync = at
                break
            anew.append(m)
        known = {}
        if anew and sync:
            # a piece that the middle cuts in two: join the tokens of both parts
            first, end = int(left.starts[-1]), int(begun[1]) if len(begun) > 1 else len(text)
            a, b = left.ids_of(-1), right.ids_of(0)
            for m in anew:
                whole = m[0].encode("utf-8", "surrogatepass") if m.span() == (first, end) else b""
                if len(a) > 1 and len(b) > 1 and begun[0] == mid and whole and whole not in self.ranks.rank:
                    known[m.span()] = self.tokens.join(a, b)
        between = self._pieces(text, anew, known)
        head = int(left.counts[:kept].sum())
        tail = int(right.counts[:sync].sum())
        return Pieces(
            np.concatenate([left.starts[:kept], between.starts, begun[sync:]]),
            np.concatenate([left.counts[:kept], between.counts, right.counts[sync:]]),
            np.concatenate([left.ids[:head], between.ids, right.ids[tail:]]),
        )


#: White space as the pattern's \s takes it.
_BLANKS = pa.array(["", *(c for c in map(chr, range(0x3001)) if regex.match(r"\s", c))])
#: Letters, then marks without an apostrophe.
_SIMPLE = r"^(?P<word> ?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


def _numbers(codes: pa.Array) -> np.ndarray:
    return codes.to_numpy(zero_copy_only=False).astype(np.int64)


class TreeCodec:
    """Encodes and decodes columns of texts. Pieces are remembered, up to `keep_bytes` of them."""

    def __init__(self, path: str, pattern: str, keep_bytes: int = 64 << 20) -> None:
        self.ranks, self.keep_bytes = Ranks(path), keep_bytes
        self.tree = TextTree(self.ranks, pattern)
        self.pattern = self.tree.pattern
        self.kind = np.dtype("<u2" if len(self.ranks.bytes_of) <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def forget(self) -> None:
        self.pieces, self.held = {}, 0
        self.tree.tokens.forget()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        found = [self.pieces.get(p) for p in pieces]
        new = [k for k, ids in enumerate(found) if ids is None]
        data = [pieces[k].encode("utf-8", "surrogatepass") for k in new]
        whole = [self.ranks.rank.get(d, -1) for d in data]
        ids, counts = self.tree.tokens.encode_all([d for d, w in zip(data, whole, strict=True) if w < 0])
        made, ends = ids.astype(self.kind).tobytes(), iter((np.cumsum(counts) * self.kind.itemsize).tolist())
        end = 0
        for k, w in zip(new, whole, strict=True):
            if w < 0:
                start, end = end, next(ends)
                found[k] = made[start:end]
            else:
                found[k] = w.to_bytes(self.kind.itemsize, "little")
            if len(pieces[k]) <= 64:
                self.held += 160 + len(pieces[k]) + len(found[k])  # a key, a value and their place, about
                if self.held > self.keep_bytes:
                    self.pieces, self.held = {}, 0
                self.pieces[pieces[k]] = found[k]
        return found

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and how many each has."""
        simple = pc.extract_regex(chunks, _SIMPLE)
        odd = simple.is_null().to_numpy(zero_copy_only=False)
        words, marks = (pc.struct_field(simple.drop_null(), f).dictionary_encode() for f in (0, 1))
        others = [[m[0] for m in self.pattern.finditer(c)] for c in chunks.take(pa.array(np.flatnonzero(odd))).to_pylist()]
        named = pa.concat_arrays([words.dictionary, marks.dictionary, pa.array([p for c in others for p in c], chunks.type)]).dictionary_encode()
        code, n = _numbers(named.indices), len(words.dictionary)
        counts = np.full(len(chunks), 2)
        counts[odd] = [len(c) for c in others]
        starts = np.cumsum(counts) - counts
        pieces = np.empty(int(counts.sum()), np.int64)
        pieces[starts[~odd]] = code[_numbers(words.indices)]
        pieces[starts[~odd] + 1] = code[n + _numbers(marks.indices)]
        pieces[spread(starts[odd], counts[odd])] = code[n + len(marks.dictionary) :]
        found = self._pieces(named.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        ids = np.frombuffer(b"".join(found), self.kind)[spread((np.cumsum(size) - size)[pieces], size[pieces])]
        ends = np.concatenate([[0], np.cumsum(size[pieces])])
        return ids, ends[starts + counts] - ends[starts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin and the last one's end."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        words, codes = coded.dictionary, _numbers(coded.indices)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        at = np.zeros(len(codes), bool)
        at[ends[:-1]] = True
        firsts, place = np.unique(codes[at], return_inverse=True)
        odd = pc.is_in(pc.utf8_slice_codeunits(words, 0, 1), value_set=_BLANKS).to_numpy(zero_copy_only=False)
        rows_odd = np.add.reduceat(odd[codes] & ~at, ends[:-1]) > 0 if len(codes) else np.zeros(0, bool)
        rows_odd |= odd[codes[at]]
        codes[at] = len(words) + place
        # rows with an odd word are trees of their own: what their words get here is not used
        spaced = pc.if_else(pa.array(odd), "", pc.binary_join_element_wise("", words, " "))
        known, size = self._chunks(pa.concat_arrays([spaced, pc.if_else(pa.array(odd[firsts]), "", words.take(pa.array(firsts)))]))
        n = size[codes]
        ids = known[spread((np.cumsum(size) - size)[codes], n)]
        bounds = np.concatenate([[0], np.cumsum(n)])[ends]
        if not rows_odd.any():
            return ids, bounds
        parts = [self.tree.encode(texts[r].as_py()).astype(self.kind) if rows_odd[r] else ids[bounds[r] : bounds[r + 1]] for r in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of some ids: those of their left half, then those of their right half."""
        if len(ids) > LEAF_IDS:
            mid = len(ids) // 2
            return self.decode(ids[:mid]) + self.decode(ids[mid:])
        n = self.ranks.sizes[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.ranks.starts[ids] - (ends - n), n)
        return self.ranks.all_bytes[at].tobytes()


_codecs: dict[tuple[str, str], TreeCodec] = {}


def codec(path: str, pattern: str) -> TreeCodec:
    """One for each worker process, file and pattern; what it remembers goes when a task ends."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = TreeCodec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str, text: str = "text", flush: int = 4 << 20) -> DataFrame:
    """docs with `ids` (array of int) and `decoded` (binary, the bytes that the ids stand for) of each row's whole text.

    ranks: the vocabulary's file, present on every machine. pattern: cuts a text into the pieces that are encoded apart.
    flush: bytes of text after which rows go back to Spark.
    """
    rest = [c for c in docs.columns if c not in ("ids", "decoded", "__text")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        try:
            for batch in batches:
                for start, end in rows_at_once(batch.column(len(rest)), flush):
                    part = batch.slice(start, end - start)
                    texts = pc.fill_null(part.column(len(rest)), "")
                    if len(texts) == 1 and len(texts[0].as_buffer()) > LONG_TEXT:
                        ids = own.tree.encode(texts[0].as_py()).astype(own.kind)
                        bounds = np.array([0, len(ids)])
                    else:
                        ids, bounds = own.encode(texts)
                    decoded = [own.decode(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], lists, pa.array(decoded, pa.binary())], names=[*rest, "ids", "decoded"])
        finally:
            own.forget()

    return docs.select(*rest, F.col(text).alias("__text")).mapInArrow(run, schema)
