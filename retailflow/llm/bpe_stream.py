"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

A merge list decides a token once enough symbols to its right are known. How many is a property of the
list alone: `sufficient_lookahead` computes a bound from it. The encoder keeps the symbols of the piece
at hand, emits each token that ends at least that far before the last known symbol, and restarts behind it,
so its memory does not depend on the length of a text or of a word. The decoder turns token ids into bytes
and bytes into text, also incrementally.

Rows: a null text counts as an empty one, which has no ids and decodes to ''. Repeated rows give repeated
results. Columns of the input beyond those named are carried along; if they clash with the names of the new
columns, the new ones replace them.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the tokenizer's file format: the mark of a word's end, and the pieces its text is cut into.
WORD_END = "</w>"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_PIECE = regex.compile(rf"(?P<contraction>{'|'.join(CONTRACTIONS)})|(?P<letters>\p{{L}}+)|(?P<number>\p{{N}})|(?P<rest>[^{SPACE}\p{{L}}\p{{N}}]+)")
_GAP = re.compile(r"[\x20\x09-\x0D]+")
_BITS = 20
_ID = (1 << _BITS) - 1
_NONE = 1 << 62
#: A chunk of text without white space that is longer than this is streamed and not kept in a cache.
LONG_CHUNK = 96
#: Characters of a long chunk that go into the transducer at a time, and bytes into the decoder.
SLICE = 1 << 16
#: Characters of a long text that are cut into chunks at a time.
SLICES = 1 << 20


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where Latin-1 prints it, else the next one from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


#: Blocks that hold all characters with a combining class or a decomposition.
_COMPOSED = ((0x300, 0x3400), (0xA600, 0xAC00), (0xF900, 0x20000))


def composing() -> frozenset[str]:
    """Characters that may fuse with the one before them under NFC; a text can be cut before any other."""
    found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for code in (c for block in _COMPOSED for c in range(*block)):
        c = chr(code)
        if unicodedata.combining(c):
            found.add(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and parts[0][0] != "<":
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


class MergeList:
    """A tokenizer file's vocabulary and merges, by id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of: dict[int, str] = {i: s for s, i in (vocab | self.special).items()}
        self.rules: list[tuple[int, int, int]] = []
        for rule in spec["model"]["merges"]:
            left, right = rule if isinstance(rule, list) else rule.split(" ")
            self.rules.append((vocab[left], vocab[right], vocab[left + right]))
        self.merge = {(a << _BITS) | b: (rank << _BITS) | c for rank, (a, b, c) in reversed([*enumerate(self.rules)])}
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.final = [vocab[c + WORD_END] for c in alphabet]
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.lookahead = sufficient_lookahead(self.rules, {*self.inner, *self.final})


def sufficient_lookahead(rules: list[tuple[int, int, int]], base: set[int]) -> int:
    """Symbols that must be known behind a token before it can no longer change.

    Encode a text and a prefix of it with the same list, rule by rule. Both agree up to some point, at first
    the prefix's end. A rule (a, b) moves that point left, by the length of a, only if b starts at the point in
    one of the two; after an earlier move by (a', b') what starts there begins with a'. So b has a' among its
    leftmost parts, and the moves form a chain of rules of rising rank. The longest chain bounds the distance.
    """
    length, left_part = dict.fromkeys(base, 1), {}
    reach: dict[int, int] = {}  # the longest chain so far that ends with a rule whose left side is this token
    most = 0
    for a, b, c in rules:
        if a not in length or b not in length:
            raise ValueError("a merge uses a token that no earlier merge makes")
        before, part = 0, b
        while part is not None:
            before, part = max(before, reach.get(part, 0)), left_part.get(part)
        chain = length[a] + before
        reach[a] = max(reach.get(a, 0), chain)
        most = max(most, chain)
        if c not in length:
            length[c], left_part[c] = length[a] + length[b], a
    return most


def merged(symbols: list[int], merge: dict[int, int]) -> list[int]:
    """Symbols after all merges, the rule of least rank first, each from left to right."""
    find = merge.get
    symbols = symbols[:]
    pairs = [find((a << _BITS) | b, _NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
    while pairs and (least := min(pairs)) != _NONE:
        i = pairs.index(least)
        symbols[i : i + 2] = [new := least & _ID]
        del pairs[i]
        if i:
            pairs[i - 1] = find((symbols[i - 1] << _BITS) | new, _NONE)
        if i < len(pairs):
            pairs[i] = find((new << _BITS) | symbols[i + 1], _NONE)
    return symbols


class PieceEncoder:
    """Encodes one piece (letters, a digit, or other marks) whose characters arrive bit by bit."""

    def __init__(self, table: MergeList) -> None:
        self.table, self.symbols = table, []
        self.window = 4 * table.lookahead + 64
        self.held: bytes = b""  # the last byte: it becomes another symbol if the piece ends with it

    def feed(self, text: str) -> list[int]:
        data, out = self.held + text.encode("utf-8", "replace"), []
        self.held = data[-1:]
        inner = self.table.inner
        for i in range(0, len(data) - 1, self.window):
            self.symbols += [inner[b] for b in data[i : min(i + self.window, len(data) - 1)]]
            if len(self.symbols) >= self.window:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        tokens, end, n = merged(self.symbols, self.table.merge), 0, 0
        for n, token in enumerate(tokens):  # noqa: B007
            size = self.table_length(token)
            if end + size > len(self.symbols) - self.table.lookahead:
                break
            end += size
        self.symbols = self.symbols[end:]
        return tokens[:n]

    def table_length(self, token: int) -> int:
        return len(self.table.text_of[token].removesuffix(WORD_END))

    def finish(self) -> list[int]:
        if not self.held:
            return []
        symbols = [*self.symbols, self.table.final[self.held[0]]]
        self.symbols, self.held = [], b""
        return merged(symbols, self.table.merge)


class StreamEncoder:
    """Encodes a text that arrives bit by bit: feed() and finish() return the token ids that became stable."""

    _composing: frozenset[str] | None = None

    def __init__(self, table: MergeList) -> None:
        self.table = table
        self.raw = ""  # not yet normalised: may still fuse with what follows, or start a special token
        self.text = ""  # normalised, not yet cut into pieces: at most a contraction
        self.kind = ""
        self.piece = PieceEncoder(table)
        self.special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None
        self.hold = max(map(len, table.special), default=1) - 1

    def feed(self, text: str) -> list[int]:
        self.raw += text
        out: list[int] = []
        while self.special and (m := self.special.search(self.raw)):
            out += [*self._normal(self.raw[: m.start()]), *self._end(), self.table.special[m[0]]]
            self.raw = self.raw[m.end() :]
        cut = len(self.raw) - self.hold
        if StreamEncoder._composing is None:
            StreamEncoder._composing = composing()
        while cut > 0 and self.raw[cut] in StreamEncoder._composing:
            cut -= 1
        if cut > 0:
            out += self._normal(self.raw[:cut])
            self.raw = self.raw[cut:]
        return out

    def finish(self) -> list[int]:
        out = [*self._normal(self.raw), *self._end()]
        self.raw = ""
        return out

    def _normal(self, text: str) -> list[int]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        self.text += text.lower()
        return self._pieces(False)

    def _end(self) -> list[int]:
        out = [*self._pieces(True), *self.piece.finish()]
        self.kind = ""
        return out

    def _pieces(self, last: bool) -> list[int]:
        """Takes pieces from the text; unless it is the last of it, two characters stay, as a contraction needs them."""
        out: list[int] = []
        at, text = 0, self.text
        until = len(text) if last else len(text) - 2
        while at < until:
            if self.kind in ("letters", "rest"):  # the piece at hand goes on first: a run is as long as it can be
                m = (_LETTERS if self.kind == "letters" else _REST).match(text, at)
                if m:
                    end = min(m.end(), until)
                    out += self.piece.feed(text[at:end])
                    at = end
                    continue
                out += self.piece.finish()
                self.kind = ""
            m = _PIECE.match(text, at)
            if not m:
                at += 1
                continue
            if m.lastgroup in ("letters", "rest"):
                self.kind = m.lastgroup
                continue
            out += [*self.piece.feed(m[0]), *self.piece.finish()]
            at = m.end()
        self.text = text[at:]
        return out


_LETTERS = regex.compile(r"\p{L}+")
_REST = regex.compile(rf"[^{SPACE}\p{{L}}\p{{N}}]+")


class StreamDecoder:
    """Ids to bytes by table, bytes to text by a UTF-8 state machine that keeps an unfinished character.

    joined=True gives the vocabulary's own strings with a space between them, as the library does for a file
    without a decoder; joined=False gives the text that the tokens stand for, a space for each word's end.
    """

    def __init__(self, table: MergeList, joined: bool = True) -> None:
        self.table, self.joined, self.started = table, joined, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        strings = [self.table.text_of[i] for i in ids]
        if not strings:
            return ""
        if self.joined:
            data = ((" " if self.started else "") + " ".join(strings)).encode()
        else:
            data = b"".join(self._bytes(s) for s in strings)
        self.started = True
        return self.state.decode(data)

    def finish(self) -> str:
        return self.state.decode(b"", True)

    @staticmethod
    def text(data: pa.Buffer | bytes) -> str:
        """Bytes to text, slice by slice, through the state machine."""
        state, view = codecs.getincrementaldecoder("utf-8")("replace"), memoryview(data)
        return "".join([state.decode(view[i : i + SLICE], i + SLICE >= len(view)) for i in range(0, len(view), SLICE)])

    def _bytes(self, token: str) -> bytes:
        if token in self.table.special:
            return token.encode()
        body = token.removesuffix(WORD_END)
        return bytes(self.table.byte_of[c] for c in body) + b" " * (body != token)


class DocumentCodec:
    """Encodes whole texts: their chunks between white space are told apart by Arrow, each distinct one goes through
    the transducer once for some megabytes of text, and numpy lays out the ids. Short pieces are remembered, up to
    `keep_bytes` of them; a long chunk is streamed and never kept."""

    def __init__(self, path: str, keep_bytes: int = 32 << 20) -> None:
        self.table, self.keep_bytes = MergeList(path), keep_bytes
        self.kind = np.dtype("<u2" if max(self.table.text_of) < 1 << 16 else "<u4")
        strings = [self.table.text_of.get(i, "").encode() for i in range(max(self.table.text_of) + 1)]
        self.strings = pa.array(strings, pa.binary())
        self.pieces: dict[str, bytes] = {}
        self.held = 0
        self.encoder = PieceEncoder(self.table)

    def forget(self) -> None:
        self.pieces, self.held = {}, 0

    def _packed(self, ids: list[int]) -> bytes:
        return array("H" if self.kind.itemsize == 2 else "I", ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if len(chunk) <= LONG_CHUNK and (m := _SIMPLE.fullmatch(chunk)):
            # letters, then marks without an apostrophe: two pieces, none of them a contraction
            word, marks = m.groups()
            return (self._piece(word.lower()) if word else b"") + (self._piece(marks) if marks else b"")
        stream, out = StreamEncoder(self.table), []
        for i in range(0, len(chunk), SLICE):
            out.append(self._packed(stream.feed(chunk[i : i + SLICE])))
        return b"".join([*out, self._packed(stream.finish())])

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            ids = self._packed([*self.encoder.feed(piece), *self.encoder.finish()])
            self.held += 160 + len(piece) + len(ids)  # a key, a value and their place, about
            if self.held > self.keep_bytes:
                self.forget()
            self.pieces[piece] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin and the last one's end."""
        return by_distinct_chunk(texts, self._chunk, self.kind)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of ids, as the library gives it for a file without a decoder: Arrow joins the tokens' strings,
        and what it joins goes through the incremental byte-to-text machine."""
        strings = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.strings.take(pa.array(ids)))
        return [StreamDecoder.text(data.as_buffer()) for data in pc.binary_join(strings, b" ")]

    def coded(self, text: str) -> tuple[np.ndarray, str]:
        """Ids and decoded text of a long text, taken in parts that end at white space."""
        ids, decoded = [], []
        for part in parts_of(text):
            some, ends = self.encode(pa.array([part], pa.string()))
            ids.append(some)
            if len(some):
                decoded += self.decode(some, ends)
        return np.concatenate([*ids, np.empty(0, self.kind)]), " ".join(decoded)


def by_distinct_chunk(texts: pa.Array, encode: Callable[[str], bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's ids begin and the last one's end.

    Each distinct chunk between white space is encoded once, to little-endian ids of that kind.
    """
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    found = [*map(encode, coded.dictionary.to_pylist())]
    size = np.fromiter(map(len, found), np.int64, len(found)) // kind.itemsize
    known = np.frombuffer(b"".join(found), kind)
    del found
    codes = coded.indices.to_numpy(zero_copy_only=False)
    n = size[codes]
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(ends[-1]) + np.repeat((np.cumsum(size) - size)[codes] - ends[:-1], n)
    return known[at], ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of SLICES characters, about, each but the last ending before white space."""
    at = 0
    while at < len(text):
        end = min(at + SLICES, len(text))
        if end < len(text):  # up to the last white space, or else the next
            back = max(text.rfind(c, at, end) for c in " \n\t\r")
            ahead = _GAP.search(text, end) if back <= at else None
            end = back if back > at else ahead.start() if ahead else len(text)
        yield text[at:end]
        at = end


_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-;=?@\[-`{-~]*)")
_codecs: dict[str, DocumentCodec] = {}


def codec(path: str) -> DocumentCodec:
    """One for each worker process and file; what it remembers goes when a task ends."""
    if path not in _codecs:
        _codecs[path] = DocumentCodec(path)
    return _codecs[path]


def rows_at_once(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with `most` bytes of text, about; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, n in enumerate(size.tolist()):
        if row > start and held + n > most:
            yield start, row
            start, held = row, 0
        held += n
    if start < len(size):
        yield start, len(size)


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", flush: int = 1 << 20) -> DataFrame:
    """docs with `ids` (array of int) and `decoded` (string) for each row's whole text; a null text counts as ''.

    tokenizer: the tokenizer's file, present on every machine. flush: bytes of text after which rows go back to Spark.
    """
    rest = [c for c in docs.columns if c not in ("ids", "decoded", "__text")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        try:
            for batch in batches:
                for start, end in rows_at_once(batch.column(len(rest)), flush):
                    part = batch.slice(start, end - start)
                    texts = pc.fill_null(part.column(len(rest)), "")
                    if len(texts) == 1 and len(texts[0].as_buffer()) > SLICES:
                        ids, decoded = own.coded(texts[0].as_py())
                        ends, decoded = np.array([0, len(ids)]), [decoded]
                    else:
                        ids, ends = own.encode(texts)
                        decoded = own.decode(ids, ends)
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], lists, pa.array(decoded, pa.string())], names=[*rest, "ids", "decoded"])
        finally:
            own.forget()

    return docs.select(*rest, F.col(text).alias("__text")).mapInArrow(run, schema)
