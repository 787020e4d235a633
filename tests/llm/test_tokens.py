import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailflow.llm import bpe_stream, queries, token_files

LETTERS = "abcdefghijklmnoprstuvw'!? 1\té́ΣİßÅñ́<|>日が"


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


@pytest.fixture(scope="module")
def merges(tokenizer):
    return bpe_stream.MergeList(tokenizer)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def streamed(merges, text, step):
    encoder, decoder = bpe_stream.StreamEncoder(merges), bpe_stream.StreamDecoder(merges)
    ids, out = [], ""
    for i in range(0, len(text), step):
        some = encoder.feed(text[i : i + step])
        ids += some
        out += decoder.feed(some)
    some = encoder.finish()
    return ids + some, out + decoder.feed(some) + decoder.finish()


TEXTS = ["", "it's we'll 'S x'm 12 3½ !!'s", "a\x1cb\x85c　d", "x" * 5000, "ab" * 3000 + "'s", "!" * 3000 + "'ll", "日本語" * 900, "😀'd😀" * 50, "<|endoftext|>hi<|startoftext|> <|endoftext|", "é" * 40]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("step", [1, 7, 100_000])
def test_stream_equals_library(merges, library, text, step):
    assert streamed(merges, text, step) == expected(library, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=LETTERS, max_size=200), step=st.integers(1, 9))
def test_any_text_in_any_bits(merges, library, text, step):
    assert streamed(merges, text, step) == expected(library, text)


def test_memory_does_not_follow_the_text(merges):
    encoder, most = bpe_stream.StreamEncoder(merges), 0
    rng = random.Random(1)
    for _ in range(60):
        encoder.feed("".join(rng.choice("inthera") for _ in range(1000)))
        most = max(most, len(encoder.raw) + len(encoder.text) + len(encoder.piece.symbols))
    assert most < 2 * encoder.piece.window + 2000


def test_lookahead_is_needed_and_enough():
    #      0: a, 1: b, 2: c, 3: ab, 4: bc
    assert bpe_stream.sufficient_lookahead([(0, 1, 3), (1, 2, 4)], {0, 1, 2}) == 1
    assert bpe_stream.sufficient_lookahead([(1, 2, 4), (0, 1, 3)], {0, 1, 2}) == 2
    with pytest.raises(ValueError, match="no earlier merge"):
        bpe_stream.sufficient_lookahead([(3, 2, 4)], {0, 1, 2})


def test_decoded_text(merges):
    decoder = bpe_stream.StreamDecoder(merges, joined=False)
    assert decoder.feed(streamed(merges, "Hello wörld 日本", 3)[0]) + decoder.finish() == "hello wörld 日本 "


def test_encode_documents(spark, documents, none, tokenizer, library):
    clashing = documents.withColumnRenamed("score", "ids")
    got = bpe_stream.encode_documents(clashing, tokenizer, flush=50).collect()
    assert len(got) == documents.count()
    for r in got:
        assert (r.ids, r.decoded) == expected(library, r.text)
    assert bpe_stream.encode_documents(none, tokenizer).count() == 0
    for r in queries.bpe_digests(documents).collect():
        text = next(x.text for x in got if x.doc_id == r.doc_id)
        ids, decoded = expected(library, text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=50))
def test_pack_round_trip(values):
    ranks = np.array(values, np.uint32)
    assert (token_files.unpack(*token_files.pack(ranks), len(ranks)) == ranks).all()


def test_token_files(spark, documents, none, tokenizer, library, tmp_path):
    token_files.write_token_files(documents.withColumnRenamed("score", "ids"), str(tmp_path / "a"), tokenizer, end_id=2)
    got = token_files.read_token_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(got) == documents.count()
    texts = {r.doc_id: r.text for r in documents.collect()}
    at = 0
    for r in got:
        ids = np.array([*expected(library, texts[r.doc_id])[0], 2], "<u4")
        assert (r.start, bytes(r.ids)) == (at, ids.tobytes())
        at += len(ids)
    token_files.write_token_files(none, str(tmp_path / "b"), tokenizer, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_token_file_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in queries.op9_token_files(spark, sf_dir).collect()}
    at = 0
    for doc_id, text in sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()):
        ids = np.array([*expected(library, text)[0], 2], "<u4")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_bpe_query(spark, sf_dir, library):
    got = {r.doc_id: r.ids_sha256 for r in queries.op6_bpe_stream(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert got[r.doc_id] == hashlib.sha256(" ".join(map(str, expected(library, r.text)[0])).encode()).hexdigest()
