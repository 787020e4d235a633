import base64
import hashlib
import random
import sys
import zlib
from itertools import permutations
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailflow.llm import bpe_tree, filter_audit, queries, turn_repair

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import rows_of, rows_of_frame  # noqa: E402

# ---- conversation structure repair


def cheapest(codes, entry=turn_repair.START, after=turn_repair._FINAL):
    """(cost, audit, end) by the least (cost, audit) of each state, turn by turn."""
    best = {entry: (0, "")}

    def put(into, q, x):
        if q not in into or x < into[q]:
            into[q] = x

    def inserted(states):
        for _ in range(2):
            for p, (c, t) in list(states.items()):
                put(states, 3 if p == 2 else 2, (c + 5, t + "I"))

    inserted(best)
    for ch in codes:
        new = {}
        for p, (c, t) in best.items():
            put(new, p, (c + 2, t + "D"))
            if ch in "bd":
                continue
            extra, i = 5 * ch.isupper(), ch.lower()
            if i == "s" and p == 0:
                put(new, 1, (c + extra, t + "K"))
            want = "a" if p == 2 else "u"
            put(new, 3 if p == 2 else 2, (c + extra, t + "K") if i == want else (c + extra + 1, t + "R"))
        best = new
        inserted(best)
    return min((c + after[q], t, q) for q, (c, t) in best.items() if after[q] < turn_repair._BIG)


@settings(max_examples=400, deadline=None)
@given(codes=st.text(alphabet="suaxSUAXbdua", max_size=18))
def test_audits_equal_brute_force(codes):
    assert turn_repair.Alignment(codes).audit(turn_repair.START, turn_repair._FINAL) == cheapest(codes)


@settings(max_examples=200, deadline=None)
@given(codes=st.text(alphabet="suaxSUAXbdua", max_size=10), entry=st.sampled_from(range(4)))
def test_transfer_equals_brute_force(codes, entry):
    costs = turn_repair.Alignment(codes).transfer()
    for q in range(4):
        after = tuple(0 if k == q else turn_repair._BIG for k in range(4))
        try:
            want = cheapest(codes, entry, after)[0]
        except ValueError:
            want = turn_repair._BIG
        assert costs[4 * entry + q] == want


def kind(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        left = []
        for c, turn, role, text in rows:
            if c != conv or (k := kind(c, turn)) == 0:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            if k == 1:
                text = ""
            if k == 2:
                text = text.translate({ord(x): None for x in ".!?"})
            left += [(turn, "user" if k == 4 else role, text)] * (1 + (k == 3))
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen = "", set()
        for _, role, text in left:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            i = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "b" if not bare else "d" if (role, text) in seen else i if bare[-1] in ".!?" else i.upper()
            seen.add((role, text))
        cost, audit, _ = cheapest(codes)
        lines, k, state = [], 0, "s"
        for letter in audit:
            follow = "a" if state == "u" else "u"
            if letter == "I":
                lines.append({"u": "user", "a": "assistant"}[follow] + ":")
                state = follow
                continue
            _, role, text = left[k]
            k += 1
            if letter != "D":
                role = role if letter == "K" else {"u": "user", "a": "assistant"}[follow]
                lines.append(f"{role}:{text}")
                state = role[:1]
        turns = [r[0] for r in left if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(left, left[1:], strict=False)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def some_turns(n, seed):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool", None, ""], ["Yes.", "No!", "open", None, "", " \n", "Why? ", "a" * 50 + "."]
    return [(rng.choice([1, 2, 2, 2, 3, 4, None]), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {k}.") for k in range(n)]


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, pos string")
    return {r[0]: tuple(r)[1:] for r in turn_repair.repair(df).collect()}


@pytest.mark.parametrize("bits", [9, 2])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    """With nulls, repeats, odd roles and a clashing column; with blocks of four turns, conversations have many."""
    monkeypatch.setattr(turn_repair, "BLOCK_BITS", bits)
    rows = some_turns(300, 4)
    rows += rows[:20]
    assert repaired(spark, rows) == brute_repair(rows)


def test_long_conversation_in_blocks(spark):
    """One conversation of several thousand turns beside a short one, in blocks of the usual size."""
    rng = random.Random(9)
    rows = [(7, k, rng.choice(["user", "assistant", "assistant", "tool"]), f"Text {rng.randrange(5000)}" + rng.choice([".", ".", ""])) for k in range(3000)] + [(8, 0, "user", "Hm.")]
    assert repaired(spark, rows) == brute_repair(rows)


def test_repair_edge_rows(spark):
    assert repaired(spark, []) == {}
    gone = next(k for k in range(1000) if kind(1, k) == 0)
    assert repaired(spark, [(1, gone, "user", "Hi.")]) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    far = [(2, -(2**63), "user", "A."), (2, 2**63 - 1, "assistant", "B.")]
    assert repaired(spark, far)[2][0] == brute_repair(far)[2][0] if any(kind(2, r[1]) == 0 for r in far) else 2**63 - 1


def test_repair_query(spark, sf_dir):
    assert rows_of_frame(queries.op11_turn_repair(spark, sf_dir)) == rows_of(queries.SQL["op11_turn_repair"], sf_dir)


# ---- byte-level BPE as a tree


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return str(tokenizers.path("byte_bpe_multi_50k.tiktoken")), tokenizers.PATTERN


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    with open(vocabulary[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tree_codec(vocabulary):
    return bpe_tree.TreeCodec(*vocabulary)


BITS = st.sampled_from(["a", "b", "the", "  ", " ", "\n", "\t", "'s", "'ll", "'", "é", "中", "😀", "1", "23", "!", "...", "\x1c", "\x85", "　", "aaaa", "tion", "x" * 50])


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(BITS, max_size=40), leaf=st.sampled_from([1, 2, 3, 5, 17, 100]))
def test_tree_equals_library(vocabulary, tree_codec, library, parts, leaf):
    text = "".join(parts)
    want = library.encode_ordinary(text)
    assert bpe_tree.TextTree(tree_codec.ranks, vocabulary[1], leaf).encode(text).tolist() == want
    ids, ends = tree_codec.encode(pa.array([text, "x " + text, text], pa.string()))
    assert ids[ends[0] : ends[1]].tolist() == want == ids[ends[2] : ends[3]].tolist()
    assert tree_codec.decode(ids[ends[0] : ends[1]]) == text.encode()


LONG_TEXTS = ["a" * 60_000, "ab" * 40_000, " " * 50_000 + "x", "\n" * 30_000, "éa" * 30_000, "é" * 40_001 + "'" * 333, "the end. " * 200_000]


@pytest.mark.parametrize("text", LONG_TEXTS, ids=range(len(LONG_TEXTS)))
def test_long_runs(vocabulary, tree_codec, library, text):
    assert bpe_tree.TextTree(tree_codec.ranks, vocabulary[1]).encode(text).tolist() == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(left=st.binary(min_size=1, max_size=40), right=st.binary(min_size=1, max_size=40))
def test_joined_tokens_are_those_of_the_whole(tree_codec, left, right):
    tokens, rank = tree_codec.tree.tokens, tree_codec.ranks.rank
    assert tokens.join(bpe_tree.merged(left, rank), bpe_tree.merged(right, rank)) == bpe_tree.merged(left + right, rank)


@settings(max_examples=200, deadline=None)
@given(pieces=st.lists(st.binary(max_size=40), max_size=12))
def test_trees_reduced_together_equal_single_ones(tree_codec, pieces):
    ids, counts = tree_codec.tree.tokens.encode_all(pieces)
    assert ids.tolist() == [t for p in pieces for t in bpe_tree.merged(p, tree_codec.ranks.rank)] and counts.sum() == len(ids)
    assert counts.tolist() == [len(bpe_tree.merged(p, tree_codec.ranks.rank)) for p in pieces]


@pytest.mark.parametrize("text", [*LONG_TEXTS[:2], *LONG_TEXTS[4:6], "=" * 100_000], ids=range(5))
def test_long_runs_among_others(tree_codec, library, text):
    ids, ends = tree_codec.encode(pa.array(["", "x " + text, "y"]))
    assert ids.tolist() == library.encode_ordinary("x " + text) + library.encode_ordinary("y") and ends[0] == ends[1]


def test_new_words_are_joined_together(vocabulary, library, monkeypatch):
    """Of words that were not met before, few need a boundary mended on its own."""
    rng, alone, one = random.Random(3), [], bpe_tree.TokenTree.join
    parts = ["the", "an", "on", "er", "re", "in", "ing", "ti", "ha", "st", "ed", "ea", "sh", "nd", "wh", "ly", "ble", "ou"]
    text = " ".join("".join(rng.choices(parts, k=rng.randint(3, 6))) for _ in range(20_000))
    monkeypatch.setattr(bpe_tree.TokenTree, "join", lambda *a: alone.append(1) or one(*a))
    ids, _ = bpe_tree.TreeCodec(*vocabulary).encode(pa.array([text]))
    assert ids.tolist() == library.encode_ordinary(text) and len(alone) < 0.7 * len({*text.split()})


def test_decoding_in_leaves(tree_codec, monkeypatch):
    ids = tree_codec.encode(pa.array(["Ab é 日本 " * 50]))[0]
    whole = tree_codec.decode(ids)
    monkeypatch.setattr(bpe_tree, "LEAF_IDS", 3)
    assert tree_codec.decode(ids) == whole == ("Ab é 日本 " * 50).encode() and tree_codec.decode(ids[:0]) == b""


def test_a_token_that_no_merge_reaches(tmp_path):
    """A piece that is a token is that token, though merges would not make it."""
    rows = [(bytes([b]), b) for b in range(256)] + [(b"ab", 256), (b"xyz", 257)]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in rows))
    codec = bpe_tree.TreeCodec(str(path), r"[a-z]+| ")
    ids, _ = codec.encode(pa.array(["xyz xyzab ab"]))
    assert ids.tolist() == [257, 32, *b"xyz", 256, 32, 256]


def test_tree_documents(spark, documents, none, vocabulary, library):
    rows = bpe_tree.encode_documents(documents.withColumnRenamed("lang", "ids"), *vocabulary).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == documents.count() and rows[0].source == "a"
    for r in rows:
        assert r.ids == library.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    assert bpe_tree.encode_documents(none, *vocabulary).collect() == []


def test_tree_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op12_bpe_tree(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# ---- filter interaction audit


def brute_audit(docs, labels):
    rows = []
    for doc_id, text, source in docs:
        t = text or ""
        words = t.encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len({*words}) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t)}
        fails["E"] = doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _ in docs)
        quality = {q for d, q, _ in labels if d == doc_id and d is not None}
        toxic = {x for d, _, x in labels if d == doc_id and d is not None}
        rows.append((source or "", {f for f in fails if fails[f]}, 1 in quality, 1 in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                failing = [r for r in own if f in r[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    """Nulls in all columns, repeated ids, repeated and contradictory labels, clashing columns, a long text."""
    long = " ".join(f"w{k}" for k in range(300))
    docs = [(1, long, "a"), (2, long, "b"), (3, None, "a"), (4, "", None), (5, "", ""), (None, long, "a"), (6, "X " * 300, "b"), (6, "X " * 300, "b"), (7, long + " #", "a"), (8, long + " #", "b"), (9, "w " * 50_000, None)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (None, 1, 1), (8, 1, None), (6, 1, 0), (77, 1, 1)]
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id bigint, text string, source string, mask int, letter string")
    named = spark.createDataFrame([(*x, "n") for x in labels], "doc_id bigint, quality int, toxic int, part string")
    got = filter_audit.audit_documents(df, named)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == brute_audit(docs, labels)
    assert filter_audit.audit_documents(df.limit(0), named).count() == 0
    assert filter_audit.audit_documents(df, named.limit(0)).filter("good_lost > 0 or toxic_lost > 0").count() == 0


def test_other_filters(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a b", "s"), (2, "a", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    two = [filter_audit.Filter("X", F.col("n_words") < 2), filter_audit.Filter("Y", F.col("n_chars") > 0)]
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in filter_audit.audit_documents(df, labels, two).collect()}
    assert got == {("XY", 1): (1, 1, 1), ("XY", 2): (0, 1, 3), ("YX", 1): (0, 2, 3), ("YX", 2): (0, 0, 1)}
    with pytest.raises(ValueError, match="letter of its own"):
        filter_audit.audit_documents(df, labels, [two[0], two[0]])


def test_audit_query(spark, sf_dir):
    assert rows_of_frame(queries.op13_filter_audit(spark, sf_dir)) == rows_of(queries.SQL["op13_filter_audit"], sf_dir)
