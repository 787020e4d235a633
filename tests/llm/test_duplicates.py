import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from retailflow.llm import ngram_join, queries, substring_dedup


def words(text):
    return (text or "").encode().split()


def grams(text):
    w = words(text)
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute_similar(rows):
    """{doc_id: (class, links, group)} by comparing all pairs of classes."""
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id] = grams(text)
    classes = defaultdict(list)
    for d, s in sets.items():
        if s:
            classes[s].append(d)
    reps = {min(v): s for s, v in classes.items()}
    links = {r: [q for q, t in reps.items() if q != r and len(s & t) >= 0.8 * len(s | t) - 1e-9] for r, s in reps.items()}
    group = {}
    for r in sorted(reps):
        todo = [r]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = r
                todo += links[x]
    out = {}
    for d, s in sets.items():
        r = min(classes[s]) if s else d
        out[d] = (r, len(links.get(r, ())), group.get(r, r))
    return out


def collected(df):
    return {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in df.collect() if r.doc_id is not None}


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(3)
    base = [[f"b{k}x{rng.randrange(400)}" for _ in range(120)] for k in range(4)]
    rows = []
    for k in range(240):
        w = list(base[k % 4])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        rows.append((1000 - k, " ".join(w)))
    rows += [(2000 + k, rows[k % 7][1]) for k in range(60)] + [(3000 + k, " ".join(f"r{rng.randrange(10**6)}" for _ in range(80))) for k in range(40)]
    return rows


@pytest.mark.parametrize("block", [256, 16, 4])
def test_links_equal_brute_force(spark, near_copies, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # small blocks: buckets are split over tasks
    df = spark.createDataFrame(near_copies, "doc_id bigint, text string")
    got, want = collected(ngram_join.similar(df, recall=0.999999)), brute_similar(near_copies)
    assert got == want


def one_cluster(n, edits, seed=5):
    """Texts that differ from one base in a few words each."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10_000)}" for _ in range(150)]
    rows = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(1, edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
        rows.append((k, " ".join(w)))
    return rows


@pytest.mark.parametrize("edits", [1, 3, 6])
def test_hot_cluster_equals_brute_force(spark, monkeypatch, edits):
    """One bucket many times as large as a block, of near copies within and beyond the reach of a pivot."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = one_cluster(300, edits) + [(1000 + k, t) for k, t in one_cluster(100, 1, 6)] + [(2000, one_cluster(300, edits)[0][1])]
    got, want = collected(ngram_join.similar(spark.createDataFrame(rows, "doc_id bigint, text string"), recall=0.999999)), brute_similar(rows)
    assert got == want and max(n for _, n, _ in want.values()) > 20


def test_shuffle_of_a_hot_cluster_grows_with_it(spark, monkeypatch):
    """20,000 near copies: no more sets go to the comparison than for a cluster of a tenth of them, but for a few each."""
    shipped = []
    plain = ngram_join._compared
    monkeypatch.setattr(ngram_join, "_compared", lambda rows, threshold: shipped.append(rows.count()) or plain(rows, threshold))
    for n in (2_000, 20_000):
        got = ngram_join.similar(spark.createDataFrame(one_cluster(n, 1), "doc_id bigint, text string").repartition(4))
        assert got.filter("group_id <> 0").count() == 0 and got.filter(f"n_links < {n - 1}").count() < n / 100
    assert shipped[1] <= 20 * max(shipped[0], 1_000)


def templates(n, families=0, size=4, seed=9):
    """Texts of 240 words that share 180: no links, but for families of near copies among them."""
    rng = random.Random(seed)
    page = [f"c{k}" for k in range(180)]
    rows = []
    for k in range(n):
        if k >= families * size or k % size == 0:
            own = [f"u{rng.randrange(10**9)}" for _ in range(60)]
        else:
            own = [*own[:30], f"v{k}", *own[31:]]
        rows.append((k * 3 - 50, " ".join(page + own)))
    return rows


def shipped_sets(monkeypatch):
    seen = []
    plain = ngram_join._compared
    monkeypatch.setattr(ngram_join, "_compared", lambda rows, threshold: seen.append({r.mode: r["count"] for r in rows.groupBy((rows.band < 0).alias("mode")).count().collect()}) or plain(rows, threshold))
    return seen


@pytest.mark.parametrize("block", [8, 32])
def test_templates_equal_brute_force(spark, monkeypatch, block):
    """Families within a template, a cluster of near copies and repeated rows, by n-grams and by blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "COPIES", 1)
    seen = shipped_sets(monkeypatch)
    rows = templates(400, families=30) + [(5000 + k, t) for k, t in one_cluster(100, 2)]
    near = rows[0][1].split()
    rows += [(7000 + k, " ".join([*near[:200], f"w{k}", *near[201:]])) for k in range(60)]  # a ball within the template
    rows += rows[:9]
    got, want = collected(ngram_join.similar(spark.createDataFrame(rows, "doc_id bigint, text string"), recall=0.999999)), brute_similar(rows)
    assert got == want and seen[0].get(True)


def test_shuffle_of_a_template_grows_with_it(spark, monkeypatch):
    """Twice the pages of one template: twice the sets, about."""
    seen = shipped_sets(monkeypatch)
    for n in (4_000, 8_000):
        got = ngram_join.similar(spark.createDataFrame(templates(n), "doc_id bigint, text string").repartition(4))
        assert got.filter("n_links > 0").count() == 0
    few, many = (sum(s.values()) for s in seen)
    assert many <= 2.2 * max(few, 4_000), seen


def test_rarest_ngrams_hold_one_in_common():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, 64).astype(np.uint32)
    for n in range(1, 60):
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        for lost in range(len(a)):
            b = a[lost:]
            if len(b) >= 0.8 * len(a):
                assert set(ngram_join.rarest(a, counts, 0.8).tolist()) & set(ngram_join.rarest(b, counts, 0.8).tolist())


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_similar_edge_rows(spark, documents, none):
    clashing = documents.withColumnRenamed("score", "class_id")
    got = ngram_join.similar(clashing)
    assert got.count() == documents.count()
    by_id = collected(got)
    assert by_id[5] == by_id[6] == (5, 0, 5)
    assert by_id[2] == (2, 0, 2) and by_id[3] == (3, 0, 3) and by_id[7] == (7, 0, 7)
    assert ngram_join.similar(none).count() == 0
    kept = ngram_join.one_of_each_group(documents)
    assert kept.columns == documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "7", "8", "None"])
    assert ngram_join.one_of_each_group(none).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 90)], "doc bigint, root bigint")
    got = {r.doc: r.root for r in ngram_join.components(edges).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and got[100] == 90


def test_linked_is_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(30)]
    got = ngram_join.linked(sets, np.arange(30), np.arange(30), 0.5)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert got[i, j] == (len(set(x) & set(y)) >= 0.5 * len(set(x) | set(y)))


def test_join_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert collected(queries.op1_ngram_join(spark, sf_dir)) == brute_similar(rows)


def brute_removed(rows, window=50):
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc_id is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        out.append((str(doc_id), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("window", [50, 7])
def test_removed_words_equal_brute_force(spark, window):
    rng = random.Random(window)
    vocabulary = [f"v{k}" for k in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(90)] for _ in range(4)]
    rows = []
    for k in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            p, i = rng.choice(passages), rng.randrange(30)
            w += p[i : i + rng.randrange(20, 60)]
        rows.append((rng.randrange(10**6), " ".join(w)))
    rows += [(7, "same " * 200), (9, "same " * 130), (8, rows[0][1]), (None, rows[1][1]), (11, None), (12, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.dedup_substrings(df, window).collect())
    assert got == brute_removed(rows, window)


def test_dedup_edge_rows(spark, documents, none):
    clashing = documents.withColumnRenamed("score", "n_words")
    got = substring_dedup.dedup_substrings(clashing, rest_text=True)
    assert got.count() == documents.count() and got.columns.count("n_words") == 1 and "text" in got.columns
    by_id = {(r.doc_id, r.source): r for r in got.collect()}
    assert by_id[(6, None)].n_removed == by_id[(6, None)].n_words and by_id[(5, "a")].n_removed == 0
    assert by_id[(7, "b")].n_removed == 0
    assert substring_dedup.dedup_substrings(none).count() == 0


def test_dedup_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_removed(rows))
    got = queries.op5_substring_dedup(spark, sf_dir)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == want


def test_same_id_other_text(spark):
    long = " ".join(f"a{k}" for k in range(60))
    df = spark.createDataFrame([(1, long), (2, long), (2, " ".join(f"c{k}" for k in range(60)))], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed) for r in substring_dedup.dedup_substrings(df).collect())
    assert got == [(1, 0), (2, 0), (2, 60)]
