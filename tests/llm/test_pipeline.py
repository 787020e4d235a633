import hashlib
import re

import pytest
from test_duplicates import brute_removed, brute_similar

import corpus_pipeline
from retailflow.llm.common import new_path
from retailflow.llm.decontaminate import term


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "BPE encoding and decoding"]


def test_run_equals_brute_force(spark, sf_dir, tokenizer):
    """Every stage but the limits of the quality rules, whose own test holds them against labels, is done again by plain loops."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf_dir).collect()
    group = brute_similar([(r.doc_id, r.text) for r in kept])
    rows = [(r.doc_id, r.text) for r in kept if group[r.doc_id][2] == r.doc_id]
    text = dict(rows)
    rows = [(int(d), t if gone else text[int(d)]) for d, _, gone, t in brute_removed(rows)]
    items = [[x for x in map(term, r.text.split()) if x] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def leaks(t):
        own = " " + " ".join(x for x in map(term, t.split()) if x) + " "
        return any(f" {' '.join(i)} " in own for i in items)

    want = {d: hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for d, t in rows if not leaks(t)}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("which", ["documents", "none"])
def test_stages_on_edge_rows(spark, sf_dir, request, which):
    docs = request.getfixturevalue(which).withColumnRenamed("score", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        path = new_path(spark, re.sub(r"\W", "_", name))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.tokens(spark, docs, sf_dir).count() == docs.count()
