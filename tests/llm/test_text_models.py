import re
import time
import tracemalloc
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from oracle import rows_of, rows_of_frame
from pyspark.sql import functions as F

from retailflow.llm import decontaminate, html_blocks, preferences, quality_rules, queries, string_kernel, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- language


def test_language_query(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op3_string_kernel(spark, sf_dir).collect()
    assert len(got) == len(langs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in out) >= 0.97 * len(out)


def test_language_edge_rows(spark, documents, none):
    texts = [(k, t, lang) for k, (t, lang) in enumerate([("der hund und die katze", "de"), ("the dog and the cat", "en")] * 20)]
    model = string_kernel.fit(spark.createDataFrame(texts, "doc_id bigint, text string, lang string"))
    assert model.langs == ["de", "en"]
    got = string_kernel.predict(documents.withColumnRenamed("score", "lang_pred"), model)
    assert got.columns.count("lang_pred") == 1 and got.count() == documents.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert [by_id[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and by_id[2].score == 0
    assert by_id[1].lang_pred == "en"
    assert string_kernel.predict(none, model).count() == 0
    nothing = string_kernel.fit(none)
    assert {r.lang_pred for r in string_kernel.predict(documents, nothing).collect()} == {"und"}


def test_labels_are_no_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = string_kernel.fit(docs.filter(~string_kernel.held_out()))
    got = lambda df: sorted((r.doc_id, r.lang_pred) for r in string_kernel.predict(df, model).select("doc_id", "lang_pred").collect())
    assert got(docs) == got(docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}))


def test_no_more_rows_are_collected_than_the_bound(spark, monkeypatch):
    """20,000 rows with one id, and 300 languages."""
    seen = []
    monkeypatch.setattr(string_kernel, "Model", lambda texts, langs, settings: seen.append(langs))
    bound = string_kernel.Settings()
    string_kernel.fit(spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("text "), "id").alias("text")))
    string_kernel.fit(spark.range(3_000).select("id", F.concat(F.lit("l"), F.col("id") % 300).alias("lang"), F.lit("text").alias("text")), doc_id="id")
    assert len(seen[0]) == bound.per_lang and len(set(seen[1])) == bound.most_langs


def test_scores_equal_plain_kernel_ridge_regression():
    """All texts are landmarks: Nyström features give the full kernel's solution, here from n-gram sets and the dual form."""
    import numpy as np

    rng, letters = np.random.default_rng(3), {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnab"}
    text = lambda lang: " ".join("".join(rng.choice(list(letters[lang]), rng.integers(2, 8))) for _ in range(rng.integers(3, 12)))
    langs = [*sorted(letters)] * 12
    texts = [text(k) for k in langs]
    asked = [text(k) for k in langs]
    settings = string_kernel.Settings(landmarks=100)
    got_lang, got_score = string_kernel.Model(texts, langs, settings).predict(asked)

    sets = lambda t: {f" {t} "[k : k + n] for n in (1, 2, 3) for k in range(len(t) + 3 - n)}
    kernel = lambda x, y: np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in map(sets, y)] for a in map(sets, x)]) + 1
    wanted = np.array([[1.0 if own == lang else -1.0 for lang in sorted(letters)] for own in langs])
    alpha = np.linalg.solve(kernel(texts, texts) + settings.ridge / len(texts) * 12 * np.eye(len(texts)), wanted)
    scores = kernel(asked, texts) @ alpha
    share = np.exp(settings.sharpness * scores)
    share /= share.sum(axis=1, keepdims=True)
    assert got_lang == [sorted(letters)[k] for k in scores.argmax(axis=1)]
    assert np.abs(share.max(axis=1) - got_score).max() < 0.01


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><a href="/">Home</a></header><nav class="menu"><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie notice">We use cookies.</div><!-- <p>hidden</p> -->
<article><h1>Title &amp; more</h1><p>First   <b>bold</b>
text.<br>Line &lt;b&gt; two.<p>Second &eacute;&#233; paragraph of the story goes on here.</p>
<div class="ad">Buy now</div><p>Third paragraph ends the story, and it is long enough.</p>
<section class="comments"><p>Nice post!</p></section></article>
<aside class="sidebar"><p>Other posts</p></aside><form>Sign up <input name=x></form><footer>&copy; us</footer></body>"""


@pytest.fixture(scope="module")
def labeller(spark, sf_dir):
    return html_blocks.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_blocks_of_broken_markup():
    found = html_blocks.blocks(PAGE)
    assert [b.text for b in found][:4] == ["T", "Home", "One", "Two"]
    assert "First bold text. Line <b> two." in [b.text for b in found]
    assert all("hidden" not in b.text and "var t" not in b.text for b in found)
    assert html_blocks.blocks("a < b <p>c<script>x") and html_blocks.blocks("<p title='x>y'>ok</p>")[0].text == "ok"
    assert html_blocks.blocks("<!-- open") == [] and html_blocks.blocks(None) == []
    long = html_blocks.blocks("<div>" * 3000 + "<p>" + "x " * 100_000)
    assert len(long) == 1 and len(long[0].path) == 3001


@pytest.mark.parametrize("raw", ["<svg-icon></svg-icon>", "<template-card>x</template-card>", "<svg-icon/>", "<svg/>", "<svg width='1' title='a>b' />", '<SVG viewBox="0 0 1 1"/>', "<svg><p>no</p></svg>", "<script type='x'>no</script>", "<style\n>no</style >", "<iframe/>no</iframe>"])
def test_text_after_raw_names(raw):
    found = html_blocks.blocks(f"<article><p>one</p>{raw}<p>two</p></article><p>three</p>")
    assert [b.text for b in found if b.text != "x"] == ["one", "two", "three"]
    assert [html_blocks.own_label(b) for b in found if b.text != "x"] == [1, 1, 0]


@pytest.mark.parametrize("n", [10, 4_000, 5_000, 1_000_000])
@pytest.mark.parametrize("unit", ["x", "a>b ", "<p class='ad'>", "</div>"])
@pytest.mark.parametrize("quote", ['"', "'"])
def test_long_attribute_values(n, unit, quote):
    value = quote + (unit * (n // len(unit) + 1)).replace(quote, "")[:n] + quote
    found = html_blocks.blocks(f"<article data-x={value}><p>one</p><div class='comments' data-x = {value}><p>two</p></div>three</article><p>four</p>")
    assert [b.text for b in found] == ["one", "two", "three", "four"]
    assert [b.path for b in found] == [(("article", ()), ("p", ())), (("article", ()), ("div", ("comments",)), ("p", ())), (("article", ()),), (("p", ()),)]
    assert [html_blocks.own_label(b) for b in found] == [1, 0, 1, 0]


def test_quotes_that_do_not_close():
    assert [b.text for b in html_blocks.blocks("<p it's>It's one</p><p class='x>two</p>")] == ["It's one", "two"]
    many = html_blocks.blocks("<p title=\">text</p>" * 20_001)
    assert many and many[-1].text == "text"


def test_page_in_another_layout(labeller):
    text = html_blocks.main_texts([PAGE], labeller)[0]
    assert text == "Title & more\n\nFirst bold text. Line <b> two.\n\nSecond éé paragraph of the story goes on here.\n\nThird paragraph ends the story, and it is long enough."


#: Layouts and marks that no training page has.
HELD_OUT = [
    ("<article><h1>T</h1><p>Code: <code>x=1</code></p><pre>a\nb</pre><figure><figcaption>Caption here.</figcaption></figure><dl><dt>term</dt><dd>meaning</dd></dl></article>", ["T", "Code: x=1", "a b", "Caption here.", "term", "meaning"]),
    ("<h1>Title</h1><div class='story'><p>The first paragraph of the story is long enough to read.</p><p>Second one follows here with more words.</p></div><div class='discussion'><p>Nice post!</p><p>I disagree with it.</p></div>", ["Title", "The first paragraph of the story is long enough to read.", "Second one follows here with more words."]),
    ("<table><tr><td><a href='/'>Menu one</a><br><a href='/b'>Menu two</a></td><td><p>The main story starts in this cell, and is long.</p><p>It goes on in a second paragraph.</p></td></tr></table>", ["The main story starts in this cell, and is long.", "It goes on in a second paragraph."]),
    ("<div id=nav><a href=/>Home</a></div><main><h2>How to</h2><ol><li>Step one.</li><li>Step two.</li></ol><p>Be careful with it.</p><blockquote>Said someone.</blockquote></main><div class=comments><ol><li>Great!</li></ol></div><footer>x</footer>", ["How to", "Step one.", "Step two.", "Be careful with it.", "Said someone."]),
]


@pytest.mark.parametrize(("page", "want"), HELD_OUT)
def test_layouts_that_training_does_not_have(labeller, page, want):
    assert html_blocks.main_texts([f"<html><body>{page}</body></html>"], labeller) == ["\n\n".join(want)]


@pytest.mark.parametrize("page", ["<a" * 100_000, "<a " * 100_000, '<a b=">' * 50_000, "<a =\">\"'" * 50_000, "<div>x" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<div>" * 50_000 + "<li>" * 50_000, "<p class  =" * 50_000, "<!--" * 100_000, "<script" * 100_000 + ">", "</script " * 100_000, "<" * 300_000])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    html_blocks.blocks(page)
    assert time.process_time() - began < 5


def test_deep_pages_share_their_paths():
    tracemalloc.start()
    html_blocks.blocks("<div>x" * 8000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20_000_000


def test_no_more_pages_are_collected_than_the_bound(spark, monkeypatch):
    """20,000 pages without an id, which all have one hash."""
    seen = []
    monkeypatch.setattr(html_blocks, "blocks", lambda page: seen.append(page) or [])
    pages = spark.range(20_000).select(F.lit(None).cast("bigint").alias("page_id"), F.concat(F.lit("<p>"), "id").alias("html"))
    assert html_blocks.fit(pages) is None and len(seen) == html_blocks.Settings().pages


def test_page_query(spark, sf_dir):
    import html

    got = {r.page_id: r for r in queries.op4_html_blocks(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body[1] if body else "")]
        want = "\n\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_page_edge_rows(spark, labeller):
    rows = [(1, "u", None, "a"), (2, None, "", "b"), (None, "u", PAGE, "c"), (None, "u", PAGE, "c")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_blocks.extract(df, labeller)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect())[:2] == [0, 0] and got.count() == 4
    assert html_blocks.extract(df.limit(0), labeller).count() == 0
    assert html_blocks.fit(df.limit(0)) is None
    assert html_blocks.main_texts(["<p>a<p>b"], None) == ["a\n\nb"]


def test_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    model = html_blocks.Labeller(html_blocks.Settings(hidden=3))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = html_blocks.padded([rng.normal(size=(n, html_blocks.PATH_DIMS + html_blocks.WORD_DIMS + html_blocks.SIZES)) for n in (4, 2)])
    x, y = x.astype(np.float64), rng.integers(0, 2, mask.shape)

    def loss():
        z = model.scores(x, mask)
        return (np.logaddexp(0, z) - y * z)[mask > 0].sum() / mask.sum()

    grad = model.gradients(x, mask, y)
    for name in ("hf", "hb", "xf", "ob", "out"):
        place = tuple(rng.integers(n) for n in model.p[name].shape)
        model.p[name][place] += 1e-2
        up = loss()
        model.p[name][place] -= 2e-2
        down = loss()
        model.p[name][place] += 1e-2
        assert abs((up - down) / 2e-2 - grad[name][place]) < 1e-3


# ---- URLs


def test_url_query(spark, sf_dir):
    assert rows_of_frame(queries.op7_url_filter(spark, sf_dir)) == rows_of(queries.SQL["op7_url_filter"], sf_dir)


URLS = [
    (None, "", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("x://y.example.com/de/1", "y.example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
    ("http://www.cheap-pills.com/a\nb", "www.cheap-pills.com", "/a\nb", None, "block"),
    ("http://pillsbury.com/", "pillsbury.com", "/", None, "allow"),
    ("http://a.com://b.net/", "a.com:", "//b.net/", None, "allow"),
    ("http://ÄÖ.net/", "ÄÖ.net", "/", "net/", "block"),
]


def test_url_rules(spark):
    hosts = [url_filter.host_rule(r, v) for r, v in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))]
    df = spark.createDataFrame([(u, "mine") for u, *_ in URLS], "url string, rule string")
    got = url_filter.filter_urls(df, hosts, url_filter.default_patterns()).collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == URLS
    assert url_filter.filter_urls(df.limit(0), hosts, []).count() == 0
    table = url_filter.filter_urls(df, hosts, url_filter.default_patterns(), literal_rules=0).collect()  # the same rules joined as a table
    assert sorted(map(str, table)) == sorted(map(str, got))


def test_rules_without_tokens_run_for_all(spark):
    df = spark.createDataFrame([("http://h/aa",), ("http://h/b",)], "url string")
    got = url_filter.filter_urls(df, [], [url_filter.Rule("double", "block", r"(.)\1$", ())]).collect()
    assert [r.verdict for r in got] == ["block", "allow"]


def test_filed_under_the_rarest_token(spark):
    df = url_filter.with_host_and_path(spark.createDataFrame([("http://a.b/c",), ("http://a.d/c",)], "url string"))
    assert url_filter.rarest_tokens(df, [url_filter.Rule("r", "block", "x", ("a", "b", "c"))]) == ["b"]


@pytest.mark.parametrize("most", [0, 20_000])
def test_rules_of_one_name(spark, most):
    """Each is filed under its own token; a pattern with a host rule's name is no host rule."""
    df = spark.createDataFrame([("http://aa/x",), ("http://bb/x",), ("http://cc/x",), ("http://aa/x",)], "url string")
    rules = [url_filter.Rule("dup", "block", "^aa", ("aa",)), url_filter.Rule("dup", "block", "^bb", ("bb",)), url_filter.Rule("cc/", "block", "^cc", ("cc",), -1)]
    got = url_filter.filter_urls(df, [url_filter.host_rule("cc/", "allow")], rules, literal_rules=most).collect()
    assert sorted((r.url, r.rule, r.pattern, r.verdict) for r in got if r.url > "http://b") == [("http://bb/x", None, "dup", "block"), ("http://cc/x", "cc/", "cc/", "allow")]
    assert [(r.rule, r.verdict) for r in got if r.url < "http://b"] == [(None, "block")] * 2


def test_thirty_thousand_rules(spark):
    rules = [url_filter.label_rule(f"bad{k}") for k in range(30_000)]
    df = spark.createDataFrame([("http://bad7.com/",), ("http://x-bad29999.org/a",), ("http://bad30000.com/",), (None,)], "url string")
    got = {r.url: r.verdict for r in url_filter.filter_urls(df, [], rules).collect()}
    assert [got[u.url] for u in df.collect()] == ["block", "block", "allow", "allow"]


def test_rules_from_a_table(spark):
    patterns = [r"//ads\.", r"/casino/", r"-win-[0-9]+", r"(?i)/spam/", r"zq|zw", r"[.]pills[.]", r"/x(yz)?-promo\.html"]
    found = url_filter.rules_of(spark.createDataFrame([(p,) for p in patterns] + [(None,)], "pattern string"))
    assert {r.pattern: r.tokens for r in found} == {patterns[0]: ("ads",), patterns[1]: ("casino",), patterns[2]: ("win",), patterns[3]: (), patterns[4]: (), patterns[5]: ("pills",), patterns[6]: ("promo",)}
    df = spark.createDataFrame([("http://h/casino/1",), ("http://h/Spam/",), ("http://q.pills.com/",), ("http://h/mycasino/",), ("http://h/zw",)], "url string")
    assert [r.verdict for r in url_filter.filter_urls(df, [], found).collect()] == ["block", "block", "block", "allow", "block"]


# ---- quality


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for k in range(len(w) - 2) if seen[(w[k], w[k + 1], w[k + 2])] > 1 for j in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_quality_query(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op8_quality_rules(spark, sf_dir).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in labels:
            assert r.kept == bool(labels[r.doc_id])


def test_quality_edge_rows(spark, documents, none):
    clashing = documents.withColumnRenamed("score", "n_words")
    measures = quality_rules.measured(clashing)
    assert {(r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in measures.collect()} == {(r.text, *base(r.text)) for r in documents.collect()}
    bounds = quality_rules.limits(quality_rules.sketches(measures))
    judged = quality_rules.judged(measures, bounds)
    assert judged.count() == documents.count() and judged.filter("kept is null").count() == 0
    assert quality_rules.filter_documents(none).count() == 0
    assert quality_rules.filter_documents(clashing).columns == clashing.columns


def test_limits_adapt_to_their_group(spark):
    clean = [(k, " ".join(f"word{k}x{j}" for j in range(60)), "en", "a") for k in range(60)]
    coded = [(100 + k, " ".join(f"w{k}x{j} #" for j in range(60)), "xx", "b") for k in range(60)]
    odd = [(200, " ".join(f"odd{j} #" for j in range(60)), "en", "a")]
    df = spark.createDataFrame(clean + coded + odd, "doc_id bigint, text string, lang string, source string")
    measures = quality_rules.measured(df)
    judged = quality_rules.judged(measures, quality_rules.limits(quality_rules.sketches(measures), least=20))
    assert {r.doc_id for r in judged.filter("not kept").collect()} == {200}


# ---- test items


def test_question_and_answer():
    assert decontaminate.question_and_answer("What is it? It is a cat.") == (["what", "is", "it"], ["it", "is", "a", "cat"])
    assert decontaminate.question_and_answer("one two three") == (["one", "two"], ["three"])
    assert decontaminate.question_and_answer("") == ([], [])


def test_retrieval_equals_scoring_all():
    import numpy as np

    rng = np.random.default_rng(5)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 80, rng.integers(3, 70)))) for k in range(60)]
    settings = decontaminate.Settings(threshold=0.3)
    index = decontaminate.TestItems(items, settings)
    ids = np.array([index.terms.get(f"t{x}", -1) for x in rng.integers(0, 120, 700)])
    entries = index.item_of
    want = set()
    for start in range(0, max(1, len(ids) - settings.stride), settings.stride):
        here = set(ids[start : start + 2 * settings.stride].tolist()) - {-1}
        score = np.zeros(len(entries))
        for t in here:
            for r in range(index.runs[t], index.runs[t + 1]):
                for p in range(index.run_start[r], index.run_start[r + 1]):
                    score[index.entry[p]] += index.impact[p]
        want |= {(int(entries[k]), start, round(float(score[k]), 6)) for k in np.flatnonzero(score >= settings.threshold - 1e-9)}
    assert {(i, s, round(x, 6)) for i, s, x in index.retrieved(ids)} == want and want


def test_decontamination_query(spark, sf_dir):
    terms = lambda t: [x for x in map(decontaminate.term, (t or "").split()) if x]
    items = {r.item_id: terms(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        own = " " + " ".join(terms(r.text)) + " "
        want |= {(r.doc_id, i) for i, t in items.items() if t and f" {' '.join(t)} " in own}
    got = queries.op10_decontaminate(spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)


def test_decontamination_edge_rows(spark, documents, none):
    item = "Which river runs through the old town of stones? The wide green river runs there."
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "x y z")], "item_id bigint, text string")
    extra = documents.withColumn("item_id", F.lit(5)).unionByName(spark.createDataFrame([(50, "so " * 400 + item.upper() + " and" * 90, "en", "a", 1, 5), (51, "Which river runs through the old town of stones? I do not know.", "en", "a", 1, 5)], "doc_id bigint, text string, lang string, source string, score bigint, item_id int"))
    got = decontaminate.contaminated(extra, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(50, 1)}
    kept = decontaminate.clean(extra, bench)
    assert kept.columns == extra.columns and kept.count() == extra.count() - 1
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(extra, bench.limit(0)).count() == 0
    assert decontaminate.clean(none, bench).count() == 0


def test_many_items_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 400)
    items = [(k, f"question number q{k} about thing t{k} in place p{k}? the answer is a{k} for sure b{k}.") for k in range(30)]
    docs = spark.createDataFrame([(k, "start " + t) for k, t in items], "doc_id bigint, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, k) for k in range(30)}


def test_one_index_equals_four(spark, monkeypatch):
    """Scores and hits do not depend on how many indexes the items are dealt to."""
    import numpy as np

    rng = np.random.default_rng(11)
    words = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.4, n) % 300)
    items = [(k, f"{words(rng.integers(3, 40))}? {words(rng.integers(1, 12))}.") for k in range(400)]
    texts = [(k, f"{words(50)} {items[rng.integers(400)][1]} {words(60)}") for k in range(60)]
    docs, bench = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    facts = lambda: sorted((r.doc_id, r.item_id, round(r.score, 9), r.first_word) for r in decontaminate.contaminated(docs, bench, decontaminate.Settings(threshold=0.4, overlap=0.2)).collect())
    one = facts()
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", sum(len(t) for _, t in items) // 4 + 1)
    assert facts() == one and len(one) > 60
    assert decontaminate.clean(docs, bench).count() < 60


def test_many_documents_at_once_equal_each_alone():
    import numpy as np

    rng = np.random.default_rng(7)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 200, rng.integers(5, 50)))) for k in range(80)]
    index = decontaminate.TestItems(items, decontaminate.Settings())
    texts = [None, "", "!!", *(" ".join([f"T{x}," for x in rng.integers(0, 400, rng.integers(0, 300))] + [items[rng.integers(80)][1]]) for _ in range(40))]
    ids = index.ids_of(pa.array(texts, pa.string()))
    assert [x.tolist() for x in ids] == [[index.terms.get(decontaminate.term(c), -1) for c in (t or "").split() if decontaminate.term(c)] for t in texts]
    got = index.contaminating_all(ids)
    assert got == [index.contaminating(x) for x in ids] and sum(map(bool, got)) >= 40


# ---- preferences


def test_preference_query(spark, sf_dir):
    assert rows_of_frame(queries.op2_preferences(spark, sf_dir)) == rows_of(queries.SQL["op2_preferences"], sf_dir)
    shared = [r.n_prefix_turns for r in queries.op2_preferences(spark, sf_dir).collect()]
    assert sum(n > 0 for n in shared) > 0.5 * len(shared)


def test_preferences(spark):
    rows = [
        (1, True, 10, 0, "user", "hi"), (1, True, 10, 1, "assistant", "good"), (1, True, 10, 1, "assistant", "good"), (1, True, 10, 2, None, None),
        (1, False, 11, 0, "user", "hi"), (1, False, 11, 1, "assistant", "bad ñ"),
        (2, True, 20, 0, "user", "x"), (3, False, 30, None, "user", "y"), (None, True, 40, 0, "user", "z"), (4, True, None, 0, "user", "z"),
        (5, True, 50, 0, "user", "same"), (5, False, 51, 0, "user", "same"),
    ]
    df = spark.createDataFrame(rows, "p bigint, good boolean, conv_id bigint, turn bigint, role string, text string").withColumn("prompt", F.lit("mine"))
    got = {r.pair_id: r for r in preferences.format_preferences(df, "p", "good").collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert (one.n_prefix_turns, one.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert one.chosen == "<|assistant|>\ngood<|end|>\n<|unknown|>\n<|end|>\n" and one.rejected == "<|assistant|>\nbad ñ<|end|>\n"
    assert [one.chosen[s.start : s.end] for s in one.chosen_mask] == ["good<|end|>\n"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_mask] == ["bad ñ<|end|>\n"]
    assert (got[2].prompt, got[2].rejected, got[2].rejected_id) == ("", "", None) and got[3].chosen == ""
    assert (got[5].n_prefix_turns, got[5].chosen, got[5].rejected) == (1, "", "")
    assert preferences.format_preferences(df.limit(0), "p", "good").count() == 0


def test_limits_are_the_same_in_every_run(spark):
    """A group of 100,000 rows in different orders and partitions: equal limits, and quantiles near the exact ones."""
    rows = spark.range(100_000).select(
        F.lit("en").alias("lang"),
        F.lit("hot").alias("source"),
        (50 + F.abs(F.hash("id")) % 900).cast("bigint").alias("n_words"),
        (400 + F.abs(F.hash("id", F.lit(1))) % 5000).cast("bigint").alias("word_chars"),
        (F.abs(F.hash("id", F.lit(2))) % 40).cast("bigint").alias("n_symbols"),
        (F.abs(F.hash("id", F.lit(3))) % 3).cast("bigint").alias("n_dup_lines"),
        F.lit(9).alias("__lines"),
        (F.abs(F.hash("id", F.lit(4))) % 30).cast("bigint").alias("n_repeat_words"),
        F.lit(False).alias("base_failed"),
    )
    found = [quality_rules.limits(quality_rules.sketches(r)).collect() for r in (rows, rows.repartition(7, "n_words"), rows.orderBy(F.desc("word_chars")))]
    assert found[0] == found[1] == found[2]
    exact = rows.select(F.expr("percentile_disc(0.5) within group (order by word_chars / n_words)").alias("m"), F.expr("percentile_disc(0.25) within group (order by word_chars / n_words)").alias("l")).first()
    assert abs(found[0][0].word_length_most - (exact.m + quality_rules.SPREADS * (exact.m - exact.l))) < 0.03 * found[0][0].word_length_most


def test_filtered_documents_keep_clashing_columns(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text, "en", "a", 5), (2, "short", "en", "a", 6)], "doc_id int, text string, lang string, source string, n_words int")
    assert [(r.doc_id, r.n_words) for r in quality_rules.filter_documents(docs).collect()] == [(1, 5)]


# ---- results that must not change with repeats


def test_repeats_crowd_out_no_language(spark):
    """20,000 copies of one Spanish text beside 60 German and 60 English ones: Spanish is learned, whatever the text is."""
    for k in range(3):
        spanish = spark.range(20_000).select("id", F.lit(f"el perro grande corre por la calle número {k}").alias("text"), F.lit("es").alias("lang"))
        others = spark.range(120).select((F.col("id") + 30_000).alias("id"), F.concat(F.lit("der und das ist nicht the of and "), "id").alias("text"), F.when(F.col("id") < 60, "de").otherwise("en").alias("lang"))
        model = string_kernel.fit(spanish.union(others).withColumnRenamed("id", "doc_id"))
        assert model.langs == ["de", "en", "es"]


def test_repeats_of_one_page_give_a_model(spark):
    page = "<html><body><ul class='menu'><li><a href='#'>Home</a></li></ul><article><h1>Title</h1><p>The council met on Monday and spoke at length.</p></article><footer>Imprint</footer></body></html>"
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.lit(page).alias("html"))
    model = html_blocks.fit(pages)
    assert model is not None
    assert html_blocks.main_texts([page], model) == ["Title\n\nThe council met on Monday and spoke at length."]


def test_limits_differ_between_groups(spark, sf_dir):
    """On the tables, with groups of a hundred: quartiles and tails set most limits, not the least spreads."""
    measures = quality_rules.measured(spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/documents.parquet").select("doc_id", "text", "lang", "source")).drop("text")
    rows = quality_rules.limits(quality_rules.sketches(measures), least=100).collect()
    own, floors = 0, 0
    for name, r in ((f"{r.name}_{side}", r) for r in quality_rules.RATIOS for side in (("most", "least") if r.low else ("most",))):
        values = {round(x[name], 6) for x in rows}
        own += len(values) > len(rows) / 4
        floors += sum(abs(x[name]) <= r.spreads * r.least_spread * 1.001 for x in rows)
    assert own >= 3 and floors <= 2 * len(rows)


def test_items_that_say_too_little(spark):
    docs = spark.createDataFrame([(1, "well yes that is a long text about nothing at all " * 3), (2, "so he said: the river runs north. Yes it does.")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "Yes."), (2, "Is it? Yes."), (3, "The river runs north. Yes it does.")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {(2, 3)}


def test_items_of_one_id_are_spread_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 400)
    items = [(None, f"question number q{k} about thing t{k} in place p{k}? the answer is a{k} for sure b{k}.") for k in range(30)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    sizes = [len(x.items) for x, several in decontaminate._indexes(bench, "item_id", "text", decontaminate.Settings()) if several]
    assert len(sizes) > 3 and max(sizes) < 15 and sum(sizes) == 30
