import re

import pytest
from eventide.llm import site_style_tree as sst
from eventide.llm.queries import QUERIES

from tests.conftest import SF001, SF01

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head>
<body class="news"><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side</aside><div id="ad-1">Buy</div>
<article><header><h1>Head &amp; line {n}</h1></header><p>First  <b>bold</b>
text&nbsp;{n}.<p>Second<br>line {n} &lt;ok&gt;<!-- no --><ul><li>one<li>two</ul>
<form><input value="x"><button>Send</button></form><div class="share">Share</div>
<section id="comments"><p>A reader says</p></section></article><footer>&copy; foot</footer></body></html>"""


def want(n):
    return f"Head & line {n}\nFirst bold text {n}.\nSecond line {n} <ok>\none\ntwo"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_article_without_furniture(spark):
    df = pages(spark, [(i, f"http://H{i % 3}.example/x", PAGE.format(n=i)) for i in range(30)])
    got = {r.page_id: r.text for r in sst.extract(df).collect()}
    assert got == {i: want(i) for i in range(30)}


def test_style_tree_removes_what_a_site_repeats(spark):
    """No marked element here: only entropy tells the furniture from the text."""
    def html(i, site):
        return (f"<body><div class=x7><p>Welcome to {site}</p><p>All about {site}</p></div>"
                f"<div class=y9><p>Story {i} of {site} begins</p><p>and {i} ends</p></div>"
                f"<div class=z3>Call us any time</div></body>")
    rows = [(i, f"http://{'ab'[i % 2]}.example/{i}", html(i, "ab"[i % 2])) for i in range(60)]
    rows.append((99, "http://small.example/", html(99, "small")))  # too few pages: the tree of all hosts
    got = {r.page_id: r.text for r in sst.extract(pages(spark, rows)).collect()}
    for i in range(60):
        assert got[i] == f"Story {i} of {'ab'[i % 2]} begins\nand {i} ends"
    assert "Call us" not in got[99] and "Story 99 of small begins\nand 99 ends" in got[99]


def test_site_of_one_article_keeps_it(spark):
    rows = [(i, "http://one.example/", "<body><article><p>Always the same story</p></article></body>") for i in range(40)]
    assert {r.text for r in sst.extract(pages(spark, rows)).collect()} == {"Always the same story"}


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<p>a</p> <p>cut <a hre", "a\ncut"),
    ("<p title='a>b'>x</p>", "x"), ("a < b and <p>c", "a < b and\nc"), ("<nav>only</nav>", ""), ("<p>x<script>1<2</p>", "x"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes", "yes"), ("</p></b>x</i>", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<P>UP</P><DIV>down</DIV>", "UP\ndown"),
    ("<p>a<span class=ad>x</span>b</p>", "ab"), ("<main><p>in</main><p>out", "in"), ("&#233;&eacute;&am", "éé&am"),
])
def test_single_pages(html, text):
    assert sst.Page(html or "").text({}) == text


STORY = "<h1>Head</h1><p>A story of <b>some</b> length.<p>Its end."
TOLD = "Head\nA story of some length.\nIts end."


@pytest.mark.parametrize("name", ["has-sidebar", "content-with-sidebar", "no-comments", "page-header-fixed", "wrapper sidebar"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_layout_wrappers_keep_their_page(name, tag):
    side = "<div class=sidebar>Side</div><div class='main-menu'><a href=/a>a menu of many many words and words</a></div>"
    for html in (f"<div class='{name}'><{tag}>{STORY}</{tag}>{side}</div><p class=site-footer>Foot</p>",
                 f"<main><div class='{name}'><div id=page-header><{tag}>{STORY}</{tag}></div>{side}</div></main>"):
        assert sst.Page(html).text({}) == TOLD


@pytest.mark.parametrize("html, text", [
    # word marks stay where the page has a text of its own
    (f"<article><p>Short.</article><div id=comments><article>{STORY}</article></div>", "Short."),
    (f"<div><p>Short.</div><div class=comments-area><article>{STORY}</article></div>", "Short."),
    (f"<main><p>Short.</main><div class=related-posts><article>{STORY}</article></div>", "Short."),
    (f"<div>{STORY}</div><div class=cookie-notice>We use cookies</div>", TOLD),
    (f"<div class=comments-on>{STORY}</div>", TOLD), ("<div hidden class=ad>no</div>", ""),
])
def test_word_marks_of_what_is_no_wrapper(html, text):
    assert sst.Page(html).text({}) == text


def test_odd_pages(spark):
    df = pages(spark, [(1, None, None), (1, None, None), (None, "", ""), (2, "nonsense", "<p>x" + " word" * 100_000),
                       (3, "http://h/", "<" * 2000), (4, "http://h/", "<div>" * 3000 + "deep")])
    df = df.selectExpr("*", "'t' AS text", "1 AS host", "2 AS nodes")
    got = sst.extract(df).collect()
    assert len(got) == 6 and all(r.text is not None and r.host == 1 for r in got)
    assert {r.text for r in got if r.page_id in (1, None)} == {""}
    assert [r.text for r in got if r.page_id == 4] == ["deep"]
    assert sst.extract(df.limit(0)).count() == 0


def test_pages_of_the_tables(spark):
    import html as h
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = QUERIES["op6_site_style_tree"](spark, SF01).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", source[r.page_id], re.S)[1]
        body = re.sub(r"<[^<>]*$", "", body)
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# --- pipeline ------------------------------------------------------------------------

def test_pipeline_stages(spark):
    """Each stage against a plain version on what its predecessor kept."""
    import corpus_pipeline as cp
    from eventide.llm import quality_ranker
    from tests.llm.test_dedup import brute_classes
    from tests.llm.test_mix_decontaminate_toxicity import brute

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "benchmark decontamination",
                     "mixing sources to target weights", "token-ID / binary output"]
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF001).cache()
        assert out.columns == docs.columns
        kept[name] = out.collect()
        docs = out
    first, second, third, fourth = kept.values()
    all_docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    ids = {r.doc_id for r in first}
    assert sum((labels[d] == 1) == (d in ids) for d in labels) >= 0.95 * len(labels)
    assert sorted(r.doc_id for r in second) == sorted(
        {int(c) for _, _, c in brute_classes([(r.doc_id, r.text) for r in first])})
    bad = {d for d, _ in brute([(r.doc_id, r.text) for r in second], bench)}
    assert sorted(r.doc_id for r in third) == sorted(r.doc_id for r in second if r.doc_id not in bad)
    assert {r.doc_id for r in fourth} <= {r.doc_id for r in third}
    records = cp.STAGES[-1][1](spark, docs, SF001).orderBy("start").collect()
    assert sorted(r.doc_id for r in records) == sorted(r.doc_id for r in fourth)
    assert records[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(records, records[1:]))
    assert quality_ranker.DECISION == 0.3 and all_docs.count() >= len(first)


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    import corpus_pipeline as cp
    for docs in (odd_docs, no_docs):
        for _, stage in cp.STAGES[:-1]:
            columns, docs = docs.columns, stage(spark, docs, SF001)
            assert docs.columns == columns
        assert cp.STAGES[-1][1](spark, docs, SF001).count() == docs.count()
