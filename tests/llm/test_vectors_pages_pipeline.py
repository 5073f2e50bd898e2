from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from nimbra.llm import catalog, op7_html_extraction, op9_neighbours

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("blocks", [(4, 8), (4096, 8192)])
def test_neighbours_by_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(op9_neighbours, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(op9_neighbours, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(op9_neighbours, "ROWS_AT_ONCE", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    draw = np.random.default_rng(0)
    v = draw.normal(size=(90, 8)).astype(np.float32)
    v[20:50] = v[20]  # many ties
    v[50:55] *= 1e-42  # scales that underflow
    v[55:58] *= 1e18
    rows = [(i, [float(x) for x in v[i]], "x") for i in range(90)]
    rows += [(100, None, "x"), (101, [0.0] * 8, "x"), (102, [1.0] * 7 + [float("nan")], "x"), (103, [], "x"), (104, [1.0] * 7 + [None], "x"), (None, [1.0] * 8, "x"), (120, [1.0] * 5, "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string").repartition(3)
    try:
        got = op9_neighbours.nearest(frame.where("vec_id % 20 = 0"), frame, 7).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    d = v.astype(np.float64)
    expected = {}
    for q in range(0, 90, 20):
        scores = np.add.accumulate(d * d[q], axis=1)[:, -1]
        best = sorted((-scores[i], i) for i in range(90) if i != q)[:7]
        expected[q] = [(i, -s) for s, i in best]
    assert found == expected  # the query of another length has nothing to be compared with
    assert op9_neighbours.nearest(frame.limit(0), frame, 7).count() == 0
    assert op9_neighbours.nearest(frame.where("vec_id = 20"), frame.limit(0), 7).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><a href="/">Home</a><h1>Site</h1></header><nav><ul><li><a href=x>menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies, accept them all, please, today.</div><div id=sidebar><p>Aside, with commas, and more text here, quite long.</p></div>
<article><header><h1>The&nbsp;title &amp; more</h1><p>By someone</p></header><p>First <b>bold</b>, second\n  line, and a <a href="y">link</a> in it.<p>Short.
<ul><li>one item</li><li>another item</li></ul><div class="ad">buy now</div><form><p>Mail, please, give it to us now.</p></form>
<section class="comments"><p>A reader's comment, with commas, which is long enough.</p></section></article>
<footer>&copy; footer</footer></body></html>"""


def test_main_text():
    expected = "The title & more\n\nFirst bold, second line, and a link in it.\n\nShort.\n\none item\n\nanother item"
    assert op7_html_extraction.main_text(PAGE) == expected


def test_main_text_without_an_article_element():
    body = "".join(f"<p>Paragraph {i}, with some text, and commas, so that it scores.</p>" for i in range(4))
    page = f"<body><div class=menu><a href=1>One</a><a href=2>Two</a></div><div id=content><h2>Head</h2>{body}<p>End.</p></div><div><a href=a>more links</a> <a href=b>and more links</a></div>"
    got = op7_html_extraction.main_text(page).split("\n\n")
    assert got[0] == "Head" and got[-1] == "End." and len(got) == 6


@pytest.mark.parametrize("page", ["", "   ", "<p", "<", "<!-- x", "<script>x", "</p></div>", "<nav><a>x</a></nav>", "<a" * 1000, "<div>" * 3000, "&#xZZ; &bogus", "<b><p>x</b>y"])
def test_broken_pages(page):
    assert isinstance(op7_html_extraction.main_text(page), str)


def test_pages_of_any_kind(spark):
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", PAGE, 5), (3, "u", PAGE, 5), (None, "u", "<p>" + "long text, " * 100_000, 5)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    got = op7_html_extraction.extract(frame).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["n_chars"] > 0 for r in got} == {1: False, 2: False, 3: True, None: True}
    assert op7_html_extraction.extract(frame.limit(0)).count() == 0


def test_stages_chain_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, found = found, stage(spark, found, SF_DIR)
        assert found.columns == docs.columns
        assert found.select("doc_id").subtract(before.select("doc_id")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, found, SF_DIR)
    assert packed.select("doc_id").distinct().count() == found.count() > 0
    assert corpus_pipeline.STAGES[0][1](spark, docs.limit(0), SF_DIR).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES) == list(range(1, 14))
