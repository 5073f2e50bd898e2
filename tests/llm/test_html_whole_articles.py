"""Text of an article that looks like something else, and pages that are badly closed."""

from __future__ import annotations

import time

from nimbra.llm.op7_html_extraction import main_text

P = "A sentence of an article, with some words in it, and more of them to come. " * 3
TEXT = P.strip()


def page(inside: str) -> list[str]:
    head = '<nav><a href="/">Home</a> <a href="/b">News</a></nav>'
    foot = '<footer><p>All rights reserved by the owners of this page.</p></footer>'
    return main_text(f"<html><body>{head}<article>{inside}</article>{foot}</body></html>").split("\n\n")


def test_references_stay_and_announced_links_go():
    links = "".join(f'<li><a href="/{i}">Paper number {i} of them</a></li>' for i in range(4))
    got = page(f"<p>{P}</p><h2>References</h2><ol>{links}</ol><h2>Related articles</h2><ul>{links}</ul>")
    assert got == [TEXT, "References", *[f"Paper number {i} of them" for i in range(4)]]
    assert page(f"<p>{P}</p><div><h3>Lire aussi</h3><ul>{links}</ul></div><p>{P}</p>") == [TEXT, TEXT]
    assert page(f'<p>{P}</p><ul class="related">{links}</ul><p>{P}</p>') == [TEXT, TEXT]


def test_standfirst_stays_and_byline_goes():
    lead = "What happened on that day, and why it matters."
    got = page(f"<header><h1>Title</h1><p>{lead}</p><p>By A. Writer, 3 May 2024, 10:15</p></header><p>{P}</p>")
    assert got == ["Title", lead, TEXT]


def test_formulas_and_fallback_texts_are_read():
    assert page(f"<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold in all that follows here.</p><p>{P}</p>")[0] == (
        "Let x=2 hold in all that follows here."
    )
    assert page(f'<p>{P}</p><object data="a"><p>{P}</p></object>') == [TEXT, TEXT]


def test_unclosed_elements_do_not_swallow_the_rest():
    for name in ("object", "noscript", "svg", "iframe", "select", "template"):
        assert page(f"<p>{P}</p><{name}><p>{P}</p>")[0] == TEXT
        assert len(page(f"<p>{P}</p><{name} a=b><p>{P}</p>")) == 2, name
    assert page(f"<p>{P}</p><script>var a = '<p>no</p>';")[0] == TEXT


def test_deep_nesting_takes_linear_time():
    began = time.perf_counter()
    for name in ("div", "b"):
        assert page(f"<{name}>" * 50_000 + f"<p>{P}</p>" + f"</{name}>" * 50_000) == [TEXT]
    assert time.perf_counter() - began < 4
