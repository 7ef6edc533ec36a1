import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubagem.llm import html_text
from cubagem.llm.html_text import Labeller, blocks_of, extract_text, features_of, fit_labeller, labels_of, rewritten

PAGES = "/root/testdata/sf0.01/pages.parquet"


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    page = (
        "<!DOCTYPE html><title>A &amp; <b></title><body class='x'><nav><ul><li><a href=/a>one</a><li>two</ul></nav><!-- no <p> -->"
        "<p>Some <b>bold<i>er</i></b>text&nbsp;&#233;\n\n x<br>next<p>more<script>var a='</p>';</script> 1 < 2 &am</p><td>cell<p"
    )
    assert texts(page) == ["A & <b>", "one", "two", "Some boldertext é x next", "more", "1 < 2 &am", "cell"]
    first, *_ = blocks_of("<div id=top class='menu Top-Bar'><ul><li><a href=x>go</a> now")
    assert [e[0] for e in first.path] == ["div", "ul", "li"] and set(first.path[0]) == {"div", "top", "menu", "bar"}
    assert 0 < first.linked < 1
    assert texts("") == texts("<p></p> \n") == texts("<!-- open <p>a</p>") == texts("<script>a<p>b</p>") == []
    assert texts("a" * 100_000 + "<p>b") == ["a" * 100_000, "b"]
    assert texts("<p title=\"a > b\">c</p><p title='open>d</p>") == ["c", "d"]


def test_gradients():
    rng = np.random.default_rng(5)
    model = Labeller(dim=7, hidden=3)
    model.weights = {name: w.astype(np.float64) for name, w in model.weights.items()}
    lengths, labels = np.array([5, 3, 1]), np.array([1, 0, -1, 1, 0, 0, 1, 1, -1])
    x = rng.normal(size=(9, 7))
    _, slopes = model.gradients(x, lengths, labels)
    for name, w in model.weights.items():
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 10)]:
            kept, losses = w[at], []
            for step in (1e-3, -1e-3):
                w[at] = kept + step
                losses.append(model.gradients(x, lengths, labels)[0])
            w[at] = kept
            assert slopes[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=2e-4)


def test_order_of_pages_does_not_matter():
    rng = np.random.default_rng(6)
    model, lengths = Labeller(dim=7, hidden=3), np.array([2, 0, 6, 1, 6])
    x = rng.normal(size=(15, 7)).astype(np.float32)
    together = model.probabilities(x, lengths)
    ends = np.cumsum(lengths)
    alone = [model.probabilities(x[e - n : e], np.array([n])) for n, e in zip(lengths, ends, strict=True) if n]
    np.testing.assert_allclose(together, np.concatenate(alone), atol=1e-6)


def main_text(page):
    """By the one way in which the given pages mark it."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)
    body = re.sub(r"<[^>]*$", "", body[1]) if body else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())


def test_held_out_pages_also_in_other_markup(spark):
    pages = [r["html"] for r in spark.read.parquet(PAGES).orderBy("page_id").collect()]
    model, rng = fit_labeller(pages[:150]), np.random.default_rng(7)
    words = np.array(" ".join(b.text for p in pages[150:] for b in blocks_of(p)).split(), object)
    right = known = 0
    for page in pages[150:]:
        blocks = blocks_of(page)
        found = model.probabilities(features_of(blocks), np.array([len(blocks)])) >= 0.5
        assert " ".join(b.text for b, kept in zip(blocks, found, strict=True) if kept) == main_text(page)
        other, labels = rewritten(blocks, labels_of(blocks), words, rng)
        found = model.probabilities(features_of(other), np.array([len(other)])) >= 0.5
        labels = np.array(labels)
        right, known = right + (found == labels)[labels >= 0].sum(), known + (labels >= 0).sum()
    assert right / known > 0.97


def test_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(html_text, "SLICE_CHARS", 5000)
    rows = spark.read.parquet(PAGES).withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("x"))
    long = "<article>" + "<p>The long words of it are many.</p>" * 3000 + "</article>"
    odd = [(None, None, None), (1, "u", ""), (1, "u", "<p></p>"), (2, None, "<nav><li><a href=x>Home</a></nav>" + long)]
    odd = spark.createDataFrame(odd, "page_id long, url string, html string").selectExpr("*", "'a' AS text", "'b' AS n_chars")
    found = extract_text(rows.union(rows.where("page_id < 5")).unionByName(odd)).collect()
    assert len(found) == rows.count() + 5 + 4 and all(r["n_chars"] == len(r["text"]) for r in found)
    assert [r["text"] for r in found if r["page_id"] is None] == [""]
    assert max((r["text"] for r in found), key=len) == " ".join(["The long words of it are many."] * 3000)
    pages = {(r["page_id"], r["url"]): main_text(r["html"]) for r in rows.collect()}
    assert all(pages[r["page_id"], r["url"]] == r["text"] for r in found if (r["page_id"], r["url"]) in pages)
    assert extract_text(rows.limit(0)).collect() == []
    assert [r["text"] for r in extract_text(odd.limit(3)).collect()] == ["", "", ""]
