"""Bodies by rules against a plain parse of each page with the same selectors."""

import random

import pytest

from quillstream.functions import dom
from quillstream.operators import bodies, listing

MARKERS = ["terms of use", "log in"]


def plain_body(page, source):
    if source not in listing.BODIES:
        return None
    root = dom.parse(page)
    root.remove(listing.CHROME)
    for selector in [listing.BODIES[source], *listing.FALLBACKS]:
        if found := root.select(selector):
            return "\n".join(n.text() for n in found)
    return root.text()


def plain_strict(page, least):
    root = dom.parse(page)
    root.remove(listing.STRICT_CHROME)
    for selector in listing.STRICT:
        found = " ".join(" ".join(n.text(" ") for n in root.select(selector)).split())
        if len(found) >= least and not any(m in found.lower() for m in MARKERS):
            return found
    return None


def plain_sample(page):
    root = dom.parse(page)
    root.remove(listing.SAMPLE_CHROME)
    longest = max((n.text(" ") for n in root.select("article")), key=len, default="")
    if len(longest) > 200:
        return longest[:3000]
    for selector in listing.SAMPLE:
        joined = "\n\n".join(t for n in root.select(selector) if len(t := n.text(" ")) > 100)
        if len(joined) > 200:
            return joined[:3000]
    node = root.first("main") or root.first("body")
    found = node.text(" ") if node is not None else ""
    return found[:3000] if len(found) > 200 else None


KINDS = ["", "", " class='field--body big'", " class='content'", " class='cmp-text x'", " itemprop='articleBody'", " class='article-body'", " class='rich-text'", " class='nav'", " class='cookie'", " class=research-detail"]


def random_page(rng, depth=4):
    out = []
    for _ in range(rng.randrange(1, 4)):
        tag = rng.choice(["p", "div", "div", "article", "main", "section", "nav", "form", "script", "aside", "b"])
        words = " ".join(rng.choice(["alpha", "be&amp;ta", "Terms", "of", "use", "gamma", "log", "in", "<br>"]) for _ in range(rng.choice([3, 20, 80])))
        inner = random_page(rng, depth - 1) if depth and tag != "script" and rng.random() < 0.7 else words
        out.append(f"<{tag}{rng.choice(KINDS)}>{inner}</{tag}>")
    return rng.choice(["", " loose words "]) + "".join(out)


def test_bodies_equal_a_plain_parse(spark):
    rng = random.Random(3)
    sources = [*listing.BODIES, "unknown", None]
    pages = [None, "", "plain text of some length", "<article></article><p>x</p>"] + [f"<body>{random_page(rng)}</body>" for _ in range(250)]
    rows = [(k, sources[k % len(sources)], p) for k, p in enumerate(pages)]
    got = {r["page_id"]: r for r in bodies.bodies(spark.createDataFrame(rows, "page_id long, source_id string, html string"), bodies.body_rules(spark), 40, MARKERS).collect()}
    assert len(got) == len(rows)
    seen = [0, 0, 0]
    for k, source, page in rows:
        body = plain_body(page, source)
        want = (body if body is not None and len(body) >= 40 else None, plain_strict(page, 40), plain_sample(page))
        assert (got[k]["body"], got[k]["strict"], got[k]["sample"]) == want, (k, source, page)
        seen = [n + (w is not None) for n, w in zip(seen, want, strict=True)]
    assert min(seen) > 40


@pytest.mark.parametrize(
    "selector, want",
    [("div.a p", ["one", "two"]), ("[data-k='v w'] b, i", ["deep", "last"]), ("section div.a.c p", ["two"]), ("P", ["one", "two", "out"]), ("[data-k*='w'] b", ["deep"]), ("[data-k]", ["deep"]), ("q", []), ("section section p", [])],
)
def test_a_row_adds_a_source(spark, selector, want):
    page = "<section><div class='a b'><p>one</p></div><div class='c a'><p>two</p></div></section><p>out</p><span data-k='v w'><u><b>deep</b></u></span><i>last</i>"
    rules = spark.createDataFrame([("new", "body", 0, selector)], bodies.RULES)
    found = spark.createDataFrame([(1, "new", page), (2, "other", page)], "page_id long, source_id string, html string")
    got = bodies.bodies(found, rules, 1).collect()
    assert {r["page_id"]: r["body"] for r in got} == {1: "\n".join(want) if want else None, 2: None}


def test_contents_fall_back_to_the_feed(spark):
    schema = "page_id long, source_id string, status int, body string, title string, category string, summary string"
    rows = [(1, "ark", 200, "text", "t", None, None), (2, "ark", 403, None, " t ", "c", "s"), (3, "ark", 200, None, "t", "", None), (4, "ark", 500, None, "t", "c", "s"), (5, "man", 403, None, "t", "c", "s"), (6, "ark", 403, None, "", "c", " "), (7, "ark", None, None, "t", "", ""), (8, "man", 200, "x", None, None, None)]
    got = bodies.contents(spark.createDataFrame(rows, schema), bodies.body_rules(spark)).collect()
    assert {r["page_id"]: (r["content_status"], r["content"]) for r in got} == {
        1: ("ok", "text"), 2: ("metadata_only", "Title: t\nCategory: c\nSummary: s"), 3: ("metadata_only", "Title: t"), 4: ("failed", None),
        5: ("failed", None), 6: ("failed", None), 7: ("failed", None), 8: ("ok", "x"),
    }


def test_no_rules_and_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, source_id string, html string")
    assert bodies.bodies(empty, bodies.body_rules(spark)).count() == 0
    none = bodies.bodies(spark.createDataFrame([(1, "man", "<p>x</p>")], empty.schema), spark.createDataFrame([], bodies.RULES)).collect()
    assert [tuple(r) for r in none] == [(1, None, None, None)]


def test_only_the_kinds_asked_for_are_made(spark):
    """The daily run reads bodies alone: samples and strict texts are several times the work."""
    page = "<main><article><p>" + "word " * 60 + "</p></article><article><p>more of it</p><script>x</script></article></main>"
    found = spark.createDataFrame([(1, "man", page), (2, "ark", page), (3, "other", page), (4, "man", None)], "page_id long, source_id string, html string")
    rules = bodies.body_rules(spark)
    every, body = bodies.bodies(found, rules).collect(), bodies.bodies(found, rules, kinds=("body",)).collect()
    assert {r.page_id: r.body for r in body} == {r.page_id: r.body for r in every}
    assert all(r.strict is None and r.sample is None for r in body) and any(r.strict and r.sample for r in every)
    assert {r.kind for r in bodies.texts(found, rules, ("body",)).collect()} == {"body"}
