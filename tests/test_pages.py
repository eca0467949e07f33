"""Signals of pages against a plain parse of each."""

import random
import re

import pytest

from quillstream.functions import dom, scoring
from quillstream.operators import pages

CHROME = "nav, footer, header, .nav, .footer, .header, script, style"


def plain(page):
    root = dom.parse(page)
    text = root.text(" ").lower()
    out = {
        "has_password": any(n.attrs.get("type") == "password" for n in root.select("input")),
        "login_phrases": sum(p in text for p in pages.LOGIN_PHRASES),
        "articles": len(root.select("article")),
        "times": len(root.select("time")),
        "dates": len(re.findall(scoring.SCREEN_DATES, text)),
        "h2": len(root.select("h2")),
    }
    root.remove(CHROME)
    main = root.text(" ")
    return out | {"check_times": len(root.select("time")), "check_headings": len(root.select("h2, h3")), "check_dates": len(re.findall(scoring.CHECK_DATES, main))}


def random_page(rng, depth=4):
    out = []
    for _ in range(rng.randrange(1, 6)):
        tag = rng.choice(["p", "div", "h2", "h3", "time", "article", "nav", "header", "section", "script", "b", "template"])
        kind = rng.choice(["", "", "", ' class="nav x"', ' class="big"', " class=footer"])
        inner = random_page(rng, depth - 1) if depth and rng.random() < 0.6 and tag != "script" else rng.choice(["Jan 5, 2024", "2024-03-04 and 5 feb 2023", "log in", "Sign up now", "x &amp; y", "<br>6 May", "  ", "2024/1/2"])
        out.append(f"<{tag}{kind}>{inner}</{tag}>" if rng.random() < 0.93 else f"<{tag}{kind}>{inner}")
        if rng.random() < 0.2:
            out.append(rng.choice(["tail 7 Jun 2024", '<input type="password">', "<input type=text>", "<!-- Jan 6, 2024 -->", "Aug <i>9</i>, 2024"]))
    return "".join(out)


@pytest.fixture(scope="module")
def some():
    rng = random.Random(5)
    fixed = [None, "", "only text 2024-01-02", "<p>a</p></div></p>", "<nav><h2>a</h2>", "<div class='nav'>Jan 1, 2024<h2>x</h2></div><h2>y</h2>" * 2, "<h2>a" * 5, "<article>" * 3 + "<time>" * 3]
    return fixed + [random_page(rng) for _ in range(150)]


def test_signals_equal_a_plain_parse(spark, some):
    rows = spark.createDataFrame([(k, 200, p, "x") for k, p in enumerate(some)], "page_id long, status int, html string, text string")
    got = {r["page_id"]: r.asDict() for r in pages.with_signals(rows).collect()}
    names = plain("").keys()
    assert len(got) == len(some)
    wrong = [(some[k], plain(some[k]), {n: got[k][n] for n in names}) for k in got if {n: got[k][n] for n in names} != plain(some[k])]
    assert not wrong, wrong[0]


def test_verdicts_and_checks(spark):
    index = "<article>a</article>" * 2 + "<time>t</time>" * 2
    rows = [(1, 200, index), (2, 200, index + "<input type=password>"), (3, 200, "<p>log in</p><p>or register</p>" + index), (4, 200, "<h2>a</h2>" * 3), (5, 200, "<p>a</p>"), (6, 404, index), (7, None, None), (8, 200, None), (9, 200, "<h3>x</h3>" * 30 + "<nav>" + "<time>x</time>" * 40 + "</nav>")]
    df = spark.createDataFrame(rows, "page_id long, status int, html string")
    assert {r["page_id"]: r["reason"] for r in pages.screen(df).collect()} == {1: "index", 2: "login wall", 3: "login wall", 4: "index", 5: "no index", 6: "not accessible", 7: "not accessible", 8: "no index", 9: "no index"}
    checks = {r["page_id"]: (r["accessible"], r["article_count"], r["error"]) for r in pages.daily_checks(df).collect()}
    assert checks[1] == (True, 2, None) and checks[6] == (False, 0, "HTTP 404") and checks[7] == (False, 0, "fetch error") and checks[9] == (True, 20, None)
