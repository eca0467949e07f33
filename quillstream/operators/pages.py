"""Signals of parsed pages, and what screening and trial checks make of them.

A page is parsed once, into a table of its elements and pieces of text with their places, where an element's interval
encloses what it holds. Everything else is counting over that table: what stands in chrome, or in code, is told by the
furthest end of such elements opened so far, in one window over a page.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import scoring
from quillstream.functions.html import VOID
from quillstream.operators import funnel

# What a trial check leaves out of a page, elements whose text is no text, and phrases of login walls.
CHECK_CHROME = ["nav", "footer", "header", "script", "style"]
CHECK_CHROME_CLASSES = ["nav", "footer", "header"]
NO_TEXT = ["script", "style", "template"]
LOGIN_PHRASES = ["log in", "sign in", "register", "subscribe to read", "create an account", "forgot password", "sign up"]

PIECE = "#text"
NODES = "page_id long, pos int, end_pos int, tag string, kind string, classes array<string>, text string"
ATTRIBUTES = "attrs map<string, string>"


class _Nodes(HTMLParser):
    """Elements and pieces of text in one numbering. An end tag closes what is open inside its element; text between two
    marks of any kind is one piece."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[list] = []
        self.text: list[str] = []
        self.n = 0

    def _piece(self):
        if self.text and (piece := "".join(self.text).strip()):
            self.n += 1
            self.rows.append([self.n, self.n, PIECE, None, None, piece, None])
        self.text = []

    def handle_starttag(self, tag, attrs):
        self._piece()
        self.n += 1
        named = dict(attrs)
        row = [self.n, self.n, tag, named.get("type"), (named.get("class") or "").split(), None, [(k, v or "") for k, v in named.items()]]
        self.rows.append(row)
        if tag not in VOID:
            self.open.append(row)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._piece()
        if any(row[2] == tag for row in self.open):
            while True:
                row = self.open.pop()
                self.n += 1
                row[1] = self.n
                if row[2] == tag:
                    break

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._piece()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finish(self) -> list[list]:
        self.close()
        self._piece()
        for row in self.open:
            row[1] = self.n + 1
        return self.rows


def nodes(pages: DataFrame, attributes: bool = False) -> DataFrame:
    """NODES of pages(page_id, html): a row for every element and piece of text, where the page is; with ATTRIBUTES if
    they are asked for."""
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.map_(pa.string(), pa.string())][: 8 if attributes else 7]
    names = ["page_id", "pos", "end_pos", "tag", "kind", "classes", "text", "attrs"][: len(types)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 100):
                rows = []
                for page, html in zip(*(c.to_pylist() for c in batch[a : a + 100].columns), strict=True):
                    parser = _Nodes()
                    parser.feed(html or "")
                    rows += [(page, *row)[: len(types)] for row in parser.finish()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, NODES + (f", {ATTRIBUTES}" if attributes else ""))


def inside(tags: list[str], classes: list[str] = ()) -> Column:
    """Whether a node is one of these elements or stands in one: over a page's nodes in order."""
    hit = F.col("tag").isin(*tags)
    if classes:
        hit = hit | F.coalesce(F.arrays_overlap("classes", F.array(*map(F.lit, classes))), F.lit(False))
    so_far = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.max(F.when(hit, F.col("end_pos"))).over(so_far) >= F.col("pos"), F.lit(False))


def _text(wanted: Column) -> Column:
    """Pieces of text joined by one space, in order."""
    parts = F.array_sort(F.collect_list(F.when(wanted & (F.col("tag") == PIECE), F.struct("pos", "text"))))
    return F.array_join(F.transform(parts, lambda x: x["text"]), " ")


def page_signals(pages: DataFrame) -> DataFrame:
    """A row for each of pages(page_id, html) that has any node: has_password, login_phrases, articles, times, dates, h2
    over the whole page, and check_times, check_headings, check_dates of what is no chrome."""
    rows = nodes(pages).withColumns({"_out": ~inside(CHECK_CHROME, CHECK_CHROME_CLASSES), "_shown": ~inside(NO_TEXT)})
    tag = F.col("tag")
    counted = rows.groupBy("page_id").agg(
        F.bool_or((tag == "input") & (F.coalesce("kind", F.lit("")) == "password")).alias("has_password"),
        F.count_if(tag == "article").alias("articles"),
        F.count_if(tag == "time").alias("times"),
        F.count_if(tag == "h2").alias("h2"),
        F.count_if((tag == "time") & F.col("_out")).alias("check_times"),
        F.count_if(tag.isin("h2", "h3") & F.col("_out")).alias("check_headings"),
        F.lower(_text(F.col("_shown"))).alias("_text"),
        _text(F.col("_shown") & F.col("_out")).alias("_main"),
    )
    dates = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("long")
    return counted.select(
        "page_id", "has_password", scoring.phrase_count(F.col("_text"), LOGIN_PHRASES).alias("login_phrases"), "articles", "times", dates("_text", scoring.SCREEN_DATES).alias("dates"), "h2",
        "check_times", "check_headings", dates("_main", scoring.CHECK_DATES).alias("check_dates"),
    )


def with_signals(snapshots: DataFrame) -> DataFrame:
    """snapshots(page_id, status, html, ..) without html, with the signals of those answered by 200; others have none (0,
    false), as a page without any node has."""
    found = page_signals(snapshots.where("status = 200"))
    joined = snapshots.drop("html").join(found.hint("merge"), "page_id", "left")
    return joined.select(*[c for c in snapshots.columns if c != "html"], *[F.coalesce(c, F.lit(False) if c == "has_password" else F.lit(0)).alias(c) for c in found.columns if c != "page_id"])


def screen(snapshots: DataFrame) -> DataFrame:
    """with_signals(snapshots) with index_signals, reason and passed; a page that could not be fetched has no status."""
    return funnel.screen_verdict(with_signals(snapshots).withColumn("status", F.coalesce("status", F.lit(0))))


def daily_checks(snapshots: DataFrame) -> DataFrame:
    """(page_id, accessible, article_count, date_count, error) of a trial's check of each page."""
    rows = with_signals(snapshots)
    error = F.when(F.col("status").isNull(), "fetch error").when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    estimate = funnel.index_estimate(F.col("check_times"), F.col("check_dates"), F.col("check_headings"))
    return rows.select("page_id", error.isNull().alias("accessible"), estimate.alias("article_count"), F.col("check_dates").alias("date_count"), error.alias("error"))
