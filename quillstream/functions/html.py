"""Elements and links of html as table functions, and counts over them. The only Python in the reference's data path."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.sources import shared

VOID = set("area base br col embed hr img input link meta source track wbr".split())
# Elements that are no content, and body selectors in order of preference.
CHROME = ["nav", "footer", "header", "script", "style"]
BODY_TAGS = ["article", "main", "body"]
ELEMENTS = "page_id long, pos int, end_pos int, tag string, href string, kind string, rel string, classes string, label string, text string, inner string"


class _Elements(HTMLParser):
    """Start and end of each element in one numbering; an end tag closes what is open inside its element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.open, self.n = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.n += 1
        row = {"pos": self.n, "end": None, "tag": tag, "attrs": dict(attrs), "text": [], "inner": []}
        self.rows.append(row)
        if tag in VOID:
            row["end"] = self.n
        else:
            self.open.append(row)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(r["tag"] == tag for r in self.open):
            while True:
                self.n += 1
                row = self.open.pop()
                row["end"] = self.n
                if row["tag"] == tag:
                    break

    def handle_data(self, data):
        if self.open:
            self.open[-1]["text"].append(data)
        for row in self.open:
            if row["tag"] == "a":
                row["inner"].append(data)

    def finish(self):
        self.close()
        while self.open:
            self.n += 1
            self.open.pop()["end"] = self.n
        return self.rows


def elements(pages: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """A row for every element of pages(page_id, html), or for those of some tags: pos and end_pos enclose those of what it
    holds; text is its own, inner (of links) that of all it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ELEMENTS.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int32()] + [pa.string()] * 8
        for batch in batches:
            for a in range(0, len(batch), 200):
                out = []
                for page, text in zip(batch.column(0)[a : a + 200].to_pylist(), batch.column(1)[a : a + 200].to_pylist(), strict=True):
                    parser = _Elements()
                    parser.feed(text or "")
                    for r in parser.finish():
                        if tags is not None and r["tag"] not in tags:
                            continue
                        t = r["attrs"]
                        out.append((page, r["pos"], r["end"], r["tag"], t.get("href"), t.get("type"), t.get("rel"), t.get("class"), t.get("aria-label"), " ".join("".join(r["text"]).split()), " ".join(" ".join(r["inner"]).split()) if r["tag"] == "a" else None))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return pages.select("page_id", "html").mapInArrow(run, ELEMENTS)


def without_chrome(rows: DataFrame, chrome: list[str] = CHROME) -> DataFrame:
    """Elements that are no chrome and stand in none: intervals of chrome are spread to what they enclose by a window,
    so there is no join of a page's elements with themselves."""
    from pyspark.sql import Window

    seen = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("tag").isin(chrome), F.col("end_pos"))).over(seen)
    return rows.withColumn("_last", last).where(F.coalesce(F.col("_last") < F.col("pos"), F.lit(True))).drop("_last")


def links(rows: DataFrame) -> DataFrame:
    """(page_id, pos, href, label) of anchors with a link."""
    return rows.where("tag = 'a' and href is not null").select("page_id", "pos", F.trim("href").alias("href"), F.coalesce(F.nullif("label", F.lit("")), "inner").substr(1, 100).alias("label"))


def tag_counts(rows: DataFrame, tags: list[str]) -> DataFrame:
    return rows.groupBy("page_id").agg(*[F.count_if(F.col("tag") == t).alias(f"n_{t}") for t in tags], F.count_if((F.col("tag") == "input") & (F.lower("kind") == "password")).alias("n_password"))


def body_text(rows: DataFrame, least: int = 0) -> DataFrame:
    """page_id and text: what the first element of the best-ranked tag in BODY_TAGS encloses, chrome left out. rows are read
    twice: a stored table is not parsed twice."""
    rank = F.array_position(F.array(*map(F.lit, BODY_TAGS)), F.col("tag"))
    best = rows.where(F.col("tag").isin(BODY_TAGS)).groupBy("page_id").agg(F.min(F.struct(rank.alias("rank"), "pos", "end_pos")).alias("b"))
    inside = without_chrome(rows).join(best.hint("merge"), "page_id").where("pos >= b.pos and end_pos <= b.end_pos and text <> ''")
    parts = F.array_sort(F.collect_list(F.struct("pos", "text")))
    text = F.array_join(F.transform(parts, lambda x: x["text"]), "\n")
    return inside.groupBy("page_id").agg(text.alias("text")).where(F.length("text") >= least)


def body_rules(spark, rules: list[tuple]) -> DataFrame:
    """(source_id, selector_rank, tag, class): where a source keeps its body, best first."""
    return spark.createDataFrame(rules, "source_id string, selector_rank int, body_tag string, body_class string")


def _has_class(name: str):
    return F.col(name).isNull() | F.array_contains(F.split(F.coalesce("classes", F.lit("")), " "), F.col(name))


def body_by_rules(rows: DataFrame, rules: DataFrame, least: int = 100) -> DataFrame:
    """page_id, selector_rank and text: the first selector of the source's ranked rules whose text is longer than
    `least`, chrome left out; a page has at most as many candidates as its source has rules. rows are read twice: a stored
    table is not parsed twice."""
    from pyspark.sql import Window

    hits = rows.join(shared.by_size(rules), "source_id").where((F.col("tag") == F.col("body_tag")) & _has_class("body_class"))
    order = F.row_number().over(Window.partitionBy("page_id", "selector_rank").orderBy("pos"))
    hits = hits.withColumn("_n", order).where("_n = 1").select("page_id", "selector_rank", F.col("pos").alias("_a"), F.col("end_pos").alias("_b"))
    inside = without_chrome(rows).where("text <> ''").join(hits.hint("merge"), "page_id").where("pos >= _a and end_pos <= _b")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n")
    texts = inside.groupBy("page_id", "selector_rank").agg(text.alias("text")).where(F.length("text") > least)
    return texts.groupBy("page_id").agg(F.min(F.struct("selector_rank", "text")).alias("b")).select("page_id", "b.selector_rank", "b.text")


def feeds(rows: DataFrame) -> DataFrame:
    """(page_id, pos, href) of linked RSS and Atom feeds."""
    kind = F.lower(F.coalesce("kind", F.lit("")))
    return rows.where("tag = 'link' and trim(href) <> ''").where(F.lower("rel").contains("alternate") & (kind.contains("rss+xml") | kind.contains("atom+xml"))).select("page_id", "pos", F.trim("href").alias("href"))


@F.udtf(returnType="pos int, href string, label string", useArrow=True)
class HtmlLinks:
    """html_links(html): links of one page as rows, for LATERAL joins in SQL."""

    def eval(self, page: str):
        parser = _Elements()
        parser.feed(page or "")
        for r in parser.finish():
            if r["tag"] == "a" and r["attrs"].get("href") is not None:
                yield r["pos"], r["attrs"]["href"].strip(), (r["attrs"].get("aria-label") or " ".join(" ".join(r["inner"]).split()))[:100]


@F.udtf(returnType="pos int, end_pos int, tag string, classes string, text string", useArrow=True)
class HtmlElements:
    """html_elements(html): elements of one page as rows, for LATERAL joins in SQL."""

    def eval(self, page: str):
        parser = _Elements()
        parser.feed(page or "")
        for r in parser.finish():
            yield r["pos"], r["end"], r["tag"], r["attrs"].get("class"), " ".join("".join(r["text"]).split())


def register(spark) -> None:
    """html_links and html_elements as table functions of the session."""
    spark.udtf.register("html_links", HtmlLinks)
    spark.udtf.register("html_elements", HtmlElements)
