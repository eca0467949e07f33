"""Bodies of articles by rules that are rows: selectors compiled into joins and windows over the table of parsed nodes.

A rule says of a source (or of every one, *) which selector to try at which rank, for what kind of text. Selectors are
taken apart in SQL into alternatives of steps, each a tag, classes and attributes. A node that a step describes is a hit;
a hit of a later step counts where a hit of the step before encloses it, by the intervals of nodes, in one window over
the hits of a page; a hit of the last step is a selected node. Pages are parsed once, for all rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.functions import text
from quillstream.operators import listing, pages
from quillstream.sources import shared

RULES = "source_id string, kind string, rank int, selector string"
EVERY = "*"
# What is left out of a page before a kind of text is looked for.
CHROME = {"body": listing.CHROME, "strict": listing.STRICT_CHROME, "sample": listing.SAMPLE_CHROME}
_CHROME_OF = {"body": "body", "strict": "strict", "article": "sample", "sample": "sample", "main": "sample"}
KINDS = tuple(_CHROME_OF)
WHOLE = ""  # the selector of the page itself


def body_rules(spark: SparkSession) -> DataFrame:
    """The known sources' rules. Kinds: body, of a source's own selector, then the fallbacks, then the page; strict, ranked
    selectors of every source; article, sample and main, as quality samples are read; metadata, of sources whose feed
    stands in for a body that cannot be had."""
    of_every = {"body": [*listing.FALLBACKS, WHOLE], "strict": listing.STRICT, "article": ["article"], "sample": listing.SAMPLE, "main": ["main", "body"]}
    rows = [(s, "body", 0, selector) for s, selector in listing.BODIES.items()] + [("ark", "metadata", 0, WHOLE)]
    rows += [(EVERY, kind, k + (kind == "body"), selector) for kind, own in of_every.items() for k, selector in enumerate(own)]
    return spark.createDataFrame(rows, RULES)


def steps(rules: DataFrame) -> DataFrame:
    """(source_id, kind, rank, alternative, step, n_steps, want_tag, want_classes, want_attrs) of every rule with a
    selector. A space stands between steps, a comma between alternatives, neither inside brackets."""
    each = rules.where(F.trim("selector") != WHOLE).select("source_id", "kind", "rank", F.posexplode(F.regexp_extract_all("selector", F.lit(r"(?:\[[^\]]*\]|[^,\[])+"), F.lit(0))).alias("alternative", "_chain"))
    each = each.withColumn("_steps", F.regexp_extract_all("_chain", F.lit(r"(?:\[[^\]]*\]|[^\s\[])+"), F.lit(0)))
    each = each.select("source_id", "kind", "rank", "alternative", F.size("_steps").alias("n_steps"), F.posexplode("_steps").alias("step", "_own"))
    bare = F.regexp_replace("_own", r"\[[^\]]*\]", "")
    parts = lambda a: F.struct(F.regexp_extract(a, r"^([\w:-]+)", 1).alias("name"), F.regexp_extract(a, r"^[\w:-]+(\*?=)", 1).alias("op"), F.regexp_extract(a, r"""=['"]?([^'"]*)""", 1).alias("value"))
    return each.select(
        "source_id", "kind", "rank", "alternative", "step", "n_steps", F.lower(F.regexp_extract("_own", r"^([a-zA-Z][\w-]*)", 1)).alias("want_tag"),
        F.regexp_extract_all(bare, F.lit(r"\.([\w-]+)"), F.lit(1)).alias("want_classes"),
        F.transform(F.regexp_extract_all("_own", F.lit(r"\[([^\]]*)\]"), F.lit(1)), parts).alias("want_attrs"),
    )


def _described() -> Column:
    """A node is what a step wants."""

    def has(a: Column) -> Column:
        value = F.try_element_at(F.col("attrs"), a["name"])
        fits = F.when(a["op"] == "", True).when(a["op"] == "*=", F.contains(value, a["value"])).otherwise(value == a["value"])
        return value.isNotNull() & fits

    return ((F.col("want_tag") == "") | (F.col("tag") == F.col("want_tag"))) & (F.size(F.array_except("want_classes", "classes")) == 0) & F.forall("want_attrs", has)


def _chrome(selector: str) -> Column:
    own = [s.strip() for s in selector.split(",")]
    return pages.inside([s for s in own if not s.startswith(".")], [s[1:] for s in own if s.startswith(".")])


def _in_chrome(kinds: tuple[str, ...]) -> Column:
    """Whether a node is left out for its row's kind."""
    out = F.lit(False)
    for kind in kinds:
        out = F.when(F.col("kind") == kind, F.col(f"_no_{_CHROME_OF[kind]}")).otherwise(out)
    return out


def selected(nodes: DataFrame, rules: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(page_id, kind, rank, pos, end_pos) of the nodes that the rules' selectors find: nodes(page_id, source_id, NODES,
    attrs and whether each stands in chrome)."""
    wanted = steps(rules)
    longest = wanted.agg(F.max("n_steps")).first()[0] or 1
    elements = nodes.where(F.col("tag") != pages.PIECE).drop("kind").withColumn("source_id", F.explode(F.array("source_id", F.lit(EVERY))))
    hits = listing.by_source(elements, wanted).where(_described() & ~_in_chrome(kinds))
    hits = hits.select("page_id", "kind", "rank", "alternative", "step", "n_steps", "pos", "end_pos", (F.col("step") == 0).alias("_ok"))
    before = Window.partitionBy("page_id", "kind", "rank", "alternative").orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    for step in range(1, longest):
        reach = F.max(F.when(F.col("_ok") & (F.col("step") == step - 1), F.col("end_pos"))).over(before)
        hits = hits.withColumn("_reach", reach).withColumn("_ok", F.when(F.col("step") == step, F.coalesce(F.col("_reach") >= F.col("end_pos"), F.lit(False))).otherwise(F.col("_ok"))).drop("_reach")
    return hits.where(F.col("_ok") & (F.col("step") == F.col("n_steps") - 1)).select("page_id", "kind", "rank", "pos", "end_pos").distinct()


def texts(found: DataFrame, rules: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(page_id, kind, rank, parts): the text of every node that a rule of these kinds selects, in order; of found(page_id,
    source_id, html). A body's pieces of text follow each other as they stand, others are set apart by a space."""
    chrome = {n: CHROME[n] for n in dict.fromkeys(_CHROME_OF[k] for k in kinds)}
    rules = rules.where(F.col("kind").isin(*kinds))
    source = found.select("page_id", "source_id")
    parsed = shared.stored(pages.nodes(found, attributes=True), "nodes").join(source.hint("merge"), "page_id")
    marked = parsed.withColumns({f"_no_{n}": _chrome(selector) for n, selector in chrome.items()} | {"_shown": ~pages.inside(pages.NO_TEXT)})
    every = [(F.lit(0), F.lit(2**31 - 1).cast("int"))]
    whole = listing.by_source(source.withColumn("source_id", F.explode(F.array("source_id", F.lit(EVERY)))), rules.where((F.trim("selector") == WHOLE)))
    picked = selected(marked, rules, kinds).unionByName(whole.select("page_id", "kind", "rank", every[0][0].alias("pos"), every[0][1].alias("end_pos")))
    pieces = marked.where((F.col("tag") == pages.PIECE) & F.col("_shown")).select("page_id", F.col("pos").alias("_at"), "text", *[f"_no_{n}" for n in chrome])
    inside = picked.join(pieces.hint("merge"), "page_id", "left")
    there = (F.col("_at") > F.col("pos")) & (F.col("_at") <= F.col("end_pos")) & ~_in_chrome(kinds)
    own = F.transform(F.array_sort(F.collect_list(F.when(there, F.struct("_at", "text")))), lambda x: x["text"])
    each = inside.groupBy("page_id", "kind", "rank", "pos").agg(own.alias("_own"))
    each = each.withColumn("_text", F.when(F.col("kind") == "body", F.array_join("_own", "")).otherwise(F.array_join("_own", " ")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "_text"))), lambda x: x["_text"])
    return each.groupBy("page_id", "kind", "rank").agg(parts.alias("parts"))


def bodies(found: DataFrame, rules: DataFrame, least: int = 100, markers: list[str] = (), kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(page_id, body, strict, sample) of found(page_id, source_id, html); null what needs other kinds of text than `kinds`.

    body: what the best-ranked selector that finds anything holds, at least `least` long, for sources with a rule of their
    own; strict: the first ranked selector's text that is long enough and holds none of the markers; sample: the longest
    article, else the long parts of the first known container, else the page's main part, over 200 and at most 3,000
    characters. A page without html has none of them.
    """
    rows = texts(found, rules, kinds)
    of = lambda kind: F.col("kind") == kind
    joined = lambda between, parts="parts": F.array_join(parts, between)
    strict = text.squeezed(joined(" "))
    gated = F.exists(F.array(*map(F.lit, markers)), lambda m: F.contains(F.lower(strict), m)) if markers else F.lit(False)
    longest = F.array_max(F.transform("parts", lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    long_parts = joined("\n\n", F.filter("parts", lambda t: F.length(t) > 100))
    first = lambda value, test: F.min_by(value, F.when(test, F.col("rank")))
    main = F.element_at("parts", 1)
    best = rows.groupBy("page_id").agg(
        first(joined("\n"), of("body")).alias("_body"),
        first(strict, of("strict") & (F.length(strict) >= least) & ~gated).alias("strict"),
        first(longest["t"], of("article") & (longest["n"] > 200)).alias("_article"),
        first(long_parts, of("sample") & (F.length(long_parts) > 200)).alias("_sample"),
        first(main, of("main")).alias("_main"),
    )
    sample = F.coalesce("_article", "_sample", F.when(F.length("_main") > 200, F.col("_main")))
    ruled = rules.where((F.col("kind") == "body") & (F.col("source_id") != EVERY)).select("source_id", F.lit(True).alias("_ruled")).distinct()
    every = listing.by_source(found.select("page_id", "source_id"), ruled, "left").join(best.hint("merge"), "page_id", "left")
    body = F.when(F.col("_ruled") & (F.length("_body") >= least), F.col("_body"))
    return every.select("page_id", body.alias("body"), "strict", F.substring(sample, 1, 3000).alias("sample"))


def contents(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows(page_id, source_id, status, body, title, category, summary, ..) with content and content_status: the body; or,
    for sources with a metadata rule whose page is forbidden (403) or too short, what their feed says, as metadata_only;
    or nothing, as failed."""
    may = rules.where("kind = 'metadata'").select("source_id", F.lit(True).alias("_may")).distinct()
    held = listing.by_source(rows, may, "left")
    meta = text.metadata_body(*[F.trim(F.coalesce(c, F.lit(""))) for c in ("title", "category", "summary")])
    body = F.when(F.col("status") == 200, F.col("body"))
    instead = F.when(F.col("_may") & ((F.col("status") == 403) | ((F.col("status") == 200) & F.col("body").isNull())), meta)
    status = F.when(body.isNotNull(), "ok").when(instead.isNotNull(), "metadata_only").otherwise("failed")
    return held.withColumns({"content": F.coalesce(body, instead), "content_status": status}).drop("_may")
