"""Admission of listing rows: gates, keep-first and preference dedup, caps, ids, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import urls


def gate_by_host(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows(source_id, url) with `admitted`: the url's host is the source's expected_hostname or below it. An empty
    expectation admits all; sources is a small registry, joined by source_id."""
    joined = rows.join(sources.select("source_id", "expected_hostname"), "source_id", "left")
    free = F.coalesce("expected_hostname", F.lit("")) == ""
    return joined.withColumn("admitted", free | F.coalesce(urls.host_matches(urls.host(F.col("url")), F.col("expected_hostname")), F.lit(False)))


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order: one hash aggregate, no sort of the groups."""
    others = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def top_n(rows: DataFrame, keys: list[str], order: list, n: int | Column, name: str = "rn") -> DataFrame:
    """At most n rows of each key, numbered."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)


def prefer(rows: DataFrame, keys: list[str], preferred: Column, pos: str = "pos") -> DataFrame:
    """Of each key the first preferred row, else the first."""
    return keep_first(rows.withColumn("_worse", F.coalesce(preferred, F.lit(False)).cast("int") * -1), keys, [F.col("_worse"), F.col(pos)]).drop("_worse")


def new_rows(rows: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not stored. Either side may come from a generator, so that Spark's sizes are not relied on."""
    return rows.join(existing.select(key).hint("merge"), key, "left_anti")


def canonical_articles(rows: DataFrame) -> DataFrame:
    """Stored form of admitted listing rows(source_id, source_name, title, url, date, date_raw, fetched_at)."""
    kept = ["source_id", "source_name", "title", "url", "date", "date_raw", "fetched_at"]
    return rows.select(urls.article_id(F.col("source_id"), F.col("url")).alias("id"), *kept, F.lit(False).alias("summarized"))


def ingest(listing: DataFrame, sources: DataFrame, existing: DataFrame, default_cap: int = 10) -> DataFrame:
    """Listing rows to new articles: keep-first by url, host gate, cap per source, ids, anti join with stored ids. The
    gate comes before the cap. A second run over the same rows adds nothing."""
    first = keep_first(listing, ["source_id", "url"], [F.col("pos")])
    # Listings come from generators, whose sizes Spark does not know.
    sources = sources.hint("merge")
    gated = gate_by_host(first, sources).where("admitted").drop("admitted", "expected_hostname")
    caps = gated.join(sources.select("source_id", "max_articles"), "source_id", "left")
    capped = top_n(caps, ["source_id"], [F.col("pos")], F.coalesce("max_articles", F.lit(default_cap)))
    return new_rows(canonical_articles(capped), existing)


def replace_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of new, and those rows of old whose key new does not have."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))


def patch(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """old with the non-null values of changes."""
    renamed = changes.select(key, *[F.col(c).alias(f"_{c}") for c in changes.columns if c != key])
    joined = old.join(renamed, key, "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c != key and c in changes.columns else F.col(c) for c in old.columns])


def resolve_sources(sources: DataFrame, entrypoints: DataFrame, active_default: bool = False) -> DataFrame:
    """Each source's url: its first active entrypoint, else its own."""
    active = entrypoints.where(F.coalesce("active", F.lit(active_default)))
    first = active.groupBy("source_id").agg(F.min_by("url", "pos").alias("_url"))
    return sources.join(first, "source_id", "left").withColumn("url", F.coalesce("_url", "url")).drop("_url")
