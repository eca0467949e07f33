"""Published views over articles: timeline, themes, clusters, funds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.operators import scan

GENERAL = "General"


def day_or_epoch() -> Column:
    return F.coalesce("date", F.lit("1970-01-01").cast("date"))


def numbered(rows: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """rows(keys.., date, seq) numbered within their keys, newest first, undated last, ties by seq; neither a large key nor
    a large day is one task."""
    return scan.numbered(rows, [day_or_epoch().desc(), F.col("seq")], name, keys)


def timeline(articles: DataFrame, visible: int = 20) -> DataFrame:
    """Newest first, ties in the order they were stored, with the first page marked and how many rows are left after
    each."""
    total = articles.agg(F.count(F.lit(1)).alias("_total"))
    rows = numbered(articles, []).withColumn("visible", F.col("position") <= visible)
    return rows.crossJoin(F.broadcast(total)).withColumn("remaining", F.col("_total") - F.col("position")).drop("_total")


def theme_counts(articles: DataFrame) -> DataFrame:
    """Count and first position of each theme of summarized articles."""
    each = articles.where("summarized").select(F.explode("themes").alias("theme"), "seq")
    return each.groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


def theme_clusters(articles: DataFrame, as_of: Column) -> DataFrame:
    """Clusters by first theme (General without): size, size of the last week, whether several sources take part; in
    order: largest first, General last, ties by the first article."""
    first = F.coalesce(F.try_element_at("themes", F.lit(1)), F.lit(GENERAL))
    rows = articles.withColumn("cluster", first)
    grouped = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("date") >= F.date_sub(as_of, 7)).alias("n_week"),
        F.count_distinct("source_id").alias("n_sources"),
        F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources"),
        F.min("seq").alias("first_seq"),
    )
    grouped = grouped.withColumn("cross_fund", F.col("n_sources") >= 2).withColumn("last", F.col("cluster") == GENERAL)
    return scan.numbered(grouped, [F.col("last"), F.desc("n"), F.col("first_seq")], "place")


def cluster_members(articles: DataFrame) -> DataFrame:
    """(cluster, id, position) of every article; kept flat, as a cluster has no bound."""
    first = F.coalesce(F.try_element_at("themes", F.lit(1)), F.lit(GENERAL))
    return numbered(articles.withColumn("cluster", first), ["cluster"]).select("cluster", "id", "position")


def clusters_with_theme(members: DataFrame, articles: DataFrame, chosen: Column) -> DataFrame:
    """Members of clusters whose articles, looked up by id, have one of the chosen themes; all if none is chosen."""
    hit = articles.where((F.size(chosen) == 0) | F.arrays_overlap(F.coalesce("themes", F.array().cast("array<string>")), chosen)).select("id")
    return members.join(hit, "id", "left_semi")


def fund_rollup(sources: DataFrame, articles: DataFrame) -> DataFrame:
    """Every source with its articles, analysed ones and the date of its first article in the timeline."""
    latest = F.max_by("date", F.struct(day_or_epoch(), (-F.col("seq")).alias("s")))
    rows = articles.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("summarized").alias("analysed"), latest.alias("latest"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return sources.select("source_id").join(rows, "source_id", "left").select("source_id", zero("n"), zero("analysed"), "latest")


def fund_distribution(rollup: DataFrame) -> DataFrame:
    """Funds with articles and their share of the largest one, in percent; the number of all articles and of such funds
    stands in every row."""
    with_any = rollup.where("n > 0")
    sums = with_any.agg(F.max("n").alias("_most"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("funds"))
    return with_any.crossJoin(F.broadcast(sums)).select("source_id", "n", F.round(F.col("n") / F.col("_most") * 100, 1).alias("percent"), "total", "funds")


def headline(articles: DataFrame, as_of: Column, configured: int = 5) -> DataFrame:
    n_sources = F.count_distinct("source_id")
    week = F.count_if(F.col("date") >= F.date_sub(as_of, 7))
    unthemed = F.count_if(F.coalesce(F.size("themes"), F.lit(0)) <= 0)
    return articles.agg(F.count(F.lit(1)).alias("total"), week.alias("n_week"), F.when(n_sources > 0, n_sources).otherwise(configured).alias("n_sources"), unthemed.alias("unthemed"))


def latest_five(articles: DataFrame, n: int = 5) -> DataFrame:
    """Per fund: how many of its latest five articles there are, and how many of those are analysed."""
    order = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc(day_or_epoch()), "seq"))
    rows = articles.withColumn("rn", order).where(F.col("rn") <= n)
    return rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("tracked"), F.count_if("summarized").alias("analysed"))
