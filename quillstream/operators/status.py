"""Status transitions of candidates, entrypoints and articles, and the tables written back after a stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.functions import scoring, urls
from quillstream.operators import scan

# The statuses that a stage takes up, and those it takes up again when asked to.
STAGES = {"discover": (["seed"], []), "screen": (["discovered", "screen_failed"], ["screened"]), "score": (["screened"], ["inaccessible"])}


def of_stage(candidates: DataFrame, stage: str, again: bool = False, only: str | None = None) -> DataFrame:
    """Candidates that a stage works on; `again` adds those it has done before, `only` is one id."""
    first, more = STAGES[stage]
    rows = candidates.where(F.col("status").isin(*first, *(more if again else [])))
    return rows if only is None else rows.where(F.col("id") == only)


def pending_content(articles: DataFrame, handlers: DataFrame, source: str | None = None) -> DataFrame:
    """Articles to fetch a body for: not summarized, no body yet, of a source with a handler (and of one source)."""
    has = F.coalesce(F.col("content_status").isin("ok", "metadata_only"), F.lit(False))
    rows = articles.where(~F.coalesce("summarized", F.lit(False)) & ~has).join(handlers.select("source_id").distinct(), "source_id", "left_semi")
    return rows if source is None else rows.where(F.col("source_id") == source)


def to_analyse(articles: DataFrame) -> DataFrame:
    """Articles with a body or metadata that are not summarized."""
    return articles.where(~F.coalesce("summarized", F.lit(False)) & F.coalesce(F.col("content_status").isin("ok", "metadata_only"), F.lit(False)))


def with_body(articles: DataFrame, bodies: DataFrame) -> DataFrame:
    """articles with `body`; a missing one sets content_status to failed."""
    joined = articles.join(bodies.select("id", F.col("text").alias("body")), "id", "left")
    return joined.withColumn("content_status", F.when(F.col("body").isNull(), "failed").otherwise(F.col("content_status")))


def confidence(content_status: Column) -> Column:
    return F.when(content_status == "metadata_only", "low")


def disable_unhealthy(entrypoints: DataFrame, checks: DataFrame) -> DataFrame:
    """entrypoints with `active` false where checks(url, status) says degraded or error."""
    bad = checks.where("status <> 'ok'").select("url").distinct().withColumn("_bad", F.lit(True))
    return entrypoints.join(bad, "url", "left").withColumn("active", F.when(F.col("_bad"), False).otherwise(F.col("active"))).drop("_bad")


def by_themes(articles: DataFrame, chosen: Column) -> DataFrame:
    """Articles with one of the chosen theme slugs; all of them if none is chosen."""
    own = F.transform(F.coalesce("themes", F.array().cast("array<string>")), lambda t: F.trim(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}]+", "-"), F.lit("-")))
    return articles.where((F.size(chosen) == 0) | F.arrays_overlap(own, chosen))


def screened(candidates: DataFrame, pages: DataFrame, verdict) -> DataFrame:
    """Candidates after screening: research_url joined with pages(url, status_code, ..); verdict(rows) adds reason and
    passed. Without a URL the row says so at once; a failed fetch is screen_failed; others are screened."""
    rows = verdict(candidates.join(pages.withColumnRenamed("url", "_url"), F.col("research_url") == F.col("_url"), "left").drop("_url"))
    missing = F.coalesce("research_url", F.lit("")) == ""
    error = F.when(missing, "no URL").when(F.col("status_code").isNull(), "fetch error")
    return rows.withColumn("error", error).withColumn("status", F.when(error.isNotNull(), "screen_failed").otherwise("screened")).withColumn("passed", F.when(error.isNull(), F.col("passed")).otherwise(False))


def scored(candidates: DataFrame, entrypoints: DataFrame) -> DataFrame:
    """Candidates after scoring: with entrypoints(id, final_score) they are validated, or inaccessible where not
    publicly accessible, and fit by the best score; without any they stay as they are."""
    best = entrypoints.groupBy("id").agg(F.max("final_score").alias("_best"))
    rows = candidates.join(best, "id", "left")
    status = F.when(F.col("_best").isNull(), F.col("status")).when(F.coalesce("is_publicly_accessible", F.lit(False)), "validated").otherwise("inaccessible")
    return rows.withColumn("status", status).withColumn("fit_score", F.coalesce("_best", "fit_score")).drop("_best")


def discovered(candidates: DataFrame, links: DataFrame, feeds: DataFrame) -> DataFrame:
    """The first research link and the first feed of each candidate; discovered where there is a link."""
    first = lambda rows, name: rows.groupBy("id").agg(F.min_by("url", "pos").alias(name))
    rows = candidates.join(first(links, "_link"), "id", "left").join(first(feeds, "_feed"), "id", "left")
    rows = rows.withColumn("research_url", F.coalesce("_link", "research_url")).withColumn("rss_url", F.coalesce("_feed", "rss_url"))
    return rows.withColumn("status", F.when(F.col("_link").isNotNull(), "discovered").otherwise(F.col("status"))).drop("_link", "_feed")


def trial_writeback(candidates: DataFrame, outcomes: DataFrame, trial_days: int = 3) -> DataFrame:
    """Candidates with the notes of their trial's outcomes(id, outcome, days, mean, n_samples); failed ones are put on
    the watchlist."""
    rows = candidates.join(outcomes.select("id", "outcome", "days", "mean", "n_samples"), "id", "left")
    of, mean = F.concat(F.col("days").cast("string"), F.lit(f"/{trial_days}")), F.format_string("%.2f", F.col("mean"))
    note = (
        F.when(F.col("outcome") == "fail_quantity", F.concat(F.lit("Trial failed: articles on only "), of, F.lit(" days")))
        .when((F.col("outcome") == "fail_quality") & (F.col("n_samples") == 0), "Trial inconclusive: no quality samples obtained")
        .when(F.col("outcome") == "fail_quality", F.concat(F.lit("Trial failed: low quality ("), mean, F.lit(")")))
        .when(F.col("outcome") == "pass", F.concat(F.lit("RECOMMEND: trial passed ("), of, F.lit(" days with articles, quality="), mean, F.lit(")")))
    )
    status = F.when(F.col("outcome").startswith("fail"), "watchlist").otherwise(F.col("status"))
    return rows.withColumn("status", status).withColumn("notes", F.coalesce(note, F.col("notes"))).drop("outcome", "days", "mean", "n_samples")


def rejected_pages(pages: DataFrame, least: float = 0.5) -> DataFrame:
    return pages.where(F.col("final_score") < least).withColumn("label", F.lit("bad"))


def backfilled(labelled: DataFrame, known_bad: DataFrame, domains: DataFrame) -> DataFrame:
    """labelled(fund_id, url, domain_score, .., final_score, label, set) without good rows whose url is known to be bad;
    rows without components get those that the URL alone gives and the label good; known bad urls not yet rejected are
    added as such. domains(fund_id, domain)."""
    names = ("domain_score", "path_score", "structure_score", "gate_penalty", "final_score")
    good = labelled.where(F.col("set") == "entrypoint").join(known_bad.select("url").distinct(), "url", "left_anti")
    rejected = labelled.where(F.col("set") == "rejected")
    added = known_bad.select("fund_id", "url").distinct().join(rejected.select("url"), "url", "left_anti").withColumns({**{n: F.lit(None).cast("double") for n in names}, "label": F.lit("bad"), "set": F.lit("rejected")})
    rows = good.unionByName(rejected).unionByName(added).join(domains.select("fund_id", "domain"), "fund_id", "left")
    domain = F.coalesce(F.col("domain"), urls.host(F.col("url")))
    lacking = F.col("domain_score").isNull()
    rows = rows.withColumn("_s", scoring.url_only_score(F.col("url"), F.array(domain)))
    label = F.when(lacking & (F.col("set") == "entrypoint"), "good").otherwise(F.col("label"))
    return rows.withColumn("label", label).select("fund_id", "url", *[F.when(lacking, F.col("_s")[n]).otherwise(F.col(n)).alias(n) for n in names], "label", "set")


def domains_of(candidates: DataFrame) -> DataFrame:
    """(fund_id, domain): the official domain, else the host of the research page."""
    return candidates.select(F.col("id").alias("fund_id"), F.coalesce(F.nullif("official_domain", F.lit("")), urls.host(F.col("research_url"))).alias("domain"))


def moved(trials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(active, history): a disjoint split by `state`."""
    return trials.where("state = 'active'"), trials.where("state = 'history'")


def sample_scores(sampled: DataFrame, answers: DataFrame) -> DataFrame:
    """sampled(trial_id, day, article_num, url) with the model's scores by number: of several answers for one number
    the last wins, a missing score is 0."""
    last = answers.groupBy("trial_id", "day", "article_num").agg(F.max_by(F.struct("relevance", "depth", "extractable"), "seq").alias("_s"))
    rows = sampled.join(last, ["trial_id", "day", "article_num"], "left")
    part = {n: F.coalesce(F.col(f"_s.{n}"), F.lit(0.0)) for n in ("relevance", "depth", "extractable")}
    return rows.withColumns({**part, "overall": scoring.sample_overall(*part.values())}).drop("_s")


def sample_mean(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Mean overall of each check, to three digits; 0.0 without samples."""
    return samples.groupBy(*keys).agg(scoring.rounded_mean(F.avg(scoring.exact(F.col("overall")))).alias("mean"), F.count("overall").alias("n"))


def next_sample_day(trials: DataFrame, samples: DataFrame, days: int = 3) -> DataFrame:
    """The first day of 1 to `days` that a trial has no sample of, null when all are there."""
    done = samples.groupBy("trial_id").agg(F.collect_set("day").alias("_done"))
    left = F.array_except(F.sequence(F.lit(1), F.lit(days)), F.coalesce("_done", F.array().cast("array<int>")))
    return trials.join(done, "trial_id", "left").withColumn("next_day", F.array_min(left)).drop("_done")


def stage_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Successes and failures of a stage's run by content_status."""
    ok = F.coalesce(F.col("content_status").isin("ok", "metadata_only"), F.lit(False))
    return rows.groupBy(*keys).agg(F.count_if(ok).alias("done"), F.count_if(~ok).alias("failed"))


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of the tables, columns by name; those a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def concatenated(existing: DataFrame, *sources: DataFrame) -> DataFrame:
    """New rows of several sources in order: a row's id must be in no earlier source and not among the existing ids. One
    union and one aggregate, whatever the number of sources."""
    rows = union_all(*[s.withColumn("_nth", F.lit(n)) for n, s in enumerate(sources)])
    others = [c for c in rows.columns if c not in ("id", "_nth")]
    first = rows.groupBy("id").agg(F.min_by(F.struct(*others), "_nth").alias("r")).select("id", "r.*")
    return first.join(existing.select("id"), "id", "left_anti")


def newest_first(rows: DataFrame, keys: list[str], date: str, pos: str, n: int) -> DataFrame:
    """At most n rows of each key by date, newest first, undated last, then in stored order."""
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(date), pos))
    return rows.withColumn("rn", order).where(F.col("rn") <= n)


def validation_due(entrypoints: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Entrypoints (active unless said otherwise) never verified, or not for `days`."""
    stale = F.col("verified_at").isNull() | (F.date_diff(as_of, F.to_date("verified_at")) >= days)
    return entrypoints.where(F.coalesce("active", F.lit(True)) & stale)


def in_order(rows: DataFrame, by: str) -> DataFrame:
    """A table with the place of each row by a column that tells rows apart."""
    return scan.numbered(rows, [F.col(by)], "place")
