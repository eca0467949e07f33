"""Scalar functions over whole tables: text, URLs, dates, JSON, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions import dates, scoring, text, urls
from quillstream.plans.base import as_of, query
from quillstream.plans.registry import ALLOWED, SQL_HOST, SQL_PATH, _quoted

def doc_id() -> Column:
    return F.col("doc_id")


def body() -> Column:
    return F.col("text")


def varied(values: list[str], key: Column | None = None) -> Column:
    """One of the values by key, as the CASE of `sql_varied`."""
    key, out = doc_id() if key is None else key, F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        out = F.when(key % len(values) == i, v).otherwise(out)
    return out


def sql_varied(values: list[str], key: str = "doc_id") -> str:
    cases = " ".join(f"WHEN {i} THEN '{_quoted(v)}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def squeeze(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '\\s+', ' ', 'g'))"


# --- text ---------------------------------------------------------------------------------------------------------


@query("SELECT page_id, trim(regexp_replace(html, '<[^>]+>', '', 'g')) AS plain FROM pages")
def strip_tags(read):
    return read("pages").select("page_id", text.without_tags(F.col("html")).alias("plain"))


MARKS = ["arrow_forward {} READ MORE", "{} Learn  more", "mail_outline {}", "PRO {} pro", "Get insights {} expand_more"]


@query("SELECT doc_id, " + squeeze(f"regexp_replace(replace({sql_varied(MARKS)}, '{{}}', text), '{text.NOISE[4:]}', '', 'gi')") + " AS clean FROM documents")
def card_noise(read):
    return read("documents").select("doc_id", text.without_noise(F.replace(varied(MARKS), F.lit("{}"), body())).alias("clean"))


PREFIX = "/content/site/global/en/"


@query(f"""SELECT doc_id, CASE WHEN starts_with(a, 'By ') THEN substr(a, 4) ELSE a END AS author, CASE WHEN starts_with(p, '{PREFIX}') THEN '/' || substr(p, {len(PREFIX) + 1}) ELSE p END AS path FROM (
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'By ' || text ELSE text END AS a, CASE WHEN doc_id % 2 = 0 THEN '{PREFIX}' ELSE '/x/' END || source AS p FROM documents)""")
def prefixes_rewritten(read):
    author = F.when(doc_id() % 3 == 0, F.concat(F.lit("By "), body())).otherwise(body())
    path = F.concat(F.when(doc_id() % 2 == 0, PREFIX).otherwise("/x/"), F.col("source"))
    return read("documents").select("doc_id", text.without_prefix(author, "By ").alias("author"), text.without_prefix(path, PREFIX, "/").alias("path"))


@query("""SELECT doc_id, trim(CASE WHEN strpos(m, '|') > 0 THEN substr(m, 1, strpos(m, '|') - 1) ELSE m END) AS first, CASE WHEN strpos(m, '|') > 0 THEN trim(substr(m, strpos(m, '|') + 1)) ELSE '' END AS second
FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source || ' | ' || lang || '|x' WHEN 1 THEN source ELSE lang || '|' || source END AS m FROM documents)""")
def label_split(read):
    source, lang = F.col("source"), F.col("lang")
    raw = F.when(doc_id() % 3 == 0, F.concat(source, F.lit(" | "), lang, F.lit("|x"))).when(doc_id() % 3 == 1, source).otherwise(F.concat(lang, F.lit("|"), source))
    first, second = text.split_once(raw, "|")
    return read("documents").select("doc_id", first.alias("first"), second.alias("second"))


@query("""SELECT doc_id, substr(text, 1, 100) AS label, md5(substr(text, 1, 15000)) AS prompt, md5(substr(text, 1, 3000)) AS sample, CASE WHEN length(text) > 90 THEN substr(text, 1, 90) || '…' ELSE text END AS notes FROM documents""")
def truncations(read):
    return read("documents").select("doc_id", text.cut(body(), 100).alias("label"), F.md5(text.cut(body(), 15_000).cast("binary")).alias("prompt"), F.md5(text.cut(body(), 3000).cast("binary")).alias("sample"), text.shortened(body(), 90).alias("notes"))


TEMPLATES = ["Title: {title}. Source: {source}. Text: {content}", "Only metadata. {title} ({source}): {content}"]


@query(f"""SELECT doc_id, sha256(replace(replace(replace({sql_varied(TEMPLATES)}, '{{title}}', lang), '{{source}}', source), '{{content}}', substr(text, 1, 15000))) AS prompt_sha FROM documents""")
def prompts(read):
    made = text.prompt(varied(TEMPLATES), {"title": F.col("lang"), "source": F.col("source"), "content": body()})
    return read("documents").select("doc_id", F.sha2(made, 256).alias("prompt_sha"))


@query("SELECT doc_id, length(text) AS n FROM documents")
def bom_stripped(read):
    return read("documents").select("doc_id", F.length(text.without_bom(F.concat(F.lit("﻿"), body()))).alias("n"))


@query("""SELECT doc_id, coalesce(nullif(CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE source END, ''), nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), 'none') AS filled FROM documents""")
def field_fallbacks(read):
    a = F.when(doc_id() % 3 == 0, "").when(doc_id() % 3 == 2, F.col("source"))
    b = F.when(doc_id() % 2 == 0, "").otherwise(F.col("lang"))
    return read("documents").select("doc_id", text.first_filled(a, b, F.lit("none")).alias("filled"))


PDFS = ["openPDF('T','/a_jpn.pdf') openPDF('T', '/b.pdf?x=1')", "openPDF(\"T\",\"http://o.example/c_SC.pdf\")", "<a href='/d.pdf'>", "no link here", "<a href=\"http://o.example/e.pdf#p\">"]
PDF_WANT = ["http://o.example/b.pdf?x=1", "http://o.example/c_SC.pdf", "http://o.example/d.pdf", "", "http://o.example/e.pdf#p"]


@query(f"SELECT page_id, nullif({sql_varied(PDF_WANT, 'page_id')}, '') AS pdf FROM pages")
def pdf_links(read):
    return read("pages").select("page_id", text.pdf_link(F.concat(F.regexp_replace("html", r"\.pdf", "-pdf"), varied(PDFS, F.col("page_id"))), F.lit("http://o.example")).alias("pdf"))


@query("SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month FROM orders")
def month_years(read):
    label = F.concat(F.lit("Outlook "), F.upper(F.date_format("o_orderdate", "MMM yyyy")), F.lit(" and more"))
    return read("orders").select("o_orderkey", dates.parse_date(text.month_year(label)).alias("month"))


@query("""SELECT doc_id, list_has_any(list_transform(string_split(c, ','), lambda x: lower(trim(x))), ['analyst research', 'market commentary', 'white papers', 'market insights']) AS wanted FROM (
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'News, Market Commentary' WHEN 1 THEN source ELSE lang || ',White Papers ,x' END AS c FROM documents WHERE doc_id % 4 < 3 OR source IS NOT NULL)""")
def category_whitelist(read):
    raw = F.when(doc_id() % 4 == 0, "News, Market Commentary").when(doc_id() % 4 == 1, F.col("source")).otherwise(F.concat(F.col("lang"), F.lit(",White Papers ,x")))
    return read("documents").select("doc_id", text.wanted_category(F.split(raw, ",")).alias("wanted"))


@query("SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'Macro,' || c_mktsegment WHEN 1 THEN 'Quant/CTA,VC' ELSE c_mktsegment END AS labels FROM customer")
def strategy_labels(read):
    n, seg = F.col("c_nationkey") % 3, F.col("c_mktsegment")
    tags = F.when(n == 0, F.array(F.lit("macro"), seg)).when(n == 1, F.array(F.lit("quant"), F.lit("venture_capital"))).otherwise(F.array(seg))
    return read("customer").select("c_custkey", F.array_join(text.tag_labels(tags), ",").alias("labels"))


@query("""SELECT page_id, length(html) > 1024 AND page_id % 5 <> 0 AND page_id % 3 = 0 AS pdf, page_id % 7 = 0 AS json, length(html) > 1000 AS long_enough FROM pages""")
def payload_gates(read):
    k = F.col("page_id")
    status = F.when(k % 5 == 0, 404).otherwise(200)
    kind = F.when(k % 3 == 0, "Application/PDF; v=1").when(k % 3 == 1, "text/html")
    payload = F.when(k % 7 == 0, F.concat(F.lit('  {"id": '), k.cast("string"), F.lit("}"))).otherwise(F.col("html"))
    return read("pages").select("page_id", text.is_pdf_response(status, kind, F.length("html")).alias("pdf"), F.coalesce(text.is_json_payload(payload), F.lit(False)).alias("json"), text.long_enough(F.col("html"), 1000).alias("long_enough"))


GATES = ["{}", "{} Accept  all\ncookies", "DISCLAIMER {}", "{} log in\tto read", "subscribe {}", "This  content is available {}"]


@query(f"""SELECT doc_id, ({' OR '.join(f"contains(low, '{m}')" for m in scoring.GATE_MARKERS + scoring.DISCLAIMER_MARKERS)}) AS gated FROM (
SELECT doc_id, lower({squeeze(f"replace({sql_varied(GATES)}, '{{}}', text)")}) AS low FROM documents)""")
def gate_pages(read):
    return read("documents").select("doc_id", scoring.looks_gated(F.replace(varied(GATES), F.lit("{}"), body())).alias("gated"))


# --- URLs and scores ----------------------------------------------------------------------------------------------

HREFS = ["../up/a?x=1#f", "./same", "//other.example/p", "/root/./b/../c", "?q=2", "https://abs.example/x/../y", "deep/er/../page", "#frag", "../../../far"]


@query("""SELECT page_id, CASE page_id % 9 WHEN 0 THEN o || list_aggregate(d[:greatest(len(d) - 2, 0)], 'string_agg', '') || '/up/a?x=1#f' WHEN 1 THEN o || dir || 'same' WHEN 2 THEN s || '//other.example/p' WHEN 3 THEN o || '/root/c'
WHEN 4 THEN o || p || '?q=2' WHEN 5 THEN 'https://abs.example/y' WHEN 6 THEN o || dir || 'deep/page' WHEN 7 THEN bare || '#frag' ELSE o || '/far' END AS link FROM (
SELECT *, CASE WHEN len(d) <= 1 THEN '/' ELSE list_aggregate(d[:len(d) - 1], 'string_agg', '') || '/' END AS dir FROM (
SELECT page_id, regexp_extract(url, '^([a-z]+:)') AS s, regexp_extract(url, '^[a-z]+://[^/?#]*') AS o, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(url, '^[^#]*') AS bare,
regexp_extract_all(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/[^/]*') AS d FROM pages))""".replace("list_aggregate(d[:greatest(len(d) - 2, 0)], 'string_agg', '')", "coalesce(list_aggregate(d[:greatest(len(d) - 2, 0)], 'string_agg', ''), '')"))
def resolved_links(read):
    return read("pages").select("page_id", urls.resolve(F.col("url"), varied(HREFS, F.col("page_id"))).alias("link"))


@query(f"""SELECT page_id, d AS domain_score, round(CASE WHEN pos + neg = 0 THEN 0.5 ELSE pos / (pos + neg) END, 4) AS path_score, s AS structure_score, g AS gate_penalty,
round(d * 0.2::DOUBLE + CASE WHEN pos + neg = 0 THEN 0.5::DOUBLE ELSE pos / (pos + neg) END * 0.3::DOUBLE + s * 0.3::DOUBLE + (1 - g) * 0.2::DOUBLE, 4) AS final_score FROM (
SELECT page_id, CASE WHEN bad THEN 0.1::DOUBLE WHEN good THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS s, CASE WHEN bad THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END AS g,
greatest({', '.join(f"CASE WHEN host IN ('{d}', 'www.{d}') THEN 1.0::DOUBLE WHEN ends_with(host, '.{d}') THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END" for d in ALLOWED)}) AS d,
len(list_intersect(tok, [{', '.join(f"'{w}'" for w in urls.RESEARCH_WORDS)}])) AS pos, len(list_intersect(tok, [{', '.join(f"'{w}'" for w in urls.OTHER_WORDS)}])) AS neg FROM (
SELECT page_id, {SQL_HOST.replace('(url', '(u')} AS host, list_distinct(regexp_split_to_array(lower({SQL_PATH.replace('(url', '(u')}), '[/_-]')) AS tok,
{' OR '.join(f"contains(lower(u), '{w}')" for w in scoring.URL_AGAINST)} AS bad, {' OR '.join(f"contains(lower(u), '{w}')" for w in scoring.URL_FOR)} AS good FROM (
SELECT page_id, regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1' || CASE page_id % 4 WHEN 0 THEN '/Research' WHEN 1 THEN '/careers' WHEN 2 THEN '/insights/team' ELSE '' END) AS u FROM pages)))""")
def url_only_scores(read):
    k = F.col("page_id")
    path = F.when(k % 4 == 0, "/Research").when(k % 4 == 1, "/careers").when(k % 4 == 2, "/insights/team").otherwise("")
    origin = F.regexp_extract("url", urls.ORIGIN, 1)
    url = F.concat(origin, path, F.substring("url", F.length(origin) + 1, F.length("url")))
    return read("pages").select("page_id", scoring.url_only_score(url, F.array(*map(F.lit, ALLOWED))).alias("s")).select("page_id", "s.*")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN s + 0.1::DOUBLE WHEN doc_id % 4 = 1 THEN s - 0.1::DOUBLE ELSE s END AS score FROM (SELECT doc_id, (doc_id % 10) / 10.0::DOUBLE AS s FROM documents)")
def classifier_adjusted(read):
    sure = F.when(doc_id() % 4 < 2, 0.8).when(doc_id() % 4 == 2, 0.79)
    return read("documents").select("doc_id", scoring.adjusted(doc_id() % 10 / F.lit(10.0), doc_id() % 2 == 0, sure).alias("score"))


@query("""SELECT c_custkey, CASE WHEN f IS NULL THEN 'none' WHEN floor(f * 100) >= 70 THEN 'high' WHEN floor(f * 100) >= 50 THEN 'middle' ELSE 'low' END AS fit, CASE WHEN q >= 0.7 THEN 'high' WHEN q >= 0.5 THEN 'middle' ELSE 'low' END AS trial,
CASE WHEN q >= 0.6 THEN 'high' WHEN q >= 0.4 THEN 'middle' ELSE 'low' END AS sample, c_nationkey = 3 AS recommended FROM (
SELECT *, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 100 / 100.0::DOUBLE END AS f, c_custkey % 11 / 11.0::DOUBLE AS q FROM customer)""")
def report_bands(read):
    k = F.col("c_custkey")
    fit, q = F.when(k % 5 > 0, k % 100 / F.lit(100.0)), k % 11 / F.lit(11.0)
    notes = F.when(F.col("c_nationkey") == 3, F.concat(F.lit("RECOMMEND: "), F.col("c_name"))).when(F.col("c_nationkey") == 4, F.col("c_name"))
    return read("customer").select("c_custkey", text.fit_band(fit).alias("fit"), text.quality_band(q, 0.7, 0.5).alias("trial"), text.quality_band(q, 0.6, 0.4).alias("sample"), text.is_recommended(notes).alias("recommended"))


@query("""SELECT c_custkey, CASE WHEN ok THEN wd ELSE 0.2 END AS domain, CASE WHEN ok THEN wp ELSE 0.3 END AS path, CASE WHEN ok THEN 0.25::DOUBLE ELSE 0.3::DOUBLE END AS structure, CASE WHEN ok THEN 0.25::DOUBLE ELSE 0.2::DOUBLE END AS gate FROM (
SELECT *, wd IS NOT NULL AND round(abs(wd + wp + 0.5 - 1), 9) <= 0.01 AS ok FROM (SELECT c_custkey, CASE WHEN c_custkey % 6 > 0 THEN c_custkey % 6 / 20.0::DOUBLE END AS wd, 0.25::DOUBLE AS wp FROM customer))""")
def weight_scan(read):
    k = F.col("c_custkey")
    w = F.struct(F.when(k % 6 > 0, k % 6 / F.lit(20.0)).alias("domain"), F.lit(0.25).alias("path"), F.lit(0.25).alias("structure"), F.lit(0.25).alias("gate"))
    return read("customer").select("c_custkey", scoring.weights_or_default(w).alias("w")).select("c_custkey", "w.*")


# --- dates --------------------------------------------------------------------------------------------------------


@query("SELECT event_id, ts::DATE AS iso, CASE WHEN event_id % 2 = 0 THEN ts::DATE END AS fallback, ts::DATE AS mail, ts::DATE AS dashed FROM events")
def feed_dates(read):
    ts, k = F.col("ts"), F.col("event_id")
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(k % 2 == 0, "Z").otherwise("+09:00"))
    other = F.when(k % 2 == 0, F.date_format(ts, "MMMM d, yyyy")).otherwise(F.lit("soon"))
    mail = F.concat(F.lit("Mon, "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" -0500"))
    dashed = F.date_format(ts, "MM-dd-yyyy")
    return read("events").select("event_id", dates.iso_date(iso).alias("iso"), dates.iso_date(other).alias("fallback"), dates.mail_date(mail).alias("mail"), dates.parse_date(dashed, ("MM-dd-yyyy",)).alias("dashed"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS screen, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END::BIGINT AS checks, event_id % 4 <> 3 AS is_date FROM events")
def date_counts(read):
    ts, k = F.col("ts"), F.col("event_id")
    raw = (
        F.when(k % 4 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit(" and "), F.date_format(ts, "MMM dd, yyyy")))
        .when(k % 4 == 1, F.concat(F.date_format(ts, "d MMMM yyyy"), F.lit(".")))
        .when(k % 4 == 2, F.lit("1987/1/2"))
        .otherwise(F.lit("Perhaps 20240 soon"))
    )
    count = lambda p: F.regexp_count(raw, F.lit(p))
    return read("events").select("event_id", count(scoring.SCREEN_DATES).alias("screen"), count(scoring.CHECK_DATES).alias("checks"), dates.looks_like_date(F.when(k % 4 == 3, F.lit("Perhaps so")).otherwise(raw)).alias("is_date"))


@query("SELECT event_id, ts::DATE - DATE '2024-01-05' + 1 AS trial_day, ts::DATE >= DATE '2024-02-20' - 7 AS week, ts::DATE >= DATE '2024-02-20' - 30 AS month FROM events")
def elapsed_days(read):
    day = F.to_date("ts")
    return read("events").select("event_id", dates.trial_day(F.lit("2024-01-05").cast("date"), day).alias("trial_day"), dates.within_days(day, as_of(), 7).alias("week"), dates.within_days(day, as_of(), 30).alias("month"))


# --- JSON ---------------------------------------------------------------------------------------------------------

FENCED = '{"summary_en": "s", "summary_zh": "z", "themes": ["%s"], "key_takeaway_en": "k", "key_takeaway_zh": "t"}'


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type END AS theme FROM events""")
def model_answers(read):
    k, kind = F.col("event_id"), F.col("event_type")
    whole = F.format_string(FENCED, kind)
    raw = F.when(k % 4 == 0, whole).when(k % 4 == 1, F.concat(F.lit("Here:\n```json\n"), whole, F.lit("\n```\nDone"))).when(k % 4 == 2, F.col("props")).otherwise(F.concat(F.lit("```\n"), F.substring(whole, 1, 40), F.lit("\n```")))
    return read("events").select("event_id", F.get_json_object(text.answer_json(raw), "$.themes[0]").alias("theme"))


THEME_SQL = "[" + ", ".join(f"'{t}'" for t in text.THEMES) + "]"


@query(f"""WITH raw AS (SELECT doc_id, [{', '.join(f"lower({THEME_SQL}[(doc_id + {k}) % 15 + 1][:{n}])" for k, n in ((0, 50), (1, 4), (7, 6)))}, {THEME_SQL}[doc_id % 15 + 1], lang] AS names FROM documents),
each AS (SELECT doc_id, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM raw),
parts AS (SELECT theme, nth, unnest(string_split(lower(theme), '/')) AS part FROM (SELECT unnest({THEME_SQL}) AS theme, generate_subscripts({THEME_SQL}, 1) AS nth)),
named AS (SELECT doc_id, pos, CASE WHEN list_contains({THEME_SQL}, name) THEN name ELSE (SELECT arg_min(theme, nth) FROM parts WHERE starts_with(lower(trim(name)), part)) END AS theme FROM each),
firsts AS (SELECT doc_id, theme, min(pos) AS pos FROM named WHERE theme IS NOT NULL GROUP BY 1, 2)
SELECT d.doc_id, coalesce(string_agg(theme, ',' ORDER BY pos), '') AS themes FROM documents d LEFT JOIN firsts f ON f.doc_id = d.doc_id GROUP BY 1""")
def theme_matching(read):
    themes = F.array(*map(F.lit, text.THEMES))
    name = lambda k, n: F.lower(F.substring(F.element_at(themes, ((doc_id() + k) % 15 + 1).cast("int")), 1, n))
    raw = F.to_json(F.array(name(0, 50), name(1, 4), name(7, 6), F.element_at(themes, (doc_id() % 15 + 1).cast("int")), F.coalesce("lang", F.lit(""))))
    return read("documents").select("doc_id", F.array_join(text.canonical_themes(raw), ",").alias("themes"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS published FROM orders")
def json_ld_dates(read):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    own = F.concat(F.lit('{"@type": "Article", "datePublished": "'), day, F.lit('T08:00:00Z"}'))
    raw = F.when(k % 4 == 0, own).when(k % 4 == 1, F.concat(F.lit('[{"@type": "Org"}, '), own, F.lit("]"))).when(k % 4 == 2, F.lit('{"@type": "Org"}')).otherwise(F.lit("not json"))
    return read("orders").select("o_orderkey", text.published_in_json_ld(raw).alias("published"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE o_orderpriority END AS title, CASE o_orderkey % 3 WHEN 0 THEN '/insights/' || o_orderkey WHEN 1 THEN '/b/' || o_orderkey END AS link FROM orders""")
def data_layers(read):
    k = F.col("o_orderkey")
    key, title = k.cast("string"), F.col("o_orderpriority")
    raw = (
        F.when(k % 3 == 0, F.concat(F.lit('{"card-1": {"publishDate": "2024", "itemTitle": "'), title, F.lit('", "xdm:linkURL": "/insights/'), key, F.lit('"}}')))
        .when(k % 3 == 1, F.concat(F.lit('{"a": {"itemTitle": "'), title, F.lit('"}, "b": {"linkURL": "/b/'), key, F.lit('"}}')))
        .otherwise(F.lit("{}"))
    )
    first, link = text.data_layer(raw)
    return read("orders").select("o_orderkey", first["itemTitle"].alias("title"), link.alias("link"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 ELSE event_id % 100 END::DOUBLE AS value FROM events")
def safe_floats(read):
    k = F.col("event_id")
    raw = F.when(k % 4 == 0, F.col("value").cast("string")).when(k % 4 == 1, "n/a").when(k % 4 == 3, (k % 100).cast("string"))
    return read("events").select("event_id", text.safe_float(raw).alias("value"))
