"""Every query of the plans against its SQL over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from quillstream import plans

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no tables here")
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 7)
    return value.isoformat()[:19] if hasattr(value, "isoformat") else value


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    db.sql("SET timezone = 'UTC'")
    for path in TABLES.glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query_equals_its_sql(spark, tables, name):
    got = plans.QUERIES[name](spark, str(TABLES))
    want = tables.sql(plans.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES.get(t, t) for c, t in got.dtypes} == types
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    place = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in place) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["body_by_rules", "body_text_dom", "chrome_removed_length"])
def test_references_without_semicolon(spark, tmp_path, name):
    """Titles are cut anywhere, inside a character reference too."""
    cut = ["a &amp", "a &am", "a &", "b &quot", "c &lt", "d &gt &copy e", "f &amp;amp", "g &#x27", "h &#39", "i &middot;&middot"]
    page = lambda t: f"<html><head><title>{t}</title></head><body><nav>{t}</nav><article><h1>{t}</h1><p>{'word ' * 30}{t}</p></article></body></html>"
    rows = [(k, f"https://a.example/{k}", page(t)) for k, t in enumerate(cut)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = plans.QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = db.sql(plans.ORACLE[name])
    place = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in place) for r in want.fetchall())
