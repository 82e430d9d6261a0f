"""Queries on tables made for what grows: full pages, hot cells, many partitions; held against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from glyphmill.operators import content, validate
from glyphmill.plans import queries as plans


def same(spark, d, name, table):
    """Whether a query gives what its SQL gives over one table; the rows of the latter."""
    got = entry.queries()[name](spark, d).toArrow()
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW {table} AS SELECT * FROM '{d}/{table}.parquet'")
        want = c.sql(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = lambda t: sorted(map(repr, zip(*[t[c].to_pylist() for c in columns])))
    assert rows(got) == rows(want)
    return want.num_rows


def parts(folder, *selects):
    """A table of parts (p_partkey, p_size); other columns by their names."""
    duckdb.sql(f"COPY (SELECT k::BIGINT AS p_partkey, s::INT AS p_size, 'Brand' AS p_brand, 'a small name' AS p_name FROM ({' UNION ALL '.join(selects)})) TO '{folder}/part.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def pages(tmp_path):
    """A page of boxes in each other, one of boxes that all differ, one of a part that is there twice, one of null keys,
    parts without a page."""
    return parts(tmp_path, "SELECT i * 31500 AS k, 1 AS s FROM range(400) r(i)", "SELECT i * 7, 2 FROM range(60) r(i)", "SELECT 5, 3 FROM range(2)", "SELECT NULL, 4 FROM range(2)", "SELECT i, NULL FROM range(3) r(i)")


def test_overlap_pairs_are_dealt_out(spark, pages, monkeypatch):
    wide = 8 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(plans, "BLOCK", 50, raising=False)  # a cell of 400 boxes is eight blocks
    assert same(spark, pages, "q11_overlap_pairs", "part") > 400 * 399 // 2
    df = entry.queries()["q11_overlap_pairs"](spark, pages)
    assert df.rdd.getNumPartitions() >= wide
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_pages_with_boxes_in_each_other_need_no_pairs(spark, pages, monkeypatch):
    assert same(spark, pages, "q12_max_overlap_per_page", "part") == 2
    seen, pairs = [], plans._pairs
    monkeypatch.setattr(plans, "_pairs", lambda b, *rest: seen.append(b) or pairs(b, *rest))
    entry.queries()["q12_max_overlap_per_page"](spark, pages)
    assert {r.p_size for r in seen[0].collect()} == {2, 3}


def test_samples_are_checked_once_a_part_in_many_tasks(spark, tmp_path):
    """A part that is there twice is two samples; a single small file is no single task."""
    d = parts(tmp_path, "SELECT i AS k, 1 AS s FROM range(200) r(i)", "SELECT 8 * i, 1 FROM range(20) r(i)")
    assert same(spark, d, "q47_sample_errors", "part") > 0
    assert entry.queries()["q47_sample_errors"](spark, d).rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


def test_a_view_is_taken_apart_once(spark):
    """What a check costs goes with the times a value's schema is read: one for each value that is looked at."""
    samples = spark.range(1).selectExpr("id AS sample_ord", "'s' AS id", "'i' AS image", "9 AS width", "9 AS height", *[f"string(id) AS {x}" for x in ("vlm", "ocr", "trans", "canonical")])
    plan = validate.sample_errors(samples)._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.count("schema_of_variant(") < 20  # 551 when each condition read them anew


def test_attempts_are_made_once_and_stay_where_they_are(spark, sf):
    """Attempts of a sample are some fifty rows: they are made once for all samples, and meet without a shuffle."""
    df = entry.queries()["q50_fallback_items"](spark, sf)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate ") == 2  # a few attempts, and more for those that they leave short
    made = content.fallback_items(content.samples(spark, 5, 1), 12)
    below = made._jdf.queryExecution().executedPlan().toString()
    assert below.count("Exchange hashpartitioning") == 1 and made.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


def test_samples_that_few_attempts_leave_short_get_all(spark, monkeypatch):
    rows = content.samples(spark, 80, 77)
    made = rows.withColumn("kinds", content.kind_sequence(F.col("category"), F.col("seed"), 12))
    items = lambda df: {r.sample_id: [tuple(x) for x in r["items"]] for r in df.collect()}
    few, full = (items(content._folded(made, 12, n)) for n in (1, content.ATTEMPTS))
    monkeypatch.setattr(content, "FEW", 1)
    got = items(content.fallback_items(rows, 12))
    short = {k for k, x in few.items() if len(x) < 12}
    assert short and got == {k: full[k] if k in short else few[k] for k in got} and len(got) == 80
