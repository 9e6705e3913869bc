"""Shape of the physical plans."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fathomline import session

QUERIES = entry.queries()
JOB_WRITES = {"sink_append", "sink_insert_overwrite", "replace_day", "stream_upsert", "stream_dedup", "binary_scan", "csv_strict_roundtrip",
              "load_count_gate", "mail_chain", "segment_chain", "stream_weekly", "pinned_increment"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOB_WRITES))
def test_no_pair_joins_and_no_row_udfs(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["scan_filter_project"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_orderstatus" not in plan.split("ReadSchema")[1]


def test_latest_per_key_limits_groups_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["latest_per_key"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["upsert_nullsafe", "nullsafe_join", "domain_suffix_join", "alias_match", "interval_join"])
def test_rule_joins_are_hash_or_merge_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_checks_and_profile_read_each_table_once(spark, sf_dir):
    for name, scans in (("quality_checks", {"orders": 1, "lineitem": 1, "documents": 1, "customer": 1}), ("text_profile", {"documents": 1})):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        reused = plan.count("ReusedExchange")
        for table, n in scans.items():
            assert plan.count(f"/{table}.parquet]") <= n + reused, (name, table)
    assert plan_of(QUERIES["quality_checks"](spark, sf_dir)).count("FileScan") == 4


def test_profile_needs_no_large_sketch(spark, sf_dir):
    assert "1000000" not in plan_of(QUERIES["num_profile"](spark, sf_dir))


def test_python_batches_are_bounded(spark):
    """Rows and bytes that a Python worker gets at once do not grow with the table."""
    session.configure(spark)

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)], "size": [int(b["t"].str.len().sum())]})

    for width, rows in ((10, 4_000), (20_000, 2_000)):
        seen = spark.range(0, rows, 1, 1).select(F.repeat(F.lit("x"), F.lit(width)).alias("t")).mapInPandas(sizes, "n long, size long").collect()
        assert sum(r.n for r in seen) == rows
        assert max(r.n for r in seen) <= 1_000 and max(r.size for r in seen) <= 5_000_000


@pytest.mark.parametrize("name, workers", [("segment_rows", 3), ("clean_mail", 3)])
def test_a_mail_passes_few_python_workers(spark, sf_dir, name, workers):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("ArrowEvalPython") <= workers


def test_header_rewrite_cleans_a_text_once(spark, sf_dir):
    """The filter on the cleaned text must not compute it a second time."""
    assert plan_of(QUERIES["header_rewrite"](spark, sf_dir)).count("ArrowEvalPython [_flattened") == 1


def test_document_text_takes_bounded_batches(spark, sf_dir):
    """The query itself sets the bounds, whatever the session had before."""
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    QUERIES["document_text"](spark, sf_dir)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 1_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").startswith("4")
