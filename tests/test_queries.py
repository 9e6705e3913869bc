"""Every registered query against its check SQL, or a plain run where SQL cannot say it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import duck, normalised
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    table = QUERIES[name](spark, sf_dir).toArrow()
    if name not in ORACLES:
        assert table.num_columns > 0
        return
    expected = con.sql(ORACLES[name]).to_arrow_table()
    assert sorted(table.column_names) == sorted(expected.column_names)
    assert normalised(table) == normalised(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sent_values_of_mails_with_an_html_body(spark, sf_dir):
    """Every mail that forwards another one gives a Sent value, HTML-only mails of each fifth conversation included."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn")
    forwards = {r.conv_id * 2**32 + r.turn for r in turns.join(turns.selectExpr("conv_id", "turn + 1 AS turn"), ["conv_id", "turn"]).collect()}
    got = [r.pk_seq for r in QUERIES["sent_values"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(forwards)
    assert any(pk // 2**32 % 5 == 0 for pk in got)
