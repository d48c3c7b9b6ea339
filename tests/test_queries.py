"""Every registered query against its SQL oracle at the smallest scale."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import compare
from flightlake import catalog
from flightlake.operators import history
from flightlake.sources import testdata

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_of_the_data_model_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry_point.queries())
    assert set(catalog.QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    found = compare.spark_rows(entry_point.queries()[name](spark, SF))
    expected = compare.oracle_rows(con, entry_point.oracle_sql()[name])
    assert found == expected


@pytest.mark.parametrize(
    ("name", "step", "wrong"),
    [
        ("gold_replace_airport", "replace_date", lambda history, fresh, day, table: fresh),
        ("gold_replace_country", "replace_date", lambda history, fresh, day, table: history),
        ("upsert_airport", "upsert", lambda target, batch, key: batch),
        ("upsert_country", "upsert", lambda target, batch, key: target),
    ],
)
def test_oracles_catch_a_step_that_ignores_a_side(spark, monkeypatch, name, step, wrong):
    # The run date has enough flights from this scale on.
    sf = "/root/testdata/sf0.01"
    expected = compare.oracle_rows(compare.connect(sf), entry_point.oracle_sql()[name])
    assert compare.spark_rows(entry_point.queries()[name](spark, sf)) == expected
    monkeypatch.setattr(history, step, wrong)
    assert compare.spark_rows(entry_point.queries()[name](spark, sf)) != expected


def test_the_data_model_stands_without_the_training_operators():
    """As if the subpackage and the pipeline had been deleted."""
    code = (
        "import sys; sys.modules['flightlake.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; from flightlake import catalog\n"
        "assert set(e.queries()) == set(e.oracle_sql()) == set(catalog.QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_a_delivery_is_read_without_the_lines_of_the_other(spark):
    both = testdata.bronze_flights(spark, "/root/testdata/sf0.001")
    for batch in ("a", "b"):
        alone = testdata.bronze_flights(spark, "/root/testdata/sf0.001", batch)
        wanted = both.where(F.col("bronze_file") == batch)
        assert alone.exceptAll(wanted).isEmpty() and wanted.exceptAll(alone).isEmpty()
        plan = alone._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan
        assert ("EqualTo(l_linenumber,3)" in plan) == (batch == "b")
