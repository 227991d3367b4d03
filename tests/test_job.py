"""The whole job: laws over outcomes, batch against stream, plan shape, and every query against its SQL."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import fixtures as X
from checks import queries as C
from rowmend import execute, run_batch
from rowmend.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    return (int(value) if value == int(value) else float(value)) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = C.QUERIES[name](spark, SF)
    names = sorted(frame.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in frame.collect()), key=repr)
    expected = duck.sql(C.ORACLES[name])
    assert sorted(expected.columns) == names
    rows = [dict(zip(expected.columns, r)) for r in expected.fetchall()]
    assert got == sorted((tuple(plain(r[n]) for n in names) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(C.QUERIES) == set(C.ORACLES) <= set(contract.queries())
    assert len([n for n in C.QUERIES if not n.startswith("text_")]) == 71


def test_entry(spark):
    assert sum(r["n"] for r in contract.entry(spark).collect()) == 1000


def test_batch_counts_add_up(spark):
    out = X.scratch_dir(spark)
    counts = run_batch(spark, C.text_dir(spark, SF), X.check_config(), f"{out}/good", f"{out}/bad", f"{out}/lost")
    assert sum(counts.values()) == 1000
    assert spark.read.parquet(f"{out}/good").count() == counts["recovered"]
    assert spark.read.text(files.error_dir(f"{out}/bad")).count() == counts["failed"]
    assert spark.read.text(files.error_dir(f"{out}/lost")).count() == counts["unrecoverable"]


def test_recovering_the_failures_again(spark):
    """Error rows are input for a later run: they unwrap to the event inside and count up."""
    failed = C.outcomes(spark, SF).filter("code = 'ReplacementFailure' AND recoveries > 0").select("recoveries", "error_row")
    again = execute(failed.select("recoveries", F.col("error_row").alias("value")).withColumnRenamed("recoveries", "before"), X.check_config())
    rows = again.select("before", "recoveries", "err.code").collect()
    assert rows and all(r["recoveries"] == r["before"] + 1 and r["code"] == "ReplacementFailure" for r in rows)


def test_plan_is_one_narrow_stage(spark):
    done = execute(spark.read.text(C.text_dir(spark, SF)), X.check_config())
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "parse_json" not in plan


def test_error_dirs():
    assert files.default_error_bases("s3://b/in/*") == ("s3://b/in/unrecovered", "s3://b/in/unrecoverable")
    assert files.default_error_bases("s3://b/in", "s3://b/bad/") == ("s3://b/bad/", "s3://b/bad/unrecoverable")
    assert files.default_error_bases("s3://b/in", "s3://b/bad", "s3://b/lost") == ("s3://b/bad", "s3://b/lost")
