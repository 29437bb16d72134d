"""Line items shipped on any day reach the queries on shipments."""

import datetime as dt

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from starload import registry


@pytest.mark.parametrize("name", ["c5_fact_full", "c5_fact_two_batches", "c5_retry_after_failure"])
def test_days_outside_the_generated_years(spark, tmp_path, name):
    line = spark.read.parquet(f"{DATA}/lineitem.parquet")
    few = line.where("l_linenumber < 7").limit(2)
    for years in (-10, 30):
        day = (F.col("l_shipdate") + F.expr(f"interval {years} years")).cast("timestamp_ntz").alias("l_shipdate")
        few.select(*[day if c == "l_shipdate" else c for c in line.columns]).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{DATA}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    shipped = spark.read.parquet(f"{tmp_path}/lineitem.parquet").select("l_partkey", F.to_date("l_shipdate")).distinct()
    want = {(k, int(d.strftime("%Y%m%d"))) for k, d in shipped.collect()}
    assert min(d for _, d in want) < 19950101 and max(d for _, d in want) > 20011231
    found = registry.queries()[name](spark, str(tmp_path))
    assert {(r.appid, r.date_key) for r in found.collect()} == want
