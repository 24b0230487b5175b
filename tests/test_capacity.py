"""Capacity: widths, measured passes and projections."""

import datetime

import pytest
from pyspark.sql import functions as F

from campuslens.operators import capacity as Z


def test_row_bytes(spark):
    when = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 2, "é", True, when, None), (None, None, None, None, None, "abc")],
                               "a bigint, b int, s string, f boolean, t timestamp_ntz, x string")
    assert [r[0] for r in df.select(Z.row_bytes(df)).collect()] == [8 + 4 + 2 + 1 + 8, 21 + 3]
    with pytest.raises(TypeError, match="n has no measured width"):
        Z.row_bytes(spark.createDataFrame([([1],)], "n array<int>"))


def test_measure_counts_the_rows_of_the_job(spark):
    df = spark.range(0, 5000, 1, 4).select("id", (F.col("id") % 7).cast("int").alias("g"))
    m = Z.measure(df, lambda d: d.groupBy("g").agg(F.sum("id")))
    assert (m.rows, m.bytes, m.bytes_per_row) == (5000, 60_000, 12.0) and m.seconds > 0
    none = Z.measure(df.where("id < 0"), lambda d: d.groupBy("g").agg(F.sum("id")))
    assert (none.rows, none.bytes, none.bytes_per_row) == (0, 0, None)


def test_projection(spark):
    base = spark.createDataFrame([(100, 2000, 10)], "n bigint, b bigint, m bigint")
    got = {r["escenario"]: r for r in Z.project(base, {"now": None, "big": 1000}, 200_000).collect()}
    assert (got["now"]["eventos_anuales"], got["now"]["cabe_en_8gb"]) == (100.0, True)
    assert got["big"]["eventos_anuales"] == 10_000.0 and got["big"]["memoria_gb"] == 0.0002
    assert not got["big"]["cabe_en_8gb"]  # 10,000 rows of 20 bytes, three times over
