"""Files laid out along a curve over several columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veilmark import io


def test_filters_on_either_column_skip_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(900)).cast("int")).alias("d"),
        F.when(F.col("id") % 50 != 0, F.format_string("k%04d", F.pmod(F.xxhash64(F.col("id") + 1), F.lit(5000)))).alias("t"),
        F.array("id").alias("nested"),
    )
    for columns in (["a", "d"], ["t", "a"]):
        path = str(tmp_path / "_".join(columns))
        io.write_clustered(rows, path, columns, 16)
        assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 20_000
        files = io.file_ranges(spark, path, columns)
        assert files.count() == 16 and files.agg(F.max("n")).first()[0] < 4 * 20_000 / 16
        for c in columns:
            middle = rows.agg(F.max(c), F.min(c)).first()
            for value in middle:
                hit = files.filter((F.col(f"min_{c}") <= F.lit(value)) & (F.col(f"max_{c}") >= F.lit(value))).count()
                assert hit <= 8, (c, value, hit)


def test_a_hot_value_spreads_over_files(spark, tmp_path):
    rows = spark.range(8_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit(None).cast("int").alias("b"), "id")
    io.write_clustered(rows, str(tmp_path / "hot"), ["a", "b"], 8)
    files = io.file_ranges(spark, str(tmp_path / "hot"), ["a"])
    assert files.agg(F.max("n")).first()[0] < 2_000
    assert spark.read.parquet(str(tmp_path / "hot")).distinct().count() == 8_000


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "a long, t string")
    io.write_clustered(empty, str(tmp_path / "empty"), ["a", "t"], 4)
    assert spark.read.schema(empty.schema).parquet(str(tmp_path / "empty")).count() == 0
    with pytest.raises(TypeError, match="no place"):
        io.write_clustered(spark.range(3).select(F.array("id").alias("x")), str(tmp_path / "x"), ["x"], 2)
    with pytest.raises(ValueError, match="taken"):
        io.write_clustered(spark.range(3).withColumn("__curve", F.lit(1)), str(tmp_path / "y"), ["id"], 2)
    with pytest.raises(ValueError, match="one column"):
        io.write_clustered(spark.range(3), str(tmp_path / "z"), [], 2)
