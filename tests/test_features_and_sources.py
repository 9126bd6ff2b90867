from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tabreg.functions import equal_width_bin
from tabreg.operators.diagnose import histogram, sample_pairs
from tabreg.operators.features import (
    CalendarFeatures,
    category_indexer,
    engineer_features,
    feature_pipeline,
    largest_arity,
    scaler,
    vector_attributes,
)
from tabreg.operators.score import validate_requests
from tabreg.sources import TRANSACTIONS_SCHEMA, ingest_csv, scan_csv, shared_path, stage


def test_schema_has_46_nullable_fields():
    kinds = [f.dataType.typeName() for f in TRANSACTIONS_SCHEMA]
    assert (len(kinds), kinds.count("string"), kinds.count("integer"), kinds.count("double")) == (46, 37, 4, 5)
    assert all(f.nullable for f in TRANSACTIONS_SCHEMA)


def test_calendar_parts_of_text_and_date_columns(spark):
    df = spark.createDataFrame(
        [("02-06-2024", datetime.date(2024, 6, 2)), ("Unknown", None), (None, None)], "t string, d date"
    )
    for column in ("t", "d"):
        rows = CalendarFeatures(dateCol=column, weekendDays=[1, 7]).transform(df).collect()
        assert [rows[0][c] for c in ("trans_year", "trans_month", "trans_quarter", "trans_dayofweek", "is_weekend")] == [2024, 6, 2, 1, True]
        assert rows[1].trans_year is None and rows[2].trans_dayofweek is None


def test_unseen_category_follows_the_policy(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    assert [r[0] for r in category_indexer(["c"]).fit(seen).transform(new).select("c_indexed").collect()] == [1.0, 2.0, 2.0]
    assert category_indexer(["c"], "skip").fit(seen).transform(new).count() == 1
    with pytest.raises(Exception, match="(?i)unseen|null"):
        category_indexer(["c"], "error").fit(seen).transform(new).collect()


def test_feature_names_metadata_and_dropped_rows(spark):
    df = spark.createDataFrame(
        [(1.0, "a", "01-02-2020", 10), (2.0, None, "01-03-2020", 20), (None, "b", "01-03-2020", 20), (3.0, "b", "bad", 5)],
        "x double, c string, d string, y int",
    )
    rows, names, _ = engineer_features(df, ["x"], ["c"], "d", "y")
    assert names == ["x", "trans_year", "trans_month", "trans_quarter", "trans_dayofweek", "c_indexed"]
    assert rows.count() == 2 and dict(rows.dtypes)["label"] == "double"
    assert [a["name"] for a in vector_attributes(rows)] == names
    assert largest_arity(rows) == 3
    # Metadata survives storing the rows.
    assert largest_arity(stage(rows.select("features", "label"))) == 3


def test_one_hot_and_scaled_pipelines(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (2.0, "b", 2), (3.0, "b", 3)], "x double, c string, y int")
    rows = feature_pipeline(["x"], ["c"], one_hot=True, scaling="minmax").fit(df).transform(df)
    assert rows.first().features.size == 1 + 3
    with pytest.raises(ValueError):
        scaler("robust")


def test_constant_column_scales_to_zero_or_half(spark):
    df = spark.createDataFrame([(5.0, "a"), (5.0, "b")], "x double, c string")
    rows = feature_pipeline(["x"], ["c"]).fit(df).transform(df)
    assert scaler("standard").fit(rows).transform(rows).first().scaled_features[0] == 0.0
    assert scaler("minmax").fit(rows).transform(rows).first().scaled_features[0] == 0.5


def test_malformed_lines_are_counted_once_and_for_all(spark, tmp_path):
    file = tmp_path / "rows.csv"
    file.write_text("a,b,c\n1,2.5,x\nfoo,1,y\n3,bar,z\n4,4,w,extra\n")
    schema = "a int, b double, c string"
    from pyspark.sql.types import _parse_datatype_string

    accepted, rejected = ingest_csv(spark, str(file), _parse_datatype_string(schema))
    assert accepted.count() == 1 and rejected.count() == 3
    assert accepted.select("c").count() == 1
    assert {r[0] for r in rejected.collect()} == {"foo,1,y", "3,bar,z", "4,4,w,extra"}


def test_header_in_another_order_is_not_read_silently(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    file = tmp_path / "swapped.csv"
    file.write_text("b,a\nx,1\n")
    with pytest.raises(Exception):
        scan_csv(spark, str(file), _parse_datatype_string("a string, b string")).collect()


def test_shared_folder_follows_the_session_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first.startswith(folder + "/tabreg/x-") and first != second
    stored = stage(spark.range(3), "three")
    assert stored.count() == 3 and folder in stored.inputFiles()[0]


def test_histogram_edges_and_flat_column(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "x double")
    bars = {r.bin: r for r in histogram(df, F.col("x"), bins=5).collect()}
    assert [bars[i].row_count for i in range(5)] == [2, 2, 2, 2, 3]
    assert (bars[0].lower_edge, bars[4].upper_edge) == (0.0, 10.0)
    flat = histogram(spark.createDataFrame([(4.0,)] * 3, "x double"), F.col("x"), bins=4).orderBy("bin").collect()
    assert [r.row_count for r in flat] == [0, 0, 3, 0] and flat[0].lower_edge == 3.5
    row = spark.range(1).select(equal_width_bin(F.lit(1.0), F.lit(0.0), F.lit(1.0), 10).alias("b")).first()
    assert row.b == 9


def test_sample_keeps_everything_when_small(spark):
    assert sample_pairs(spark.range(50), "id", size=100).count() == 50
    assert 0 < sample_pairs(spark.range(5000), "id", size=500).count() < 1000


def test_sample_is_independent_of_the_split(spark):
    from tabreg.operators.resample import holdout_split

    for part in holdout_split(spark.range(20_000), "id"):
        assert 1600 < sample_pairs(part, "id", size=2000).count() < 2400


def test_nan_and_null_are_in_no_bin(spark):
    from tabreg.operators.diagnose import bins_2d

    df = spark.createDataFrame([(0.0, 1.0), (10.0, 2.0), (float("nan"), 3.0), (None, 4.0)], "x double, y double")
    assert [r.row_count for r in histogram(df, F.col("x"), bins=2).orderBy("bin").collect()] == [1, 1]
    assert sum(r.row_count for r in bins_2d(df, "x", "y", bins=2).collect()) == 2
    assert sum(r.row_count for r in histogram(df.limit(0), F.col("x"), bins=2).collect()) == 0


def test_validation_flags_each_reason(spark):
    known = spark.createDataFrame([("c", "a"), ("c", "b"), ("other", "z")], "column_name string, value string")
    asked = spark.createDataFrame(
        [(1, 50.0, "01-01-2020", "a"), (2, 0.5, "01-01-2020", "b"), (3, 50.0, "01-01-2031", "a"), (4, 50.0, "01-01-2020", "z"), (5, None, None, None)],
        "id int, procedure_area double, instance_date string, c string",
    )
    checked = validate_requests(asked, known, ["c"]).orderBy("id").collect()
    assert [r.is_valid for r in checked] == [True, False, False, False, False]
    assert [r.c_ok for r in checked] == [True, True, True, False, False]


def test_partitioned_table_prunes_and_is_gathered(spark, tmp_path):
    from tabreg.sources import scan_parquet, write_partitioned

    year = F.when(F.col("id") % 3 == 0, 2001).otherwise(F.col("id") % 5)
    rows = spark.range(0, 3000, 1, 12).select("id", year.alias("year"))
    path = str(tmp_path / "by-year")
    write_partitioned(rows, path, ["year"])
    stored = scan_parquet(spark, path)
    assert stored.count() == 3000 and stored.filter("year = 2001").count() == 1000
    assert len(list((tmp_path / "by-year" / "year=2001").glob("*.parquet"))) <= 8
    plan = stored.filter("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_missing_inputs_are_named_and_not_scored(spark, tmp_path):
    from tabreg.operators.features import RequiredInputs

    df = spark.createDataFrame([(1.0, 2, 5.0), (None, None, 5.0), (float("nan"), 1, 5.0), (1.0, None, 5.0)], "a double, b int, prediction double")
    stage_ = RequiredInputs(inputCols=["a", "b"])
    stage_.write().overwrite().save(str(tmp_path / "required"))
    rows = RequiredInputs.load(str(tmp_path / "required")).transform(df).collect()
    assert [(r.prediction, r.unscored_reason) for r in rows] == [(5.0, None), (None, "a"), (None, "a"), (None, "b")]
