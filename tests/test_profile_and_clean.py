from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tabreg.operators import quantiles as q
from tabreg.operators.clean import (
    MissingValueImputer,
    MissingValueImputerModel,
    OutlierFilter,
    OutlierFilterModel,
    SparseColumnDropper,
    deduplicate,
    deduplicate_rare,
    keep_kinds,
)
from tabreg.operators.profile import describe, missing_report, retention_audit, table_counts
from tabreg.plans import clean


def brute(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


@pytest.mark.parametrize("shape", ["spread", "one value holds a third", "two values", "integers", "infinite"])
def test_exact_quantiles_refine_to_the_sorted_answer(spark, shape):
    rng = random.Random(7)
    values = {
        "spread": [rng.gauss(0, 1e6) for _ in range(3000)],
        "one value holds a third": [5.0] * 1000 + [rng.uniform(0, 10) for _ in range(2000)],
        "two values": [1.0] * 1500 + [2.0] * 1500,
        "integers": [float(rng.randrange(50)) for _ in range(3000)],
        "infinite": [-math.inf] * 700 + [rng.uniform(0, 10) for _ in range(2000)] + [math.inf] * 300,
    }[shape]
    values += [None, float("nan")] * 10
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    assert q.exact_quantiles(df, "x", wanted)["x"] == [brute(values, p) for p in wanted]


def test_bits_of_a_value_are_computed_once_a_pass(spark):
    values = spark.range(10).select(F.lit(None).cast("int").alias("part"), q.ordered_bits(F.col("id").cast("double")).alias("v0"))
    once = values._jdf.queryExecution().optimizedPlan().toString().count("LOG2(")
    passed = q._counts(q._paired(values, 1).filter(F.col("bits").between(3, 1 << 62)), 48, [])
    assert passed._jdf.queryExecution().optimizedPlan().toString().count("LOG2(") == once > 0


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert q.exact_quantiles(df, "x", [0.5])["x"] == [None]
    assert q.approx_quantiles(df, "x", [0.5])["x"] == [None]
    with pytest.raises(ValueError):
        OutlierFilter(inputCol="x").fit(df)


def test_unknown_settings_raise(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        OutlierFilter(inputCol="x", method="zscore").fit(df)
    with pytest.raises(ValueError):
        OutlierFilter(inputCol="x", action="flag").fit(df)
    with pytest.raises(ValueError):
        MissingValueImputer(numericStrategy="max").fit(df)
    with pytest.raises(ValueError):
        deduplicate(df, ["x"], keep="any")


def test_imputer_fills_null_and_nan_and_leaves_other_types(spark):
    df = spark.createDataFrame(
        [(1.0, 1, "a", None), (float("nan"), None, None, True), (None, 4, "b", False), (4.0, 4, "b", False)],
        "x double, n int, s string, flag boolean",
    )
    filled = MissingValueImputer().fit(df).transform(df)
    assert filled.dtypes == df.dtypes
    assert sorted(r.x for r in filled.collect()) == [1.0, 2.5, 2.5, 4.0]
    assert sorted(r.n for r in filled.collect()) == [1, 3, 4, 4]
    assert sorted(r.s for r in filled.collect()) == ["Unknown", "a", "b", "b"]
    assert filled.filter("flag is null").count() == 1
    mode = MissingValueImputer(textStrategy="mode", numericStrategy="median").fit(df).transform(df)
    assert sorted(r.s for r in mode.collect()) == ["a", "b", "b", "b"]
    dropped = MissingValueImputer(textStrategy="drop", numericStrategy="drop").fit(df).transform(df)
    assert dropped.count() == 2


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, None), (None, "a")], "x double, s string")
    filled = MissingValueImputer(textStrategy="mode").fit(df).transform(df)
    assert filled.filter("x is null").count() == 2
    assert filled.filter("s = 'a'").count() == 2


def test_sparse_threshold_is_strict(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 3.0), (None, None)], "half double, most double")
    assert SparseColumnDropper(threshold=50.0).fit(df).transform(df).columns == ["half"]


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert missing_report(empty).filter("missing_pct is not null").count() == 0
    assert describe(empty).filter("value_count = 0").count() == 2
    assert table_counts(empty).first()[0] == 0
    assert SparseColumnDropper().fit(empty).transform(empty).columns == ["x", "s"]
    audit = retention_audit(empty, {"positive": F.col("x") > 0}).collect()
    assert [r.rows_out for r in audit] == [0, 0] and audit[0].kept_pct is None


def test_dedup_variants_agree_when_a_third_of_the_rows_is_one_row(spark):
    rows = [(1, "hot", 1.0)] * 500 + [(i, f"s{i % 7}", None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, s string, x double").repartition(6)
    expected = {tuple(r) for r in df.collect()}
    for result in (deduplicate(df), deduplicate_rare(df)):
        found = [tuple(r) for r in result.collect()]
        assert len(found) == len(expected) and set(found) == expected


def test_keyed_dedup_keeps_the_preferred_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 1, "n")], "k string, v int, s string")
    first = {tuple(r) for r in deduplicate(df, ["k"], prefer=["v"]).collect()}
    last = {tuple(r) for r in deduplicate(df, ["k"], prefer=["v"], keep="last").collect()}
    assert first == {("a", 1, "y"), ("b", 5, "z"), (None, 1, "n")}
    assert last == {("a", 2, "x"), ("b", 5, "z"), (None, 1, "n")}


def test_kind_filter_ignores_case_and_blanks(spark):
    df = spark.createDataFrame([("Sales",), (" SALES ",), ("Gifts",), (None,)], "kind string")
    assert keep_kinds(df, "kind").count() == 2
    assert keep_kinds(df, "kind", ["gifts", "sales"]).count() == 3


def test_bounds_are_inclusive_and_not_negative(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,), (float("nan"),)], "x double")
    model = OutlierFilter(inputCol="x", factor=1.5).fit(df)
    assert model.bounds == (0.0, 75 + 1.5 * 50)
    assert model.transform(df).count() == 100
    clipped = OutlierFilter(inputCol="x", method="percentile", lower=0.1, upper=0.9, action="clip").fit(df).transform(df)
    low, high = clipped.filter("x is not null and not isnan(x)").agg(F.min("x"), F.max("x")).first()
    assert (low, high) == (10.0, 90.0)
    assert clipped.filter("x is null").count() == 1 and clipped.filter("isnan(x)").count() == 1


def test_fitted_cleaning_steps_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (None, "b"), (4.0, "b")], "x double, s string")
    for fitted, kind in [
        (OutlierFilter(inputCol="x", factor=3.0).fit(df), OutlierFilterModel),
        (MissingValueImputer(textStrategy="mode").fit(df), MissingValueImputerModel),
    ]:
        path = str(tmp_path / kind.__name__)
        fitted.write().overwrite().save(path)
        again = kind.load(path)
        assert again.transform(df).collect() == fitted.transform(df).collect()


def test_known_cleaning_counts(spark):
    from workload.fixture import KIND, TARGET, txn

    raw = txn(spark, "/root/testdata/sf0.01")
    rows, model = clean(raw, TARGET, KIND)
    assert raw.count() == 15_300
    assert rows.count() == 9_760
    assert "sparse_value" not in rows.columns
    assert model.stages[0].bounds[1] == pytest.approx(2_049_075.449)
    assert clean(raw, TARGET, KIND, rare_duplicates=True)[0].count() == 9_760
