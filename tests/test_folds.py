"""Leak-free cross-validation, moments, stored codes, stratified folds, and tables that grow by files."""

from __future__ import annotations

import math
import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabreg.operators import codes as codes_module
from tabreg.operators.arrivals import DistinctStore, FileProfile
from tabreg.operators.codes import code_dictionary, encode_stored
from tabreg.operators.features import category_indexer, largest_arity
from tabreg.operators.gram import Moments, fit_without_folds, has_closed_form, moments, solve
from tabreg.operators.profile import RowAudit, describe, missing_report
from tabreg.operators.quantiles import double_of, exact_quantiles, ordered_bits, quantiles_without_parts
from tabreg.operators.ranks import row_numbers
from tabreg.operators.resample import assign_folds, assign_stratified_folds, bootstrap_exact
from tabreg.plans import Preparation, cross_validate, prepare_folds
from tabreg.sources import newest_version, publish, retire_versions


def disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


# --- quantiles -------------------------------------------------------------


def test_bits_order_as_doubles(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [2.0**e * f for e in range(-1074, 1024, 7) for f in (1, -1, 1 + 2**-52, 1 - 2**-53)]
    values += [0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 0.1, 1e15, 3.0]
    values = [v for v in values if not math.isnan(v)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", ordered_bits(F.col("x")).alias("b")).collect()
    assert all(double_of(r.b) == r.x for r in rows)
    by_value = sorted(rows, key=lambda r: r.x)
    assert all(a.b < b.b if a.x < b.x else a.b == b.b for a, b in zip(by_value, by_value[1:]))


def test_quantiles_without_each_part(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(4), rng.choice([7.0, rng.gauss(0, 50)]), rng.randrange(9)) for _ in range(2000)] + [(1, None, None), (2, float("nan"), 3)]
    df = spark.createDataFrame(rows, "part int, x double, n int").repartition(5)
    wanted = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = quantiles_without_parts(df, ["x", "n"], wanted, "part", range(4))
    for without in (None, 0, 1, 2, 3):
        for at, name in ((1, "x"), (2, "n")):
            values = [r[at] for r in rows if r[0] != without and r[at] is not None and not math.isnan(r[at])]
            assert found[without][name] == [disc(values, p) for p in wanted]
    middle = exact_quantiles(df, ["x"], [0.5, 0.37], interpolate=True)["x"]
    values = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    assert np.allclose(middle, np.quantile(values, [0.5, 0.37]), rtol=1e-12)
    only = spark.createDataFrame([(0, 1.0), (0, 2.0)], "part int, x double")
    assert quantiles_without_parts(only, "x", [0.5], "part", [0, 1]) == {None: {"x": [1.0]}, 0: {"x": [None]}, 1: {"x": [1.0]}}


# --- numbers and codes -----------------------------------------------------


def test_row_numbers_count_each_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, i int").repartition(6)
    found = row_numbers(df, ["g"], [F.desc("o"), F.col("i")]).collect()
    for group in ("hot", "b", None):
        own = sorted((r for r in found if r.g == group), key=lambda r: r.row_no)
        assert [r.i for r in own] == [i for _, _, i in sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))]
        assert [r.row_no for r in own] == list(range(len(own))) and {r.group_rows for r in own} == {len(own)}
    assert sorted(r.row_no for r in row_numbers(df, [], ["i"]).collect()) == list(range(2000))
    assert row_numbers(df.limit(0), ["g"], ["o"]).collect() == []


@pytest.mark.parametrize("hot", [256, 2, 0])
def test_stored_codes_same_as_indexer(spark, monkeypatch, hot):
    monkeypatch.setattr(codes_module, "HOT_VALUES", hot)
    rng = random.Random(4)
    rows = [(i, rng.choice(["x"] * 10 + [f"v{rng.randrange(40)}", None]), rng.choice("abc")) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, c string, d string").repartition(4)
    unseen = df.unionByName(spark.createDataFrame([(-1, "new", None)], df.schema))
    dictionary = code_dictionary(df, ["c", "d"])
    for invalid in ("keep", "skip"):
        want = category_indexer(["c", "d"], invalid).fit(df).transform(unseen)
        found = encode_stored(unseen, dictionary, ["c", "d"], invalid)
        assert sorted(map(tuple, found.select("id", "c_indexed", "d_indexed").collect())) == sorted(map(tuple, want.select("id", "c_indexed", "d_indexed").collect()))
    vectors = VectorAssembler(inputCols=["c_indexed"], outputCol="features").transform(encode_stored(df, dictionary, ["c"]))
    assert largest_arity(vectors) == dictionary.filter("column_name = 'c'").count() + 1
    with pytest.raises(Exception, match="no code in c for"):
        encode_stored(unseen.filter("c is not null"), dictionary, ["c"], "error").collect()
    with pytest.raises(ValueError):
        encode_stored(df, dictionary, ["c"], "drop")
    nothing = encode_stored(df.limit(0), code_dictionary(df.limit(0), ["c"]), ["c"])
    assert nothing.collect() == [] and encode_stored(df, code_dictionary(df.limit(0), ["c"]), ["c"]).agg(F.max("c_indexed")).first()[0] == 0.0


def test_codes_of_a_million_values_stay_in_the_cluster(spark, monkeypatch):
    """A third of the rows hold one value, the others a value each."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    rows = spark.range(1_500_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("c"))
    collected = []
    plain = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: collected.append(len(out := plain(self))) or out)
    dictionary = code_dictionary(rows, ["c"])
    coded = encode_stored(rows, dictionary, ["c"])
    shown = coded.groupBy((F.col("c") == "hot").alias("hot")).agg(
        F.countDistinct("c_indexed").alias("n"), F.min("c_indexed").alias("low"), F.max("c_indexed").alias("high")
    )
    monkeypatch.undo()
    assert sum(collected) <= 1
    assert {r.hot: (r.n, r.low, r.high) for r in shown.collect()} == {True: (1, 0.0, 0.0), False: (1_000_000, 1.0, 1_000_000.0)}


# --- moments ---------------------------------------------------------------


def test_moments_merge_and_solve_as_the_library(spark):
    rng = np.random.default_rng(5)
    x = rng.normal([40.0, 3.0, -2.0], [10.0, 1.0, 500.0], (900, 3))
    y = x @ [2.0, -30.0, 0.01] + rng.normal(0, 5, 900)
    df = spark.createDataFrame([(i, i % 3, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, fold int, features array<double>, label double")
    df = df.withColumn("features", array_to_vector("features")).persist()
    parts = moments(df, by="fold")
    merged, whole = parts[0] + parts[1] + parts[2], moments(df)[None]
    assert merged.count == 900 and np.allclose(merged.mean, whole.mean, rtol=1e-12) and np.allclose(merged.products, whole.products, rtol=1e-9, atol=1e-6)
    for penalty in (0.0, 0.1, 25.0):
        model = LinearRegression(regParam=penalty, solver="normal").fit(df.filter("fold <> 1"))
        coefficients, intercept = solve(parts[0] + parts[2], penalty)
        assert np.allclose(coefficients, model.coefficients.toArray(), rtol=1e-7, atol=1e-9) and abs(intercept - model.intercept) < 1e-3
    fitted = fit_without_folds(df, LinearRegression(regParam=0.1), [0, 1, 2])
    want = LinearRegression(regParam=0.1, solver="normal").fit(df.filter("fold <> 2")).transform(df)
    both = fitted[2].transform(df).select("id", F.col("prediction").alias("p")).join(want, "id")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-4
    far = x + [1e7, 0.0, 0.0]  # far from the origin, and with a constant
    wide = spark.createDataFrame([([*a.tolist(), 7.0], float(b)) for a, b in zip(far, y)], "features array<double>, label double")
    coefficients, intercept = solve(moments(wide.withColumn("features", array_to_vector("features")))[None])
    plain = np.linalg.lstsq(np.column_stack((x - x.mean(0), np.ones(900))), y, rcond=None)[0]
    assert np.allclose(coefficients[:3], plain[:3], rtol=1e-6) and coefficients[3] == 0.0
    assert abs(intercept + coefficients[:3] @ far.mean(0) - y.mean()) < 1e-5
    assert moments(df.limit(0), width=3) == {} and solve(Moments(2, np.array([1.0, 5.0]), np.zeros((2, 2))))[1] == 5.0
    assert has_closed_form(LinearRegression(maxIter=100, regParam=0.1))
    for other in (LinearRegression(elasticNetParam=0.5, regParam=0.1), LinearRegression(loss="huber"), LinearRegression(fitIntercept=False), LinearRegression(weightCol="w")):
        assert not has_closed_form(other)


# --- folds -----------------------------------------------------------------


def priced(spark, n=800, outliers=()):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "a", "b", f"c{i % 7}", None]), rng.choice([None, *[float(rng.randrange(1, 9))] * 3]), float(rng.randrange(100, 200))) for i in range(n)]
    rows += [(n + i, "a", 2.0, price) for i, price in enumerate(outliers)] + [(-1, "a", 1.0, None), (-2, "b", 1.0, float("nan"))]
    return rows, spark.createDataFrame(rows, "id long, kind string, size double, price double").repartition(4)


def learned(rows, folds, left_out):
    """Plain bounds, fill and codes from the rows outside one fold (or from all)."""
    seen = [r for r in rows if folds[r[0]] != left_out and r[3] is not None and not math.isnan(r[3])]
    low, high = disc([r[3] for r in seen], 0.25), disc([r[3] for r in seen], 0.75)
    low, high = max(0.0, low - 3 * (high - low)), high + 3 * (high - low)
    inside = [r for r in seen if low <= r[3] <= high]
    sizes = [r[2] for r in inside if r[2] is not None]
    counts = Counter(r[1] or "Unknown" for r in inside)
    order = sorted(counts, key=lambda v: (-counts[v], v))
    return low, high, len(inside), sum(sizes) / len(sizes), {v: i for i, v in enumerate(order)}


@pytest.mark.parametrize("scope", ["fold", "global"])
def test_states_same_as_fits_of_their_own(spark, scope):
    rows, df = priced(spark, outliers=[9000.0, 390.0, 380.0, 401.0, 410.0])
    settings = Preparation("price", ("size",), ("kind",))
    prepared = prepare_folds(df, settings, "id", 4, scope=scope)
    folds = {r.id: r.fold for r in assign_folds(df.select("id"), "id", 4).collect()}
    for fold in range(4):
        low, high, n, fill, code = learned(rows, folds, fold if scope == "fold" else None)
        state = prepared.state(fold)
        assert (state.lower, state.upper, state.rows) == (low, high, n) and abs(state.fills["size"] - fill) < 1e-9 and state.labels == {"kind": len(code)}
        train, validation = [{r.id: r for r in part.collect()} for part in prepared.split(fold)]
        assert set(train) == {r[0] for r in rows if folds[r[0]] != fold and r[3] is not None and low <= r[3] <= high}
        mine = {r[0] for r in rows if folds[r[0]] == fold and r[3] is not None and not math.isnan(r[3])}
        assert set(validation) == (mine if scope == "fold" else {i for i in mine if low <= dict((r[0], r[3]) for r in rows)[i] <= high})
        for r in rows:
            if (found := train.get(r[0]) or validation.get(r[0])) is not None:
                assert found.kind_indexed == code.get(r[1] or "Unknown", len(code)) and abs(found.size - (fill if r[2] is None else r[2])) < 1e-9
    assert prepared.facts().count() == (4 if scope == "fold" else 1)
    with pytest.raises(ValueError):
        prepared.split(4)


def test_global_scope_lets_an_outlier_leak(spark):
    """A planted price that only its own fold knows moves the fill of that fold under 'global' and no number under 'fold'."""
    rows, df = priced(spark)
    planted = df.unionByName(spark.createDataFrame([(5000, "planted", 1e6, 150.0)], df.schema))
    fold = assign_folds(planted, "id", 4).filter("id = 5000").first().fold
    settings = Preparation("price", ("size",), ("kind",))
    states = {(name, scope): prepare_folds(rows_, settings, "id", 4, scope=scope).state(fold)
              for name, rows_ in (("plain", df), ("planted", planted)) for scope in ("fold", "global")}
    assert states["plain", "fold"] == states["planted", "fold"]
    assert states["planted", "global"].fills["size"] > 10 * states["plain", "global"].fills["size"]
    assert states["planted", "global"].labels["kind"] == states["plain", "global"].labels["kind"] + 1
    line = {}
    for scope in ("fold", "global"):
        validated = cross_validate(planted, LinearRegression(), "id", 4, preparation=settings, fit_scope=scope)
        line[scope] = {r.id: r.prediction for r in validated.predictions.collect()}
    assert set(line["fold"]) == set(line["global"]) and any(abs(line["fold"][i] - line["global"][i]) > 1e-6 for i in line["fold"])


def test_sparse_columns_go_by_fold_and_odd_input_raises(spark):
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, F.lit(1.0)).alias("thin"), (F.col("id") * 1.0).alias("size"), (F.col("id") % 10 + 100.0).alias("price"))
    prepared = prepare_folds(rows, Preparation("price", ("thin", "size")), "id", 3)
    assert prepared.state(0).dropped == ["thin"] and len(prepared.train(0).first().features) == 1
    assert "thin" not in prepared.validation(0).columns
    with pytest.raises(ValueError, match="no prices"):
        prepare_folds(rows.limit(0), Preparation("price", ("size",)), "id", 3)
    with pytest.raises(ValueError, match="scope"):
        prepare_folds(rows, Preparation("price"), "id", 3, scope="some")
    with pytest.raises(ValueError, match="preparation"):
        cross_validate(rows, LinearRegression(), None, 3, preparation=Preparation("price", ("size",)), random=True)
    with pytest.raises(ValueError, match="folds have rows"):
        cross_validate(rows.filter("id in (0, 1)"), LinearRegression(), "id", 30, preparation=Preparation("price", ("size",)))


def test_stratified_folds_are_even_and_layout_free(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([5.0, rng.gauss(0, 9), None])) for i in range(3000)]  # one price in a third of the rows
    df = spark.createDataFrame(rows, "id long, price double")
    folded = assign_stratified_folds(df.repartition(7), "id", "price", 7, strata=5)
    counts = folded.groupBy("stratum").pivot("fold", list(range(7))).count().fillna(0).collect()
    prices = [p for _, p in rows if p is not None]
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in counts) and len(counts) == len({disc(prices, i / 5) for i in range(1, 5)}) + 2
    assert folded.exceptAll(assign_stratified_folds(df.repartition(2), "id", "price", 7, strata=5)).count() == 0
    assert assign_stratified_folds(df.limit(0), "id", "price").collect() == []
    with pytest.raises(ValueError):
        assign_stratified_folds(df, "id", "price", 1)


def test_exact_bootstrap_has_the_stated_size(spark):
    df = spark.range(5000).select("id", F.lit("x").alias("__row_"))
    for fraction, n in ((1.0, 5000), (0.3, 1500)):
        drawn = bootstrap_exact(df.repartition(5), "id", 2, fraction=fraction)
        assert drawn.agg(F.sum("bootstrap_count")).first()[0] == n and drawn.count() == 5000
    share = drawn.filter("bootstrap_count = 0").count() / 5000
    assert abs(share - math.exp(-0.3)) < 0.03
    again = bootstrap_exact(df.repartition(2), "id", 2, fraction=0.3)
    assert again.exceptAll(drawn).count() == 0
    assert bootstrap_exact(df.limit(0), "id").collect() == []


# --- tables that grow ------------------------------------------------------


def test_store_takes_new_rows_and_is_not_shuffled(spark):
    rows = [(i % 50, None if i % 7 == 0 else f"t{i % 11}", 0.5) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    store = DistinctStore.create(df.filter("a < 30"), "distinct_rows_test", 16)
    fresh = store.new_rows(df.unionByName(df))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, fresh.collect())) == Counter({r: 1 for r in set(rows) if r[0] >= 30})
    initial = plan[plan.rindex("SortMergeJoin") :]
    assert initial.count("Exchange") == 1 and initial.index("Exchange") < initial.index("distinct_rows_test") and "Bucketed: true" in initial
    store.add(df)
    assert set(map(tuple, store.rows().collect())) == set(rows) and store.rows().count() == len(set(rows))
    assert store.new_rows(df).count() == 0 and store.new_rows(df.limit(0)).count() == 0
    spark.sql("DROP TABLE distinct_rows_test")


def test_profile_follows_new_files(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, rng.gauss(1e6, 3.0)]), rng.choice([None, "x", f"t{i}"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "n long, x double, s string")
    files, profile = str(tmp_path / "files"), FileProfile(spark, str(tmp_path / "states"), str(tmp_path / "files"))
    df.filter("n < 1500").repartition(2).write.parquet(files)
    assert profile.refresh().count() == 2
    df.filter("n >= 1500").repartition(3).write.mode("append").parquet(files)
    assert profile.refresh().count() == 3 and profile.refresh().count() == 0
    whole = spark.read.parquet(files)
    assert sorted(map(tuple, profile.missing_report().collect())) == sorted(map(tuple, missing_report(whole).select("column_name", "missing_count", "missing_pct", "dtype").collect()))
    found = {r.column_name: r for r in profile.describe().collect()}
    for want in describe(whole).collect():
        mine = found[want.column_name]
        assert (mine.value_count, mine.min_value, mine.max_value, mine.min_text, mine.max_text) == (want.value_count, want.min_value, want.max_value, want.min_text, want.max_text)
        if want.mean is not None:
            assert abs(mine.mean - want.mean) < 1e-6 * abs(want.mean) and abs(mine.stddev - want.stddev) < 1e-6 * want.stddev
    values = sorted(r[1] for r in rows if r[1] is not None)
    assert abs(sum(v <= found["x"].approx_median for v in values) / len(values) - 0.5) < 0.02
    assert abs(found["n"].approx_distinct - 4000) < 120


def test_readers_see_whole_versions_only(spark, tmp_path):
    path = str(tmp_path / "served")

    def write(text):
        return lambda at: spark.createDataFrame([(text,)], "t string").write.json(at)

    def broken(at):
        raise RuntimeError("lost between two writes")

    with pytest.raises(FileNotFoundError):
        newest_version(spark, path)
    first = publish(spark, path, {"a": write("1"), "b": write("1")})
    with pytest.raises(RuntimeError):
        publish(spark, path, {"a": write("2"), "b": broken})
    assert newest_version(spark, path) == first
    third = publish(spark, path, {"a": write("3"), "b": write("3")})
    assert newest_version(spark, path) == third and spark.read.json(f"{third}/b").first().t == "3"
    publish(spark, path, {"a": write("4")})
    assert len(retire_versions(spark, path, keep=2)) == 2 and spark.read.json(f"{third}/a").first().t == "3"
    with pytest.raises(ValueError):
        retire_versions(spark, path, keep=0)


def test_audit_counts_while_rows_are_written(spark):
    audit = RowAudit()
    rows = audit.step(spark.range(100), "raw")
    rows = audit.step(rows.filter("id % 2 = 0"), "even")
    audit.step(rows.filter("id < 0"), "none").write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in audit.table(spark).collect()] == [(1, "even", 100, 50, 50.0, 50.0), (2, "none", 50, 0, 0.0, 0.0)]
