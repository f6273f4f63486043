import pytest
from pyspark.sql import functions as F

from clusterloom.operators import prep, selection


def one(spark, values, ddl="v string"):
    return spark.createDataFrame([(v,) for v in values], ddl).withColumn("id", F.monotonically_increasing_id())


def test_numeric_majority_is_strict(spark):
    assert prep.split_types(one(spark, ["1", "2", "x"]), None, ("id",))[0] == ["v"]
    assert prep.split_types(one(spark, ["1", "x"]), None, ("id",))[1] == ["v"]
    assert prep.split_types(one(spark, ["nan", "1"]), None, ("id",))[1] == ["v"]


def test_medians_fill(spark):
    t = spark.createDataFrame([(1.0, 1.0), (None, None), (3.0, 3.0), (10.0, None)], "a double, b double")
    assert selection.medians(t, ["a", "b"]) == {"a": 3.0, "b": 2.0}


def test_narrowed_order_statistics_equal_sorting(spark, monkeypatch):
    monkeypatch.setattr(selection, "COLLECTED", 20)
    values = [float((i * 7919) % 1009) for i in range(3000)] + [5.0] * 2000
    t = one(spark, values, "v double")
    ranks = [0, 1, 17, 2499, 2500, 4998, 4999]
    got = selection.order_statistics(t, "v", ranks)
    want = sorted(values)
    assert [got[r].value for r in ranks] == [want[r] for r in ranks]
    assert all(got[r].under <= r < got[r].under + got[r].at for r in ranks)
    assert selection.medians(t, ["v"])["v"] == (want[2499] + want[2500]) / 2
    with pytest.raises(ValueError):
        selection.order_statistics(t, "v", [5000])


def test_mode_prefers_smallest_on_ties(spark):
    assert prep.modes(one(spark, ["b", "a", "a", "b", None]), ["v"]) == {"v": "a"}


def test_constant_column_scales_to_zero_and_labels_sort(spark):
    t = spark.createDataFrame([(0, 5, 1.0, "c"), (1, 5, 3.0, "a"), (2, 5, 2.0, None)], "id bigint, k int, x double, cls string")
    out, model = prep.prepare(t)
    rows = {r["id"]: r for r in out.collect()}
    assert [rows[i]["features"] for i in range(3)] == [[0.0, 0.0], [0.0, 1.0], [0.0, 0.5]]
    assert model.classes == ["a", "c", "nan"] and [rows[i]["label"] for i in range(3)] == [1, 0, 2]


def test_empty_categorical_becomes_missing_and_markers_vanish(spark):
    t = spark.createDataFrame([(0, "?", "a", "x"), (1, ".", "b", "y"), (2, "", "a", "x")], "id bigint, gone string, c string, cls string")
    out, model = prep.prepare(t)
    assert model.feature_names == ["gone_Missing", "c_a", "c_b"]
    assert [r["features"] for r in out.orderBy("id").collect()] == [[1.0, 1.0, 0.0], [1.0, 0.0, 1.0], [1.0, 1.0, 0.0]]
    assert "label" not in prep.prepare(t, drop_class=True)[0].columns


def test_model_transforms_new_rows(spark):
    t = spark.createDataFrame([(0, 0.0, "a", "x"), (1, 4.0, "b", "y")], "id bigint, n double, c string, cls string")
    model = prep.fit_prep(t)
    new = spark.createDataFrame([(9, 2.0, "zz", "never")], t.schema)
    row = model.transform(new).first()
    assert row["features"] == [0.5, 0.0, 0.0] and row["label"] is None


def test_wide_layout_equals_dense(spark, monkeypatch):
    t = spark.createDataFrame([(i, float(i), f"v{i % 7}", "?" if i % 4 == 0 else f"w{i % 3}", "x") for i in range(40)], "id bigint, n double, a string, b string, cls string")
    dense, model = prep.prepare(t)
    want = {(r["id"], p, v) for r in dense.collect() for p, v in enumerate(r["features"]) if v or p == 0}
    monkeypatch.setattr(prep, "MAX_DENSE", 4)
    wide = prep.fit_prep(t, drop_class=True)
    assert wide.categories is None
    assert {tuple(r) for r in wide.transform_long(t).select("id", "position", "value").collect()} == want
    assert {(r["id"], p, v) for r in wide.transform(t).collect() for p, v in zip(r["features"].positions, r["features"]["values"])} == {w for w in want if w[2]}


def test_row_numbers_are_global(spark):
    t = spark.createDataFrame([(f"k{(i * 37) % 101:03d}",) for i in range(101)], "k string").repartition(5)
    assert [r["position"] for r in selection.row_numbers(t, ["k"]).orderBy("k").collect()] == list(range(101))


def test_sample_is_exact_and_repeatable(spark):
    t = spark.range(500)
    a = {r["id"] for r in selection.exact_sample(t, 30, 1).collect()}
    assert len(a) == 30 and a == {r["id"] for r in selection.exact_sample(t.repartition(7), 30, 1).collect()}


def test_large_sample_equals_small_path(spark, monkeypatch):
    t = spark.range(3000)
    want = {r["id"] for r in selection.exact_sample(t, 700, 5).collect()}
    monkeypatch.setattr(selection, "TOP_ROWS", 10)
    assert {r["id"] for r in selection.exact_sample(t, 700, 5).collect()} == want
    assert selection.exact_sample(t, 4000, 5).count() == 3000
