
import pytest
from pyspark.sql import functions as F

from paneltide.operators import panel as ops
from paneltide.operators.joins import natural_join, scalar, suffix_join
from paneltide.operators.reshape import assert_unique, pivot_multi, pivot_wide, unpivot


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_rolling_complete_nulls_until_full(spark):
    df = spark.createDataFrame([("a", y, float(y)) for y in range(1, 8)] + [("b", 1, 1.0), ("b", 2, None),
                                ("b", 3, 3.0), ("b", 4, 4.0), ("b", 5, 5.0), ("b", 6, 6.0), ("b", 7, 7.0)],
                               "c string, y int, x double")
    out = {(r.c, r.y): r.x for r in ops.rolling_complete(df, "c", "y", ["x"], n=5).collect()}
    assert out[("a", 4)] is None and out[("a", 5)] == 3.0 and out[("a", 7)] == 5.0
    assert out[("b", 5)] is None and out[("b", 6)] is None and out[("b", 7)] == 5.0


def test_interpolate_interior_only(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 2.0), ("a", 3, None), ("a", 5, 8.0), ("a", 6, None),
                                ("b", 1, None), ("b", 2, 5.0), ("b", 3, None)], "c string, y int, x double")
    out = {(r.c, r.y): r.x for r in ops.interpolate_linear(df, "c", "y", ["x"]).collect()}
    assert out[("a", 1)] is None and out[("a", 6)] is None
    assert out[("a", 3)] == pytest.approx(4.0)
    assert out[("b", 1)] is None and out[("b", 3)] is None and out[("b", 2)] == 5.0


def test_dedup_keep_first_is_deterministic(spark):
    data = [("k1", 3, "c"), ("k1", 1, "a"), ("k1", 2, "b"), ("k2", 5, "z"), ("k2", 5, "y")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    for n in (1, 16):
        out = rows(ops.dedup_keep_first(df.repartition(n), ["k"], ["o"]), "k")
        assert out == [("k1", 1, "a"), ("k2", 5, "y")]


def test_pivot_wide_absent_values_give_null(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "id string, k string, v int")
    out = rows(pivot_wide(df, ["id"], "k", ["x", "y", "z"], value_col="v", name=str), "id")
    assert out == [("a", 1, 2, None), ("b", 3, None, None)]
    with pytest.raises(ValueError):
        assert_unique(df.unionByName(df), ["id", "k"])


def test_pivot_multi_names_value_first(spark):
    df = spark.createDataFrame([("v", "pre", 1.0, 2.0), ("v", "post", 3.0, 4.0)],
                               "variable string, g string, mean double, sd double")
    out = pivot_multi(df, ["variable"], "g", ["pre", "post"], ["mean", "sd"])
    assert out.columns == ["variable", "mean_pre", "mean_post", "sd_pre", "sd_post"]
    assert rows(out, "variable") == [("v", 1.0, 3.0, 2.0, 4.0)]


def test_unpivot_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "id int, a double, b double")
    assert rows(unpivot(df, ["id"]), "variable") == [(1, "a", 1.0), (1, "b", None)]


def test_suffix_join_only_clashing_non_keys(spark):
    a = spark.createDataFrame([(1, 2020, 10.0, "x")], "g int, year int, pop double, only_a string")
    b = spark.createDataFrame([(1, 2020, 20.0)], "g int, year int, pop double")
    out = suffix_join(a, b, ["g", "year"], "left", ("_acs1", "_acs5"))
    assert sorted(out.columns) == sorted(["g", "year", "pop_acs1", "only_a", "pop_acs5"])


def test_natural_join_and_many_to_many(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "ori int, s string")
    m = spark.createDataFrame([(1, "g1"), (1, "g2")], "ori int, geo string")
    out = natural_join(a, m)
    assert out.count() == 3


def test_scalar_subquery(spark):
    df = spark.createDataFrame([(2008,), (2010,)], "year int")
    out = df.select((F.col("year") - scalar(df.select(F.min("year")))).alias("p"))
    assert sorted(r.p for r in out.collect()) == [0, 2]


def test_regime_diff_requires_both_regimes(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 4.0), ("b", 1, 2.0)], "c string, post int, x double")
    assert rows(ops.regime_diff(df, "c", "post", ["x"]), "c") == [("a", 3.0)]


def test_group_row_ranges(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3)], "g string, y int")
    assert rows(ops.group_row_ranges(df, "g"), "g") == [("a", 1, 2), ("b", 3, 3), ("c", 4, 6)]


def test_count_per_key_and_partition_totals(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    out = rows(ops.count_per_key(df, ["k"]), "k", "v")
    assert out == [("a", 1, 2), ("a", 2, 2), ("b", 5, 1)]


def test_null_keys_keep_their_totals(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), ("a", None, 3)], "k string, j int, v int")
    out = {r.v: r.n for r in ops.count_per_key(df, ["k", "j"]).collect()}
    assert out == {1: 2, 2: 2, 3: 1} and ops.count_per_key(df, ["k", "j"]).columns == ["k", "j", "v", "n"]


def test_lag_within(spark):
    df = spark.createDataFrame([("a", 2, 2.0), ("a", 1, 1.0), ("b", 1, 9.0)], "c string, y int, x double")
    out = {(r.c, r.y): r.x_lag1 for r in ops.lag_within(df, "c", "y", ["x"]).collect()}
    assert out == {("a", 1): None, ("a", 2): 1.0, ("b", 1): None}


def test_rollup_checks_its_constants(spark):
    ok = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "x", None), ("b", 3, "y", 1.5)], "k string, v int, g string, n double")
    assert rows(ops.rollup(ok, ["k"], sums=["v"], constants=["g", "n"]), "k") == [("a", 3, "x", None), ("b", 3, "y", 1.5)]
    for bad in (("b", 4, "z", 1.5), ("b", 4, "y", None)):
        mixed = ok.unionByName(spark.createDataFrame([bad], ok.schema))
        with pytest.raises(Exception, match="several values of " + ("g" if bad[2] == "z" else "n")):
            ops.rollup(mixed, ["k"], sums=["v"], constants=["g", "n"]).collect()


def test_pivot_checks_its_cells(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "y", None), (2, "x", 7)], "id int, k string, v int")
    wide = lambda d: pivot_wide(d, ["id"], "k", ["x", "y"], value_col="v", name=str, unique=True)
    assert rows(wide(df), "id") == [(1, 5, None), (2, 7, None)]
    with pytest.raises(Exception, match="pivot column y"):
        wide(df.unionByName(spark.createDataFrame([(1, "y", 3)], df.schema))).collect()


def test_sizing_conf_scales_with_input():
    from paneltide.session import sizing_conf
    small = sizing_conf(10 << 30, 64)
    big = sizing_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 416000
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0


def test_dedup_keep_first_nulls_last(spark):
    df = spark.createDataFrame([("k", None, "n"), ("k", 2, "b"), ("j", None, "x")], "k string, o int, v string")
    out = rows(ops.dedup_keep_first(df, ["k"], ["o"]), "k")
    assert out == [("j", None, "x"), ("k", 2, "b")]


def test_group_row_ranges_distributed_path(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3)], "g string, y int")
    out = rows(ops.group_row_ranges(df, "g", partitions=3), "g")
    assert out == [("a", 1, 2), ("b", 3, 3), ("c", 4, 6)]


def test_hot_key_third_of_rows(spark):
    """One key holding a third of the rows: results stay exact (no capping,
    sampling or dropping)."""
    n = 9000
    data = [("HOT" if i % 3 == 0 else f"k{i % 500}", i, float(i % 17)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, o long, v double").repartition(7)
    first = {r.k: r.o for r in ops.dedup_keep_first(df, ["k"], ["o"]).collect()}
    assert first["HOT"] == 0 and len(first) == 501
    cnt = ops.count_per_key(df, ["k"]).filter(F.col("k") == "HOT").select("n").distinct().collect()
    assert [r.n for r in cnt] == [n // 3]
    roll = {r.k: r.v for r in ops.rollup(df, ["k"], sums=["v"]).collect()}
    assert roll["HOT"] == sum(float(i % 17) for i in range(0, n, 3))
    from paneltide.operators.prefix import prefix_sum
    ps = prefix_sum(df, ["o"], "v", partitions=5).filter(F.col("o") == n - 1).first()
    assert ps.idx == n and ps.cumsum == sum(float(i % 17) for i in range(n))


def test_natural_join_requires_common_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1,)], "y int")
    with pytest.raises(ValueError):
        natural_join(a, b)


def test_pivot_wide_count_mode(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y")], "id string, k string")
    out = rows(pivot_wide(df, ["id"], "k", ["x", "y", "z"], name=str), "id")
    assert out == [("a", 2, 1, None), ("b", None, 1, None)]


def test_interpolate_several_columns(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 10.0), ("a", 2, None, None), ("a", 4, 7.0, None), ("a", 5, None, 40.0)],
                               "c string, y int, u double, v double")
    out = {r.y: (r.u, r.v) for r in ops.interpolate_linear(df, "c", "y", ["u", "v"]).collect()}
    assert out[2][0] == pytest.approx(3.0) and out[2][1] == pytest.approx(17.5)
    assert out[5][0] is None and out[4][1] == pytest.approx(32.5)


def test_scalar_struct_subquery(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 30.0)], "k int, v double")
    s = scalar(df.select(F.struct(F.max("v").alias("hi"), F.min("v").alias("lo"))))
    out = df.select((F.col("v") - s["lo"]) / (s["hi"] - s["lo"])).collect()
    assert sorted(r[0] for r in out) == [0.0, 1.0]


def test_with_post_flag(spark):
    from paneltide.plans.panel import with_post
    df = spark.createDataFrame([(1997,), (1998,), (None,)], "year int")
    assert sorted((r.year or 0, r.post) for r in with_post(df).collect()) == [(0, 0), (1997, 0), (1998, 1)]
