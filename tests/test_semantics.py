"""Hand-worked fixtures for the decisions S1–S16 (see SURVEY §1.4)."""

import math

import pytest
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.operators import align, clean, distribution, encode, evaluate, ordered, profile


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_s3_cast_null_text(spark):
    df = spark.createDataFrame([(12.0,), (None,)], "lot_main double")
    out = clean.cast_columns(df, {"lot_main": "string"}, null_text="nan")
    assert sorted(r[0] for r in out.collect()) == ["12.0", "nan"]
    out2 = clean.fill_constant(clean.cast_columns(df, {"lot_main": "string"}), ["lot_main"], "NULL")
    assert sorted(r[0] for r in out2.collect()) == ["12.0", "NULL"]


@pytest.mark.parametrize("n_blocks", [1, 2, 3, 7])
def test_s4_interpolation_edges(spark, n_blocks):
    data = [  # grp, ord, v
        ("a", 0, None), ("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 4.0),
        ("a", 5, None), ("a", 6, None),
        ("b", 0, None), ("b", 1, None),           # all null
        ("c", 0, 5.0), ("c", 1, None),            # one value, trailing
        ("d", 0, None), ("d", 1, 2.0), ("d", 2, None), ("d", 3, None), ("d", 4, None),
        ("d", 5, None), ("d", 6, None), ("d", 7, 9.0),
    ]
    df = spark.createDataFrame(data, "grp string, ord bigint, v double")
    out = ordered.interpolate_linear(df, ["v"], ["ord"], ["grp"], n_blocks=n_blocks)
    got = {(g, o): v for g, o, v in rows(out, "grp", "ord", "v")}
    assert got[("a", 0)] is None
    assert got[("a", 2)] == pytest.approx(2.0) and got[("a", 3)] == pytest.approx(3.0)
    assert got[("a", 5)] == 4.0 and got[("a", 6)] == 4.0
    assert got[("b", 0)] is None and got[("b", 1)] is None
    assert got[("c", 1)] == 5.0
    assert [got[("d", i)] for i in range(2, 7)] == pytest.approx([2.0 + 7.0 / 6.0 * k for k in range(1, 6)])


def test_s4_global_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    v = rng.normal(size=500)
    v[rng.random(500) < 0.4] = np.nan
    v[:3] = np.nan
    v[-5:] = np.nan
    pdf = pd.DataFrame({"ord": np.arange(500), "v": v})
    exp = pdf["v"].interpolate(method="linear").to_numpy()
    df = spark.createDataFrame(pdf)
    for nb in (1, 4, 9):
        got = ordered.interpolate_linear(df, ["v"], ["ord"], n_blocks=nb).toPandas()
        got = got.sort_values("ord")["v"].to_numpy()
        same = (got == exp) | (np.isnan(got) & np.isnan(exp))
        assert same.all(), nb


def test_s4_string_order_fallback(spark):
    df = spark.createDataFrame([("k%03d" % i, float(i) if i % 3 else None) for i in range(40)],
                               "k string, v double")
    out = ordered.interpolate_linear(df, ["v"], ["k"], n_blocks=4)
    got = dict(rows(out, "k", "v"))
    assert got["k000"] is None
    assert got["k003"] == pytest.approx(3.0) and got["k039"] == 38.0  # trailing null repeats


def test_s6_quantiles_methods_agree(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9, 2, 8, 8, 8, 0.5]], "x double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    a = ordered.quantiles(df, "x", probs, method="rank").first()
    b = ordered.quantiles(df, "x", probs, method="percentile").first()
    c = ordered.quantiles(df, "x", probs, method="select").first()
    assert list(a) == list(b) == list(c)


def test_select_quantiles_hot_value_ties_and_groups(spark):
    # one value holds a third of all rows, infinities at both ends, a null group
    vals = [("a", 7.0)] * 300 + [("a", float(i)) for i in range(600)] + \
           [("a", float("inf")), ("a", float("-inf"))] + \
           [(None, float(i % 13)) for i in range(91)] + [("b", 1.5)]
    df = spark.createDataFrame(vals, "g string, x double")
    probs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]
    key = lambda r: (r["g"] is None, r["g"] or "")
    ref = sorted(ordered.quantiles(df, "x", probs, "g", method="percentile").collect(), key=key)
    for n_blocks in (1, 3, 40):
        got = ordered._select_quantiles(
            df.select("g", F.col("x").alias("_x")), ["g"], probs,
            [f"q{i}" for i in range(len(probs))], n_blocks)
        assert [list(r) for r in sorted(got.collect(), key=key)] == [list(r) for r in ref]
    ung = ordered.quantiles(df, "x", probs, method="select").first()
    assert list(ung) == list(ordered.quantiles(df, "x", probs, method="percentile").first())


def test_s7_iqr_train_only_inclusive(spark):
    vals = [(0, float(x)) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(1, 1000.0), (0, None)]
    df = spark.createDataFrame(vals, "is_test int, area double")
    lo, hi = clean.iqr_bounds(df, "area", 1.5, "is_test = 0")
    assert (lo, hi) == (-3.0, 13.0)
    out = clean.trim_outliers_iqr(df, "area")
    assert sorted(rows(out, "is_test", "area")) == [(0, float(x)) for x in range(1, 9)] + [(1, 1000.0)]


def test_s8_bound_is_strict(spark):
    df = spark.createDataFrame([(0, 280.0), (0, 279.99), (0, 280.01), (0, None), (1, 500.0)],
                               "is_test int, area double")
    out = clean.trim_outliers_bound(df, "area", 280.0)
    assert sorted(rows(out, "is_test", "area")) == [(0, 279.99), (1, 500.0)]
    c = clean.bound_counts(df, "area", 280.0).first()
    assert (c["above_all"], c["at_or_above_all"], c["above_only"], c["removed"]) == (2, 3, 1, 3)


def test_s9_round_half_even(spark):
    df = spark.createDataFrame([(623.295,), (0.125,), (0.135,), (2.5,)], "x double")
    got = [r[0] for r in df.select(S.round_half_even("x", 2)).collect()]
    assert got == [623.29, 0.12, 0.14, 2.5]


def test_s10_truncation(spark):
    df = spark.createDataFrame([(-1.9,), (1.9,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(S.truncate_int("x")).collect()] == [-1, 1, 0]


def test_s11_three_counting_rules(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "y"), ("b", "x"), ("b", None)],
                               "k string, v string")
    vc = rows(profile.value_counts(df, "k"), "k", "count")
    assert vc == [("a", 2), ("b", 2)]
    ds = dict(rows(profile.distinct_size(df, ["k", "v"]), "column", "n_distinct"))
    assert ds == {"k": 3, "v": 3}
    amb = rows(profile.ambiguous_keys(df, "k", "v"), "k", "n_distinct")
    assert amb == [("a", 2)]


def test_s12_concat_null(spark):
    df = spark.createDataFrame([("seoul ", "658-1"), ("busan ", None)], "region string, lot string")
    got = rows(df.select(S.concat_key(["region", "lot"]).alias("a"),
                         S.concat_key(["region", "lot"], null_as="").alias("b")), "a", "b")
    assert got == [("seoul 658-1", "seoul 658-1"), (None, "busan ")]


def test_s13_threshold_flag_null(spark):
    df = spark.createDataFrame([(2008,), (2009,), (2010,), (None,)], "y int")
    assert [r[0] for r in df.select(S.threshold_flag("y", 2009)).collect()] == [0, 1, 1, 0]


def test_s14_label_codes_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("강남구",), ("a",), (None,)], "c string")
    test = spark.createDataFrame([("z",), ("c",), ("a",), ("c",)], "c string")
    m = encode.label_fit(train, ["c"])
    assert rows(m.orderBy("code"), "value", "code") == [("a", 0), ("b", 1), ("강남구", 2)]
    m2 = encode.label_extend(m, test, ["c"])
    assert rows(m2.orderBy("code"), "value", "code")[3:] == [("c", 3), ("z", 4)]
    coded = encode.label_transform(test, m2, ["c"])
    assert sorted(r[0] for r in coded.collect()) == [0, 3, 3, 4]
    back = encode.label_inverse(coded, m2, ["c"])
    assert sorted(r[0] for r in back.collect()) == ["a", "c", "c", "z"]


def test_s14_numeric_codes_sort_numerically(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "n int")
    m = encode.label_fit(df, ["n"], as_text=False)
    assert rows(m.orderBy("code"), "value", "code") == [("9", 0), ("10", 1), ("100", 2)]
    m = encode.label_fit(df, ["n"])     # the reference fits on text
    assert rows(m.orderBy("code"), "value", "code") == [("10", 0), ("100", 1), ("9", 2)]


def test_s15_one_hot_names(spark):
    df = spark.createDataFrame([(1, "winter"), (2, "autumn"), (3, None), (4, "spring")],
                               "id int, season string")
    out = encode.one_hot(df, ["season"])
    assert out.columns == ["id", "season_autumn", "season_spring", "season_winter"]
    dropped = encode.one_hot(df, ["season"], drop_first=True)
    assert dropped.columns == ["id", "season_spring", "season_winter"]
    sums = [sum(r[1:]) for r in out.orderBy("id").collect()]
    assert sums == [1, 1, 0, 1]


def test_s16_extremes_tie_break(spark):
    df = spark.createDataFrame([(3, 1.0, 2.0), (1, 1.0, 2.0), (2, 0.0, 0.0), (0, 5.0, 1.0)],
                               "row_id bigint, label double, pred double")
    e = evaluate.with_error(df, "label", "pred")
    worst = [r["row_id"] for r in evaluate.extremes_by(e, "error", 3, "row_id").collect()]
    assert worst == [0, 1, 3]
    best = [r["row_id"] for r in evaluate.extremes_by(e, "error", 2, "row_id", largest=False).collect()]
    assert best == [2, 1]


def test_season_and_yyyymm(spark):
    df = spark.createDataFrame([(202212,), (202301,), (202304,), (202306,), (202309,)], "ym int")
    out = S.split_yyyymm(df, "ym").withColumn("s", S.season("cont_month"))
    assert rows(out, "cont_year", "cont_month", "s") == [
        (2022, 12, "winter"), (2023, 1, "winter"), (2023, 4, "spring"), (2023, 6, "summer"),
        (2023, 9, "autumn")]
    txt = S.split_yyyymm(df, "ym", as_text=True)
    assert rows(txt, "cont_month")[1] == ("01",)


def test_split_token_out_of_range(spark):
    df = spark.createDataFrame([("서울특별시  강남구 개포동",), ("two tokens",), (None,)], "p string")
    got = rows(df.select(*[S.split_token("p", i).alias(f"t{i}") for i in range(3)]), "t0", "t1", "t2")
    assert got == [("서울특별시", "강남구", "개포동"), ("two", "tokens", None), (None, None, None)]


def test_sentinels_blank_and_where_in(spark):
    df = spark.createDataFrame([(" ",), ("-",), ("x",), (None,), ("\t",)], "c string")
    s = clean.sentinels_to_null(df, {"c": ["-"]})
    assert sorted(r[0] or "<null>" for r in s.collect()) == ["\t", " ", "<null>", "<null>", "x"]
    b = clean.blank_to_null(df, ["c"])
    assert sorted(r[0] or "<null>" for r in b.collect()) == ["-", "<null>", "<null>", "<null>", "x"]
    inn = clean.where_in(df, "c", ["x"]).count()
    out = clean.where_in(df, "c", ["x"], negate=True).count()
    assert (inn, out) == (1, 4)


def test_drop_sparse_threshold_inclusive(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None), (3, 2, None)], "a int, b int, c int")
    kept = clean.drop_sparse_columns(df, max_nulls=1)
    assert kept.columns == ["a", "b"]


def test_tag_union_split_conform(spark):
    tr = spark.createDataFrame([(1, 10.0, "x")], "id int, target double, c string")
    te = spark.createDataFrame([(2, "y")], "id int, c string")
    u = align.tag_union({0: tr, 1: te})
    assert rows(u.orderBy("id"), "id", "target", "is_test") == [(1, 10.0, 0), (2, None, 1)]
    a, b = align.split_tagged(u, "is_test", "target", test_label=0.0)
    assert align.same_width(a, b) and rows(b, "target") == [(0.0,)]
    c = align.conform_to(b.select("id", "c"), ["id", "z", "c"])
    assert c.columns == ["id", "z", "c"] and rows(c, "z") == [(0,)]


def test_compare_predictions_null_semantics(spark):
    a = spark.createDataFrame([(0, 1), (1, 2), (2, None), (3, None), (4, 7)], "row_id bigint, target int")
    b = spark.createDataFrame([(0, 1), (1, 3), (2, 5), (3, None), (5, 9)], "row_id bigint, target int")
    s = evaluate.compare_predictions(a, b, "row_id").first().asDict()
    assert s == {"equal": 1, "different": 3, "only_a": 1, "only_b": 1}
    d = evaluate.diff_tables(a, b, "row_id", ["target"])
    assert dict(rows(d, "row_id", "target_diff"))[1] == -1


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 100]], "x double")
    from tablewright.operators import distribution as D
    h = D.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [11, 0, 0, 1]
    b = D.box_summary(df, "x").first()
    assert (b["q1"], b["median"], b["q3"]) == (2.75, 5.5, 8.25)
    assert (b["whisker_low"], b["whisker_high"], b["n_outliers"]) == (0.0, 10.0, 1)


def test_density_integrates_to_one(spark):
    import numpy as np
    from tablewright.operators import distribution as D
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=400)], "x double")
    d = D.density(df, "x", grid=200).orderBy("point").toPandas()
    area = np.trapezoid(d["density"], d["x"]) if hasattr(np, "trapezoid") else np.trapz(d["density"], d["x"])
    assert abs(area - 1.0) < 0.01
    # direct evaluation at one grid point
    x = np.array([r[0] for r in df.collect()])
    h = x.std(ddof=1) * len(x) ** -0.2
    p = d["x"][77]
    direct = np.exp(-0.5 * ((p - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
    assert d["density"][77] == pytest.approx(direct, rel=1e-12)


def _codes(m):
    out = {}
    for r in m.collect():
        out.setdefault(r["column"], {})[r["value"]] = r["code"]
    return out


def test_label_codes_as_text_and_typed(spark):
    df = spark.createDataFrame([(f"k{i % 37}", i % 11, float(i % 5) / 2) for i in range(300)],
                               "a string, b int, c double")
    text, typed = encode.label_fit(df, ["a", "b", "c"]), encode.label_fit(df, ["a", "b", "c"], as_text=False)
    for m, key in ((text, str), (typed, float)):
        got = _codes(m)
        assert got["b"] == {v: i for i, v in enumerate(sorted(map(str, range(11)), key=key))}
        assert got["c"] == {v: i for i, v in enumerate(sorted(("0.0", "0.5", "1.0", "1.5", "2.0"), key=key))}
        assert got["a"] == {v: i for i, v in enumerate(sorted(f"k{i}" for i in range(37)))}
    test = spark.createDataFrame([("zz", 99, 7.5), ("k1", 1, 0.5), ("aa", -1, 9.0)], "a string, b int, c double")
    for m, as_text in ((text, True), (typed, False)):
        e = _codes(encode.label_extend(m, test, ["a", "b", "c"], as_text=as_text))
        assert (e["b"]["-1"], e["b"]["99"], e["a"]["aa"], e["a"]["zz"], e["c"]["7.5"]) == (11, 12, 37, 38, 5)
        assert _codes(encode.label_extend(m, test, as_text=as_text)) == e


def test_typed_codes_of_nan_large_and_decimal_values(spark):
    from decimal import Decimal
    big = [10 ** 16, 10 ** 16 - 1, -(2 ** 53) - 1, -(2 ** 53), 2 ** 53 + 1, 2 ** 53]
    dec = [Decimal("10000000000000000.5"), Decimal("9999999999999999.5"), Decimal("-1.0"), Decimal("0.5"), Decimal("2"), Decimal("3")]
    num = [3.0, float("nan"), 1.0, 2.0, 0.5, 10.0]
    df = spark.createDataFrame(list(zip(big, dec, num)), "b bigint, d decimal(20,1), x double")
    got = _codes(encode.label_fit(df, ["b", "d", "x"], as_text=False))
    assert got["b"] == {str(v): i for i, v in enumerate(sorted(big))}
    assert got["d"] == {f"{v:.1f}": i for i, v in enumerate(sorted(dec))}
    assert got["x"] == {"0.5": 0, "1.0": 1, "2.0": 2, "3.0": 3, "10.0": 4, "NaN": 5}


def test_missing_values_have_one_rule(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0), (2, nan), (3, None), (4, 5.0)], "id int, x double")
    flags = df.select("id", S.threshold_flag("x", 0).alias("f")).collect()
    assert {r["id"]: r["f"] for r in flags} == {1: 1, 2: 0, 3: 0, 4: 1}
    assert {r["x"]: r["count"] for r in profile.value_counts(df, "x").collect()} == {1.0: 1, 5.0: 1}
    assert profile.distinct_size(df, ["x"]).first()["n_distinct"] == 3
    assert tuple(profile.compare_means({"t": df}, "x").first()) == ("t", 3.0, 2)
    b = clean.bound_counts(df.withColumn("is_test", F.lit(0)), "x", 4.0).first()
    assert (b["above_all"], b["at_or_above_all"], b["removed"]) == (1, 1, 3)
    assert [r["id"] for r in evaluate.extremes_by(df, "x", 2, "id").collect()] == [4, 1]
    assert [r["id"] for r in evaluate.extremes_by(df, "x", 2, "id", largest=False).collect()] == [1, 4]
    c = evaluate.compare_predictions(df, df, "id", "x").first()
    assert (c["equal"], c["different"]) == (2, 2)


def test_white_space_of_any_script(spark):
    rows = [("\tfoo bar",), ("a\u3000b  c",), ("",), ("\u3000 \x1c",), (None,), ("one",)]
    df = spark.createDataFrame(rows, "s string")
    got = df.select(*[S.split_token("s", i) for i in range(3)]).collect()
    assert [tuple(r) for r in got] == [("foo", "bar", None), ("a", "b", "c"), (None,) * 3, (None,) * 3, (None,) * 3, ("one", None, None)]
    assert [tuple((r[0] or "").split()[:1]) == tuple(x for x in g[:1] if x) for r, g in zip(rows, got)] == [True] * 6
    assert [r[0] for r in clean.blank_to_null(df, ["s"]).collect()] == ["\tfoo bar", "a\u3000b  c", None, None, None, "one"]


def test_density_has_every_group(spark):
    rows = [(1, 1.0), (1, 2.0), (1, 4.0), (2, 7.0), (2, 7.0), (3, 5.0), (None, 1.0), (None, 3.0), (4, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    d = distribution.density(df, "x", grid=11, group="g")
    assert d.dtypes[0] == ("g", "int")
    by = {}
    for r in d.collect():
        by.setdefault(r["g"], []).append(r)
    assert {g: len(v) for g, v in by.items()} == {1: 11, 2: 11, 3: 11, None: 11}
    assert all(r["density"] > 0 for g in (1, None) for r in by[g])
    assert {(r["x"], r["density"]) for r in by[2]} == {(7.0, None)} and {(r["x"], r["density"]) for r in by[3]} == {(5.0, None)}


def test_empty_inputs_keep_their_schema(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "g int, x double")
    for f in (lambda t: distribution.histogram(t, "x", 4, "g"), lambda t: distribution.density(t, "x", 5, group="g")):
        empty = f(df.limit(0))
        assert empty.dtypes == f(df).dtypes and empty.collect() == []


def test_sample_has_no_lattice(spark):
    ids = sorted(r[0] for r in distribution.sample_n(spark.range(10_000), 1000, 42, "id").collect())
    assert len({b - a for a, b in zip(ids, ids[1:])}) > 20


def test_one_hot_names_with_dots(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, None)], "id int, x double")
    out = encode.one_hot(df, ["x"])
    assert out.columns == ["id", "x_0.5", "x_1.0"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    from tablewright.operators import align
    assert align.conform_to(out, ["x_1.0", "new"]).columns == ["x_1.0", "new"]


def test_sorted_rank(spark):
    df = spark.range(500).select(((F.col("id") * 7) % 500).alias("v"), F.lit("x").alias("c")).repartition(7)
    got = ordered.sorted_rank(df, ["c", "v"]).collect()
    assert all(r["rank"] == r["v"] for r in got) and len(got) == 500
    assert ordered.sorted_rank(df.limit(0), ["v"]).collect() == []


def test_quantile_methods_identical_on_data(spark):
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    r = {m: ordered.quantiles(li, "l_extendedprice", probs, "l_returnflag", method=m)
              .orderBy("l_returnflag").collect() for m in ("rank", "percentile", "select", "auto")}
    assert r["rank"] == r["percentile"] == r["select"] == r["auto"]


def test_describe_grouped_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, x double")
    out = {r["g"]: r for r in profile.describe(df, "x", [0.5], group="g").collect()}
    assert out[None]["p50"] == 2.0 and out[None]["count"] == 2 and out["a"]["p50"] == 2.0


def test_one_hot_vector_matches_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, None)], "id int, s string")
    m = encode.label_fit(df, ["s"])
    test = spark.createDataFrame([(5, "a"), (6, "zz"), (7, "c")], "id int, s string")
    for drop_first in (False, True):
        v = encode.one_hot_vector(test, m, ["s"], drop_first=drop_first)
        cols = encode.one_hot(test, ["s"], values={"s": ["a", "b", "c"]}, drop_first=drop_first)
        got = {r["id"]: list(r["s_vec"].toArray()) for r in v.collect()}
        exp = {r["id"]: [float(x) for x in r[1:]] for r in cols.collect()}
        assert got == exp


def test_rows_missing(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "id int, x double")
    assert sorted(r[0] for r in clean.rows_missing(df, "x", ["id"]).collect()) == [1, 2]
