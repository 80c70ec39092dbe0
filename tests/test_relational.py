import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, relational, stats


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_not_in_follows_null_logic(spark, rows):
    probe = frame(spark, [(1,), (2,), (None,)], "k int")
    assert rows(relational.not_in(probe, frame(spark, [(2,)], "k int"), "k")) == [(1,)]
    assert rows(relational.not_in(probe, frame(spark, [(2,), (None,)], "k int"), "k")) == []
    assert rows(relational.not_in(probe, frame(spark, [], "k int"), "k")) == [(None,), (1,), (2,)]
    assert rows(relational.anti(probe, frame(spark, [(2,), (None,)], "k int"), ["k"])) == [(None,), (1,)]


OFFERS = [("s1", "pc"), ("s1", "pc"), ("s1", "orange"), ("s2", "pc"), ("s3", "orange"), ("s3", "milk")]


def test_offering_all_and_only(spark, rows):
    offers = frame(spark, OFFERS, "s string, p string")
    assert rows(relational.offering_all(offers, ["s"], "p", ["pc", "orange"])) == [("s1",)]
    assert rows(relational.only(offers, ["s"], "p", ["pc"])) == [("s2",)]


def test_division_counts_distinct_members(spark, rows):
    asked = frame(spark, [("milk", "c1"), ("milk", "c1"), ("milk", "c2"), ("tv", "c1"), ("tv", "c1")], "p string, c string")
    everyone = frame(spark, [("c1",), ("c2",)], "c string")
    assert rows(relational.divides(asked, ["p"], "c", everyone)) == [("milk",)]
    assert rows(relational.divides(asked, ["p"], "c", everyone, exclude=["c2"])) == [("milk",), ("tv",)]


def test_matching_or_and_flag(spark, rows):
    s = frame(spark, [(1, "x"), (2, "y"), (3, "y")], "id int, city string")
    hit = frame(spark, [(3,), (3,)], "id int")
    assert rows(relational.matching_or(s, F.col("city") == "x", hit, ["id"]), "id") == [(1,), (3,)]
    assert rows(relational.membership_flag(s, hit, ["id"], "in"), "id", "in") == [(1, 0), (2, 0), (3, 1)]


def test_largest_per_key_keeps_ties(spark, rows):
    offers = frame(spark, [("p", "a", 5), ("p", "b", 5), ("p", "c", 1), ("q", "a", 2)], "p string, s string, n int")
    assert rows(relational.largest_per_key(offers, ["p"], "n"), "p", "s") == [("p", "a"), ("p", "b"), ("q", "a")]


def test_lookup_falls_back_and_drops(spark, rows):
    names = frame(spark, [("alpha", "A"), ("beta", "B"), ("beta", "B")], "name string, label string")
    ids = frame(spark, [("7", "beta"), ("8", "unknown")], "id string, name string")
    df = frame(spark, [(1, "alpha", "7"), (2, "zzz", "7"), (3, "zzz", "8"), (4, None, None)], "n int, prov string, place string")
    got = relational.lookup_fallback(df, "prov", "place", names, ids, "out")
    assert rows(got, "n", "out") == [(1, "A"), (2, "B")]
    kept = relational.lookup_fallback(df, "prov", "place", names, ids, "out", drop_unresolved=False)
    assert rows(kept, "n", "out") == [(1, "A"), (2, "B"), (3, None), (4, None)]


def test_code_labels_never_multiply_rows(spark, rows):
    table = frame(spark, [("1", "Car"), ("1", "Car"), ("1", None), ("2", None)], "code string, label string")
    df = frame(spark, [("1",), ("2",), ("9",)], "c string")
    assert rows(relational.code_labels(df, "c", table, "code", "label", "d", "Other"), "c", "d") == [("1", "Car"), ("2", "Other"), ("9", "Other")]
    with pytest.raises(Exception, match="several values of label"):
        relational.code_labels(df, "c", table.union(frame(spark, [("1", "Cart")], "code string, label string")), "code", "label", "d", "Other").collect()


def test_one_sided_counts(spark, rows):
    s = frame(spark, [(1, "x"), (2, "x"), (3, "only s")], "sid int, place string")
    c = frame(spark, [(1, "x"), (2, "only c")], "cid int, place string")
    assert rows(relational.one_sided_counts(s, c, ["place"], "sid", "cid", ("s", "c"))) == [("only c", 0, 1), ("only s", 1, 0), ("x", 2, 1)]


def test_match_periods_suffixes_and_rules(spark, rows):
    a = frame(spark, [("ann", 30, 100.0), ("bob", 40, 90.0), ("bob", 20, 95.0)], "name string, age int, t double")
    b = frame(spark, [("ann", 31, 99.0), ("bob", 50, 80.0)], "name string, age int, t double")
    got = relational.match_periods(a, b, ["name"], ("_20", "_21"), {"age": (F.col("age_21") - F.col("age_20")).between(0, 7)})
    assert rows(got, "name", "age_20", "t_21") == [("ann", 30, 99.0)]
    assert relational.match_periods(a, b, ["name"], ("_20", "_21")).count() == 3


def test_rate_pivot_and_share(spark, rows):
    df = frame(spark, [("a", "yes"), ("a", "no"), ("a", None), ("b", None)], "g string, s string")
    assert rows(aggregates.rate(df, ["g"], "s", "yes")) == [("a", 1, 2, 0.5), ("b", 0, 0, None)]
    assert rows(aggregates.pivot_counts(df, ["g"], "s", ["yes", "no", "maybe"])) == [("a", 1, 1, 0), ("b", 0, 0, 0)]
    assert rows(aggregates.row_share(df, ["g"], "s"), "g", "s", "share") == [("a", None, 1 / 3), ("a", "no", 1 / 3), ("a", "yes", 1 / 3), ("b", None, 1.0)]
    assert aggregates.no_information_rate(df, "s").first()[0] == 0.5


def test_period_change_without_base_is_null(spark, rows):
    df = frame(spark, [("x", 1), ("x", 2), ("x", 2), ("y", 2)], "p string, y int")
    assert rows(aggregates.period_change(df, ["p"], "y", 1, 2)) == [("x", 1, 2, 1, 100.0), ("y", 0, 1, 1, None)]


def test_top_groups_break_ties_by_key(spark):
    df = frame(spark, [("b",), ("b",), ("a",), ("a",), ("c",)], "g string")
    assert [tuple(r) for r in relational.top_groups(df, ["g"], 2).collect()] == [("a", 2), ("b", 2)]


def test_box_summary(spark):
    df = frame(spark, [("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, v double")
    r = aggregates.box_summary(df, ["g"], "v").first()
    assert (r.q1, r.median, r.q3, r.low_whisker, r.high_whisker, r.outliers) == (2.25, 3.5, 4.75, 1.0, 5.0, 1)


def test_modes_ignore_blanks_and_break_ties_low(spark, rows):
    df = frame(spark, [("b", ""), ("a", ""), ("b", "x"), ("a", None), ("", None)], "u string, w string")
    assert rows(aggregates.modes(df, ["u", "w"])) == [("u", "a", 2), ("w", "x", 1)]


def test_ols_equals_the_closed_form(spark):
    numpy = pytest.importorskip("numpy")
    draw = numpy.random.default_rng(5)
    n = 60
    x, group = draw.normal(size=n), numpy.array(["m", "f", "z"])[draw.integers(0, 3, n)]
    y = 10 + 2 * x + (group == "f") * 3 - (group == "z") * 1.5 * x + draw.normal(size=n) * 0.1
    df = frame(spark, [(float(a), str(g), float(b)) for a, g, b in zip(x, group, y)], "x double, g string, y double")
    fit = stats.ols(df, "y", ["x"], {"g": "m"}, [("g", "x")])
    design = numpy.column_stack([x, group == "f", group == "z", (group == "f") * x, (group == "z") * x, numpy.ones(n)]).astype(float)
    beta, rss, *_ = numpy.linalg.lstsq(design, y, rcond=None)
    got = fit.coefficients.collect()
    assert [r.term for r in got] == ["x", "g=f", "g=z", "g=f:x", "g=z:x", "(intercept)"]
    assert [r.estimate for r in got] == pytest.approx(list(beta), rel=1e-6)
    sigma = rss[0] / (n - 6)
    errors = numpy.sqrt(sigma * numpy.diag(numpy.linalg.inv(design.T @ design)))
    assert [r.std_error for r in got] == pytest.approx(list(errors), rel=1e-6)
    assert all(r.low < r.estimate < r.high for r in got)
    q = fit.quality.first()
    assert q.aic == pytest.approx(n * numpy.log(rss[0] / n) + 2 * 6, rel=1e-6)
    assert q.rmse == pytest.approx((rss[0] / n) ** 0.5, rel=1e-6)


def test_many_formulas_from_one_aggregate_with_missing_values_and_many_levels(spark):
    numpy = pytest.importorskip("numpy")
    draw = numpy.random.default_rng(8)
    n = 4000
    a, b = draw.normal(1e4, 3, n), draw.normal(size=n)
    g, h = draw.integers(0, 1100, n), draw.integers(0, 3, n)
    y = 5 + 0.3 * a - 2 * b + 0.01 * g + (h == 1) * b + draw.normal(size=n)
    gap = draw.random(n) < 0.05
    data = [(float(y[i]), None if gap[i] else float(a[i]), float("nan") if i % 97 == 0 else float(b[i]), f"g{g[i]:04}", f"h{h[i]}") for i in range(n)]
    df = frame(spark, data, "y double, a double, b double, g string, h string")
    formulas = {
        "a": stats.Formula(("a",)), "b": stats.Formula(("b",), {"h": None}), "both": stats.Formula(("a", "b"), {"h": "h1"}, (("h", "b"), ("a", "b"))),
        "levels": stats.Formula(("b",), {"g": None}), "same twice": stats.Formula(("b",), {"h": None}, (("b", "b"),)), "none": stats.Formula(),
    }
    found = {r.model: r for r in stats.ols_table(df, "y", formulas).collect()}
    ok_b = numpy.arange(n) % 97 != 0
    dummies = lambda v, base: [(v == k).astype(float) for k in sorted(set(v)) if k != base]

    def check(name, rows, *columns):
        design = numpy.column_stack([numpy.ones(rows.sum()), *[c[rows] for c in columns]])
        beta = numpy.linalg.lstsq(design, y[rows], rcond=None)[0]
        rest = ((y[rows] - design @ beta) ** 2).sum()
        r = found[name]
        assert (r.n, r.parameters) == (rows.sum(), design.shape[1])
        assert r.rmse == pytest.approx((rest / r.n) ** 0.5, rel=1e-6) and r.aic == pytest.approx(r.n * numpy.log(rest / r.n) + 2 * r.parameters, rel=1e-6)
        assert r.r2 == pytest.approx(1 - rest / ((y[rows] - y[rows].mean()) ** 2).sum(), abs=1e-7)

    check("a", ~gap, a)
    check("b", ok_b, b, *dummies(h, 0))
    check("both", ~gap & ok_b, a, b, *dummies(h, 1), (h == 0) * b, (h == 2) * b, a * b)
    check("levels", ok_b, b, *[(g == k).astype(float) for k in sorted(set(g[ok_b]))[1:]])
    assert found["levels"].parameters > 1000
    check("same twice", ok_b, b, *dummies(h, 0), b * b)
    assert found["none"].parameters == 1 and found["none"].rmse == pytest.approx(y.std())


def test_a_term_that_others_make_up_has_no_estimate(spark):
    df = frame(spark, [(float(i), float(i), 2.0 * i, 1.0 + i + (i % 3)) for i in range(30)], "k double, a double, b double, y double")
    fit = stats.ols(df, "y", ["a", "b"])
    assert {r.term: r.estimate is None for r in fit.coefficients.collect()} == {"a": False, "b": True, "(intercept)": False}
    assert fit.quality.first().parameters == 2


def test_fitted_values_and_one_scan(spark):
    df = frame(spark, [(float(i), "uv"[i % 2], 3.0 + i * (1 + i % 2)) for i in range(40)] + [(None, "u", 1.0)], "x double, g string, y double")
    fit = stats.ols(df, "y", ["x"], {"g": None}, [("g", "x")])
    assert fit.fitted.count() == 40 and stats.fit_errors(fit.fitted, "y", "fitted").first().rmse == pytest.approx(0, abs=1e-9)
    by_numbers = stats.ols(df.withColumn("z", F.col("x") * F.col("x")), "y", ["x", "z"], {}, [("x", "z")])
    assert [r.term for r in by_numbers.coefficients.collect()] == ["x", "z", "x:z", "(intercept)"]
    assert stats.ols(df.limit(0), "y", ["x"]).quality.first().n == 0


def test_star_joins_every_dimension(spark, rows):
    fact = frame(spark, [(1, 7, 2), (1, 8, 3), (9, 7, 4)], "s int, p int, q int")
    sellers, goods = frame(spark, [(1, "ann")], "s int, seller string"), frame(spark, [(7, "milk"), (8, "tv")], "p int, item string")
    assert rows(relational.star(fact, [(sellers, "s"), (goods, "p")]), "seller", "item", "q") == [("ann", "milk", 2), ("ann", "tv", 3)]
    assert relational.star(fact, [(sellers, "s")], "left").count() == 3


def test_division_ignores_items_outside_the_universe(spark, rows):
    have = spark.createDataFrame([("a", i) for i in "xyz"] + [("b", i) for i in "xzq"] + [("c", "q")], "e string, i string")
    universe = spark.createDataFrame([(i,) for i in "xyzx"], "i string")
    assert rows(relational.divides(have, ["e"], "i", universe)) == [("a",)]
    assert rows(relational.divides(have, ["e"], "i", universe, exclude=["y"])) == [("a",), ("b",)]


def test_a_task_of_the_triplets_keeps_its_share_when_the_table_grows(spark, monkeypatch):
    from tallyloom.plans import trade

    folder = "/root/testdata/sf0.001"
    plain = sorted(map(tuple, trade.tx_by_triplet(spark, folder).collect()))
    months = [tuple(r) for r in trade.monthly_sales(spark, folder).collect()]
    monkeypatch.setattr(trade, "ROWS_A_PARTITION", 100)  # as on a table so many times as large
    many = trade.tx_by_triplet(spark, folder)
    wanted = -(-trade.lines(spark, folder).count() // 100)
    assert many.rdd.getNumPartitions() == wanted > 4 and sorted(map(tuple, many.collect())) == plain
    assert [tuple(r) for r in trade.monthly_sales(spark, folder).collect()] == months
