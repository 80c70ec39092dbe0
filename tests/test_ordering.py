import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ordering, stats


def skewed(spark, n=4000, seed=1):
    draw = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if draw.random() < 0.8 else draw.choice(["a", "b", "one"])
        data.append((i, group, round(draw.lognormvariate(3, 2), draw.choice([0, 2]))))
    data += [(n, "single", 5.0), (n + 1, "nulls", None), (n + 2, "twins", 1.0), (n + 3, "twins", 1.0)]
    return spark.createDataFrame(data, "id long, g string, v double")


@pytest.mark.parametrize("slots", [1, 7, 2048])
def test_quantiles_equal_the_builtin(spark, slots):
    df = skewed(spark)
    probs = {"q05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "top": 1.0}
    ours = {r["g"]: r for r in ordering.exact_quantiles(df, ["g"], "v", probs, mean="mean", slots=slots).collect()}
    theirs = df.groupBy("g").agg(F.avg("v").alias("mean"), *[F.percentile("v", p).alias(n) for n, p in probs.items()]).where("mean is not null")
    for r in theirs.collect():
        for name in ("mean", *probs):
            assert ours[r["g"]][name] == pytest.approx(r[name], rel=1e-12), (r["g"], name)
    assert set(ours) == {"hot", "a", "b", "one", "single", "twins"}


def test_quantiles_of_the_whole_table(spark):
    df = skewed(spark)
    ours = ordering.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert ours == pytest.approx(df.agg(F.percentile("v", 0.5)).first()[0], rel=1e-12)


def test_running_before(spark):
    df = skewed(spark).where("v is not null").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in ordering.running_before(df, ["g"], "v", ["n"], 13).collect()}
    data = [tuple(r) for r in df.collect()]
    for g, v, n in data:
        assert got[(g, v)] == (sum(c for a, b, c in data if a == g and b < v), sum(c for a, b, c in data if a == g))


def test_cut_points_are_found_once(spark):
    value = F.pow(F.lit(10.0), F.rand(3) * 4 + 1).cast("long")
    group = F.when(F.col("id") % 10 < 6, "en").otherwise(F.concat(F.lit("l"), (F.col("id") % 3).cast("string")))
    df = spark.range(300_000, numPartitions=24).select(group.alias("g"), value.alias("v"))
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = ordering.exact_quantiles(df, ["g"], "v", probs)
    ours = {r.g: (r.q1, r.median, r.q3) for r in found.collect()}
    theirs = {r.g: (r.q1, r.median, r.q3) for r in df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).collect()}
    assert ours == theirs
    assert "percentile_approx" not in found._jdf.queryExecution().optimizedPlan().toString()
    whole = ordering.exact_quantiles(df, [], "v", probs)
    assert "percentile_approx" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_numbered_is_a_permutation_and_repeats_itself(spark):
    df = skewed(spark)
    first = {r.id: (r.g, r.rn, r.group_rows) for r in ordering.numbered(df, ["g"], ["id"], slots=5).collect()}
    again = {r.id: (r.g, r.rn, r.group_rows) for r in ordering.numbered(df.repartition(3), ["g"], ["id"], slots=5).collect()}
    assert first == again
    by_group = {}
    for g, rn, size in first.values():
        by_group.setdefault((g, size), []).append(rn)
    for (_, size), numbers in by_group.items():
        assert sorted(numbers) == list(range(1, size + 1))


@pytest.mark.parametrize("slots", [1, 5, 65536])
def test_first_rows_are_those_of_the_numbering_and_only_one_slot_is_shuffled(spark, slots):
    df = skewed(spark).union(spark.createDataFrame([(90_000 + i, None, float(i)) for i in range(7)], "id long, g string, v double"))
    for share in (0.0, 0.13, 0.5, 1.0):
        want = ordering.numbered(df, ["g"], ["id"], slots=slots).where(F.col("rn") <= F.round(F.col("group_rows") * share)).where("g IS NOT NULL")
        found = ordering.first_of_each(df, ["g"], ["id"], F.round(F.col("_rows") * share), slots=slots)
        assert sorted(r.id for r in found.where("g IS NOT NULL").collect()) == sorted(r.id for r in want.collect())
        assert found.where("g IS NULL").count() == round(7 * share + 1e-9) and found.columns == df.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Join" not in plan


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    pairs = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.3), (1, 0.3), (0, 0.3), (0, 0.1), (1, 0.5)]
    df = spark.createDataFrame(pairs, "y int, s double")
    assert stats.auc(df, "y", "s").first()[0] == pytest.approx(brute_auc(pairs))
    # a monotone change of the scores changes nothing
    assert stats.auc(df.withColumn("s", F.exp("s") * 3), "y", "s", slots=3).first()[0] == pytest.approx(brute_auc(pairs))


def test_auc_random(spark):
    draw = random.Random(3)
    pairs = [(int(draw.random() < 0.3), round(draw.gauss(0, 1), 1)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "y int, s double")
    assert stats.auc(df, "y", "s", slots=11).first()[0] == pytest.approx(brute_auc(pairs))


def test_auc_of_one_class_is_null(spark):
    assert stats.auc(spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double"), "y", "s").first()[0] is None


DRAW = random.Random(8)


@pytest.mark.parametrize("values", [
    [i / 1e6 for i in range(20_000)] + [1e9],
    [i / 1e6 for i in range(20_000)] + [float("inf"), float("-inf")],
    [0.5 + i / 1e9 for i in range(20_000)] + [0.0, 1.0],
    [DRAW.lognormvariate(0, 6) for _ in range(20_000)],
    [10 ** DRAW.uniform(-15, 15) for _ in range(20_000)],
    [-(10 ** DRAW.uniform(-300, 300)) for _ in range(20_000)],
])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_slots_are_about_equally_deep_whatever_the_spread(spark, values, by):
    df = spark.createDataFrame([("a", v) for v in set(values)], "g string, v double")
    placed = ordering.value_slots(df.withColumn("n", F.lit(1)), by, "v", ["n"], 512)
    sizes = placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.avg("n"), F.count(F.lit(1))).first()
    assert sizes[0] <= 2 * sizes[1] and sizes[2] > 400
    edges = placed.groupBy("_slot").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_slot").collect()
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))  # slots are in the order of their values
    found = ordering.exact_quantiles(df, by, "v", {"m": 0.5}, slots=512).first()["m"]
    ordered = sorted(set(values))
    middle = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
    assert found == pytest.approx(middle, rel=1e-12)


def test_small_groups_stay_whole_and_large_ones_are_cut(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 29_000, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 300)).alias("g"), F.col("id").cast("double").alias("v"))
    placed = ordering.value_slots(df.withColumn("n", F.lit(1)), ["g"], "v", ["n"], 256)
    slots = {r.g: r.n for r in placed.groupBy("g").agg(F.countDistinct("_slot").alias("n")).collect()}
    assert slots.pop("big") > 200 and set(slots.values()) == {1}


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert ordering.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.0


def test_numbering_splits_a_group_although_the_input_is_partitioned_by_it(spark):
    df = spark.range(2000).select("id", F.lit("one").alias("g")).repartition(4, "g")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ordering.numbered(df, ["g"], ["id"]).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1
