import os
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyloom.operators import models
from tallyloom.operators.cube import CubeSpec, Dimension, StoredCube, write_cube
from tallyloom.operators.olap import Cube
from tallyloom.plans import cubes

DATA = [
    ("Fen", "Alder", "s1", "Moor", "c1", "lamp", 5), ("Fen", "Alder", "s1", "Moor", "c1", "lamp", 2), ("Fen", "Birk", "s2", "Moor", "c2", "rope", 1),
    ("Fen", None, "s3", "Fen", "c3", "rope", 4), ("Moor", "Cole", "s4", "Fen", "c3", "lamp", 7),
]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(DATA, "st string, city string, s string, cst string, c string, p string, q long")


@pytest.fixture
def spec(spark):
    return CubeSpec((("st", "city", "s"), ("cst", "c")), ("p",), {"quantity": F.sum("q"), "n": F.count(F.lit(1))})


def test_every_set_once(spec):
    sets = spec.grouping_sets()
    assert len(sets) == 4 * 3 * 2
    assert len({tuple(s) for s in sets}) == len(sets)


def test_stored_slices_equal_direct_levels(facts, spec, rows, tmp_path, spark):
    path = str(tmp_path / "cube")
    write_cube(spec.build(facts), path)
    stored = spark.read.parquet(path)
    for depths in ((0, 0), (1, 0), (2, 1), (3, 2), (0, 2)):
        for flat in ((), ("p",)):
            assert rows(spec.slice(stored, depths, flat)) == rows(spec.level(facts, depths, flat))
    chosen = F.col("st") == "Fen"
    assert rows(spec.slice(stored, (1, 0), ("p",), chosen)) == rows(spec.level(facts, (1, 0), ("p",), chosen))
    plan = spec.slice(stored, (1, 0))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level_id" in plan  # only the level's own folder is read


def test_missing_attribute_is_not_the_all_cell(facts, spec):
    cities = spec.slice(spec.build(facts), (2, 0)).where("st = 'Fen'").collect()
    assert sorted((r.city or "", r.quantity) for r in cities) == [("", 4), ("Alder", 7), ("Birk", 1)]


def test_totals_are_sums_of_parts(facts, spec):
    cube = spec.build(facts)
    whole = spec.slice(cube, (0, 0)).first().quantity
    assert whole == 19
    assert spec.slice(cube, (1, 0)).agg(F.sum("quantity")).first()[0] == whole
    assert spec.slice(cube, (3, 2), ("p",)).agg(F.sum("quantity")).first()[0] == whole


def test_olap_rows_columns_slicers_and_totals(facts, rows):
    cube = Cube(facts, {"quantity": F.sum("q"), "n": F.count(F.lit(1))})
    assert rows(cube.rows("st").result()) == [("Fen", 12, 4), ("Moor", 7, 1)]
    assert rows(cube.where(F.col("st") == "Fen").sub(F.col("cst") == "Moor").rows("p").show("quantity").result()) == [("lamp", 7), ("rope", 1)]
    assert rows(cube.rows("st").columns("p", ["lamp", "rope", "sled"]).show("quantity").result()) == [("Fen", 7, 5, 0), ("Moor", 7, 0, 0)]
    assert rows(cube.rows("st").show("quantity").with_total("st").result()) == [("All", 19), ("Fen", 12), ("Moor", 7)]


def test_pivot_of_two_measures_with_a_total(facts, rows):
    cube = Cube(facts, {"q": F.sum("q"), "n": F.count(F.lit(1))}).rows("st").columns("p", ["lamp", "ro'pe", "rope"]).with_total("st")
    found = cube.result()
    assert found.columns == ["st", "q_lamp", "q_ro'pe", "q_rope", "n_lamp", "n_ro'pe", "n_rope"]
    assert rows(found) == [("All", 14, 0, 5, 3, 0, 2), ("Fen", 7, 0, 5, 2, 0, 2), ("Moor", 7, 0, 0, 1, 0, 0)]


FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STORES = [(1, "Fen", "Alder", "a"), (2, "Fen", "Alder", "b"), (3, "Fen", None, "a"), (4, "Moor", "Alder", "a"), (5, None, None, None), (6, "Fen", "Alder", "a")]
GOODS = [(1, "lamp"), (2, "rope"), (3, "lamp"), (4, None)]


@pytest.fixture
def stored(spark, tmp_path):
    draw = random.Random(4)
    sold = [(draw.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, None]), draw.choice([1, 2, 3, 4, 9]), draw.randrange(9)) for _ in range(400)]
    facts = spark.createDataFrame(sold, "store long, good long, q int")
    stores = spark.createDataFrame(STORES, "store long, region string, town string, shop string")
    goods = spark.createDataFrame(GOODS, "good long, item string")
    dimensions = [Dimension("store", ("region", "town", "shop"), stores), Dimension("good", ("item",), goods)]
    cube = StoredCube(spark, str(tmp_path / "cube"), dimensions, {"quantity": F.col("q"), "n": F.lit(1)}).build(facts)
    named = facts.join(stores, "store").join(goods, "good")
    return cube, named


def test_stored_levels_equal_grouping_sets(stored, rows):
    cube, named = stored
    direct = CubeSpec((("region", "town", "shop"),), ("item",), {"quantity": F.sum("q"), "n": F.count(F.lit(1))})
    assert rows(cube.cells()) == rows(direct.build(named).select("region", "town", "shop", "item", F.col("level_id").cast("long"), "quantity", "n"))
    for depth in range(4):
        for flat in ((), ("item",)):
            assert rows(cube.slice((depth, len(flat)))) == rows(direct.level(named, (depth,), flat))
    chosen = (F.col("region") == "Fen") & F.col("town").isNull()
    assert rows(cube.slice((2, 1), chosen)) == rows(direct.level(named, (2,), ("item",), chosen))


def test_levels_come_from_the_smallest_finished_parent(stored):
    cube, _ = stored
    for depths in cube.sizes:
        if depths != (3, 1):
            parent = cube.parent(depths)
            finer = [one for one in cube.sizes if sum(one) == sum(depths) + 1 and all(a >= b for a, b in zip(one, depths))]
            assert parent in finer and cube.sizes[parent] == min(cube.sizes[one] for one in finer)
    assert len(cube.sizes) == 8 and cube.sizes[0, 0] == 1


def test_a_slice_reads_one_level_and_levels_shuffle_no_names(stored):
    cube, _ = stored
    read = {path.split("/cells/")[1].split("/")[0] for path in cube.slice((1, 0)).inputFiles() if "/cells/" in path}
    assert read == {f"level_id={cube.level_id((1, 0))}"}
    grouped = cube._summed(cube._cells((3, 1)), (2, 1))._jdf.queryExecution().executedPlan().toString()
    assert not any(name in grouped for name in ("region", "town", "shop", "item")) and "Expand" not in grouped


def test_an_empty_cube(spark, tmp_path):
    store = Dimension("store", ("region",), spark.createDataFrame([], "store long, region string"))
    cube = StoredCube(spark, str(tmp_path / "c"), [store], {"n": F.lit(1)}).build(spark.createDataFrame([], "store long"))
    assert cube.slice((1,)).collect() == []
    assert [tuple(r) for r in cube.cells().collect()] == [(None, 1, 0)]


def test_models_predict_in_a_session_that_built_a_cube(stored, spark):
    cube, _ = stored
    assert cube.slice((0, 0)).count() == 1
    rows = spark.createDataFrame([(Vectors.dense(float(i)), float(i % 2)) for i in range(20)], ["features", "y"])
    for model in (models.forest("y", numTrees=2).fit(rows), models.logistic("y", "features", 1.0, 20).fit(rows)):
        assert model.transform(rows).where("prediction IS NOT NULL").count() == 20
        assert model.transform(rows).select("probability").distinct().count() > 0


def test_a_slice_stores_its_level_alone(spark, tmp_path, rows):
    stores = spark.createDataFrame(STORES, "store long, region string, town string, shop string")
    goods = spark.createDataFrame(GOODS, "good long, item string")
    facts = spark.createDataFrame([(i % 8, i % 5, i) for i in range(200)], "store long, good long, q int")
    dimensions = [Dimension("store", ("region", "town", "shop"), stores), Dimension("good", ("item",), goods)]
    measures = {"quantity": F.col("q"), "n": F.lit(1)}
    whole = StoredCube(spark, str(tmp_path / "whole"), dimensions, measures).build(facts)
    early = StoredCube(spark, str(tmp_path / "early"), dimensions, measures).of(lambda m: facts.join(m["good"], "good").join(m["store"], "store"))
    for at, depths in enumerate([(1, 0), (3, 0), (2, 1), (2, 0), (3, 1), (0, 0)], 1):
        assert rows(early.slice(depths)) == rows(whole.slice(depths)) and len(early.sizes) == at and depths in early.sizes
    assert early.sizes.items() <= whole.sizes.items()


def test_trade_slices_build_no_other_level(spark):
    cubes._STORED.clear()
    cubes.cube_supplier_product(spark, FOLDER)
    ((_, cube),) = cubes._STORED.values()
    assert set(cube.sizes) == {(3, 0, 1)}
