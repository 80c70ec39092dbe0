"""Route scoring over edge lists (instance, src, dst, cost)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import checkpointed


def route_cost(routes: DataFrame, edges: DataFrame) -> DataFrame:
    """Cost of each route (instance, route, stops), one way and, as ``closed_cost``, back to its first stop.

    A route with a leg that has no edge has no cost.
    """
    stops = F.concat("stops", F.slice("stops", 1, 1))
    pairs = F.expr("transform(sequence(1, size(s) - 1), i -> struct(s[i - 1] AS src, s[i] AS dst, i = size(s) - 1 AS back))")
    legs = routes.select("instance", "route", stops.alias("s")).select("instance", "route", F.inline(pairs))
    priced = legs.join(edges, ["instance", "src", "dst"], "left")
    way = ~F.col("back")
    return priced.groupBy("instance", "route").agg(
        F.count_if(way).alias("legs"),
        F.when(F.count_if(way & F.col("cost").isNull()) == 0, F.coalesce(F.sum(F.when(way, F.col("cost"))), F.lit(0))).alias("cost"),
        F.when(F.count_if(F.col("cost").isNull()) == 0, F.sum("cost")).alias("closed_cost"),
    )


def nearest_tours(edges: DataFrame, starts: DataFrame | None = None, rounds_per_checkpoint: int = 6) -> DataFrame:
    """Nearest-neighbour tours of every instance from every start (or the given (instance, start) rows).

    Each round joins all open tours with the edges out of their last stop and keeps the cheapest unvisited one,
    the smaller name on a tie. A tour that runs into a dead end stays as it is and is not complete.
    """
    edges = checkpointed(edges.select("instance", "src", "dst", "cost"))
    places = edges.select("instance", F.explode(F.array("src", "dst")).alias("start")).distinct()
    sizes = places.groupBy("instance").agg(F.count(F.lit(1)).alias("places"))
    rounds = sizes.agg(F.max("places")).first()[0] or 0
    tours = (places if starts is None else starts.select("instance", "start")).select(
        "instance", "start", F.array("start").alias("stops"), F.lit(0).cast("long").alias("cost")
    )
    for done in range(1, rounds):
        out = edges.withColumnsRenamed({"instance": "i", "cost": "leg"})
        candidates = tours.join(
            out,
            (tours.instance == out.i) & (F.element_at("stops", -1) == out.src) & ~F.array_contains("stops", out.dst),
            "left",
        )
        best = F.min(F.when(F.col("dst").isNotNull(), F.struct("leg", "dst")))
        tours = (
            candidates.groupBy("instance", "start")
            .agg(F.any_value("stops").alias("stops"), F.any_value("cost").alias("cost"), best.alias("next"))
            .select(
                "instance",
                "start",
                F.when(F.col("next").isNull(), F.col("stops")).otherwise(F.array_append("stops", F.col("next.dst"))).alias("stops"),
                (F.col("cost") + F.coalesce(F.col("next.leg"), F.lit(0))).alias("cost"),
            )
        )
        if done % rounds_per_checkpoint == 0:
            tours = checkpointed(tours)
    return tours.join(sizes, "instance").withColumn("complete", F.size("stops") == F.col("places")).drop("places")


def exact_tours(edges: DataFrame, most_places: int = 20) -> DataFrame:
    """The cheapest round trip through all places of each instance, by programming over subsets.

    A state is (instance, set of visited places, last place) with the cheapest way to it; a round adds one place to every state
    and keeps one row per new state, so n places make at most n * 2^(n-1) states, 2,304 for 9 and ten million for 20, against (n-1)!
    trips. More places are an error. Each tour starts at the first place by name; of equally cheap ones, the first by the names on
    it. An instance without a round trip gives no row.
    """
    edges = checkpointed(edges.where("src <> dst").groupBy("instance", "src", "dst").agg(F.min("cost").alias("leg")))
    places = edges.select("instance", F.explode(F.array("src", "dst")).alias("place")).distinct()
    listed = places.groupBy("instance").agg(F.sort_array(F.collect_list("place")).alias("places"))
    listed = checkpointed(listed)
    rounds = listed.agg(F.max(F.size("places"))).first()[0] or 0
    if rounds > most_places:
        raise ValueError(f"an instance has {rounds} places; subsets of more than {most_places} are too many")
    bit = F.expr("shiftleft(1L, cast(array_position(places, dst) AS int) - 1)")
    coded = checkpointed(edges.join(listed, "instance").select("instance", "src", "dst", "leg", bit.alias("bit"), (F.col("dst") == F.col("places")[0]).alias("home")))
    zero = F.lit(0).cast(edges.schema["leg"].dataType)
    states = listed.select("instance", F.lit(1).cast("long").alias("visited"), F.col("places")[0].alias("last"), zero.alias("cost"), F.slice("places", 1, 1).alias("stops"))
    out = coded.withColumnRenamed("instance", "i")
    for _ in range(1, rounds):
        new = states.join(out, (F.col("instance") == F.col("i")) & (F.col("last") == F.col("src")) & (F.col("visited").bitwiseAND(F.col("bit")) == 0))
        way = F.struct((F.col("cost") + F.col("leg")).alias("cost"), F.array_append("stops", F.col("dst")).alias("stops"))
        best = new.groupBy("instance", F.col("visited").bitwiseOR(F.col("bit")).alias("visited"), F.col("dst").alias("last")).agg(F.min(way).alias("best"))
        grown = best.select("instance", "visited", "last", "best.cost", "best.stops")
        sizes = listed.select("instance", F.size("places").alias("n"))
        full = states.join(sizes, "instance").where(F.size("stops") == F.col("n")).drop("n")  # smaller instances wait for the others
        states = checkpointed(grown.unionByName(full))
    sizes = listed.select("instance", F.size("places").alias("n"))
    whole = states.join(sizes, "instance").where(F.size("stops") == F.col("n"))
    closed = whole.join(out.where("home"), (F.col("instance") == F.col("i")) & (F.col("last") == F.col("src")))
    best = F.min(F.struct((F.col("cost") + F.col("leg")).alias("cost"), "stops")).alias("b")
    return closed.groupBy("instance").agg(best).select("instance", "b.stops", "b.cost")


def best_route(routes: DataFrame, by: str = "cost") -> DataFrame:
    """Cheapest route of each instance; the smaller route name wins a tie."""
    best = F.min(F.struct(by, "route")).alias("b")
    return routes.where(F.col(by).isNotNull()).groupBy("instance").agg(best).select("instance", "b.route", f"b.{by}")
