"""Routes between places: the cost from one place to another is what a unit sold between them costs on average."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.formats import exact_sum
from tallyloom.operators import routes
from tallyloom.plans import trade
from tallyloom.session import checkpointed, read_table


def sold_between(spark, folder):
    """Cents and units per priority, segment and pair of places. Callers that read it more than once store it
    first: it is small, while the join behind it is not."""
    buyers = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("con_id"), F.col("o_orderpriority").alias("instance")
    ).join(trade.consumers(spark, folder).select("con_id", "segment", F.col("city").alias("dst")), "con_id")
    sellers = trade.suppliers(spark, folder).select("supp_id", F.col("city").alias("src"))
    sold = trade.lines(spark, folder).join(sellers, "supp_id").join(buyers, "order_id")
    return sold.groupBy("instance", "segment", "src", "dst").agg(
        exact_sum(F.col("price")).alias("cents"), F.sum("quantity").alias("units")
    )


def trade_edges(sold):
    """One cost matrix per order priority, in whole cents per unit; it is not symmetric."""
    summed = sold.where("src <> dst").groupBy("instance", "src", "dst").agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"))
    return summed.select("instance", "src", "dst", F.expr("cents div units").alias("cost"))


def sales_routes(sold):
    """Candidate routes: per priority and market segment, the selling places by falling sales."""
    per_place = sold.groupBy("instance", "segment", "src").agg(F.sum("units").alias("units"))
    # one entry per place: the array is as long as the list of places
    return per_place.groupBy("instance", F.col("segment").alias("route")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("units")).alias("k"), "src"))), lambda x: x["src"]).alias("stops")
    )


def route_cost(spark, folder):
    sold = checkpointed(sold_between(spark, folder))
    return routes.route_cost(sales_routes(sold), trade_edges(sold)).withColumnRenamed("cost", "open_cost")


def nn_tour(spark, folder):
    tours = routes.nearest_tours(trade_edges(sold_between(spark, folder)))
    return tours.select("instance", "start", F.concat_ws(">", "stops").alias("tour"), "cost", F.col("complete").cast("int").alias("complete"))


def best_route(spark, folder):
    """Cheapest round trip of each priority among the sales routes."""
    sold = checkpointed(sold_between(spark, folder))
    costs = routes.route_cost(sales_routes(sold), trade_edges(sold))
    return routes.best_route(costs, "closed_cost").withColumnRenamed("closed_cost", "cost")


TOURED = [f"NATION_{i}" for i in range(8)]


def exact_tour(spark, folder):
    """Cheapest round trip of each priority through eight places, and what the nearest-neighbour tours from each of them cost at best."""
    edges = checkpointed(trade_edges(sold_between(spark, folder)).where(F.col("src").isin(TOURED) & F.col("dst").isin(TOURED)))
    exact = routes.exact_tours(edges)
    near = routes.nearest_tours(edges).where("complete").select("instance", F.col("start").alias("route"), "stops")
    nearest = routes.route_cost(near, edges).groupBy("instance").agg(F.min("closed_cost").alias("nearest_cost"))
    return exact.join(nearest, "instance", "left").select("instance", F.concat_ws(">", "stops").alias("tour"), "cost", "nearest_cost")


QUERIES = {f.__name__: f for f in (route_cost, nn_tour, best_route, exact_tour)}

EDGES_SQL = """, b AS (SELECT o_orderpriority AS instance, s.city AS src, c.city AS dst, segment,
  CAST(l_quantity AS BIGINT) AS units, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON l_suppkey = supp_id JOIN c ON o_custkey = con_id),
e AS (SELECT instance, src, dst, CAST(SUM(cents) // SUM(units) AS BIGINT) AS cost FROM b WHERE src <> dst GROUP BY 1, 2, 3),
ranked AS (SELECT instance, segment AS route, src AS stop, ROW_NUMBER() OVER (PARTITION BY instance, segment ORDER BY SUM(units) DESC, src) AS k
  FROM b GROUP BY 1, 2, 3),
legs AS (SELECT instance, route, k, stop AS src,
    LEAD(stop) OVER (PARTITION BY instance, route ORDER BY k) AS nxt, FIRST_VALUE(stop) OVER (PARTITION BY instance, route ORDER BY k) AS home FROM ranked),
o1 AS (SELECT l.instance, l.route, COUNT(*) AS legs, CASE WHEN COUNT(*) = COUNT(cost) THEN CAST(SUM(cost) AS BIGINT) END AS open_cost
  FROM legs l LEFT JOIN e ON e.instance = l.instance AND e.src = l.src AND e.dst = l.nxt WHERE nxt IS NOT NULL GROUP BY 1, 2),
c1 AS (SELECT l.instance, l.route, CASE WHEN COUNT(*) = COUNT(cost) THEN CAST(SUM(cost) AS BIGINT) END AS closed_cost
  FROM legs l LEFT JOIN e ON e.instance = l.instance AND e.src = l.src AND e.dst = COALESCE(l.nxt, l.home) GROUP BY 1, 2)
"""

ORACLE = {
    "route_cost": trade.STAR_SQL.rstrip() + EDGES_SQL + "SELECT instance, route, legs, open_cost, closed_cost FROM o1 JOIN c1 USING (instance, route)",
    "best_route": trade.STAR_SQL.rstrip()
    + EDGES_SQL
    + """SELECT instance, route, closed_cost AS cost FROM c1 WHERE closed_cost IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY instance ORDER BY closed_cost, route) = 1""",
    "nn_tour": trade.STAR_SQL.replace("WITH pl", "WITH RECURSIVE pl").rstrip()
    + EDGES_SQL.rstrip()
    + """, places AS (SELECT instance, src AS place FROM e UNION SELECT instance, dst FROM e),
tour AS (
  SELECT instance, place AS start, [place] AS stops, CAST(0 AS BIGINT) AS cost FROM places
  UNION ALL
  SELECT instance, start, list_append(stops, nxt.d), cost + nxt.c FROM (
    SELECT t.instance, t.start, ANY_VALUE(t.stops) AS stops, ANY_VALUE(t.cost) AS cost, MIN({'c': e.cost, 'd': e.dst}) AS nxt
    FROM tour t JOIN e ON e.instance = t.instance AND e.src = t.stops[-1] AND NOT list_contains(t.stops, e.dst)
    GROUP BY t.instance, t.start))
SELECT instance, start, array_to_string(stops, '>') AS tour, cost,
  CAST(len(stops) = (SELECT COUNT(*) FROM places p WHERE p.instance = tour.instance) AS INTEGER) AS complete
FROM tour QUALIFY ROW_NUMBER() OVER (PARTITION BY instance, start ORDER BY len(stops) DESC) = 1""",
    # every trip through the places, against the nearest-neighbour tours among them
    "exact_tour": trade.STAR_SQL.replace("WITH pl", "WITH RECURSIVE pl").rstrip()
    + EDGES_SQL.rstrip()
    + f""", x AS (SELECT * FROM e WHERE src IN ({', '.join(f"'{p}'" for p in TOURED)}) AND dst IN ({', '.join(f"'{p}'" for p in TOURED)})),
places AS (SELECT instance, src AS place FROM x UNION SELECT instance, dst FROM x),
n AS (SELECT instance, count(*) AS n, min(place) AS home FROM places GROUP BY 1),
trip AS (
  SELECT instance, [home] AS stops, CAST(0 AS BIGINT) AS cost FROM n
  UNION ALL
  SELECT t.instance, list_append(stops, dst), t.cost + x.cost FROM trip t JOIN x ON x.instance = t.instance AND x.src = stops[-1]
    AND NOT list_contains(stops, dst)),
closed AS (SELECT t.instance, stops, t.cost + x.cost AS cost FROM trip t JOIN n ON n.instance = t.instance AND len(stops) = n
  JOIN x ON x.instance = t.instance AND src = stops[-1] AND dst = home),
near AS (
  SELECT instance, place AS start, [place] AS stops, CAST(0 AS BIGINT) AS cost FROM places
  UNION ALL
  SELECT instance, start, list_append(stops, nxt.d), cost + nxt.c FROM (
    SELECT t.instance, t.start, ANY_VALUE(t.stops) AS stops, ANY_VALUE(t.cost) AS cost, MIN({{'c': x.cost, 'd': x.dst}}) AS nxt
    FROM near t JOIN x ON x.instance = t.instance AND x.src = t.stops[-1] AND NOT list_contains(t.stops, x.dst)
    GROUP BY t.instance, t.start)),
back AS (SELECT t.instance, min(t.cost + x.cost) AS nearest_cost FROM near t JOIN n ON n.instance = t.instance AND len(stops) = n
  JOIN x ON x.instance = t.instance AND x.src = stops[-1] AND x.dst = start GROUP BY 1)
SELECT instance, array_to_string(stops, '>') AS tour, cost, nearest_cost FROM closed LEFT JOIN back USING (instance)
QUALIFY ROW_NUMBER() OVER (PARTITION BY instance ORDER BY cost, stops) = 1""",
}
