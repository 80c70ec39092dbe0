"""Star-schema reporting queries over suppliers, consumers, products, offers, requests and transactions.

Each query is a function of (spark, folder); ``ORACLE`` holds the same question as plain SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.formats import cents, exact_sum, from_cents
from tallyloom.operators import aggregates, relational, windows
from tallyloom.session import read_table

# --- stand-ins for the trade tables -----------------------------------------------------------------


def places(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    s = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supp_id"), F.col("s_name").alias("supplier"), F.col("s_nationkey").alias("place_id")
    )
    return s.join(places(spark, folder), "place_id").select("supp_id", "supplier", "city", "state")


def consumers(spark: SparkSession, folder: str) -> DataFrame:
    c = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("con_id"),
        F.col("c_name").alias("consumer"),
        F.col("c_nationkey").alias("place_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    return c.join(places(spark, folder), "place_id").drop("place_id")


def supplier_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names alone, without their places: a small table that Spark knows to be small."""
    return read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("supp_id"), F.col("s_name").alias("supplier"))


def consumer_names(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(F.col("c_custkey").alias("con_id"), F.col("c_name").alias("consumer"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_name").alias("product"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sold line, before it is known who bought it; prices in cents."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("supp_id"),
        F.col("l_partkey").alias("prod_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        cents(F.col("l_extendedprice")).alias("price"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: who bought and when."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("con_id"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder).join(sales(spark, folder), "order_id")


ROWS_A_PARTITION = 250_000


def spread_on(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal rows by the keys they are grouped or joined on, over as many partitions as their number asks for, so that a task's share
    does not grow with the table; up to the session's number of partitions Spark's own shuffle does."""
    parts = math.ceil(rows / ROWS_A_PARTITION)
    return df if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(parts, *keys)


def offers(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder).groupBy("supp_id", "prod_id").agg(F.sum("quantity").alias("quantity"))


def sales_with_consumers(spark: SparkSession, folder: str, buyers: DataFrame | None = None) -> DataFrame:
    """Orders joined to their consumer first: the wide line table then shuffles once, on the order id."""
    return sales(spark, folder).join(consumers(spark, folder) if buyers is None else buyers, "con_id")


def line_value() -> Column:
    """Money of a line, in cents like its price."""
    return F.col("quantity") * F.col("price")


STAR_SQL = """
WITH pl AS (SELECT n_nationkey place_id, n_name city, r_name state FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT s_suppkey supp_id, s_name supplier, city, state FROM supplier JOIN pl ON s_nationkey = place_id),
c AS (SELECT c_custkey con_id, c_name consumer, c_mktsegment segment, c_acctbal balance, city, state
      FROM customer JOIN pl ON c_nationkey = place_id),
p AS (SELECT p_partkey prod_id, p_name product, p_type category, p_brand brand, p_size size FROM part),
t AS (SELECT l_suppkey supp_id, o_custkey con_id, l_partkey prod_id, CAST(l_quantity AS BIGINT) quantity,
             CAST(l_extendedprice AS DECIMAL(12,2)) price, CAST(o_orderdate AS DATE) AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
o AS (SELECT l_suppkey supp_id, l_partkey prod_id, CAST(SUM(l_quantity) AS BIGINT) quantity FROM lineitem GROUP BY 1, 2),
r AS (SELECT DISTINCT con_id, prod_id FROM t)
"""

# --- row-level questions ----------------------------------------------------------------------------


def big_tx_between_places(spark, folder):
    sellers = suppliers(spark, folder).where("city = 'NATION_3'")
    buyers = consumers(spark, folder).where("city = 'NATION_5'")
    return (
        lines(spark, folder)
        .where(line_value() > 1000000 * 100)
        .join(sellers, "supp_id")
        .join(sales_with_consumers(spark, folder, buyers), "order_id")
        .join(products(spark, folder), "prod_id")
        .select("supplier", "consumer", "product", F.col("quantity").cast("long"), from_cents(F.col("price")).alias("price"))
    )


def suppliers_offering_all(spark, folder):
    wanted = ["red plate", "small widget", "hot plate"]
    stock = products(spark, folder).where(F.col("product").isin(wanted))
    having = relational.offering_all(lines(spark, folder).join(stock, "prod_id"), ["supp_id"], "product", wanted)
    return having.join(suppliers(spark, folder), "supp_id").select("supplier").distinct()


def in_or_city(spark, folder):
    stock = products(spark, folder).where("product IN ('red plate', 'hot plate') AND category = 'PROMO' AND size <= 5")
    offering = lines(spark, folder).join(stock, "prod_id").select("supp_id")
    found = relational.matching_or(suppliers(spark, folder), F.col("city") == "NATION_4", offering, ["supp_id"])
    return found.select("supplier").distinct()


def not_offered_in(spark, folder):
    local = suppliers(spark, folder).where("city = 'NATION_6'").select("supp_id")
    offered = lines(spark, folder).join(local, "supp_id").select("prod_id")
    return relational.not_in(products(spark, folder), offered, "prod_id").select("prod_id", "product")


def only_requesters(spark, folder):
    brands = [f"Brand#{i}" for i in range(3, 26)]
    wanted = (
        transactions(spark, folder)
        .join(products(spark, folder).select("prod_id", "brand"), "prod_id")
        .select("con_id", "brand")
    )
    found = relational.only(wanted, ["con_id"], "brand", brands)
    return found.join(consumers(spark, folder), "con_id").select("consumer").orderBy("consumer")


def cities_without_offers(spark, folder):
    bulk = offers(spark, folder).where("quantity >= 120").select("supp_id")
    flagged = relational.membership_flag(suppliers(spark, folder), bulk, ["supp_id"], "offers")
    return flagged.groupBy("city").agg(F.max("offers").alias("any_offer")).where("any_offer = 0").select("city")


def requested_by_all(spark, folder):
    buyer = F.concat_ws("/", "city", "segment").alias("buyer")
    asked = (
        lines(spark, folder)
        .join(sales_with_consumers(spark, folder).select("order_id", buyer), "order_id")
        .groupBy("prod_id", "buyer")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(products(spark, folder), "prod_id")
    )
    return relational.divides(asked, ["product"], "buyer", consumers(spark, folder).select(buyer))


def requested_in_all_cities_but(spark, folder):
    asked = (
        lines(spark, folder)
        .join(sales_with_consumers(spark, folder).select("order_id", "state"), "order_id")
        .groupBy("prod_id", "state")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = relational.divides(asked, ["prod_id"], "state", places(spark, folder), exclude=["ASIA"])
    return found.join(products(spark, folder), "prod_id").select("prod_id", "product")


def requested_in_whole_region(spark, folder):
    """Products requested from every city of one region, whatever other cities ask for them."""
    asked = lines(spark, folder).join(sales_with_consumers(spark, folder).select("order_id", "city"), "order_id").select("prod_id", "city").distinct()
    found = relational.divides(asked, ["prod_id"], "city", places(spark, folder).where("state = 'EUROPE'"))
    return found.join(products(spark, folder), "prod_id").select("prod_id", "product")


def largest_offer(spark, folder):
    best = relational.largest_per_key(offers(spark, folder), ["prod_id"], "quantity")
    return (
        best.join(products(spark, folder), "prod_id")
        .join(supplier_names(spark, folder), "supp_id")
        .select("product", "supplier", "quantity")
        .distinct()
        .orderBy("product", "supplier")
    )


def best_city_per_product(spark, folder):
    sold = (
        lines(spark, folder)
        .join(sales_with_consumers(spark, folder).select("order_id", "city"), "order_id")
        .groupBy("prod_id", "city")
        .agg(F.sum("quantity").alias("quantity"))
        .join(products(spark, folder).select("prod_id", "product"), "prod_id")
        .groupBy("product", "city")
        .agg(F.sum("quantity").alias("total_sold"))
    )
    return windows.rank_top(sold, ["product"], [F.desc("total_sold")])


# --- aggregates -------------------------------------------------------------------------------------


def count_by_category(spark, folder):
    return products(spark, folder).groupBy("category").agg(F.count("prod_id").alias("products"))


def having_count(spark, folder):
    per_city = consumers(spark, folder).groupBy("city").agg(F.count("con_id").alias("consumers"))
    return per_city.where("consumers >= 60")


def distinct_products_by_city(spark, folder):
    stock = offers(spark, folder).join(suppliers(spark, folder), "supp_id")
    return stock.groupBy("city").agg(F.countDistinct("prod_id").alias("products"))


def product_suppliers_by_state(spark, folder):
    stock = products(spark, folder).where("product = 'red plate'").select("prod_id")
    offering = lines(spark, folder).join(stock, "prod_id").select("supp_id").distinct()
    by_state = offering.join(suppliers(spark, folder), "supp_id").groupBy("state")
    return by_state.agg(F.countDistinct("supp_id").alias("suppliers"))


def offered_by_city_product(spark, folder):
    return (
        offers(spark, folder)
        .join(suppliers(spark, folder), "supp_id")
        .join(products(spark, folder), "prod_id")
        .groupBy("city", "product")
        .agg(F.sum("quantity").alias("offered"))
    )


def sold_by_supplier_city(spark, folder):
    stock = products(spark, folder).where("product = 'hot plate'").select("prod_id")
    return (
        lines(spark, folder)
        .join(stock, "prod_id")
        .join(sales_with_consumers(spark, folder).select("order_id", "city"), "order_id")
        .groupBy("supp_id", "city")
        .agg(F.sum("quantity").alias("quantity"))
        .join(suppliers(spark, folder).select("supp_id", "supplier"), "supp_id")
        .groupBy("supplier", "city")
        .agg(F.sum("quantity").alias("sold"))
    )


def tx_by_triplet(spark, folder):
    sold = lines(spark, folder)
    n = sold.count()  # from the footers
    by_id, by_name = ("supp_id", "con_id", "prod_id"), ("supplier", "consumer", "product")
    bought = spread_on(sold, n, "order_id").join(spread_on(sales(spark, folder), n, "order_id"), "order_id")
    named = (
        spread_on(bought, n, *by_id)
        .groupBy(*by_id)
        .agg(exact_sum(line_value()).alias("value"))
        .join(products(spark, folder).select("prod_id", "product"), "prod_id")
        .join(supplier_names(spark, folder), "supp_id")
        .join(consumer_names(spark, folder), "con_id")
    )
    return spread_on(named, n, *by_name).groupBy(*by_name).agg(from_cents(F.sum("value")).alias("total_value"))


def monthly_sales(spark, folder):
    year = sales(spark, folder).where("day >= DATE'1997-01-01' AND day < DATE'1998-01-01'")
    sold = lines(spark, folder)
    n = sold.count()  # from the footers
    by_id, by_name = ("month", "supp_id", "con_id", "prod_id"), ("month", "supplier", "consumer", "product")
    bought = spread_on(sold, n, "order_id").join(spread_on(year, n, "order_id"), "order_id").withColumn("month", F.month("day"))
    named = (
        spread_on(bought, n, *by_id)
        .groupBy(*by_id)
        .agg(F.count(F.lit(1)).alias("tx"), F.sum("quantity").alias("units"), exact_sum(line_value()).alias("value"))
        .join(products(spark, folder).select("prod_id", "product"), "prod_id")
        .join(supplier_names(spark, folder), "supp_id")
        .join(consumer_names(spark, folder), "con_id")
    )
    return (
        spread_on(named, n, *by_name)
        .groupBy(*by_name)
        .agg(
            F.sum("tx").alias("transactions"),
            F.sum("units").alias("units"),
            from_cents(F.sum("value")).alias("total_value"),
        )
        .orderBy("month", "supplier", "consumer", "product")
    )


def state_more_suppliers(spark, folder):
    wealthy = consumers(spark, folder).where("balance > 9300")
    counts = relational.one_sided_counts(
        suppliers(spark, folder), wealthy, ["state", "city"], "supp_id", "con_id", ("suppliers", "consumers")
    )
    return counts.where("suppliers > consumers")


def place_party_counts(spark, folder):
    counts = relational.one_sided_counts(
        suppliers(spark, folder), consumers(spark, folder), ["state", "city"], "supp_id", "con_id", ("suppliers", "consumers")
    )
    return counts.orderBy("state", "city")


def two_way_flow(spark, folder):
    ends = ["NATION_1", "NATION_2"]
    sellers = suppliers(spark, folder).where(F.col("city").isin(ends)).select("supp_id", F.col("city").alias("src"))
    buyers = consumers(spark, folder).where(F.col("city").isin(ends)).select("con_id", F.col("city").alias("dst"))
    moved = (
        lines(spark, folder)
        .join(sellers, "supp_id")
        .join(sales_with_consumers(spark, folder, buyers), "order_id")
        .groupBy("prod_id", "src", "dst")
        .agg(F.sum("quantity").alias("quantity"))
    )
    # every product keeps its row, with zeros where nothing moved
    named = products(spark, folder).select("prod_id", "product").join(moved, "prod_id", "left")
    return aggregates.conditional_sums(
        named,
        ["product"],
        "quantity",
        {
            "forth": (F.col("src") == ends[0]) & (F.col("dst") == ends[1]),
            "back": (F.col("src") == ends[1]) & (F.col("dst") == ends[0]),
        },
    ).orderBy("product")


QUERIES = {
    f.__name__: f
    for f in (
        big_tx_between_places,
        suppliers_offering_all,
        in_or_city,
        not_offered_in,
        only_requesters,
        cities_without_offers,
        requested_by_all,
        requested_in_all_cities_but,
        requested_in_whole_region,
        largest_offer,
        best_city_per_product,
        count_by_category,
        having_count,
        distinct_products_by_city,
        product_suppliers_by_state,
        offered_by_city_product,
        sold_by_supplier_city,
        tx_by_triplet,
        monthly_sales,
        state_more_suppliers,
        place_party_counts,
        two_way_flow,
    )
}

_SQL = {
    "big_tx_between_places": """
SELECT supplier, consumer, product, quantity, CAST(price AS DOUBLE) AS price
FROM t JOIN s USING (supp_id) JOIN c USING (con_id) JOIN p USING (prod_id)
WHERE quantity * price > 1000000 AND s.city = 'NATION_3' AND c.city = 'NATION_5'""",
    "suppliers_offering_all": """
SELECT supplier FROM s WHERE
    EXISTS (SELECT 1 FROM o JOIN p USING (prod_id) WHERE o.supp_id = s.supp_id AND product = 'red plate')
AND EXISTS (SELECT 1 FROM o JOIN p USING (prod_id) WHERE o.supp_id = s.supp_id AND product = 'small widget')
AND EXISTS (SELECT 1 FROM o JOIN p USING (prod_id) WHERE o.supp_id = s.supp_id AND product = 'hot plate')""",
    "in_or_city": """
SELECT DISTINCT supplier FROM s WHERE city = 'NATION_4' OR supp_id IN (
  SELECT supp_id FROM o JOIN p USING (prod_id)
  WHERE product IN ('red plate', 'hot plate') AND category = 'PROMO' AND size <= 5)""",
    "not_offered_in": """
SELECT prod_id, product FROM p WHERE prod_id NOT IN (
  SELECT prod_id FROM o JOIN s USING (supp_id) WHERE city = 'NATION_6')""",
    "only_requesters": """
SELECT consumer FROM c WHERE con_id IN (SELECT con_id FROM r) AND con_id NOT IN (
  SELECT con_id FROM r JOIN p USING (prod_id) WHERE brand IN ('Brand#1', 'Brand#2'))""",
    "cities_without_offers": """
SELECT DISTINCT city FROM s WHERE city NOT IN (
  SELECT city FROM s JOIN o USING (supp_id) WHERE quantity >= 120)""",
    "requested_by_all": """
SELECT product FROM r JOIN p USING (prod_id) JOIN c USING (con_id) GROUP BY product
HAVING COUNT(DISTINCT city || '/' || segment) = (SELECT COUNT(DISTINCT city || '/' || segment) FROM c)""",
    "requested_in_all_cities_but": """
SELECT prod_id, product FROM r JOIN p USING (prod_id) JOIN c USING (con_id) WHERE state <> 'ASIA'
GROUP BY prod_id, product HAVING COUNT(DISTINCT state) = (SELECT COUNT(DISTINCT state) FROM pl WHERE state <> 'ASIA')""",
    "requested_in_whole_region": """
SELECT prod_id, product FROM p WHERE NOT EXISTS (
  SELECT 1 FROM pl WHERE state = 'EUROPE' AND NOT EXISTS (
    SELECT 1 FROM r JOIN c USING (con_id) WHERE r.prod_id = p.prod_id AND c.city = pl.city))""",
    "largest_offer": """
SELECT DISTINCT product, supplier, quantity FROM o JOIN p USING (prod_id) JOIN s USING (supp_id)
WHERE quantity >= (SELECT MAX(o2.quantity) FROM o o2 WHERE o2.prod_id = o.prod_id)""",
    "best_city_per_product": """
SELECT product, city, total_sold FROM (
  SELECT product, city, CAST(SUM(quantity) AS BIGINT) AS total_sold,
         RANK() OVER (PARTITION BY product ORDER BY SUM(quantity) DESC) AS rk
  FROM t JOIN p USING (prod_id) JOIN c USING (con_id) GROUP BY product, city) WHERE rk = 1""",
    "count_by_category": "SELECT category, COUNT(prod_id) AS products FROM p GROUP BY category",
    "having_count": "SELECT city, COUNT(con_id) AS consumers FROM c GROUP BY city HAVING COUNT(con_id) >= 60",
    "distinct_products_by_city": """
SELECT city, COUNT(DISTINCT prod_id) AS products FROM o JOIN s USING (supp_id) GROUP BY city""",
    "product_suppliers_by_state": """
SELECT state, COUNT(DISTINCT supp_id) AS suppliers FROM o JOIN s USING (supp_id) JOIN p USING (prod_id)
WHERE product = 'red plate' GROUP BY state""",
    "offered_by_city_product": """
SELECT city, product, CAST(SUM(quantity) AS BIGINT) AS offered
FROM o JOIN s USING (supp_id) JOIN p USING (prod_id) GROUP BY city, product""",
    "sold_by_supplier_city": """
SELECT supplier, c.city AS city, CAST(SUM(quantity) AS BIGINT) AS sold
FROM t JOIN s USING (supp_id) JOIN c USING (con_id) JOIN p USING (prod_id)
WHERE product = 'hot plate' GROUP BY supplier, c.city""",
    "tx_by_triplet": """
SELECT supplier, consumer, product, CAST(SUM(quantity * price) AS DOUBLE) AS total_value
FROM t JOIN s USING (supp_id) JOIN c USING (con_id) JOIN p USING (prod_id) GROUP BY supplier, consumer, product""",
    "monthly_sales": """
SELECT CAST(MONTH(day) AS INTEGER) AS month, supplier, consumer, product, COUNT(*) AS transactions,
       CAST(SUM(quantity) AS BIGINT) AS units, CAST(SUM(quantity * price) AS DOUBLE) AS total_value
FROM t JOIN s USING (supp_id) JOIN c USING (con_id) JOIN p USING (prod_id)
WHERE YEAR(day) = 1997 GROUP BY MONTH(day), supplier, consumer, product""",
    "state_more_suppliers": """
SELECT state, city, suppliers, consumers FROM (
  SELECT state, city, (SELECT COUNT(*) FROM s WHERE s.city = pl.city) AS suppliers,
         (SELECT COUNT(*) FROM c WHERE c.city = pl.city AND balance > 9300) AS consumers FROM pl)
WHERE suppliers > consumers""",
    "place_party_counts": """
SELECT cs.state, cs.city, COUNT(DISTINCT s.supp_id) AS suppliers, COUNT(DISTINCT c.con_id) AS consumers
FROM (SELECT state, city FROM s UNION SELECT state, city FROM c) cs
LEFT JOIN s ON cs.state = s.state AND cs.city = s.city LEFT JOIN c ON cs.state = c.state AND cs.city = c.city
GROUP BY cs.state, cs.city""",
    "two_way_flow": """
SELECT product,
  CAST(SUM(CASE WHEN s.city = 'NATION_1' AND c.city = 'NATION_2' THEN quantity ELSE 0 END) AS BIGINT) AS forth,
  CAST(SUM(CASE WHEN s.city = 'NATION_2' AND c.city = 'NATION_1' THEN quantity ELSE 0 END) AS BIGINT) AS back
FROM p LEFT JOIN t USING (prod_id) LEFT JOIN s USING (supp_id) LEFT JOIN c USING (con_id) GROUP BY product""",
}
ORACLE = {name: STAR_SQL + sql for name, sql in _SQL.items()}
