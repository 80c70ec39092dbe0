"""Questions over sensor-like readings: events stand in for stations, orders for readings over several years."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import recode
from tallyloom.functions.formats import cents, exact_sum, from_cents
from tallyloom.operators import aggregates, cleaning, windows
from tallyloom.session import read_table


def readings(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("station"),
        "ts",
        F.col("value").cast("decimal(12,2)").alias("temperature"),
        F.get_json_object("props", "$.k").try_cast("int").alias("wind"),
    )


def minmaxavg_by_key(spark, folder):
    found = aggregates.min_avg_max(read_table(spark, folder, "events"), ["event_type"], "value")
    return found.withColumn("avg_value", F.round("avg_value", 6))


def minmaxavg_lines(spark, folder):
    """The same aggregate over the largest table, with many keys and exact money."""
    lines = read_table(spark, folder, "lineitem").select("l_partkey", cents(F.col("l_extendedprice")).alias("price"))
    found = lines.groupBy("l_partkey").agg(
        F.min("price").alias("least"), F.max("price").alias("most"), exact_sum(F.col("price")).alias("total"), F.count("price").alias("n")
    )
    return found.select(
        "l_partkey",
        from_cents(F.col("least")).alias("min_value"),
        (from_cents(F.col("total")) / F.col("n")).alias("avg_value"),
        from_cents(F.col("most")).alias("max_value"),
    )


def threshold_days(spark, folder):
    """Days with a very low and days with a very high reading, each counted once, and which are more."""
    plausible = read_table(spark, folder, "orders").where(cleaning.within(F.col("o_totalprice"), 100, 600000))
    day, low, high = F.to_date("o_orderdate"), F.col("o_totalprice") <= 3000, F.col("o_totalprice") >= 498000
    per_day = plausible.where(low | high).groupBy(day.alias("day")).agg(
        F.bool_or(low).cast("int").alias("low"), F.bool_or(high).cast("int").alias("high")
    )
    return per_day.agg(
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_days"), F.coalesce(F.sum("high"), F.lit(0)).alias("high_days")
    ).withColumn(
        "more", F.when(F.col("low_days") > F.col("high_days"), "low").when(F.col("low_days") < F.col("high_days"), "high").otherwise("same")
    )


def season_compare(spark, folder):
    """Mean of two series per season and their difference."""
    orders = read_table(spark, folder, "orders").select(
        recode.season(F.month("o_orderdate")).alias("season"),
        F.col("o_orderpriority").alias("series"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("reading"),
    )

    def mean(series):
        hit = F.when(F.col("series") == series, F.col("reading"))
        return windows.mean_of_sums(F.sum(hit), F.count(hit))

    both = orders.groupBy("season").agg(mean("1-URGENT").alias("urgent"), mean("5-LOW").alias("low"))
    return both.where("urgent IS NOT NULL AND low IS NOT NULL").withColumn("difference", F.col("urgent") - F.col("low"))


def rolling_24h_range(spark, folder):
    """Largest 24-hour swing of each station, with its window and the times of both extremes."""
    swings = windows.largest_swing(windows.rolling_extremes(readings(spark, folder), ["station"], "ts", "temperature", 24), ["station"])
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("start", "max_time", "min_time")]
    return swings.select("station", F.col("swing").cast("double").alias("swing"), *times)


def daily_swing(spark, folder):
    """Day with the largest swing of each station, by calendar day."""
    days = aggregates.daily_amplitude(readings(spark, folder), ["station"], F.to_date("ts"), "ts", "temperature")
    best = F.min(F.struct((-F.col("amplitude")).alias("v"), F.col("day").alias("d"))).alias("b")
    found = days.groupBy("station").agg(best)
    return found.select("station", (-F.col("b.v")).cast("double").alias("swing"), F.col("b.d").cast("string").alias("day"))


TARGET, LEAST, MOST = 42, 2, 250
SERIES = ("click", "view")


def best_hour(spark, folder):
    """Per month the hour, and the series it is of, closest to a target temperature, the calmer one on a tie. Each series is
    brought into one layout and labelled, then both are stacked and ranked once."""
    given = readings(spark, folder)
    one, other = (given.where(F.col("station") == name).withColumn("series", F.lit(name)).select("series", "ts", "temperature", "wind") for name in SERIES)
    hourly = one.unionByName(other).where(cleaning.within(F.col("temperature"), LEAST, MOST)).groupBy(
        F.month("ts").alias("month"), F.hour("ts").alias("hour"), "series"
    ).agg(
        windows.mean_of_sums(F.sum("temperature"), F.count("temperature")).alias("avg_temperature"),
        windows.mean_of_sums(F.sum("wind"), F.count("wind")).alias("avg_wind"),
    ).withColumn("difference", F.abs(F.col("avg_temperature") - TARGET))
    return windows.rank_top(hourly, ["month"], [F.col("difference"), F.col("avg_wind")])


def best_weekday(spark, folder):
    """Per month of the year the weekday, of orders or of shipped lines, whose mean money is closest to a target."""
    orders = read_table(spark, folder, "orders").select(F.lit("ordered").alias("series"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").cast("decimal(18,2)").alias("money"))
    lines = read_table(spark, folder, "lineitem").select(F.lit("shipped").alias("series"), F.col("l_shipdate").alias("ts"), (F.col("l_extendedprice").cast("decimal(18,2)") * 4).cast("decimal(18,2)").alias("money"))
    daily = orders.unionByName(lines).groupBy("series", F.month("ts").alias("month"), F.weekday("ts").alias("weekday")).agg(
        windows.mean_of_sums(F.sum("money"), F.count("money")).alias("mean_money"), F.count(F.lit(1)).alias("n")
    ).withColumn("difference", F.abs(F.col("mean_money") - 200_000))
    best = windows.rank_top(daily, ["month"], [F.col("difference"), F.col("n")])
    return best.select("month", "weekday", "series", "n", *[F.round(c, 4).alias(c) for c in ("mean_money", "difference")])


def rolling_7d_best(spark, folder):
    """Hottest seven days of each station."""
    means = windows.rolling_days(readings(spark, folder), F.to_date("ts"), F.col("temperature"), 7, ["station"])
    return windows.best_window(means, ["station"]).withColumn("start_day", F.col("start_day").cast("string"))


def coldest_hour_mode(spark, folder):
    """The hour that is most often the coldest of its day."""
    hourly = readings(spark, folder).groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(
        windows.mean_of_sums(F.sum("temperature"), F.count("temperature")).alias("avg_temperature")
    )
    coldest = windows.rank_top(hourly, ["day"], [F.col("avg_temperature")], "dense_rank")
    return coldest.groupBy("hour").agg(F.count(F.lit(1)).alias("days")).orderBy(F.desc("days"), "hour").limit(1)


QUERIES = {
    f.__name__: f
    for f in (
        minmaxavg_by_key, minmaxavg_lines, threshold_days, season_compare, rolling_24h_range, daily_swing, best_hour, best_weekday,
        rolling_7d_best, coldest_hour_mode,
    )
}

_R = """WITH r AS (SELECT event_id, event_type AS station, ts, CAST(value AS DECIMAL(12,2)) AS temperature,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS wind FROM events)
"""

ORACLE = {
    "minmaxavg_by_key": "SELECT event_type, MIN(value) AS min_value, ROUND(AVG(value), 6) AS avg_value, MAX(value) AS max_value FROM events GROUP BY 1",
    "minmaxavg_lines": """SELECT l_partkey, MIN(l_extendedprice) AS min_value,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS avg_value, MAX(l_extendedprice) AS max_value FROM lineitem GROUP BY 1""",
    "threshold_days": """
SELECT low_days, high_days, CASE WHEN low_days > high_days THEN 'low' WHEN low_days < high_days THEN 'high' ELSE 'same' END AS more
FROM (SELECT COUNT(DISTINCT CASE WHEN o_totalprice <= 3000 THEN CAST(o_orderdate AS DATE) END) AS low_days,
             COUNT(DISTINCT CASE WHEN o_totalprice >= 498000 THEN CAST(o_orderdate AS DATE) END) AS high_days
      FROM orders WHERE o_totalprice BETWEEN 100 AND 600000)""",
    "season_compare": """
WITH s AS (SELECT CASE WHEN MONTH(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN MONTH(o_orderdate) IN (3, 4, 5) THEN 'Spring'
    WHEN MONTH(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS reading FROM orders),
u AS (SELECT season, CAST(SUM(reading) AS DOUBLE) / COUNT(*) AS urgent FROM s WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
l AS (SELECT season, CAST(SUM(reading) AS DOUBLE) / COUNT(*) AS low FROM s WHERE o_orderpriority = '5-LOW' GROUP BY 1)
SELECT season, urgent, low, urgent - low AS difference FROM u JOIN l USING (season)""",
    "rolling_24h_range": _R
    + """, w AS (SELECT station, ts, MAX(temperature) OVER f AS hi, MIN(temperature) OVER f AS lo FROM r
  WINDOW f AS (PARTITION BY station ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 24 HOUR FOLLOWING)),
b AS (SELECT station, ts, hi, lo, ROW_NUMBER() OVER (PARTITION BY station ORDER BY hi - lo DESC, ts) AS k FROM w)
SELECT station, CAST(hi - lo AS DOUBLE) AS swing, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start,
  strftime((SELECT MIN(r.ts) FROM r WHERE r.station = b.station AND r.ts BETWEEN b.ts AND b.ts + INTERVAL 24 HOUR AND r.temperature = b.hi), '%Y-%m-%d %H:%M:%S.%f') AS max_time,
  strftime((SELECT MIN(r.ts) FROM r WHERE r.station = b.station AND r.ts BETWEEN b.ts AND b.ts + INTERVAL 24 HOUR AND r.temperature = b.lo), '%Y-%m-%d %H:%M:%S.%f') AS min_time
FROM b WHERE k = 1""",
    "daily_swing": _R
    + """, d AS (SELECT station, CAST(ts AS DATE) AS day, MAX(temperature) - MIN(temperature) AS swing FROM r GROUP BY 1, 2)
SELECT station, CAST(swing AS DOUBLE) AS swing, CAST(day AS VARCHAR) AS day FROM d
QUALIFY ROW_NUMBER() OVER (PARTITION BY station ORDER BY swing DESC, day) = 1""",
    "best_hour": _R
    + f""", h AS (SELECT CAST(MONTH(ts) AS INTEGER) AS month, CAST(HOUR(ts) AS INTEGER) AS hour, station AS series,
  CAST(SUM(temperature) AS DOUBLE) / COUNT(temperature) AS avg_temperature, CAST(SUM(wind) AS DOUBLE) / COUNT(wind) AS avg_wind
  FROM r WHERE temperature BETWEEN {LEAST} AND {MOST} AND station IN {SERIES} GROUP BY 1, 2, 3)
SELECT month, hour, series, avg_temperature, avg_wind, ABS(avg_temperature - {TARGET}) AS difference FROM h
QUALIFY RANK() OVER (PARTITION BY month ORDER BY ABS(avg_temperature - {TARGET}), avg_wind) = 1""",
    "best_weekday": """
WITH u AS (SELECT 'ordered' AS series, o_orderdate AS ts, CAST(o_totalprice AS DECIMAL(18,2)) AS money FROM orders
  UNION ALL SELECT 'shipped', l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) * 4 FROM lineitem),
d AS (SELECT series, CAST(MONTH(ts) AS INTEGER) AS month, CAST((ISODOW(ts) - 1) AS INTEGER) AS weekday, CAST(SUM(money) AS DOUBLE) / COUNT(*) AS m, COUNT(*) AS n
  FROM u GROUP BY ALL)
SELECT month, weekday, series, n, ROUND(m, 4) AS mean_money, ROUND(ABS(m - 200000), 4) AS difference FROM d
QUALIFY RANK() OVER (PARTITION BY month ORDER BY ABS(m - 200000), n) = 1""",
    "rolling_7d_best": _R
    + """, d AS (SELECT station, CAST(ts AS DATE) AS day, SUM(temperature) AS s, COUNT(*) AS c FROM r GROUP BY 1, 2),
m AS (SELECT a.station, a.day, CAST(SUM(b.s) AS DOUBLE) / SUM(b.c) AS mean_value FROM d a
  JOIN d b ON a.station = b.station AND b.day BETWEEN a.day AND a.day + 6 GROUP BY 1, 2)
SELECT station, mean_value, CAST(day AS VARCHAR) AS start_day FROM m
QUALIFY ROW_NUMBER() OVER (PARTITION BY station ORDER BY mean_value DESC, day) = 1""",
    "coldest_hour_mode": _R
    + """, h AS (SELECT CAST(ts AS DATE) AS day, CAST(HOUR(ts) AS INTEGER) AS hour,
  CAST(SUM(temperature) AS DOUBLE) / COUNT(*) AS a FROM r GROUP BY 1, 2),
k AS (SELECT hour FROM h QUALIFY DENSE_RANK() OVER (PARTITION BY day ORDER BY a) = 1)
SELECT hour, COUNT(*) AS days FROM k GROUP BY hour ORDER BY days DESC, hour LIMIT 1""",
}
