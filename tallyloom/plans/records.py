"""Record cleaning, matching and lookup questions; messy text is rendered from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import divisions, recode, timestamps
from tallyloom.operators import aggregates, cleaning, relational
from tallyloom.session import checkpointed, read_table
from tallyloom.sources import tables

BAND_LABELS = ["22-01", "02-05", "06-09", "10-13", "14-17", "18-21"]
MINUTE = "yyyy-MM-dd HH:mm"


def messy_events(spark, folder):
    """Events with their time rendered in one of five layouts, chosen by the kind of event."""
    ts = F.col("ts")
    thai = F.concat(F.date_format(ts, "d/M/"), (F.year(ts) + 543).cast("string"), F.date_format(ts, " H:mm"))
    text = (
        F.when(F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format(ts, "M/d/yyyy H:mm:ss"))
        .when(F.col("event_type") == "purchase", F.date_format(ts, "M/d/yyyy h:mm:ss a"))
        .when(F.col("event_type") == "signup", thai)
        .otherwise(F.date_format(ts, "d/M/yyyy H:mm"))
    )
    return read_table(spark, folder, "events").withColumn("adate", text)


def std_timestamp(spark, folder):
    parsed = timestamps.standard_timestamps(messy_events(spark, folder).select("event_id", "adate"), {"at": F.col("adate")})
    return parsed.select("event_id", F.date_format("at", MINUTE).alias("parsed"))


def merged_timestamp(spark, folder):
    """Date column to the hour, time column to the minute: the time column wins, except at midnight."""
    ts = F.col("ts")
    pairs = read_table(spark, folder, "events").select(
        "event_id",
        F.date_format(ts, "yyyy-MM-dd HH:00").alias("adate"),
        F.concat(F.lit("12/30/1899 "), F.date_format(ts, "h:mm a")).alias("atime"),
    )
    merged = timestamps.merged_timestamp(pairs, F.col("adate"), F.col("atime"), "at")
    return merged.select("event_id", F.date_format("at", MINUTE).alias("merged"))


def place_lookup_fallback(spark, folder):
    """Region of each customer by place name, else by place id; customers with neither are dropped."""
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("name"), F.col("r_name").alias("label"))
    ids = nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    people = read_table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.when(~F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), F.col("n_name")).alias("place"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_nationkey").cast("string")).alias("place_id"),
    )
    return relational.lookup_fallback(people, "place", "place_id", names, ids, "region").select("c_custkey", "region")


def learn_dimension(spark, folder):
    facts = read_table(spark, folder, "documents").select("source", F.nullif("lang", F.lit("en")).alias("lang"), "doc_id")
    return tables.learn_dimension(facts, "source", "lang", "doc_id")


def code_cleanup(spark, folder):
    """Zero-padded codes to integers, junk codes to the missing code."""
    padded = F.lpad(F.get_json_object("props", "$.k"), 4, "0")
    code = recode.plain_code(F.col("code"), ["90", "99"], 9999)
    return read_table(spark, folder, "events").select("event_id", padded.alias("code")).select("event_id", code.alias("code"))


def deceased_flag(spark, folder):
    outcomes = read_table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("er"), F.when(F.col("l_returnflag") == "R", "6").alias("ward")
    )
    flag = cleaning.deceased(F.col("er"), F.col("ward")).alias("deceased")
    return outcomes.groupBy("er", "ward", flag).agg(F.count(F.lit(1)).alias("n"))


def dated_lines(spark, folder):
    return read_table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("date")).alias("shipped"),
        "l_returnflag",
        "l_linestatus",
    )


def dedup_by_year(spark, folder):
    kept = cleaning.dedup_by_year(dated_lines(spark, folder), "shipped")
    return kept.withColumn("shipped", F.col("shipped").cast("string"))


def dedup_counts(spark, folder):
    return cleaning.duplicates_per_year(dated_lines(spark, folder), "shipped")


def priced_orders(spark, folder):
    """Orders whose amount arrives as text, with a marker instead of a number for one status."""
    amount = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_totalprice").cast("string"))
    return read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", amount.alias("amount"), "o_orderdate")


def age_window_filter(spark, folder):
    """Amount inside its range, date inside the study window."""
    kept = cleaning.range_filter(priced_orders(spark, folder), "amount", 1000, 300000)
    window = cleaning.within(
        F.col("o_orderdate"), F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31 23:59:59").cast("timestamp_ntz")
    )
    return kept.where(window).select("o_orderkey")


def audit_counts(spark, folder):
    orders = priced_orders(spark, folder)
    return aggregates.audit(orders, {
        "status": F.col("o_orderstatus") != "O",
        "amount": cleaning.within(F.col("amount").try_cast("double"), 1000, 300000),
        "window": F.year("o_orderdate").between(1996, 1998),
    })


def weekend_flag(spark, folder):
    ts = F.col("ts")
    return read_table(spark, folder, "events").select(
        "event_id", F.date_format(ts, "EEEE").alias("weekday"), F.when(recode.is_weekend(ts), "Weekend").otherwise("Weekday").alias("weekend")
    )


def time_band(spark, folder):
    return read_table(spark, folder, "events").select("event_id", recode.time_band(F.col("ts"), BAND_LABELS).alias("band"))


def recode_default(spark, folder):
    groups = {"es": "Romance", "fr": "Romance", "en": "Germanic", "de": "Germanic"}
    by_source = {f"src{i}": "first" for i in range(5)} | {f"src{i}": "second" for i in range(5, 10)}
    return read_table(spark, folder, "documents").select(
        "doc_id",
        recode.recode(F.col("lang"), groups).alias("family"),
        recode.recode(F.col("source"), by_source, F.lit("other")).alias("source_group"),
    )


def model_subset(spark, folder):
    rows = read_table(spark, folder, "lineitem").join(
        read_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("veh_desc")), "l_partkey"
    ).select("veh_desc", F.col("l_linenumber").cast("string").alias("injp"), F.col("l_returnflag").alias("status"))
    chosen = cleaning.model_subset(rows, "PROMO", {"1": "first", "2": "second"}, {"A": 1, "R": 0}, "status", "target")
    return chosen.groupBy("injp", "status", "target").agg(F.count(F.lit(1)).alias("n"))


def stack_reconciled(spark, folder):
    s = read_table(spark, folder, "supplier").drop("s_suppkey")
    c = read_table(spark, folder, "customer").drop("c_custkey", "c_mktsegment")
    renames = {"c_name": "s_name", "c_nationkey": "s_nationkey", "c_acctbal": "s_acctbal"}
    return tables.stack_reconciled(s, c, renames)


def people_with_gaps(spark, folder):
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") > 3, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_nationkey") < 20, F.col("c_mktsegment")).when(F.col("c_nationkey") < 23, "").alias("segment"),
    )


def missing_pattern(spark, folder):
    return aggregates.missing_pattern(people_with_gaps(spark, folder), ["balance", "segment"])


def impute_mean_mode(spark, folder):
    filled = cleaning.impute(people_with_gaps(spark, folder), ["balance"], ["segment"])
    return filled.withColumn("balance", F.round("balance", 4))


def impute_median(spark, folder):
    filled = cleaning.impute(people_with_gaps(spark, folder), ["balance"], ["segment"], how="median")
    return filled.withColumn("balance", F.round("balance", 4))


def timed_orders(spark, folder):
    """Order amounts read as seconds and written as race times, some with the minutes in the hours' place."""
    def hms(seconds, zero_last):
        first, second = F.floor(seconds / 60), F.lpad((seconds % 60).cast("string"), 2, "0")
        short = F.concat_ws(":", first.cast("string"), second, F.lit("00"))
        full = F.concat_ws(":", F.floor(seconds / 3600).cast("string"), F.lpad((F.floor(seconds / 60) % 60).cast("string"), 2, "0"), second)
        return F.when(zero_last & (seconds >= 600) & (seconds < 5940), short).otherwise(full)

    swim = F.floor(F.col("o_totalprice") / 100)
    division = F.when(F.col("o_orderstatus") == "F", "M25-29").when(F.col("o_orderstatus") == "O", "MPRO").otherwise("FPC")
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        hms(swim, F.lit(True)).alias("swim"),
        hms(F.floor(F.col("o_totalprice")), F.lit(False)).alias("overall"),
        division.alias("division"),
    )


def race_time_fix(spark, folder):
    group = divisions.age_group(F.col("division"))
    return timed_orders(spark, folder).select(
        "o_orderkey",
        timestamps.seconds_of(timestamps.repair_minutes(F.col("swim"))).alias("swim_seconds"),
        timestamps.seconds_of(F.col("overall")).alias("overall_seconds"),
        group.alias("age_group"),
        divisions.lower_bound(group).alias("age_from"),
    ).withColumn("transition", F.col("overall_seconds") - F.col("swim_seconds"))


def year_totals(spark, folder, year):
    orders = read_table(spark, folder, "orders").where(F.year("o_orderdate") == year)
    total = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total")
    return orders.groupBy("o_custkey").agg(total, F.count(F.lit(1)).cast("int").alias("orders"))


def yoy_match(spark, folder):
    """Customers active in both years whose activity changed plausibly."""
    matched = relational.match_periods(
        year_totals(spark, folder, 1996), year_totals(spark, folder, 1997), ["o_custkey"], ("_1996", "_1997"),
        {
            "orders": (F.col("orders_1997") - F.col("orders_1996")).between(0, 3),
            "gain": F.col("total_1997") - F.col("total_1996") <= 800000,
            "loss": F.col("total_1996") - F.col("total_1997") <= 500000,
        },
    )
    return matched.withColumns({c: F.col(c).cast("double") for c in ("total_1996", "total_1997")})


def _buyers(spark, folder, year):
    return read_table(spark, folder, "orders").where(F.year("o_orderdate") == year).select(F.col("o_custkey").alias("c_custkey"))


def membership_flag(spark, folder):
    people = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    return relational.membership_flag(people, _buyers(spark, folder, 1997), ["c_custkey"], "bought_1997")


def anti_reconcile(spark, folder):
    people = read_table(spark, folder, "customer").select("c_custkey", "c_name")
    return relational.anti(people, _buyers(spark, folder, 1997), ["c_custkey"])


def stratified_sample(spark, folder):
    """Exactly 20 % of each kind of event: the class sizes are checked against SQL."""
    picked = cleaning.sample_exact(read_table(spark, folder, "events"), ["event_type"], 0.2, ["event_id"])
    return picked.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("distinct_n"))


RISKS = [f"risk{i}" for i in range(1, 6)]
BRANCHES = [f"br{i}" for i in range(1, 6)]
STUDY = ("2024-01-05", "2024-01-25 23:59:59")


def raw_records(spark, folder):
    """Events rendered as an all-text record file: two date layouts, places by name, by id or by neither, junk codes, copies."""
    ts, n, user = F.col("ts"), F.col("event_id"), F.col("user_id")
    text = F.when(F.col("event_type").isin("click", "view"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    risks = {c: F.element_at(F.array(*[F.lit(x) for x in ("0", "1", "2", "9", "N", "")]), ((n + i) % 6 + 1).cast("int")) for i, c in enumerate(RISKS)}
    hurt = {c: F.when((n + i) % 7 == 0, "1").when((n + i) % 5 != 0, "0") for i, c in enumerate(BRANCHES)}
    rows = read_table(spark, folder, "events").select(
        "event_id",
        text.otherwise(F.date_format(ts, "M/d/yyyy h:mm:ss a")).alias("adate"),
        F.lit(None).cast("string").alias("atime"),
        F.when(n % 4 != 0, F.concat(F.lit("NATION_"), (user % 25).cast("string"))).otherwise("??").alias("prov"),
        (user % 27).cast("string").alias("aplace"),
        (n % 3).cast("string").alias("sex"),
        F.when(n % 17 == 0, "x").otherwise((n % 113 - 3).cast("string")).alias("age"),
        F.lpad((n % 11 + 1).cast("string"), 2, "0").alias("injt"),
        F.when(n % 5 == 0, "1").when(n % 5 == 1, "2").when(n % 5 == 2, "N").when(n % 5 == 4, "3").alias("injp"),
        F.when(n % 3 == 1, "N").when(n % 3 == 2, "1").alias("mass_casualty"),
        (n % 8).cast("string").alias("staer"),
        (user % 8).cast("string").alias("staward"),
        *[c.alias(name) for name, c in (risks | hurt).items()],
    )
    return rows.unionByName(rows.where("event_id % 10 = 0"))


def _cleaned_records(spark, folder):
    """Cleaned once and stored, as the rules that follow read the parsed times again and again."""
    nation, region = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("name"), F.col("r_name").alias("label"))
    ids = nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    cleaned = cleaning.clean_records(
        raw_records(spark, folder), names, ids, RISKS, ["N", "2", "9", "999", "902"], ["901", "902", "999"],
        ["atime", "aplace", "staer", "staward", *BRANCHES],
    )
    return checkpointed(cleaned)


def study_table(spark, folder):
    """The record pipeline from text files to the study table."""
    vehicles = read_table(spark, folder, "nation").where("n_nationkey <= 6").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    labels = {1: "Yes", 0: "No", cleaning.MISSING: "Unknown"}
    status = {c: (f"status{c[-1]}", labels) for c in RISKS}
    study = cleaning.study_records(_cleaned_records(spark, folder), vehicles, *STUDY, status, BAND_LABELS)
    return study.withColumn("adate", F.date_format("adate", MINUTE))


def _study_rules():
    return {
        "sex": ~F.col("sex").eqNullSafe(cleaning.REMOVED_SEX),
        "age": cleaning.within(F.col("age"), *cleaning.AGES),
        "window": cleaning.within(F.col("adate"), *[F.lit(t).cast("timestamp_ntz") for t in STUDY]),
    }


def study_audit(spark, folder):
    """What each rule of the study removes."""
    return aggregates.audit(_cleaned_records(spark, folder), _study_rules())


def study_rejects(spark, folder):
    """A seeded sample of twenty rejected records, checked by its size and by whether each fails a rule."""
    rules = _study_rules()
    passes = rules["sex"] & rules["age"] & rules["window"]
    rejected = _cleaned_records(spark, folder).where(~passes)
    sample = cleaning.sample_rows(rejected, 20, ["event_id"])
    return sample.agg(F.count(F.lit(1)).alias("n"), F.sum(passes.cast("int")).alias("passing"))


QUERIES = {
    f.__name__: f
    for f in (
        std_timestamp, merged_timestamp, place_lookup_fallback, learn_dimension, code_cleanup, deceased_flag, dedup_by_year,
        dedup_counts, age_window_filter, audit_counts, weekend_flag, time_band, recode_default, model_subset, stack_reconciled,
        missing_pattern, impute_mean_mode, impute_median, race_time_fix, yoy_match, membership_flag, anti_reconcile,
        stratified_sample, study_table, study_audit, study_rejects,
    )
}

_RECORDS = """WITH e AS (
  SELECT *, date_trunc('minute', ts) AS moment, CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 113 - 3 AS DOUBLE) END AS age FROM events
  UNION ALL SELECT *, date_trunc('minute', ts), CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 113 - 3 AS DOUBLE) END FROM events WHERE event_id % 10 = 0
), k AS (
  SELECT e.*, r.r_name AS prov FROM e
  JOIN nation n ON CASE WHEN event_id % 4 <> 0 THEN n.n_name = 'NATION_' || (user_id % 25) ELSE n.n_nationkey = user_id % 27 END
  JOIN region r ON n.n_regionkey = r.r_regionkey
), c AS (
  SELECT count(*) AS n0, count(*) FILTER (WHERE event_id % 3 <> 0) AS n1, count(*) FILTER (WHERE event_id % 3 <> 0 AND age BETWEEN 0 AND 100) AS n2,
    count(*) FILTER (WHERE event_id % 3 <> 0 AND age BETWEEN 0 AND 100 AND moment BETWEEN '2024-01-05' AND '2024-01-25 23:59:59') AS n3 FROM k
)
"""
_STATUS = ", ".join(
    f"CASE (event_id + {i}) % 6 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE 'Unknown' END AS status{i + 1}" for i in range(5)
)
_HURT = " OR ".join(f"(event_id + {i}) % 7 = 0" for i in range(5))
_GAPS = """WITH g AS (SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN c_acctbal END AS balance,
  CASE WHEN c_nationkey < 20 THEN c_mktsegment WHEN c_nationkey < 23 THEN '' END AS segment FROM customer)
"""
_MODE = "(SELECT segment FROM g WHERE segment <> '' GROUP BY segment ORDER BY COUNT(*) DESC, segment LIMIT 1)"
_PRICED = """WITH q AS (SELECT o_orderkey, o_orderstatus, o_orderdate,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS amount FROM orders)
"""
_DATED = """WITH d AS (SELECT l_suppkey, CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS shipped, l_returnflag, l_linestatus FROM lineitem)
"""
_YEARS = """WITH a AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS t, COUNT(*) AS n FROM orders WHERE YEAR(o_orderdate) = 1996 GROUP BY 1),
b AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS t, COUNT(*) AS n FROM orders WHERE YEAR(o_orderdate) = 1997 GROUP BY 1)
"""

ORACLE = {
    "std_timestamp": """
SELECT event_id, strftime(CASE WHEN event_type = 'error' AND DAY(ts) <= 12
  THEN make_timestamp(YEAR(ts), DAY(ts), MONTH(ts), HOUR(ts), MINUTE(ts), 0.0) ELSE ts END, '%Y-%m-%d %H:%M') AS parsed FROM events""",
    "merged_timestamp": """
SELECT event_id, strftime(CASE WHEN HOUR(ts) = 0 THEN DATE_TRUNC('day', ts) ELSE ts END, '%Y-%m-%d %H:%M') AS merged FROM events""",
    "place_lookup_fallback": """
SELECT c_custkey, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment <> 'FURNITURE'""",
    "learn_dimension": "SELECT source, arg_max(lang, doc_id) AS lang FROM documents WHERE lang <> 'en' GROUP BY source",
    "code_cleanup": """
SELECT event_id, CASE WHEN k IN (0, 90, 99) THEN 9999 ELSE k END AS code
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "deceased_flag": """
SELECT er, ward, CAST(er IN ('1', '6') OR COALESCE(ward = '6', FALSE) AS INTEGER) AS deceased, COUNT(*) AS n
FROM (SELECT CAST(l_linenumber AS VARCHAR) AS er, CASE WHEN l_returnflag = 'R' THEN '6' END AS ward FROM lineitem) GROUP BY 1, 2, 3""",
    "dedup_by_year": _DATED
    + """, x AS (SELECT DISTINCT * FROM d WHERE shipped IS NOT NULL UNION ALL SELECT * FROM d WHERE shipped IS NULL)
SELECT l_suppkey, CAST(shipped AS VARCHAR) AS shipped, l_returnflag, l_linestatus FROM x""",
    "dedup_counts": _DATED
    + """SELECT CAST(YEAR(shipped) AS INTEGER) AS year, COUNT(*) AS rows_before, COUNT(*) - COUNT(DISTINCT (l_suppkey, shipped, l_returnflag, l_linestatus)) AS removed
FROM d WHERE shipped IS NOT NULL GROUP BY 1""",
    "age_window_filter": _PRICED
    + "SELECT o_orderkey FROM q WHERE amount BETWEEN 1000 AND 300000 AND YEAR(o_orderdate) BETWEEN 1996 AND 1998",
    "audit_counts": _PRICED
    + """, k AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (WHERE o_orderstatus <> 'O') AS n1,
  COUNT(*) FILTER (WHERE o_orderstatus <> 'O' AND amount BETWEEN 1000 AND 300000) AS n2,
  COUNT(*) FILTER (WHERE o_orderstatus <> 'O' AND amount BETWEEN 1000 AND 300000 AND YEAR(o_orderdate) BETWEEN 1996 AND 1998) AS n3 FROM q)
SELECT 1 AS step, 'status' AS rule, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM k
UNION ALL SELECT 2, 'amount', n1, n2, n1 - n2 FROM k UNION ALL SELECT 3, 'window', n2, n3, n2 - n3 FROM k""",
    "weekend_flag": """
SELECT event_id, dayname(ts) AS weekday, CASE WHEN (isodow(ts) = 5 AND HOUR(ts) >= 19) OR isodow(ts) IN (6, 7)
  OR (isodow(ts) = 1 AND HOUR(ts) < 2) THEN 'Weekend' ELSE 'Weekday' END AS weekend FROM events""",
    "time_band": """
SELECT event_id, CASE WHEN HOUR(ts) >= 22 OR HOUR(ts) < 2 THEN '22-01' WHEN HOUR(ts) < 6 THEN '02-05' WHEN HOUR(ts) < 10 THEN '06-09'
  WHEN HOUR(ts) < 14 THEN '10-13' WHEN HOUR(ts) < 18 THEN '14-17' ELSE '18-21' END AS band FROM events""",
    "recode_default": """
SELECT doc_id, CASE WHEN lang IN ('es', 'fr') THEN 'Romance' WHEN lang IN ('en', 'de') THEN 'Germanic' ELSE lang END AS family,
  CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'first' WHEN source IN ('src5', 'src6', 'src7', 'src8', 'src9') THEN 'second'
  ELSE 'other' END AS source_group FROM documents""",
    "model_subset": """
SELECT CASE l_linenumber WHEN 1 THEN 'first' ELSE 'second' END AS injp, l_returnflag AS status,
  CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS target, COUNT(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO' AND l_linenumber IN (1, 2) AND l_returnflag IN ('A', 'R') GROUP BY 1, 2, 3""",
    "stack_reconciled": """
SELECT s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT c_name, c_nationkey, c_acctbal FROM customer""",
    "missing_pattern": _GAPS
    + "SELECT CAST(balance IS NULL AS INTEGER) AS balance, CAST(segment IS NULL AS INTEGER) AS segment, COUNT(*) AS n FROM g GROUP BY 1, 2",
    "impute_mean_mode": _GAPS
    + f"""SELECT c_custkey, ROUND(COALESCE(balance, (SELECT AVG(balance) FROM g)), 4) AS balance,
  COALESCE(NULLIF(segment, ''), {_MODE}) AS segment FROM g""",
    "impute_median": _GAPS
    + f"""SELECT c_custkey, ROUND(COALESCE(balance, (SELECT MEDIAN(balance) FROM g)), 4) AS balance,
  COALESCE(NULLIF(segment, ''), {_MODE}) AS segment FROM g""",
    "race_time_fix": """
SELECT o_orderkey, FLOOR(o_totalprice / 100) AS swim_seconds, FLOOR(o_totalprice) AS overall_seconds,
  CASE o_orderstatus WHEN 'F' THEN '25-29' WHEN 'O' THEN '99-99' ELSE '98-98' END AS age_group,
  CAST(CASE o_orderstatus WHEN 'F' THEN 25 WHEN 'O' THEN 99 ELSE 98 END AS DOUBLE) AS age_from,
  FLOOR(o_totalprice) - FLOOR(o_totalprice / 100) AS transition FROM orders""",
    "yoy_match": _YEARS
    + """SELECT o_custkey, CAST(a.t AS DOUBLE) AS total_1996, CAST(a.n AS INTEGER) AS orders_1996, CAST(b.t AS DOUBLE) AS total_1997,
  CAST(b.n AS INTEGER) AS orders_1997 FROM a JOIN b USING (o_custkey)
WHERE b.n - a.n BETWEEN 0 AND 3 AND b.t - a.t <= 800000 AND a.t - b.t <= 500000""",
    "membership_flag": """
SELECT c_custkey, c_name, CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE YEAR(o_orderdate) = 1997) AS INTEGER) AS bought_1997 FROM customer""",
    "anti_reconcile": """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE YEAR(o_orderdate) = 1997)""",
    "study_table": _RECORDS
    + f"""SELECT DISTINCT event_id, prov, CAST(event_id % 3 AS VARCHAR) AS sex, age, CAST(event_id % 11 + 1 AS VARCHAR) AS injt,
  CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 4 THEN '3' ELSE '9999' END AS injp,
  CASE event_id % 3 WHEN 2 THEN '1' ELSE '0' END AS mass_casualty, CAST(({_HURT}) AS INTEGER) AS head_injury,
  CAST(event_id % 8 IN (1, 6) OR user_id % 8 = 6 AS INTEGER) AS deceased, strftime(moment, '%Y-%m-%d %H:%M') AS adate,
  CASE WHEN event_id % 11 < 6 THEN 'NATION_' || (event_id % 11 + 1) ELSE 'Other than Specified' END AS veh_desc,
  CAST(year(moment) AS INTEGER) AS "year", dayname(moment) AS weekday,
  CASE WHEN (isodow(moment) = 5 AND hour(moment) >= 19) OR isodow(moment) IN (6, 7) OR (isodow(moment) = 1 AND hour(moment) < 2) THEN 'Weekend' ELSE 'Weekday' END AS weekend,
  CASE WHEN hour(moment) >= 22 OR hour(moment) < 2 THEN '22-01' WHEN hour(moment) < 6 THEN '02-05' WHEN hour(moment) < 10 THEN '06-09'
    WHEN hour(moment) < 14 THEN '10-13' WHEN hour(moment) < 18 THEN '14-17' ELSE '18-21' END AS time_category, {_STATUS}
FROM k WHERE event_id % 3 <> 0 AND age BETWEEN 0 AND 100 AND moment BETWEEN '2024-01-05' AND '2024-01-25 23:59:59'""",
    "study_audit": _RECORDS
    + """SELECT 1 AS step, 'sex' AS rule, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM c
UNION ALL SELECT 2, 'age', n1, n2, n1 - n2 FROM c UNION ALL SELECT 3, 'window', n2, n3, n2 - n3 FROM c""",
    "study_rejects": _RECORDS + "SELECT CAST(20 AS BIGINT) AS n, CAST(0 AS BIGINT) AS passing FROM c WHERE n0 - n3 >= 20",
    "stratified_sample": """
SELECT event_type, CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS n, CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS distinct_n FROM events GROUP BY 1""",
}
