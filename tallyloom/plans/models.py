"""Model questions: five folds, full numbers of draws and trials; the spaces of settings are parameters."""

from __future__ import annotations

import random

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyloom.operators import models, parzen, stats
from tallyloom.session import fingerprint, read_table

NUMERIC, CATEGORICAL, LABEL, KEY = ["n_chars"], ["lang", "source"], "quality", ["doc_id"]
AREA = dict(labelCol=LABEL, metricName="areaUnderROC")


def labelled(spark, folder):
    """Documents with a quality label; the text itself is never read."""
    docs = read_table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source")
    return read_table(spark, folder, "labels").select("doc_id", "quality").join(docs, "doc_id").withColumn("n_chars", F.col("n_chars").cast("double"))


FOLDS = 5


def encoding() -> Pipeline:
    return Pipeline(stages=models.preprocess(NUMERIC, CATEGORICAL))


def folded(spark, folder):
    """Rows with folds, kept for every candidate; scaling and encoding are fitted on the training part of each fold."""
    return models.packed(models.with_folds(labelled(spark, folder), LABEL, FOLDS, KEY))


def encoded(spark, folder):
    """All rows with their feature vector, for models that are fitted on all rows and read, not scored on others."""
    rows = labelled(spark, folder)
    return encoding().fit(rows).transform(rows).select(*KEY, LABEL, "features")


def _scores(spark, found, shown, measure="auc", extra=()):
    rows = [
        (*extra, *(str(next(v for p, v in settings.items() if p.name == name)) for name in shown), float(score))
        for settings, score in zip(found.grid, found.scores)
    ]
    names = ["predictors"] * len(extra) + shown
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + f", {measure} double")


def logreg_cv(spark, folder):
    """Cross-validated ROC AUC of logistic regression over penalty and number of selected features."""
    rows, parts = folded(spark, folder), []
    try:
        n = rows.count() * (FOLDS - 1) / FOLDS
        parts = models.fold_parts(rows, "fold", FOLDS, encoding())
        found = models.logistic_scores(parts, LABEL, models.LOGISTIC_FEATURES, models.LOGISTIC_STRENGTHS, n)
        table = [(str(k or "all"), float(c), score) for k, c, score in found]
    finally:
        models.release(parts)
        rows.unpersist()
    return spark.createDataFrame(table, "features string, strength double, auc double")


def logreg_coefficients(spark, folder):
    rows = encoded(spark, folder)
    model = models.logistic(LABEL, "features", 1.0, rows.count()).fit(rows)
    return models.importances(model, rows)


# A part of models.FOREST_GRID: forests that deep, with that many trees, take some 12 seconds each even on a few hundred rows, and the
# full grid 225 of them. ForestSearch takes any space.
GRID = {"numTrees": [10, 20, 30, 50], "maxDepth": [3, 8], "minInstancesPerNode": [1, 4], "featureSubsetStrategy": ["sqrt", "all"]}
_SEARCHES: dict[tuple[str, str], tuple[str, models.ForestSearch]] = {}


def forest_scores(spark, folder) -> models.ForestSearch:
    """Scores of forests on the folder's labelled documents. A session's searches share what any of them has scored, until a
    file changes; scaling and encoding are fitted on the training part of each fold."""
    key, state = (spark.sparkContext.applicationId, folder), fingerprint(spark, folder, "documents", "labels")
    if key not in _SEARCHES or _SEARCHES[key][0] != state:
        if key in _SEARCHES:
            models.release(_SEARCHES[key][1].parts)
        rows = folded(spark, folder)
        parts = models.fold_parts(rows, "fold", FOLDS, encoding())
        evaluator = BinaryClassificationEvaluator(**AREA)
        _SEARCHES[key] = state, models.ForestSearch(parts, LABEL, GRID["numTrees"], evaluator)
    return _SEARCHES[key][1]


def _searched(spark, settings, scores):
    rows = [(*(str(one[name]) for name in GRID), float(score)) for one, score in zip(settings, scores)]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in GRID) + ", auc double")


def rf_grid(spark, folder):
    """All 32 combinations of the four settings."""
    settings = models.settings_of(GRID)
    return _searched(spark, settings, forest_scores(spark, folder).score_all(settings))


def rf_random_search(spark, folder):
    """Twenty seeded draws from the same space."""
    settings = random.Random(42).sample(models.settings_of(GRID), 20)
    return _searched(spark, settings, forest_scores(spark, folder).score_all(settings))


def rf_sequential_search(spark, folder):
    """Fifty trials over the same space, proposed by Parzen estimators."""
    search = forest_scores(spark, folder)
    trials = parzen.sequential_search(search.score, GRID, trials=50, open_trials=2)
    table = [(i + 1, *(str(t[name]) for name in GRID), float(score)) for i, (t, score) in enumerate(trials)]
    return spark.createDataFrame(table, "place int, " + ", ".join(f"{n} string" for n in GRID) + ", auc double")


def _forest_on(rows, **settings):
    return models.forest(LABEL, **settings).fit(rows)


def rf_importance(spark, folder):
    rows = encoded(spark, folder)
    return models.importances(_forest_on(rows, numTrees=20, maxDepth=5), rows, top=10)


ENTRIES = [f"e{i}" for i in range(64)]
CHOSEN = 10  # predictors of the smaller model, chosen by their F statistic inside each training part


def _embedded(spark, folder):
    return read_table(spark, folder, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].alias(c) for i, c in enumerate(ENTRIES)])


WIDTHS = ["log2", "sqrt", "onethird", "all"]  # numbers of predictors tried at a split; the searches over documents vary more


def _forest_of_all():
    return models.forest("label", numTrees=20, maxDepth=8)


def _forest_of_chosen():
    selector = models.select_best(CHOSEN, "label")
    return Pipeline(stages=[selector, models.forest("label", features="selected", numTrees=20, maxDepth=8)])


def _candidates():
    """Both kinds of predictors, each with every split width."""
    all_of_them, chosen = _forest_of_all(), _forest_of_chosen()
    return [(all_of_them, models.grid_of(all_of_them, {"featureSubsetStrategy": WIDTHS})), (chosen, models.grid_of(chosen.getStages()[-1], {"featureSubsetStrategy": WIDTHS}))]


def _assembled():
    return VectorAssembler(inputCols=ENTRIES, outputCol="features")


def rf_multiclass_cv(spark, folder):
    """Accuracy of a forest on all predictors and on ten chosen ones, by cross-validation, over the number tried at a split."""
    rows = models.packed(_assembled().transform(models.with_folds(_embedded(spark, folder), "label", FOLDS, ["vec_id"])).select("label", "fold", "features"))
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    tables = []
    for name, (estimator, grid) in zip(("all", "chosen"), _candidates()):
        found = models.search(rows, estimator, grid, evaluator, "fold", FOLDS, refit=False)
        tables.append(_scores(spark, found, ["featureSubsetStrategy"], "accuracy", (name,)))
    rows.unpersist()
    return tables[0].unionByName(tables[1])


def nested_predictions(spark, folder):
    """Every row predicted once, by a model that never saw it: kind of predictors and split width are searched inside each outer fold."""
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    rows = _assembled().transform(_embedded(spark, folder)).select("vec_id", "label", "features")
    return models.nested_cv(rows, _candidates(), evaluator, "label", ["vec_id"]).predictions


def nested_confusion(spark, folder):
    """Labels against the nested predictions."""
    return stats.confusion(nested_predictions(spark, folder), "label", "prediction")


def nested_coverage(spark, folder):
    """Rows per label and outer fold: each row is predicted once, the folds are balanced in every class."""
    found = nested_predictions(spark, folder)
    per_fold = found.groupBy("label", "outer").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("vec_id").alias("ids"))
    return per_fold.groupBy("label").agg(
        F.sum("n").alias("predicted"), F.sum("ids").alias("rows"), (F.max("n") - F.min("n") <= 1).alias("balanced")
    )


def model_compare(spark, folder):
    rows = encoded(spark, folder)
    fits = {
        "logistic": (models.logistic(LABEL, "features", 1.0, rows.count()).fit(rows), "ridge-penalised logistic regression"),
        "forest": (_forest_on(rows, numTrees=20, maxDepth=5), "random forest, 20 trees"),
    }
    return models.compare(fits, rows, LABEL)


def _whole_model(rows):
    return Pipeline(stages=[*models.preprocess(NUMERIC, CATEGORICAL), models.forest(LABEL, numTrees=10, maxDepth=5)]).fit(rows)


def pdp_category(spark, folder):
    rows = models.packed(labelled(spark, folder))
    names = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
    return models.partial_dependence(_whole_model(rows), rows, "lang", None, NUMERIC + CATEGORICAL, names)


def pdp_numeric(spark, folder):
    rows = models.packed(labelled(spark, folder))
    return models.partial_dependence(_whole_model(rows), rows, "n_chars", models.numeric_grid(rows, "n_chars"), NUMERIC + CATEGORICAL)


def _vectors(spark, folder):
    wide = read_table(spark, folder, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])
    return models.scaled_vectors(wide, [f"e{i}" for i in range(64)])


def kmeans_k_sweep(spark, folder):
    return models.choose_k(_vectors(spark, folder), "scaled", range(2, 31))


def kmeans_totals(spark, folder):
    """Squares within and between the clusters of every k add up to the same total."""
    raw = read_table(spark, folder, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("x"))
    found = models.choose_k(raw, "x", range(2, 31))
    return found.select("k", "n", F.round(F.col("within") + F.col("between"), 3).alias("total"))


def bisecting_groups(spark, folder):
    """Three groups from the top down, against the known labels."""
    return models.groups(models.packed(_vectors(spark, folder).select("label", "scaled")), "scaled", 3).groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))


def ols_multi(spark, folder):
    fit = stats.ols(read_table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"])
    return fit.coefficients.select("term", F.round("estimate", 3).alias("estimate"))


WITH_PRODUCT = stats.Formula(("l_quantity", "l_discount"), {"l_returnflag": "N"}, (("l_returnflag", "l_quantity"),))


def ols_coefficients(spark, folder):
    """Price on quantity, discount and return flag with the flag's products: estimates, errors and intervals."""
    lines = read_table(spark, folder, "lineitem")
    fit = stats.ols(lines, "l_extendedprice", WITH_PRODUCT.numeric, WITH_PRODUCT.categorical, WITH_PRODUCT.products)
    numbers = [F.round(c, 2).alias(c) for c in ("estimate", "std_error", "t_value", "p_value", "low", "high")]
    return fit.coefficients.select("term", *numbers)


def ols_simple(spark, folder):
    """Price on quantity: estimates with their errors, and the quality of the fit, in one row."""
    fit = stats.ols(read_table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity"])
    of = lambda term, column: F.round(F.max(F.when(F.col("term") == term, F.col(column))), 4)
    terms = fit.coefficients.agg(
        of("l_quantity", "estimate").alias("slope"), of("l_quantity", "std_error").alias("slope_error"), of("l_quantity", "t_value").alias("slope_t"),
        of("(intercept)", "estimate").alias("intercept"), of("(intercept)", "std_error").alias("intercept_error"),
    )
    quality = fit.quality.select("n", *[F.round(c, 4).alias(c) for c in ("r2", "adjusted_r2", "rmse")], F.round("aic", 1).alias("aic"))
    one = F.lit(1).alias("one")
    return terms.select("*", one).join(quality.select("*", one), "one").drop("one")


def ols_slopes(spark, folder):
    """Slope and level of price on quantity per return flag, put together from the products of one model."""
    lines = read_table(spark, folder, "lineitem")
    fit = stats.ols(lines, "l_extendedprice", ["l_quantity"], {"l_returnflag": "N"}, [("l_returnflag", "l_quantity")])
    flag = F.coalesce(F.nullif(F.regexp_extract("term", "l_returnflag=([^:]+)", 1), F.lit("")), F.lit("N"))
    kind = F.when(F.col("term").endswith("l_quantity"), "slope").otherwise("level")
    terms = fit.coefficients.select(flag.alias("flag"), kind.alias("kind"), "estimate")
    base = {k: F.max(F.when((F.col("flag") == "N") & (F.col("kind") == k), F.col("estimate"))) for k in ("slope", "level")}
    whole = terms.agg(F.struct(*[c.alias(k) for k, c in base.items()])).scalar()
    own = terms.groupBy("flag").agg(*[F.max(F.when(F.col("kind") == k, F.col("estimate"))).alias(k) for k in base]).withColumn("base", whole)
    return own.select("flag", *[F.round(F.col(k) + F.when(F.col("flag") == "N", 0.0).otherwise(F.col("base")[k]), 4).alias(k) for k in base])


def ols_models(spark, folder):
    """Adjusted R2, AIC and error of several formulas side by side, from one scan."""
    numbers = ("l_quantity", "l_discount", "l_tax")
    formulas = {
        "quantity": stats.Formula(("l_quantity",)),
        "all numbers": stats.Formula(numbers),
        "with flag": stats.Formula(numbers, {"l_returnflag": "N"}),
        "with product": WITH_PRODUCT,
    }
    found = stats.ols_table(read_table(spark, folder, "lineitem"), "l_extendedprice", formulas)
    return found.select("model", "n", "parameters", *[F.round(c, 6).alias(c) for c in ("r2", "adjusted_r2")], F.round("aic", 2).alias("aic"), F.round("rmse", 3).alias("rmse"))


QUERIES = {
    f.__name__: f
    for f in (
        logreg_cv, logreg_coefficients, rf_grid, rf_random_search, rf_sequential_search, rf_importance, rf_multiclass_cv, nested_confusion, nested_coverage, model_compare,
        pdp_category, pdp_numeric, kmeans_k_sweep, kmeans_totals, bisecting_groups, ols_multi, ols_simple, ols_slopes, ols_coefficients, ols_models,
    )
}

# Co-moments within a set of rows, as SQL; the response is y, the numbers are q, d and x.
_CO = "count(*) AS n, avg(y) AS my, avg(q) AS mq, avg(d) AS md, " + ", ".join(
    f"covar_pop({a}, {b}) * count(*) AS {a}{b}" for a, b in ("yy", "yq", "yd", "yx", "qq", "qd", "qx", "dd", "dx", "xx")
)
_LINES = "l AS (SELECT l_returnflag AS flag, l_extendedprice AS y, l_quantity AS q, l_discount AS d, l_tax AS x FROM lineitem)"


def _swept(table: str, by: str, left: str) -> str:
    """Co-moments after one number has been taken out of the others."""
    kept = [f"{a}{b}" for i, a in enumerate(left) for b in left[i:]]
    pair = lambda a: "".join(sorted((a, by), key="yqdx".index))
    return f"SELECT {', '.join(f'{c} - {pair(c[0])} * {pair(c[1])} / {by}{by} AS {c}' for c in kept)} FROM {table}"


def _in_groups(left: str) -> str:
    return ", ".join(f"sum({a}{b}) AS {a}{b}" for i, a in enumerate(left) for b in left[i:])


ORACLE = {
    "kmeans_totals": """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS place FROM embeddings),
t AS (SELECT place, var_pop(v) * count(*) AS squares, count(*) AS n FROM e GROUP BY place)
SELECT CAST(k AS INTEGER) AS k, any_value(n) AS n, ROUND(sum(squares), 3) AS total FROM t, range(2, 31) AS r(k) GROUP BY k""",
    # The products give each flag a slope of its own, so only the discount ties the groups together.
    "ols_coefficients": f"""
WITH {_LINES}, g AS (SELECT flag, {_CO} FROM l GROUP BY flag),
w AS (SELECT sum(yd - yq * qd / qq) AS num, sum(dd - qd * qd / qq) AS den, sum(n) AS n, sum(yy - yq * yq / qq) AS own FROM g),
v AS (SELECT num / den AS b, den, n - 7 AS free, (own - num * num / den) / (n - 7) AS s2 FROM w),
k AS (SELECT flag, (yq - b * qd) / qq AS slope, my - mq * (yq - b * qd) / qq - b * md AS level, qd / qq AS k, md - mq * qd / qq AS e,
  1 / qq AS slope_own, 1.0 / n + mq * mq / qq AS level_own FROM g, v),
t AS (
  SELECT 'l_discount' AS term, b AS estimate, sqrt(s2 / den) AS std_error FROM v
  UNION ALL SELECT 'l_quantity', slope, sqrt(s2 * (slope_own + k * k / den)) FROM k, v WHERE flag = 'N'
  UNION ALL SELECT '(intercept)', level, sqrt(s2 * (level_own + e * e / den)) FROM k, v WHERE flag = 'N'
  UNION ALL SELECT 'l_returnflag=' || a.flag, a.level - z.level, sqrt(s2 * (a.level_own + z.level_own + (a.e - z.e) ** 2 / den))
    FROM k a, k z, v WHERE a.flag <> 'N' AND z.flag = 'N'
  UNION ALL SELECT 'l_returnflag=' || a.flag || ':l_quantity', a.slope - z.slope, sqrt(s2 * (a.slope_own + z.slope_own + (a.k - z.k) ** 2 / den))
    FROM k a, k z, v WHERE a.flag <> 'N' AND z.flag = 'N'
), u AS (  -- quantile and tail of Student's t by their expansions in the degrees of freedom around the normal ones
  SELECT *, estimate / std_error AS t_value, 1.959963984540054 AS z, free FROM t, v
), r AS (
  SELECT *, z + (z ** 3 + z) / (4 * free) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * free ** 2) AS reach,
    abs(t_value) * (1 - 1 / (4 * free)) / sqrt(1 + t_value ** 2 / (2 * free)) AS a FROM u
), h AS (SELECT *, 1 / (1 + 0.2316419 * a) AS c FROM r)
SELECT term, ROUND(estimate, 2) AS estimate, ROUND(std_error, 2) AS std_error, ROUND(t_value, 2) AS t_value,
  ROUND(2 * exp(-a * a / 2) / sqrt(2 * pi()) * (0.319381530 * c - 0.356563782 * c ** 2 + 1.781477937 * c ** 3 - 1.821255978 * c ** 4 + 1.330274429 * c ** 5), 2) AS p_value,
  ROUND(estimate - reach * std_error, 2) AS low, ROUND(estimate + reach * std_error, 2) AS high FROM h""",
    "ols_models": f"""
WITH {_LINES}, a AS (SELECT {_CO} FROM l), g AS (SELECT flag, {_CO} FROM l GROUP BY flag),
q1 AS ({_swept("a", "q", "ydx")}), q2 AS ({_swept("q1", "d", "yx")}), q3 AS ({_swept("q2", "x", "y")}),
f0 AS (SELECT {_in_groups("yqdx")} FROM g), f1 AS ({_swept("f0", "q", "ydx")}), f2 AS ({_swept("f1", "d", "yx")}), f3 AS ({_swept("f2", "x", "y")}),
p0 AS ({_swept("g", "q", "yd")}), p1 AS (SELECT {_in_groups("yd")} FROM p0), p2 AS ({_swept("p1", "d", "y")}),
m AS (SELECT 'quantity' AS model, 2 AS p, yy AS rest FROM q1 UNION ALL SELECT 'all numbers', 4, yy FROM q3
  UNION ALL SELECT 'with flag', 6, yy FROM f3 UNION ALL SELECT 'with product', 7, yy FROM p2)
SELECT model, n, p AS parameters, ROUND(1 - rest / yy, 6) AS r2, ROUND(1 - rest / yy * (n - 1) / (n - p), 6) AS adjusted_r2,
  ROUND(n * ln(rest / n) + 2 * p, 2) AS aic, ROUND(sqrt(rest / n), 3) AS rmse FROM m, a""",
    "ols_simple": """
WITH m AS (SELECT count(*) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
  regr_sxy(l_extendedprice, l_quantity) AS sxy, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
r AS (SELECT *, sxy / sxx AS b, syy - sxy * sxy / sxx AS rss FROM m)
SELECT ROUND(b, 4) AS slope, ROUND(sqrt(rss / (n - 2) / sxx), 4) AS slope_error, ROUND(b / sqrt(rss / (n - 2) / sxx), 4) AS slope_t,
  ROUND(my - b * mx, 4) AS intercept, ROUND(sqrt(rss / (n - 2) * (1.0 / n + mx * mx / sxx)), 4) AS intercept_error, n,
  ROUND(1 - rss / syy, 4) AS r2, ROUND(1 - rss / syy * (n - 1) / (n - 2), 4) AS adjusted_r2, ROUND(sqrt(rss / n), 4) AS rmse,
  ROUND(n * ln(rss / n) + 4, 1) AS aic FROM r""",
    "ols_slopes": """
SELECT l_returnflag AS flag, ROUND(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS level FROM lineitem GROUP BY 1""",
    "nested_coverage": "SELECT label, CAST(count(*) AS BIGINT) AS predicted, CAST(count(*) AS BIGINT) AS rows, TRUE AS balanced FROM embeddings GROUP BY label",
    "ols_multi": """
WITH m AS (SELECT covar_pop(l_extendedprice, l_quantity) AS y1, covar_pop(l_extendedprice, l_discount) AS y2, var_pop(l_quantity) AS s11,
  var_pop(l_discount) AS s22, covar_pop(l_quantity, l_discount) AS s12, AVG(l_extendedprice) AS my, AVG(l_quantity) AS m1, AVG(l_discount) AS m2 FROM lineitem),
b AS (SELECT *, (y1 * s22 - y2 * s12) / (s11 * s22 - s12 * s12) AS b1, (y2 * s11 - y1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)
SELECT 'l_quantity' AS term, ROUND(b1, 3) AS estimate FROM b UNION ALL SELECT 'l_discount', ROUND(b2, 3) FROM b
UNION ALL SELECT '(intercept)', ROUND(my - b1 * m1 - b2 * m2, 3) FROM b""",
}
