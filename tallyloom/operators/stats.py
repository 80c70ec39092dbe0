"""Correlation, classification measures and least squares."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations, product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import running_before


def corr_long(df: DataFrame, cols: Sequence[str], high: float = 0.9) -> DataFrame:
    """Correlation of every pair of columns, all in one aggregate, and whether it marks collinearity."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows))).withColumn("collinear", (F.abs("r") >= high).cast("int"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def auc(df: DataFrame, label: str, score: str, slots: int = 1024, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by the rank-sum rule, tied scores counting half; one row, or one per group of ``by``.

    Rows are first reduced to one per score, so ranks are running sums over score ranges, never one global sort.
    """
    counted = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    ranked = running_before(counted, by, "_s", ["pos", "neg"], slots)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    losses = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    return ranked.groupBy(*by).agg(F.try_divide(wins, wins + losses).alias("auc"))


def ols_univariate(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """One simple regression per predictor, all from one aggregate; rows with a missing member are left out pairwise."""
    def fit(i: int, x: str) -> list[Column]:
        args = (F.col(y), F.col(x))
        return [
            F.regr_slope(*args).alias(f"slope{i}"), F.regr_intercept(*args).alias(f"intercept{i}"),
            F.regr_r2(*args).alias(f"r2{i}"), F.regr_count(*args).alias(f"n{i}"),
            F.regr_sxx(*args).alias(f"sxx{i}"), F.regr_syy(*args).alias(f"syy{i}"),
        ]

    wide = df.agg(*[c for i, x in enumerate(xs) for c in fit(i, x)])
    rows = [
        F.struct(F.lit(x).alias("term"), *[F.col(f"{part}{i}").alias(part) for part in ("slope", "intercept", "r2", "n", "sxx", "syy")])
        for i, x in enumerate(xs)
    ]
    error = F.sqrt((1 - F.col("r2")) * F.col("syy") / (F.col("n") - 2) / F.col("sxx"))
    return wide.select(F.inline(F.array(*rows))).withColumn("std_error", error).drop("sxx", "syy")


def fit_errors(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """In-sample mean absolute percentage error and root mean squared error."""
    gap = F.col(y) - F.col(predicted)
    return df.agg((F.avg(F.abs(gap / F.col(y))) * 100).alias("mape"), F.sqrt(F.avg(gap * gap)).alias("rmse"))


@dataclass(frozen=True)
class Formula:
    """Predictors of one model: numeric columns, categorical ones with their base level (None: the first), and products of two."""

    numeric: tuple[str, ...] = ()
    categorical: Mapping[str, str | None] = field(default_factory=dict)
    products: tuple[tuple[str, str], ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class Fit:
    """Estimates by term with errors and intervals (null where a term is a combination of others), and the quality in one row."""

    coefficients: list[tuple]
    quality: tuple
    predicted: Column


COEFFICIENTS = "term string, estimate double, std_error double, t_value double, p_value double, low double, high double"
QUALITY = "n long, parameters int, r2 double, adjusted_r2 double, aic double, rmse double"
ALIASED = 1e-11  # a term with less than this share of its variation left is a combination of the others


class CrossProducts:
    """Everything that least squares on any of some columns needs, from one aggregate over the rows.

    Rows are grouped by the categorical columns and by which columns are missing; a group keeps counts, means and co-moments of
    its numbers, which Spark merges without loss of digits. A dummy is constant in a group, so the cross-products of all terms of
    a formula, dummies and products included, are sums over groups: however many levels there are, no list of them is made first
    and no column added. Each formula uses the rows that have all of its own columns. The driver holds a row per group.
    """

    def __init__(self, df: DataFrame, y: str, formulas: Sequence[Formula]):
        self.spark, self.y = df.sparkSession, y
        self.categorical = sorted({c for f in formulas for c in f.categorical})
        pairs = {tuple(sorted(p)) for f in formulas for p in f.products if set(p) <= set(f.numeric)}
        self.plain = sorted({c for f in formulas for c in f.numeric})
        self.numbers = [y, *self.plain, *[f"{a}:{b}" for a, b in sorted(pairs)]]
        self.factors = [(y,), *[(c,) for c in self.plain], *sorted(pairs)]
        number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in (y, *self.plain)}
        number |= {f"{a}:{b}": number[a] * number[b] for a, b in sorted(pairs)}
        missing = {f"_m{i}": number[c].isNull() for i, c in enumerate((y, *self.plain))}
        framed = df.select(*self.categorical, *[number[c].alias(f"_x{i}") for i, c in enumerate(self.numbers)], *[m.alias(n) for n, m in missing.items()])
        k = len(self.numbers)
        means = [F.avg(f"_x{i}").alias(f"_a{i}") for i in range(k)]
        moments = [F.covar_pop(f"_x{i}", f"_x{j}").alias(f"_c{i}_{j}") for i in range(k) for j in range(i, k)]
        self.groups = framed.groupBy(*self.categorical, *missing).agg(F.count(F.lit(1)).alias("_n"), *means, *moments).collect()

    def _terms(self, formula: Formula, groups: list) -> dict[str, tuple[int | None, dict[str, object]]]:
        """Terms by name: the number they multiply, if any, and the levels they stand for."""
        parts: dict[str, dict[str, tuple]] = {c: {c: (self.numbers.index(c), {})} for c in formula.numeric}
        for c, base in formula.categorical.items():
            levels = sorted({g[c] for g in groups})
            left = levels[0] if base is None and levels else base
            parts[c] = {f"{c}={v}": (None, {c: v}) for v in levels if v != left}
        terms = {name: term for part in parts.values() for name, term in part.items()}
        for a, b in formula.products:
            for (left, (x, one)), (right, (z, two)) in product(parts[a].items(), parts[b].items()):
                both = self.factors.index(tuple(sorted((left, right)))) if x is not None and z is not None else (z if x is None else x)
                terms[f"{left}:{right}"] = (both, {**one, **two})
        return terms

    def fit(self, formula: Formula, confidence: float = 0.95) -> Fit:
        wanted = {i for i, c in enumerate((self.y, *self.plain)) if c == self.y or c in formula.numeric}
        groups = [g for g in self.groups if not any(g[f"_m{i}"] for i in wanted) and all(g[c] is not None for c in formula.categorical)]
        terms = self._terms(formula, groups)
        columns = [(0, {}), *terms.values()]  # the response comes first
        k, size = len(self.numbers), len(columns)
        n = sum(g["_n"] for g in groups)
        at = np.array([k if x is None else x for x, _ in columns])
        means, squares, counts = np.zeros((len(groups), size)), np.zeros((size, size)), np.array([g["_n"] for g in groups], float)
        for place, g in enumerate(groups):
            on = np.array([all(g[c] == v for c, v in levels.items()) for _, levels in columns], float)
            average = np.array([*[g[f"_a{i}"] or 0.0 for i in range(k)], 1.0])
            moment = np.zeros((k + 1, k + 1))
            for i in range(k):
                for j in range(i, k):
                    moment[i, j] = moment[j, i] = g[f"_c{i}_{j}"] or 0.0
            means[place] = on * average[at]
            here = np.flatnonzero(on)
            squares[np.ix_(here, here)] += g["_n"] * moment[np.ix_(at[here], at[here])]
        centre = counts @ means / n if n else np.zeros(size)
        off = means - centre
        return self._solve(list(terms), squares + (off * counts[:, None]).T @ off, centre, n, confidence, columns)

    def _solve(self, names: list[str], s: np.ndarray, centre: np.ndarray, n: int, confidence: float, columns: list) -> Fit:
        """Sweep every term in; what is left of the response is the residual, the swept block the inverse."""
        total, start = float(s[0, 0]), np.diag(s).copy()
        swept = []
        for i in range(1, len(s)):
            if s[i, i] > ALIASED * start[i]:
                s = sweep(s, i)
                swept.append(i)
        p, rest = len(swept) + 1, max(float(s[0, 0]), 0.0)
        inverse = -s[np.ix_(swept, swept)]
        estimates = s[swept, 0]
        free = n - p
        variance = rest / free if free > 0 else math.nan
        reach = self._student(free).inverseCumulativeProbability(0.5 + confidence / 2) if free > 0 else math.nan
        level = centre[0] - estimates @ centre[swept]
        found = dict(zip(swept, zip(estimates, np.diag(inverse))))
        rows = [self._row(name, *found.get(i, (None, None)), variance, reach, free) for i, name in enumerate(names, 1)]
        rows.append(self._row("(intercept)", level, 1 / n + centre[swept] @ inverse @ centre[swept] if n else 0.0, variance, reach, free))
        r2 = 1 - rest / total if total > 0 else math.nan
        adjusted = 1 - (1 - r2) * (n - 1) / free if free > 0 else math.nan
        aic = n * math.log(rest / n) + 2 * p if n and rest > 0 else math.nan
        predicted = F.lit(float(level))
        for i, estimate in zip(swept, estimates):
            number, levels = columns[i]
            value = F.lit(float(estimate))
            if number is not None:
                for part in self.factors[number]:
                    value = value * F.col(part)
            for c, v in levels.items():
                value = value * (F.col(c) == F.lit(v)).cast("double")
            predicted = predicted + value
        return Fit(rows, (n, p, r2, adjusted, aic, math.sqrt(rest / n) if n else math.nan), predicted)

    def _student(self, free: int):
        return self.spark.sparkContext._jvm.org.apache.commons.math3.distribution.TDistribution(float(free))

    def _row(self, name: str, estimate, scale, variance: float, reach: float, free: int) -> tuple:
        if estimate is None:
            return (name, *[None] * 6)
        error = math.sqrt(max(scale * variance, 0.0)) if free > 0 else math.nan
        t = estimate / error if error else math.nan
        p_value = 2 * (1 - self._student(free).cumulativeProbability(abs(t))) if free > 0 and error else math.nan
        return (name, *map(float, (estimate, error, t, p_value, estimate - reach * error, estimate + reach * error)))


def sweep(s: np.ndarray, i: int) -> np.ndarray:
    """Sweep one row and column of a symmetric matrix; swept rows hold minus the inverse and the estimates."""
    column = s[:, i] / s[i, i]
    out = s - np.outer(column, s[i, :])
    out[:, i] = out[i, :] = column
    out[i, i] = -1 / s[i, i]
    return out


@dataclass(frozen=True)
class Ols:
    """A fitted least-squares model: coefficient table, one-row quality table, and the rows with their fitted values."""

    coefficients: DataFrame
    quality: DataFrame
    fitted: DataFrame


def ols(
    df: DataFrame, y: str, numeric: Sequence[str], categorical: Mapping[str, str | None] | None = None,
    interactions: Sequence[tuple[str, str]] = (), confidence: float = 0.95,
) -> Ols:
    """Multiple regression from one aggregate over the rows that have all its columns."""
    formula = Formula(tuple(numeric), dict(categorical or {}), tuple(interactions))
    fit = CrossProducts(df, y, [formula]).fit(formula, confidence)
    spark = df.sparkSession
    fitted = df.dropna(subset=[y, *formula.columns]).withColumn("fitted", fit.predicted)
    return Ols(spark.createDataFrame(fit.coefficients, COEFFICIENTS), spark.createDataFrame([fit.quality], QUALITY), fitted)


def ols_table(df: DataFrame, y: str, formulas: Mapping[str, Formula]) -> DataFrame:
    """Quality of several formulas side by side, all from one aggregate."""
    shared = CrossProducts(df, y, list(formulas.values()))
    rows = [(name, *shared.fit(formula).quality) for name, formula in formulas.items()]
    return df.sparkSession.createDataFrame(rows, f"model string, {QUALITY}")
