"""Logistic and least squares models from sums over cells.

Rows with equal inputs become one cell, written once. Least squares needs one aggregate over the
cells, a logistic fit one per step of reweighting; only the p x p system reaches the driver. Fits
have closed forms or converge to one solution, so they can be checked in any engine.

Defined results: rows with a missing input or label do not train and get no prediction; collinear
terms share their effect (least norm); labels that the inputs separate stop after `STEPS` steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import q, quoted, text
from liftlens.operators.periods import treated_only
from liftlens.operators.scale import cut_lineage
from liftlens.operators.shape import GROUP
from liftlens.operators.stats import class_scores, holdout_split, r2

STEPS = 25
CLOSE = 1e-12  # relative step at which a logistic fit has converged


@dataclass(frozen=True)
class Term:
    """One column of the design: the input it belongs to and its value as SQL text."""

    feature: str
    value: str


@dataclass
class Linear:
    terms: list[Term]
    coefficients: np.ndarray
    logistic: bool

    def _sum(self, terms: Sequence[int]) -> str:
        return " + ".join(f"({self.terms[i].value}) * {float(self.coefficients[i])!r}D" for i in terms) or "0D"

    def predicted(self) -> Column:
        """The expected label of a row."""
        z = self._sum(range(len(self.terms)))
        return F.expr(f"1D / (1D + exp(-({z})))" if self.logistic else z)

    def importance(self, rows: DataFrame) -> DataFrame:
        """Per input: the spread over `rows` of what its terms add, as a share of all inputs'."""
        features = list(dict.fromkeys(t.feature for t in self.terms))
        own = {f: [i for i, t in enumerate(self.terms) if t.feature == f] for f in features}
        spread = rows.agg(*[F.expr(f"stddev_pop({self._sum(own[f])})").alias(f"s{i}")
                            for i, f in enumerate(features)]).first()
        values = [spread[f"s{i}"] or 0.0 for i in range(len(features))]
        total = sum(values) or 1.0
        return rows.sparkSession.createDataFrame(
            [(f, float(v / total)) for f, v in zip(features, values)], "feature string, importance double")


def design(df: DataFrame, numeric: Sequence[str], factors: Sequence[str] = (),
           within: str | None = None) -> list[Term]:
    """An intercept, the numeric inputs and 0/1 terms of the factors' levels but the first. With
    `within`, each level of that column has an intercept and slopes of its own."""
    levels = {c: sorted(r[0] for r in df.select(q(c).cast("string")).distinct().dropna().collect())
              for c in [*factors, *([within] if within else [])]}  # as many rows as terms
    is_level = lambda c, v: f"CASE WHEN CAST({quoted(c)} AS STRING) = {text(v)} THEN 1D WHEN {quoted(c)} IS NOT NULL THEN 0D END"
    slopes = [Term(c, f"CAST({quoted(c)} AS DOUBLE)") for c in numeric]
    slopes += [Term(c, is_level(c, v)) for c in factors for v in levels[c][1:]]
    if not within:
        return [Term("intercept", "1D"), *slopes]
    return [Term(t.feature if t.feature != "" else within, f"({is_level(within, v)}) * ({t.value})")
            for v in levels[within] for t in [Term("", "1D"), *slopes]]


def cells(df: DataFrame, terms: Sequence[Term], y: str) -> DataFrame:
    """x0, x1, ... with the rows n and the sum of labels y of all rows that have these values."""
    x = [f"x{i}" for i in range(len(terms))]
    rows = df.select(*[F.expr(t.value).alias(n) for t, n in zip(terms, x)], q(y).cast("double").alias("y"))
    return cut_lineage(rows.dropna().groupBy(*x).agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("y")))


def _system(table: DataFrame, p: int, weight: str, rest: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weight * x x' and of rest * x."""
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    row = table.agg(*[F.expr(f"sum(({weight}) * x{i} * x{j})") for i, j in pairs],
                    *[F.expr(f"sum(({rest}) * x{i})") for i in range(p)]).first()
    a = np.zeros((p, p))
    for (i, j), v in zip(pairs, row):
        a[i, j] = a[j, i] = v or 0.0
    return a, np.array([v or 0.0 for v in row[len(pairs):]])


def fit(df: DataFrame, terms: Sequence[Term], y: str, logistic: bool, steps: int = STEPS) -> Linear:
    table, p = cells(df, terms, y), len(terms)
    b = np.zeros(p)
    solve = lambda a, v: np.linalg.lstsq(a, v, rcond=1e-12)[0]
    if not logistic:
        return Linear(list(terms), solve(*_system(table, p, "n", "y")), False)
    for _ in range(steps):
        z = " + ".join(f"x{i} * {float(v)!r}D" for i, v in enumerate(b))
        chance = f"(1D / (1D + exp(-({z}))))"
        step = solve(*_system(table, p, f"n * {chance} * (1D - {chance})", f"y - n * {chance}"))
        b = b + step
        if np.abs(step).max() <= CLOSE * (1 + np.abs(b).max()):
            break
    return Linear(list(terms), b, True)


def cell_propensity(df: DataFrame, terms: Sequence[Term], treat: str = GROUP, key: str = "emp_id",
                    seed: int = 0) -> tuple[DataFrame, float | None, Linear]:
    """P(treated | inputs) of all rows, trained on two thirds of the keys; the F1 of the rest."""
    split = cut_lineage(holdout_split(df, key, seed=seed))
    model = fit(split.where(F.col("is_test") == 0), terms, treat, True)
    scored = split.withColumn("probability", model.predicted()).withColumn(
        "predictions", (F.col("probability") > 0.5).cast("int"))
    f1 = class_scores(scored.where(F.col("is_test") == 1), treat, "predictions").first()["f1"]
    return scored, f1, model


def cell_kpi(df: DataFrame, kpi: str, terms: Sequence[Term], treat: str = GROUP, key: str = "emp_id",
             seed: int = 0) -> tuple[DataFrame, float | None, Linear]:
    """The expected KPI of all rows, trained on the treated of two thirds of the keys; R2 of the
    treated of the rest."""
    split = cut_lineage(holdout_split(df, key, seed=seed))
    model = fit(treated_only(split, treat).where(F.col("is_test") == 0), terms, kpi, False)
    scored = split.withColumn("predictions", model.predicted())
    score = r2(treated_only(scored, treat).where(F.col("is_test") == 1), kpi, "predictions").first()["r2"]
    return scored, score, model
