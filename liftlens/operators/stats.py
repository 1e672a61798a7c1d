"""Statistics: variance inflation, holdout split, and the scores of fitted models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import q
from liftlens.operators.scale import cut_lineage, grouped_quantiles, lookup_join, running_sum

HASH_RANGE = 4294967296


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Sums of products of all column pairs over rows without nulls: one aggregate whose
    result is p x p whatever the number of rows."""
    cols = list(columns)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = (
        df.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
        .dropna()
        .agg(F.count("*").alias("n"),
             *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}") for i, j in pairs])
        .first()
    )
    g = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        g[i, j] = g[j, i] = row[f"g{i}_{j}"] or 0.0
    return g, row["n"]


def _vif(g: np.ndarray) -> np.ndarray:
    """Uncentred variance inflation from the Gram matrix; collinear columns get infinity."""
    scale = np.sqrt(np.diag(g))
    scale[scale == 0] = 1.0
    unit = g / np.outer(scale, scale)
    if np.linalg.matrix_rank(unit) < len(unit):
        out = np.empty(len(unit))
        for i in range(len(unit)):
            rest = [j for j in range(len(unit)) if j != i]
            fit = np.linalg.lstsq(unit[np.ix_(rest, rest)], unit[rest, i], rcond=None)[0]
            left = unit[i, i] - fit @ unit[rest, i]
            out[i] = np.inf if left <= 1e-12 else unit[i, i] / left
        return out
    return np.diag(unit) * np.diag(np.linalg.inv(unit))


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    g, _ = gram_matrix(df, columns)
    rows = [(c, float(v)) for c, v in zip(columns, _vif(g))]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def vif_prune(df: DataFrame, columns: Sequence[str], limit: float = 5.0) -> list[str]:
    """Columns left after dropping the worst until every inflation is below `limit`. Keys and
    the treated flag are not passed in. The result does not depend on the table's size."""
    keep = list(columns)
    g, _ = gram_matrix(df, keep)
    while len(keep) > 1:
        values = _vif(g)
        worst = int(np.argmax(values))
        if values[worst] < limit:
            break
        keep.pop(worst)
        g = np.delete(np.delete(g, worst, 0), worst, 1)
    return keep


def key_hash(key: Column) -> Column:
    """Number in [0, 2^32) from a whole-number key by multiplicative hashing."""
    small = F.pmod(key.cast("bigint"), F.lit(2147483648).cast("bigint"))
    return F.pmod(small * F.lit(2654435761).cast("bigint"), F.lit(HASH_RANGE).cast("bigint"))


def holdout_split(
    df: DataFrame, key: str, frac: float = 0.33, stratify: str | None = None, seed: int = 0
) -> DataFrame:
    """Add `is_test`. The side depends on the key alone, so it survives recomputation and
    keeps all rows of one key together. Text keys are hashed first.

    With `stratify` the cut is the exact hash quantile of each class, so that every class
    gives the same share; there may be any number of classes, and null is one.
    """
    numeric = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    base = q(key) if numeric else F.crc32(F.concat_ws(":", q(key), F.lit(seed)))
    if numeric and seed:
        base = base + F.lit(seed)
    names = [q(c) for c in df.columns]
    df = df.withColumn("__h", key_hash(base))
    if stratify is None:
        return df.withColumn(
            "is_test", (F.col("__h") < F.lit(frac * HASH_RANGE)).cast("int")).drop("__h")
    # the class as two columns that join without nulls
    df = df.withColumns({"__class": F.coalesce(q(stratify).cast("string"), F.lit("")),
                         "__none": q(stratify).isNull()})
    cuts = grouped_quantiles(df.select("__class", "__none", F.col("__h").alias("__cut")),
                             ["__class", "__none"], {"__cut": frac})
    split = lookup_join(df, cut_lineage(cuts), ["__class", "__none"])
    return split.select(*names, (F.col("__h") < F.col("__cut")).cast("int").alias("is_test"))


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*[q(c) for c in by])


def confusion_pct(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Actual by predicted class in % of all rows, two decimals, half-even."""
    cells = df.agg(*[F.count_if((q(y) == a) & (q(yhat) == p)).alias(f"n{a}{p}")
                     for a in (0, 1) for p in (0, 1)])
    total = F.expr("n00 + n01 + n10 + n11")
    pct = lambda a, p: F.bround(F.try_divide(F.col(f"n{a}{p}"), total) * 100, 2)
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), pct(a, 0).alias("predicted_0"),
                 pct(a, 1).alias("predicted_1"))
        for a in (0, 1)])))


def class_scores(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """F1 of the positive class and accuracy, from one pass of counts."""
    tp = F.count_if((q(y) == 1) & (q(yhat) == 1))
    wrong = F.count_if(q(y) != q(yhat))
    return _grouped(df, by).agg(
        F.try_divide(2 * tp, 2 * tp + wrong).alias("f1"),
        F.avg((q(y) == q(yhat)).cast("double")).alias("accuracy"),
        F.count("*").alias("n"),
    )


def r2(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Coefficient of determination. The spread about the mean is the population variance
    times n, which Spark merges stably, so one pass is enough."""
    scored = df.where(q(y).isNotNull() & q(yhat).isNotNull())
    miss = q(y) - q(yhat)
    return _grouped(scored, by).agg(
        (1 - F.try_divide(F.sum(miss * miss), F.var_pop(q(y)) * F.count("*"))).alias("r2"),
        F.count("*").alias("n"),
    )


def fit_corr(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of outcome and fit, its square, and the mean outcome."""
    return (
        _grouped(df, by)
        .agg(F.corr(q(yhat), q(y)).alias("__c"), F.avg(q(y)).alias("y_orig_mean"))
        .select(*[q(c) for c in by], (F.col("__c") * F.col("__c")).alias("y_r2"),
                F.abs("__c").alias("y_cor"), "y_orig_mean")
    )


def auc(df: DataFrame, y: str, score: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """Area under the ROC curve by ranks. Rows shrink to distinct scores first; the running
    count of negatives below each score is taken in distributed order."""
    counts = (
        df.where(q(score).isNotNull())
        .groupBy(*[q(c) for c in by], q(score).alias("__s"))
        .agg(F.sum(F.when(q(y) == 1, 1.0).otherwise(0.0)).alias("pos"),
             F.sum(F.when(q(y) == 1, 0.0).otherwise(1.0)).alias("neg"))
    )
    ranked = running_sum(cut_lineage(counts), by, "__s", ["neg"], **kw)
    wins = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    return _grouped(ranked, by).agg(
        F.try_divide(F.sum(wins), F.sum("pos") * F.sum("neg")).alias("auc"))
