"""Average treatment effects in the overlap population, with cluster-robust errors.

The effect is the weighted regression of outcome residuals on treatment residuals,
tau = sum(w dW dY) / sum(w dW^2). With stratum means as the nuisance part, both sums follow
from arm totals per stratum, so rows are reduced once, before the only wide shuffle, and
all KPIs, segments and errors are worked out on the strata.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import Z_975, ci_text, q, quoted, significance, text
from liftlens.operators.matching import with_stratum
from liftlens.operators.scale import cut_lineage, running_sum

OVERALL = "Overall"
MIN_ROWS = 5
NOISE = 1e-12  # a squared error below this share of its terms is rounding: the fit is exact


def confidence_interval(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Add bounds, the interval as text, and whether it excludes zero."""
    z = Z_975 if alpha == 0.05 else NormalDist().inv_cdf(1 - alpha / 2)
    ate, margin = F.col("Average_treatment_effect"), F.col("Standard_Error") * F.lit(z)
    return (
        df.withColumn("ci_low", ate - margin)
        .withColumn("ci_high", ate + margin)
        .withColumn("CI", ci_text(F.col("ci_low"), F.col("ci_high")))
        .withColumn("Significance", significance(F.col("ci_low"), F.col("ci_high")))
    )


def _moments(df: DataFrame, keys, kpis, treat: str, weight: str, squares: bool) -> DataFrame:
    """Arm totals per key: rows, and per KPI the weights and weighted outcomes (with
    `squares` also those of squared weights). Rows without the KPI do not count for it.
    `weight` is SQL text."""
    return df.groupBy(*[q(k) for k in keys]).agg(
        *[F.expr(e) for e in _moment_sums(kpis, treat, weight, squares)])


def _moment_sums(kpis, treat: str, weight: str, squares: bool) -> list[str]:
    t = quoted(treat)
    sums = [f"count_if({t} = {a}) AS __n{a}" for a in (1, 0)]
    for i, k in enumerate(kpis):
        y = f"CAST({quoted(k)} AS DOUBLE)"
        for a in (1, 0):
            cell = lambda e: f"sum(CASE WHEN {t} = {a} AND {y} IS NOT NULL THEN {e} END)"
            sums += [f"{cell(weight)} AS __w{a}_{i}", f"{cell(f'{weight} * {y}')} AS __y{a}_{i}"]
            if squares:
                ww = f"{weight} * {weight}"
                sums += [f"{cell(ww)} AS __v{a}_{i}", f"{cell(f'{ww} * {y}')} AS __u{a}_{i}",
                         f"{cell(f'{ww} * {y} * {y}')} AS __z{a}_{i}"]
    return sums


def _merge(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = [c for c in moments.columns if c not in set(keys)]
    return moments.groupBy(*[q(k) for k in keys]).agg(*[F.sum(c).alias(c) for c in sums])


def _by_kpi(moments: DataFrame, keys, kpis, squares: bool) -> DataFrame:
    letters = "wyvuz" if squares else "wy"
    rows = ", ".join(
        f"struct({text(k)} AS KPI, " + ", ".join(
            f"coalesce(__{s}{a}_{i}, 0D) AS __{s}{a}" for s in letters for a in (1, 0)) + ")"
        for i, k in enumerate(kpis))
    return moments.selectExpr(
        *[quoted(k) for k in keys], "__n1", "__n0", f"inline(array({rows}))")


def _score_sums(strata: DataFrame, keys, squares: bool) -> DataFrame:
    """Per stratum: a = sum(w dW dY), b = sum(w dW^2), and the squares of their terms, which
    are the stratum itself (clusters) or each row (no clusters). dW is 1 - p for treated and
    -p for controls, with p and m the stratum's weighted means of treatment and outcome."""
    keep = [quoted(k) for k in [*keys, "KPI"]] + ["__n1", "__n0"]
    s = strata.selectExpr("*", "__w1 > 0 AND __w0 > 0 AS __both").selectExpr(
        "*", "CASE WHEN __both THEN __w1 / (__w1 + __w0) END AS __p",
        "CASE WHEN __both THEN (__y1 + __y0) / (__w1 + __w0) END AS __m")
    first = ["__y1 * (1 - __p) - __y0 * __p AS __a",
             "CASE WHEN __both THEN __w1 * __w0 / (__w1 + __w0) END AS __b"]
    if not squares:
        return s.selectExpr(*keep, "__both", *first).selectExpr(
            *keep, "__a", "__b", "__a * __a AS __aa", "__a * __b AS __ab", "__b * __b AS __bb",
            "CASE WHEN __both THEN 1 ELSE 0 END AS __g")

    def arms(power: int, term: str) -> str:
        treated, control = term.replace("#", "1"), term.replace("#", "0")
        sign = "-" if power % 2 else "+"
        return f"pow(1 - __p, {power}) * ({treated}) {sign} pow(__p, {power}) * ({control})"

    return s.selectExpr(
        *keep, *first,
        arms(2, "__z# - 2 * __m * __u# + __m * __m * __v#") + " AS __aa",
        arms(3, "__u# - __m * __v#") + " AS __ab", arms(4, "__v#") + " AS __bb",
        "CASE WHEN __both THEN __n1 + __n0 ELSE 0 END AS __g")


TOTALS = ("a", "b", "aa", "ab", "bb")


def _estimate(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """Effect and error from group totals of `_score_sums` over __g independent units."""
    keep = [quoted(c) for c in by]
    spread = "__aa - 2 * __tau * __ab + __tau * __tau * __bb"
    noise = f"{NOISE!r}D * (__aa + __tau * __tau * __bb)"
    tau = sums.selectExpr("*", "try_divide(__a, __b) AS __tau")
    return tau.selectExpr(
        "*", f"CASE WHEN {spread} > {noise} THEN {spread} ELSE 0D END AS __spread"
    ).selectExpr(
        *keep,
        "__n AS n_rows",
        "__g AS n_clusters",
        "__tau AS Average_treatment_effect",
        "try_divide(sqrt(__spread * try_divide(__g, __g - 1)), __b) AS Standard_Error",
        f"""CASE WHEN __n < {MIN_ROWS} THEN 'fewer than {MIN_ROWS} rows'
            WHEN __b IS NULL OR __b <= 0 THEN 'no overlap' END AS reason""",
    )


def _finish(moments: DataFrame, by, cluster: str, kpis, squares: bool, keep_skipped: bool):
    keys = [*by, cluster]
    strata = _score_sums(_by_kpi(moments, keys, kpis, squares), keys, squares)
    sums = strata.groupBy(*[q(c) for c in by], "KPI").agg(
        F.expr("sum(__n1 + __n0) AS __n"), F.expr("sum(__g) AS __g"),
        *[F.expr(f"sum(__{c}) AS __{c}") for c in TOTALS])
    out = _estimate(sums, [*by, "KPI"])
    return out if keep_skipped else out.where(F.col("reason").isNull())


def _share_auc(moments: DataFrame, by: Sequence[str]) -> DataFrame:
    """AUC of the treated share of each stratum as a propensity, per group."""
    share = F.expr("__n1 / (__n1 + __n0)").alias("__s")
    scores = moments.groupBy(*[q(c) for c in by], share).agg(
        F.expr("CAST(sum(__n1) AS DOUBLE) AS __pos"), F.expr("CAST(sum(__n0) AS DOUBLE) AS __neg"))
    return running_sum(cut_lineage(scores), by, "__s", ["__neg"]).groupBy(*[q(c) for c in by]).agg(F.expr(
        """try_divide(sum(__pos * (before___neg + __neg / 2)), sum(__pos) * sum(__neg)) AS auc"""))


def overlap_effect(
    df: DataFrame,
    kpis: Sequence[str],
    treat: str,
    cluster: str,
    by: Sequence[str] = (),
    weight: str | None = "weights",
    clustered: bool = True,
    with_auc: bool = False,
    keep_skipped: bool = False,
) -> DataFrame:
    """Effect of `treat` on every KPI per group, nuisance = weighted means of the stratum
    `cluster` inside the group. Errors are robust by stratum, or by row if not `clustered`.
    Groups of fewer than 5 rows or without overlap are skipped (or kept with a reason)."""
    w = quoted(weight) if weight else "1D"
    moments = _moments(df, [*by, cluster], kpis, treat, w, not clustered)
    out = _finish(moments, list(by), cluster, kpis, not clustered, keep_skipped)
    return out.join(_share_auc(moments, by), list(by)) if with_auc and by else out


def effect_by_treatment(
    df: DataFrame, kpis: Sequence[str], treat: str, cluster: str, **kw
) -> DataFrame:
    effects = overlap_effect(df, kpis, treat, cluster, ["treatment_id"], **kw)
    return effects.withColumn("Segment_Name", F.lit(OVERALL)).withColumn("Segment", F.lit(OVERALL))


def effect_by_segment(
    df: DataFrame,
    kpis: Sequence[str],
    treat: str,
    cluster: str,
    segments: Sequence[str],
    weight: str | None = "weights",
    clustered: bool = True,
    with_auc: bool = False,
    keep_skipped: bool = True,
) -> DataFrame:
    """Effects per treatment and segment value, and overall. Rows are first reduced to
    (treatment, segment values, stratum); only those totals are repeated per segment column.
    Groups of fewer than 5 rows or without overlap are kept with a reason, or skipped if not
    `keep_skipped`."""
    w = quoted(weight) if weight else "1D"
    squares = not clustered
    cells = _moments(df, ["treatment_id", *segments, cluster], kpis, treat, w, squares)
    return _segment_effects(cells, kpis, cluster, segments, squares, with_auc, keep_skipped)


def _segment_effects(cells: DataFrame, kpis, cluster: str, segments, squares, with_auc, keep):
    groups = ", ".join(
        [f"struct('{OVERALL}' AS Segment_Name, '{OVERALL}' AS Segment)"]
        + [f"struct({text(s)} AS Segment_Name, CAST({quoted(s)} AS STRING) AS Segment)"
           for s in segments])
    by = ["treatment_id", "Segment_Name", "Segment"]
    kept = [c for c in cells.columns if c not in set(segments)]
    moments = _merge(
        cells.selectExpr(*[quoted(c) for c in kept], f"inline(array({groups}))"), [*by, cluster])
    moments = moments.where(F.col("Segment").isNotNull())
    out = _finish(moments, by, cluster, kpis, squares, keep)
    return out.join(_share_auc(moments, by), by) if with_auc else out


def cem_effects(
    df: DataFrame,
    kpis: Sequence[str],
    treat: str,
    covariates: Sequence[str],
    rules: Mapping,
    segments: Sequence[str],
    keep_skipped: bool = True,
) -> DataFrame:
    """`effect_by_segment` of `cem_match`, without making the matched rows.

    A control's matching weight depends on its stratum only. So rows are reduced straight to
    arm totals per (treatment, segment values, stratum), the strata are counted on those
    totals, and the weights scale the control totals. No row is joined or shuffled; the
    exchange carries totals combined inside each task.
    """
    placed = with_stratum(df, covariates, rules)
    cells = cut_lineage(
        _moments(placed, ["treatment_id", *segments, "subclass"], kpis, treat, "1D", False))
    return _segment_effects(
        _matched_cells(cells, kpis), kpis, "subclass", segments, False, False, keep_skipped)


def _matched_cells(cells: DataFrame, kpis: Sequence[str]) -> DataFrame:
    """The arm totals of strata with both arms, those of controls by their matching weight."""
    both = cells.groupBy("subclass").agg(
        F.sum("__n1").alias("__t"), F.sum("__n0").alias("__c")
    ).where((F.col("__t") > 0) & (F.col("__c") > 0))
    ratio = both.agg(F.sum("__c") / F.sum("__t")).first()[0]
    scaled = {f"__{s}0_{i}" for s in "wy" for i in range(len(kpis))}
    return cells.join(both, "subclass").selectExpr(*[
        f"{c} * (__t / __c * {ratio or 0.0!r}D) AS {c}" if c in scaled else quoted(c)
        for c in cells.columns])


def both_effects(
    df: DataFrame,
    kpis: Sequence[str],
    treat: str,
    covariates: Sequence[str],
    rules: Mapping,
    segments: Sequence[str],
    weight: str,
) -> tuple[DataFrame, DataFrame]:
    """The fit on matched rows (clustered by stratum) and the fit of all rows by their `weight`
    (by row), each with the AUC of its strata and with the groups that have no effect.

    Both come from one table of arm totals per (treatment, segment values, stratum), which
    carries the moments of both weight systems: rows are read once and joined with nothing."""
    placed = with_stratum(df, covariates, rules)
    keys = ["treatment_id", *segments, "subclass"]
    own = _moment_sums(kpis, treat, "1D", False)
    other = [e.replace(" AS __", " AS __v_") for e in _moment_sums(kpis, treat, quoted(weight), True)]
    cells = cut_lineage(placed.groupBy(*[q(k) for k in keys]).agg(*[F.expr(e) for e in [*own, *other]]))
    names = [c for c in cells.columns if c not in keys]
    plain = cells.select(*[q(k) for k in keys], *[c for c in names if not c.startswith("__v_")])
    weighed = cells.select(*[q(k) for k in keys],
                           *[F.col(c).alias("__" + c[4:]) for c in names if c.startswith("__v_")])
    return (
        _segment_effects(_matched_cells(plain, kpis), kpis, "subclass", segments, False, True, True),
        _segment_effects(weighed, kpis, "subclass", segments, True, True, True))


def residual_effect(
    df: DataFrame,
    by: Sequence[str],
    dy: str,
    dw: str,
    weight: str,
    cluster: str,
    keep_skipped: bool = True,
) -> DataFrame:
    """The same effect from given row residuals (for instance of cross-fitted forests),
    centred per group. Five sums per cluster and their products per group are enough: the
    centring constants enter afterwards, so no second pass or join is needed."""
    w, y, d = quoted(weight), quoted(dy), quoted(dw)
    terms = {"s": w, "w": f"{w} * {d}", "y": f"{w} * {y}", "x": f"{w} * {d} * {y}",
             "d": f"{w} * {d} * {d}"}
    keep = [q(c) for c in by]
    per_cluster = df.groupBy(*keep, q(cluster)).agg(
        F.count("*").alias("__n"), *[F.expr(f"sum({e}) AS __{k}") for k, e in terms.items()])
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    groups = per_cluster.groupBy(*keep).agg(
        F.sum("__n").alias("__n"), F.count("*").alias("__g"),
        *[F.expr(f"sum(__{k}) AS __t_{k}") for k in names],
        *[F.expr(f"sum(__{a} * __{b}) AS __p_{a}{b}") for a, b in pairs])
    groups = groups.selectExpr("*", "__t_w / __t_s AS __mw", "__t_y / __t_s AS __my")
    # centred sums as linear forms in the five terms
    forms = {"a": {"s": "__mw * __my", "w": "-__my", "y": "-__mw", "x": "1D"},
             "b": {"s": "__mw * __mw", "w": "-2 * __mw", "d": "1D"}}

    def total(f: dict) -> str:
        return " + ".join(f"({e}) * __t_{k}" for k, e in f.items())

    def product(f: dict, g: dict) -> str:
        return " + ".join(f"({e}) * ({h}) * __p_{min(k, m, key=names.index)}"
                          f"{max(k, m, key=names.index)}"
                          for k, e in f.items() for m, h in g.items())

    a, b = forms["a"], forms["b"]
    sums = groups.selectExpr(
        *[quoted(c) for c in by], "__n", "__g", total(a) + " AS __a", total(b) + " AS __b",
        product(a, a) + " AS __aa", product(a, b) + " AS __ab", product(b, b) + " AS __bb")
    out = _estimate(sums, by)
    return out if keep_skipped else out.where(F.col("reason").isNull())


def arbitrate(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Per group keep fit `a` (matched) if its propensity AUC is higher, else fit `b`. With
    `how` "full" a group that has one fit keeps that one."""
    values = ["Average_treatment_effect", "Standard_Error", "auc", "n_rows"]

    def packed(df: DataFrame, name: str):
        return df.select(*[q(k) for k in keys], F.struct(*values).alias(name))

    takes_a = F.col("b").isNull() | (F.col("a.auc") > F.col("b.auc"))
    pick = F.when(takes_a, F.col("a")).otherwise(F.col("b"))
    fit = F.when(takes_a, "matched").otherwise("weighted")
    joined = packed(a, "a").join(packed(b, "b"), list(keys), how)
    return joined.select(*[q(k) for k in keys], pick.alias("p"), fit.alias("fit"),
                         F.col("a.auc").alias("auc_matched"), F.col("b.auc").alias("auc_weighted")
                         ).select(*[q(k) for k in keys], "p.*", "fit", "auc_matched",
                                  "auc_weighted")


def as_effect_table(effects: DataFrame, *more: str) -> DataFrame:
    """The published columns, with numeric bounds beside the interval text, and `more`."""
    return confidence_interval(effects).select(
        "KPI", "treatment_id", "Segment_Name", "Segment", "Average_treatment_effect",
        "Standard_Error", "ci_low", "ci_high", "CI", "Significance", *more)

