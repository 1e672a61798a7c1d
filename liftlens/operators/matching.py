"""Coarsened exact matching: bins, strata, weights, balance, and the search over designs.

A row's stratum is the tuple of its bins. Everything the search needs is a sum per stratum,
so the only wide step is one aggregate per (design, stratum), combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import balance_tier, bin_of, q, quoted
from liftlens.operators.scale import (
    HotKeys,
    cut_lineage,
    exact_quantiles,
    key_hash64,
    most_hot_keys,
    quantile_sizes,
    skew_join,
    task_count,
)

# A rule is "q5" (5 quantile bins), "w3" (3 equal widths), "sturges" (the default),
# "log0.6" (geometric grid with that step; "log0.6:50" keeps cuts from 50 on instead of from
# LEAST_WIDTH) or a tuple of explicit cuts.
Rule = str | tuple
LEAST_WIDTH = 1000.0  # least cut of a geometric grid after its first


@dataclass(frozen=True)
class Design:
    """One matching design of the search."""

    number: int
    strategy: str
    name: str
    rules: dict[str, Rule] = field(hash=False)


def _log_grid(lo: float, hi: float, any_zero: bool, constant: float, min_width: float):
    """Geometric cuts from lo to past hi; with zeros the grid is shifted to start at 1."""
    shift = 1.0 - lo if any_zero else 0.0
    a, b = lo + shift, hi + shift
    if a <= 0:  # negative values and no zero: no logarithm exists
        return []
    step = math.log(1.0 + constant)
    count = math.floor((math.log(b) + step - math.log(a)) / step + 1e-10) + 1
    cuts = [lo] + [math.exp(math.log(a) + i * step) - shift for i in range(1, count)]
    return [c for i, c in enumerate(cuts) if i == 0 or c >= min_width]


def log_cutpoints(
    df: DataFrame, columns: Sequence[str], constant: float = 0.3, min_width: float = LEAST_WIDTH
) -> DataFrame:
    """(column_name, cut_no, cut) of the geometric grid; ranges from one aggregate, the grid
    expanded from it."""
    stats = df.agg(*[
        F.struct(F.min(q(c)).cast("double").alias("lo"), F.max(q(c)).cast("double").alias("hi"),
                 F.bool_or(q(c) == 0).alias("zero")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"s{i}.{f}").alias(f)
                                                   for f in ("lo", "hi", "zero")])
        for i, c in enumerate(columns)])))
    shift = F.when(F.col("zero"), 1.0 - F.col("lo")).otherwise(F.lit(0.0))
    step = math.log(1.0 + constant)
    shifted = stats.select("column_name", "lo", shift.alias("shift"),
                           (F.col("lo") + shift).alias("a"), (F.col("hi") + shift).alias("b"))
    last = F.floor((F.ln("b") + step - F.ln("a")) / step + 1e-10).cast("int")
    grid = shifted.where(F.col("a") > 0).select(
        "column_name", "lo", "shift", "a", F.explode(F.sequence(F.lit(0), last)).alias("cut_no"))
    cut = F.when(F.col("cut_no") == 0, F.col("lo")).otherwise(
        F.exp(F.ln("a") + F.col("cut_no") * step) - F.col("shift"))
    return grid.select("column_name", "cut_no", cut.alias("cut")).where(
        (F.col("cut_no") == 0) | (F.col("cut") >= min_width))


def cutpoints(df: DataFrame, rules: Mapping[str, Sequence[Rule]]) -> dict[tuple, list[float]]:
    """Sorted cuts for each (column, rule): one aggregate for ranges, one call for all
    quantiles. Only these numbers reach the driver."""
    columns = list(rules)
    if not columns:
        return {}
    binned = [c for c in columns if _quantile_sizes(rules[c])]
    row = df.agg(
        *quantile_sizes(binned),
        F.count("*").alias("n"),
        *[F.min(q(c)).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(q(c)).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)],
        *[F.bool_or(q(c) == 0).alias(f"z{i}") for i, c in enumerate(columns)],
    ).first()
    probs = {
        c: sorted({i / k for k in _quantile_sizes(rules[c]) for i in range(1, k)})
        for c in binned
    }
    quantiles = exact_quantiles(df, probs, sizes=row)
    by_prob = {c: dict(zip(probs[c], quantiles[c])) for c in binned}
    out = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        for rule in rules[c]:
            if not isinstance(rule, str):
                cuts = [float(x) for x in rule]
            elif lo is None:
                cuts = []
            elif rule.startswith("q"):
                k = int(rule[1:])
                cuts = [by_prob[c][j / k] for j in range(1, k)]
            elif rule.startswith("log"):
                step, _, width = rule[3:].partition(":")
                cuts = _log_grid(lo, hi, bool(row[f"z{i}"]), float(step), float(width or LEAST_WIDTH))
            else:
                k = int(rule[1:]) if rule != "sturges" else (row["n"] - 1).bit_length() + 1
                cuts = [lo + (hi - lo) * j / k for j in range(1, k)]
            out[c, rule] = sorted(set(cuts))
    return out


def _quantile_sizes(rules: Sequence[Rule]) -> set[int]:
    return {int(r[1:]) for r in rules if isinstance(r, str) and r.startswith("q")}


def coarsen(df: DataFrame, rules: Mapping[str, Rule], suffix: str = "_bin") -> DataFrame:
    """Add the bin number of each column. Categories are matched as they are."""
    cuts = cutpoints(df, {c: [r] for c, r in rules.items()})
    return df.withColumns({c + suffix: bin_of(c, cuts[c, r]) for c, r in rules.items()})


def split_covariates(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric covariates, which are binned, and the rest, which match exactly."""
    kinds = dict(df.dtypes)
    numeric = [c for c in columns
               if kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double")
               or kinds[c].startswith("decimal")]
    return numeric, [c for c in columns if c not in numeric]


def _label(parts: Sequence[Column]) -> Column:
    """Readable stratum name; separators inside values are escaped, so names are unique."""
    safe = [
        F.replace(F.replace(F.coalesce(p.cast("string"), F.lit("\\N")), F.lit("\\"),
                            F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        for p in parts
    ]
    return F.concat_ws("|", *safe)


def with_stratum(
    df: DataFrame, covariates: Sequence[str], rules: Mapping[str, Rule], name: str = "subclass"
) -> DataFrame:
    """Add the stratum of each row, whether matched or not: the bins of the numeric
    covariates (rule `sturges` if none is given) and the categories."""
    numeric, exact = split_covariates(df, covariates)
    rules = {c: rules.get(c, "sturges") for c in numeric}
    cuts = cutpoints(df, {c: [r] for c, r in rules.items()})
    parts = [bin_of(c, cuts[c, rules[c]]) for c in numeric] + [q(c) for c in exact]
    return df.withColumn(name, _label(parts))


def strata(df: DataFrame, treat: str, keys: Sequence[str]) -> DataFrame:
    """Treated and control counts of the strata that hold both."""
    return (
        df.groupBy(*[q(k) for k in keys])
        .agg(F.count_if(q(treat) == 1).alias("n_treated"),
             F.count_if(q(treat) == 0).alias("n_control"))
        .where((F.col("n_treated") > 0) & (F.col("n_control") > 0))
    )


def cem_match(
    df: DataFrame,
    treat: str,
    covariates: Sequence[str],
    rules: Mapping[str, Rule],
    match_within: str | None = None,
) -> DataFrame:
    """Matched rows with `subclass` and `weights` (treated 1; controls t_s/c_s x C/T, which
    sum to the number of matched controls). With `match_within`, each of its values is
    matched on its own. The join back to the rows is safe for hot strata."""
    pool = [match_within] if match_within else []
    placed = with_stratum(df, covariates, rules)
    keys = [*pool, "subclass"]
    both = cut_lineage(strata(placed, treat, keys))
    ratio = F.sum("n_control") / F.sum("n_treated")
    hot = _hot_strata(both, keys)
    if pool:
        scale = both.groupBy(q(match_within)).agg(ratio.alias("__scale"))
        both = both.join(scale, pool)
        per_pool = F.col("__scale")
    else:
        per_pool = F.lit(both.agg(ratio).first()[0]).cast("double")
    weight = F.col("n_treated") / F.col("n_control") * per_pool
    return (
        skew_join(placed, both.withColumn("__w", weight), keys, hot=hot)
        .withColumn("weights", F.when(q(treat) == 1, 1.0).otherwise(F.col("__w")))
        .select(*[q(c) for c in df.columns], "subclass", "weights")
    )


def _hot_strata(counted: DataFrame, keys: Sequence[str], min_rows: int = 100_000) -> HotKeys:
    """The largest strata; their sizes are known from the counts."""
    size = F.col("n_treated") + F.col("n_control")
    most = most_hot_keys(task_count(counted.sparkSession))
    top = counted.select(key_hash64(keys).alias("h"), size.alias("n")).orderBy(
        F.desc("n"), "h").limit(most).collect()
    total = counted.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    hot = HotKeys()
    hot.add(keys, [(r["h"], r["n"]) for r in top], max(total, 1),
            task_count(counted.sparkSession), min_rows)
    return hot


def designs(df: DataFrame, covariates: Sequence[str], least_width: float | None = None
            ) -> list[Design]:
    """The designs to search: quantile fifths on all; thirds on one covariate at a time; the
    0.6 geometric grid on one numeric covariate at a time; the 0.5 grid on the first numeric
    one, else fifths, one at a time; and 2 to 5 quantile or width bins on all. Covariates
    without a stated rule take the default. 9 + 3p designs for p covariates. `least_width` is the
    least cut of the grids after their first, for KPIs of another size."""
    numeric, _ = split_covariates(df, covariates)
    width = "" if least_width is None else f":{least_width:g}"
    out = [("match_result1", "q5", {c: "q5" for c in numeric})]
    for c in covariates:
        out.append(("match_result2", f"{c}_q3", {c: "q3"}))
    for c in covariates:
        out.append(("match_result3", f"{c}_log0.6", {c: f"log0.6{width}"}))
    for c in covariates:
        rule = "log0.5" if numeric and c == numeric[0] else "q5"
        out.append(("match_result4", f"{c}_{rule}", {c: rule + width * (rule != "q5")}))
    for kind in ("q", "w"):
        for k in range(2, 6):
            out.append(("match_result5", f"{kind}_{k}", {c: f"{kind}{k}" for c in numeric}))
    return [
        Design(i + 1, s, n, {c: r.get(c, "sturges") for c in numeric})
        for i, (s, n, r) in enumerate(out)
    ]


def _packed(index: Mapping[tuple, int], sizes: Mapping[tuple, int], rules) -> list[str]:
    """Bins of one design as mixed-radix whole numbers (SQL text): exact, one or two longs."""
    words, word, room = [], "0L", 1
    for key in rules.items():
        if room * sizes[key] > 2**62:
            words.append(word)
            word, room = "0L", 1
        word = f"({word} * {sizes[key]}L + `__b{index[key]}` + 1)"
        room *= sizes[key]
    return [*words, word]


def design_strata(
    df: DataFrame,
    treat: str,
    covariates: Sequence[str],
    search: Mapping[int, Mapping[str, Rule]],
    pool: Sequence[str] = (),
) -> DataFrame:
    """Per rule set and stratum: arm sizes and covariate sums by arm. One shuffle; the keys
    are exact, not hashed."""
    numeric, exact = split_covariates(df, covariates)
    needed = {c: sorted({r[c] for r in search.values()}, key=str) for c in numeric}
    cuts = cutpoints(df, needed)
    index = {key: i for i, key in enumerate(cuts)}
    sizes = {key: len(v) + 2 for key, v in cuts.items()}
    binned = df.select(
        *[q(c) for c in dict.fromkeys([*pool, treat, *covariates])],
        *[bin_of(c, cuts[c, r]).alias(f"__b{i}") for (c, r), i in index.items()],
    )
    packed = {n: _packed(index, sizes, r) for n, r in search.items()}
    width = max(len(p) for p in packed.values())
    structs = ", ".join(
        f"struct({n} AS __design, "
        + ", ".join(f"{w} AS __key{i}" for i, w in enumerate(p + ["0L"] * (width - len(p))))
        + ")"
        for n, p in packed.items())
    t, kept = quoted(treat), [q(c) for c in dict.fromkeys([*pool, *exact])]
    sums = [(f"__x{a}_{i}", f"sum(CASE WHEN {t} = {a} THEN CAST({quoted(x)} AS DOUBLE) END)")
            for i, x in enumerate(numeric) for a in (1, 0)]
    combinations = cut_lineage(
        binned.groupBy(*kept, *[f"__b{i}" for i in index.values()])
        .agg(F.expr(f"count_if({t} = 1)").alias("__t"), F.expr(f"count_if({t} = 0)").alias("__c"),
             *[F.expr(e).alias(n) for n, e in sums]))
    return (
        combinations.select("*", F.expr(f"inline(array({structs}))"))
        .groupBy("__design", *kept, *[f"__key{w}" for w in range(width)])
        .agg(*[F.sum(n).alias(n) for n in ("__t", "__c", *[n for n, _ in sums])])
    )


def candidate_balance(
    df: DataFrame,
    treat: str,
    covariates: Sequence[str],
    search: Sequence[Design] | None = None,
) -> DataFrame:
    """One row per design: rows matched (raw and effective), match share, and the largest
    standardised mean difference with its covariate.

    Differences are (treated mean - weighted control mean) / s.d. of all treated; of equal ones
    (to nine decimals) the first covariate is named. Categories match exactly, so their
    differences are 0 by construction and are not computed. Missing values have strata of their
    own; they count as matched rows, but not in that covariate's means.
    """
    search = list(search or designs(df, covariates))
    numeric, _ = split_covariates(df, covariates)
    groups: dict[tuple, int] = {}  # designs with equal rules are computed once
    member = {d.number: groups.setdefault(tuple(d.rules.items()), d.number) for d in search}
    parts = design_strata(
        df, treat, covariates, {n: dict(rules) for rules, n in groups.items()})
    spread = df.agg(
        F.count("*").alias("n"),
        *[F.stddev_samp(F.when(q(treat) == 1, q(x).cast("double"))).alias(f"s{i}")
          for i, x in enumerate(numeric)],
    ).first()
    both = (F.col("__t") > 0) & (F.col("__c") > 0)
    sums = parts.groupBy("__design").agg(
        F.coalesce(F.sum(F.when(both, F.col("__t"))), F.lit(0)).alias("T"),
        F.coalesce(F.sum(F.when(both, F.col("__c"))), F.lit(0)).alias("C"),
        F.sum(F.when(both, F.col("__t") * F.col("__t") / F.col("__c"))).alias("tt_c"),
        *[F.sum(F.when(both, F.col(f"__x1_{i}"))).alias(f"m1_{i}") for i in range(len(numeric))],
        # the treated with a value, and as much weight of controls
        *[F.sum(F.when(both & F.col(f"__x1_{i}").isNotNull(), F.col("__t"))).alias(f"k_{i}")
          for i in range(len(numeric))],
        *[F.sum(F.when(both, F.col("__t") / F.col("__c") * F.col(f"__x0_{i}"))).alias(f"m0_{i}")
          for i in range(len(numeric))],
    )
    smd = [
        F.try_divide((F.col(f"m1_{i}") - F.col(f"m0_{i}")) / F.nullif(F.col(f"k_{i}"), F.lit(0)),
                     F.lit(spread[f"s{i}"]).cast("double"))
        for i in range(len(numeric))
    ]
    worst = F.array_max(F.array_compact(F.array(*[
        F.when(s.isNotNull(), F.struct(F.round(F.abs(s), 9).alias("size"),
                                       F.lit(-i).alias("first"),
                                       s.alias("smd"), F.lit(x).alias("name")))
        for i, (s, x) in enumerate(zip(smd, numeric))])))
    info = df.sparkSession.createDataFrame(
        [(d.number, member[d.number], d.strategy, d.name) for d in search],
        "candidate_no int, __design int, Match_Num string, Cutpoint string")
    ess = F.col("T") + F.try_divide(F.col("T") * F.col("T"), F.col("tt_c"))
    matched = F.when(F.col("Match_Num") == "match_result1",
                     (F.col("T") + F.col("C")).cast("double")).otherwise(F.coalesce(ess, F.lit(0.0)))
    return (
        sums.withColumn("worst", worst)
        .join(F.broadcast(info), "__design")
        .select(
            "candidate_no", "Match_Num", "Cutpoint",
            F.lit(spread["n"]).cast("bigint").alias("NumOriginal"),
            matched.alias("NumMatched"),
            (F.col("T") + F.col("C")).alias("rows_matched"),
            F.coalesce(ess, F.lit(0.0)).alias("effective_matched"),
            F.col("worst.smd").alias("std_mean_diff_max_matched"),
            F.col("worst.name").alias("max_covariate"),
        )
        .withColumn("Category", balance_tier(F.col("std_mean_diff_max_matched")))
        .withColumn("MatchPercent", F.col("NumMatched") / F.col("NumOriginal"))
    )


def select_match(candidates: DataFrame, require_green: bool = False) -> DataFrame:
    """The design with the highest match share; the first one on ties."""
    if require_green:
        candidates = candidates.where(F.col("Category") == "Green")
    best = F.max_by(F.struct(*[q(c) for c in candidates.columns]),
                    F.struct(F.col("MatchPercent"), -F.col("candidate_no")))
    return candidates.agg(best.alias("b")).where(F.col("b").isNotNull()).select("b.*")


def balance(df: DataFrame, matched: DataFrame, treat: str, covariates: Sequence[str]) -> DataFrame:
    """Balance of given matched rows per numeric covariate: means by arm (weighted), the
    standardised difference with the s.d. of all treated in `df`, and its tier."""
    numeric, _ = split_covariates(df, covariates)
    spread = df.agg(*[F.stddev_samp(F.when(q(treat) == 1, q(x).cast("double"))).alias(f"s{i}")
                      for i, x in enumerate(numeric)]).first()

    def mean(x: str, arm: int) -> Column:
        weight = F.when((q(treat) == arm) & q(x).isNotNull(), F.col("weights"))
        return F.try_divide(F.sum(weight * q(x)), F.sum(weight))

    sums = matched.agg(*[mean(x, a).alias(f"m{a}_{i}")
                         for i, x in enumerate(numeric) for a in (1, 0)])
    return sums.select(F.inline(F.array(*[
        F.struct(
            F.lit(x).alias("covariate"),
            F.col(f"m1_{i}").alias("mean_treated"),
            F.col(f"m0_{i}").alias("mean_control"),
            F.try_divide(F.col(f"m1_{i}") - F.col(f"m0_{i}"),
                         F.lit(spread[f"s{i}"]).cast("double")).alias("smd"),
        ) for i, x in enumerate(numeric)]))).withColumn("Category", balance_tier(F.col("smd")))
