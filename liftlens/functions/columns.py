"""Column expressions of the study vocabulary. All stay inside the JVM; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z_975 = 1.959963984540054  # two-sided 95 % normal quantile


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """SQL literal of a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def q(name: str) -> Column:
    """Column by exact name; names may hold spaces, dots, % or backticks."""
    return F.col(quoted(name))


def snap_days(days: Column, windows=(30, 60, 90), tolerance: int = 5) -> Column:
    """Map day offsets within `tolerance` of a window length onto it; others pass unchanged."""
    out = None
    for w in windows:
        hit = days.between(w - tolerance, w + tolerance)
        out = F.when(hit, F.lit(w)) if out is None else out.when(hit, F.lit(w))
    return (out.otherwise(days) if out is not None else days).cast("int")


def snap_limit(days: int, windows=(30, 60, 90), tolerance: int = 5) -> int:
    """Largest offset that still snaps to at most `days`."""
    for w in windows:
        if w - tolerance <= days <= w + tolerance:
            return w + tolerance if days >= w else w - tolerance - 1
    return days


def day_diff(later: Column, earlier: Column) -> Column:
    """Whole days from `earlier` to `later`, rounded towards minus infinity. Dates and times
    of day are compared apart, which is integer arithmetic on zone-free timestamps."""

    def day(c: Column) -> Column:
        return c.cast("date")

    def time_of_day(c: Column) -> Column:
        return c - day(c).cast("timestamp_ntz")

    borrowed = F.when(time_of_day(later) < time_of_day(earlier), 1).otherwise(0)
    return F.datediff(day(later), day(earlier)) - borrowed


def period_status(days_before_start: Column) -> Column:
    return (
        F.when(days_before_start > 0, "pre").when(days_before_start <= 0, "post").otherwise("NA")
    )


def treated_flag(taken_end: Column) -> Column:
    return F.when(taken_end.isNull(), 0).otherwise(1)


def plain_number(value: Column) -> Column:
    """Two decimals, half-even, without trailing zeros: 10.50 -> 10.5, 3.00 -> 3."""
    text = F.bround(value, 2).cast("decimal(38,2)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def ci_text(lo: Column, hi: Column) -> Column:
    return F.concat(F.lit("["), plain_number(lo), F.lit(" - "), plain_number(hi), F.lit("]"))


def significance(lo: Column, hi: Column) -> Column:
    covers_zero = (lo <= 0) & (hi >= 0)
    return F.when(covers_zero, "Not Significant").when(~covers_zero, "Significant")


def balance_tier(smd: Column) -> Column:
    size = F.abs(smd)
    return (
        F.when(size < F.lit(0.05), "Green")
        .when(size < F.lit(0.10), "Yellow")
        .when(size.isNotNull(), "Red")
    )


def parse_timestamp(value: Column, formats=("yyyy-MM-dd", "MM-dd-yyyy")) -> Column:
    """Zone-free timestamp of the first format that fits, else null.

    ISO text (with or without time of day) is cast directly; `MM-dd-yyyy` text is first
    turned into ISO order, so the session time zone never takes part.
    """
    text = F.trim(value.cast("string"))
    tries = []
    for fmt in formats:
        if fmt == "yyyy-MM-dd":
            iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text)
        elif fmt == "MM-dd-yyyy":
            us = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})(.*)$"
            iso = F.when(text.rlike(us), F.regexp_replace(text, us, "$3-$1-$2$4"))
        else:
            raise ValueError(f"unsupported timestamp format {fmt!r}")
        tries.append(iso.try_cast("timestamp_ntz"))
    return F.coalesce(*tries)


def bin_sql(name: str, cuts: list[float]) -> str:
    """Left-closed bin number of a column, as SQL text: how many cuts are <= value. Null has
    bin -1. One expression text is much cheaper to build than a column call per cut."""
    x = quoted(name)
    if not cuts:
        return f"CASE WHEN {x} IS NULL THEN -1 ELSE 0 END"
    steps = " ".join(f"WHEN {x} < {float(c)!r}D THEN {i}" for i, c in enumerate(cuts))
    return f"CASE WHEN {x} IS NULL THEN -1 {steps} ELSE {len(cuts)} END"


def bin_of(name: str, cuts: list[float]) -> Column:
    return F.expr(bin_sql(name, cuts))
