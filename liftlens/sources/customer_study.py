"""A treatment study derived from the order tables, in the shape of the three raw inputs.

Employees are customers. A customer is treated if they placed an order of the treatment's
priority in the treatment's half year. KPIs are taken from orders in fixed windows before
and after it; customers without orders in a window have zero KPIs.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.config import StudyConfig, Treatment

PRIORITY = {
    "URGENT_1998H1": "1-URGENT",
    "HIGH_1998H1": "2-HIGH",
    "URGENT_1998H2": "1-URGENT",
}
# Window lengths in days; the short ones are off by a few days, as periods in real data are.
PRE_WINDOW = 720
POST_WINDOWS = (32, 58, 720)

CONFIG = StudyConfig(
    project="customer_orders",
    kpis={"Order Value": "sum", "Order Count": "sum", "% Open Orders": "sum"},
    treatments=(
        Treatment("URGENT_1998H1", "Urgent orders H1", "1998-01-01", "1998-06-30"),
        Treatment("HIGH_1998H1", "High orders H1", "1998-01-01", "1998-06-30"),
        Treatment("URGENT_1998H2", "Urgent orders H2", "1998-07-01", "1998-12-31"),
    ),
    covariates=("ACCTBAL", "LIFETIME"),
    segments=("MARKET", "NATION", "REGION"),
    pre_days=(720,),
    post_days=(30, 60, 720),
    treatment_columns={
        "EMP_ID": "emp_id",
        "START_DATE": "treatment_allocated_date",
        "END_DATE": "treatment_allocated_end_date",
        "OFFERING_ID": "treatment_id",
        "OFFERING_LABEL": "treatment_label_taken",
        "DATE_START_TREATMENT_TAKEN": "start_date_of_treatment_taken",
        "DATE_END_TREATMENT_TAKEN": "end_date_of_treatment_taken",
    },
    population_columns={
        "START_DATE": "start_date",
        "END_DATE": "end_date",
        "EMP_ID": "emp_id",
        "OFFERING_ID": "treatment_id",
    },
    segment_columns={"EMP_ID": "emp_id"},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treated customers with the window in which the treatment was taken; dates as text."""
    offers = ", ".join(
        f"""struct('{t.treatment_id}' AS id, '{t.label}' AS label,
        '{PRIORITY[t.treatment_id]}' AS priority, TIMESTAMP_NTZ '{t.start}' AS start,
        TIMESTAMP_NTZ '{t.end}' AS end)""" for t in CONFIG.treatments)
    first, last = min(t.start for t in CONFIG.treatments), max(t.end for t in CONFIG.treatments)
    us = lambda c: f"date_format({c}, 'MM-dd-yyyy')"
    return (
        table(spark, sf_dir, "orders")
        .where(f"o_orderdate BETWEEN TIMESTAMP_NTZ '{first}' AND TIMESTAMP_NTZ '{last}'")
        .where(F.col("o_orderpriority").isin(sorted(set(PRIORITY.values()))))
        .selectExpr("o_custkey", "o_orderdate", f"""explode(filter(array({offers}), o ->
            o.priority = o_orderpriority AND o_orderdate BETWEEN o.start AND o.end)) AS o""")
        .groupBy("o_custkey", "o")
        .agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
        .selectExpr(
            "CAST(o_custkey AS STRING) AS EMP_ID",
            us("first") + " AS DATE_START_TREATMENT_TAKEN",
            us("last") + " AS DATE_END_TREATMENT_TAKEN",
            "o.label AS OFFERING_LABEL", "o.id AS OFFERING_ID",
            us("o.start") + " AS START_DATE", us("o.end") + " AS END_DATE")
    )


def _windows():
    """Per treatment and measuring window: the treatment, the first and last day shown, and the
    first day that counts (post windows count from the day after they open)."""
    for t in CONFIG.treatments:
        start, end = date.fromisoformat(t.start), date.fromisoformat(t.end)
        first, last = start - timedelta(PRE_WINDOW), start - timedelta(1)
        yield t, first, last, first
        for d in POST_WINDOWS:
            yield t, end, end + timedelta(d), end + timedelta(1)


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, treatment and window. KPIs are whole numbers: order value in
    currency units (from exact cents), order count, and the share of open orders in %.

    All windows come from one aggregate per customer, which shares its partitioning with
    the join to the customers; rows are only multiplied after it.
    """
    aggregates, rows, numbers = [], [], {}
    ntz = lambda d: f"TIMESTAMP_NTZ '{d}'"
    for t, first, last, counted_from in _windows():
        known = len(numbers)
        i = numbers.setdefault((t.start, t.end, last), known)  # treatments share windows
        inside = f"o_orderdate BETWEEN {ntz(counted_from)} AND {ntz(last)}"
        if i == known:
            aggregates += [
                f"sum(CASE WHEN {inside} THEN cents END) AS cents{i}",
                f"count_if({inside}) AS n{i}",
                f"count_if({inside} AND o_orderstatus = 'O') AS open{i}",
                f"count_if(o_orderdate < {ntz(t.start)}) AS before{i}",
            ]
        rows.append(
            f"""struct('{t.treatment_id}' AS OFFERING_ID, {ntz(first)} AS START_DATE,
            {ntz(last)} AS END_DATE, coalesce(cents{i} div 100, 0L) AS `Order Value`,
            coalesce(n{i}, 0L) AS `Order Count`,
            coalesce(CASE WHEN n{i} > 0 THEN (100 * open{i}) div n{i} END, 0L)
              AS `% Open Orders`,
            c_acctbal AS ACCTBAL, CAST(coalesce(before{i}, 0L) AS DOUBLE) AS LIFETIME)"""
        )
    measured = (
        table(spark, sf_dir, "orders")
        .selectExpr("o_custkey AS c_custkey", "o_orderdate", "o_orderstatus",
                    "CAST(round(o_totalprice * 100) AS BIGINT) AS cents")
        .groupBy("c_custkey")
        .agg(*[F.expr(a) for a in aggregates])
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return customers.join(measured, "c_custkey", "left").selectExpr(
        "CAST(c_custkey AS STRING) AS EMP_ID", f"inline(array({', '.join(rows)}))")


def raw_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region are the fixed 25- and 5-row dimensions of the schema."""
    places = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("EMP_ID"),
            F.col("c_mktsegment").alias("MARKET"),
            F.col("n_name").alias("NATION"),
            F.col("r_name").alias("REGION"),
        )
    )


def daily_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily form: one row per order line, dated by shipment, for the first treatment."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("emp_id"),
        F.lit(CONFIG.treatments[0].treatment_id).alias("treatment_id"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("Units"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("Line Cents"),
    )
