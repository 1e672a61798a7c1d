"""Reading and writing tables (CSV and parquet)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header and a stated schema: no inference pass over the data. Quotes inside
    quoted text are doubled. Lines that do not fit keep their text in `_corrupt_record`.
    `multiline` reads texts with line breaks, one task per file."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One scan over any number of parquet outputs, columns matched by name."""
    return spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Partitioned parquet. Rebalancing groups rows by partition value so that each task
    writes few files, and splits a value that is too large for one task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


MANIFEST = "value string, run string, number long, rows long"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], MANIFEST)


def write_batch(df: DataFrame, path: str, by: str, values: Sequence[str]) -> str:
    """Write the rows of one batch, the `values` of column `by`, and list them as finished.

    Every run has a folder of its own, and the manifest gets its lines in one append after all
    rows are written. So a rerun of some values replaces these alone, a run that breaks leaves
    nothing to see, and readers never meet half a batch. Returns the run's name."""
    spark = df.sparkSession
    run = uuid.uuid4().hex
    rows = df.where(F.col(by).cast("string").isin(list(values)))
    write_parquet(rows, f"{path}/run-{run}", (by,))
    number = _manifest(spark, path).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    schema = df.schema  # an empty run has no files to tell it
    counts = {r[0]: r[1] for r in spark.read.schema(schema).parquet(f"{path}/run-{run}").groupBy(
        F.col(by).cast("string")).count().collect()}
    lines = [(str(v), run, number, counts.get(str(v), 0)) for v in dict.fromkeys(values)]
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return run


def finished(spark: SparkSession, path: str) -> DataFrame:
    """value, run, number and rows: the last finished run of each value."""
    last = F.max_by(F.struct("run", "number", "rows"), "number").alias("last")
    return _manifest(spark, path).groupBy("value").agg(last).select("value", "last.*")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, by: str) -> DataFrame:
    """All finished batches as one table: of each value only its last run. Other partitions of a
    run are pruned, not read."""
    runs: dict[str, list[str]] = {}
    for r in finished(spark, path).collect():  # one line per value
        if r["rows"]:
            runs.setdefault(r["run"], []).append(r["value"])
    parts = [spark.read.schema(schema).parquet(f"{path}/run-{run}").where(
        F.col(by).cast("string").isin(values)) for run, values in sorted(runs.items())]
    names = [f.name for f in schema]
    empty = spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts, empty).select(*[F.col(f"`{n}`") for n in names])
