"""What the text operators share: reading tables, words, folds, Arrow mapping."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\t\n\v\f\r "
_WORDS = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[str]:
    """Maximal runs of characters other than ASCII white space; none for null."""
    return _WORDS.findall(text) if text else []


def fold(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def fold_of(value: object, n: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % n


def by_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
             schema: str) -> DataFrame:
    """`function` over Arrow batches; one batch at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 22
           ) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts in `column` have about `size` bytes; a
    longer text is a run of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.cumsum(lengths.astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            reached = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, reached + size, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
