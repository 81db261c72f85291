"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from shelfspark.sources.scratch import scratch_path

#: Rows of an Arrow batch that are turned into Python objects at a time, and the text they may hold together.
SLICE_ROWS, SLICE_CHARS = 512, 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared scratch folder and read again: it is computed once, and its
    lineage ends at files that outlive any executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], size_of: str, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no piece holds more than ``rows`` rows or, but for a single long row,
    ``SLICE_CHARS`` bytes in the text column ``size_of``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(size_of)), 0).to_numpy(
            zero_copy_only=False
        )
        start, total = 0, 0
        for i, n in enumerate(lengths):
            if i > start and (i - start == rows or total + n > SLICE_CHARS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
