"""Token counts from flat token files: a vectorised separator scan in blocks, stitched by a prefix scan.

A flat file is nothing but ids, each document ended by one end-of-document id, with no index. Files are cut into blocks
of ``BLOCK_IDS`` ids that tasks read and search on their own. A document that crosses block boundaries is put together
from one row per block: a running maximum of the last separator gives where the document open at a block's start began,
a running sum of separators gives its number in the file.

Empty documents count 0 ids. Ids behind the last separator of a file are a document that has not ended (``ended`` is
false). An empty file has no documents. A file whose length is no whole number of ids is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import slices, stored
from shelfspark.llm.token_files import make_folder, read_range, write_file
from shelfspark.llm.tokens import encoder
from shelfspark.sources.scratch import scratch_path

BLOCK_IDS = 1 << 20


def write_flat_files(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One file per task with documents; ``file string, place long, doc_id`` says which document stands where.

    Special tokens in a text are ordinary text, so the end id of a special token never occurs inside a document. A
    null text is an empty document.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        enc.library.encode_special_tokens = True
        end = np.array([end_id], enc.dtype).tobytes()
        held: list[pa.RecordBatch] = []

        def chunks():
            for batch in slices(batches, "text"):
                held.append(batch.select(["doc_id"]))
                yield b"".join([ids + end for ids in enc.encode(batch["text"].to_pylist())])

        name = f"tokens-{TaskContext.get().partitionId():08d}.ids"
        try:
            write_file(folder, name, chunks())
        finally:
            enc.library.encode_special_tokens = False
        place = 0
        for batch in held:
            n = batch.num_rows
            places = pa.array(np.arange(place, place + n, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), places, batch["doc_id"]], ["file", "place", "doc_id"])
            place += n

    return stored(docs.sparkSession, named.mapInArrow(write, f"file string, place long, doc_id {id_type}"), "token-places")


def scan_separators(spark: SparkSession, folder: str, end_id: int, dtype: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """A row for each block: ``path, block, n_ids, n_ends, last_end`` and the ``ends``, counted from the file's start."""
    width = np.dtype(dtype).itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "length")
    last = F.greatest(F.ceil(F.col("length") / (width * block_ids)), F.lit(1)) - 1
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(batch[c].to_pylist() for c in ("path", "length", "block")), strict=True):
                if length % width:
                    raise ValueError(f"{path} does not hold whole ids")
                start = block * block_ids
                ids = np.frombuffer(read_range(path, start * width, min(block_ids, length // width - start) * width), dtype)
                ends = (np.flatnonzero(ids == end_id) + start).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]),
                        pa.array([block], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([len(ends)], pa.int64()),
                        pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                        pa.array([ends.tobytes()], pa.binary()),
                    ],
                    ["path", "block", "n_ids", "n_ends", "last_end", "ends"],
                )

    return blocks.repartition("path", "block").mapInArrow(
        scan, "path string, block long, n_ids long, n_ends long, last_end long, ends binary"
    )


def count_tokens(spark: SparkSession, folder: str, end_id: int, dtype: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file string, place long, start long, n_tokens long, ended boolean`` of each document in the folder's files."""
    scanned = scan_separators(spark, folder, end_id, dtype, block_ids)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = scanned.select(
        F.substring_index("path", "/", -1).alias("file"),
        "block",
        "n_ids",
        "ends",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("place"),
        F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)).alias("open"),
        F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull().alias("last"),
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.frombuffer(r["ends"], "<i8")
                starts = np.concatenate(([r["open"]], ends + 1))
                stop = r["block"] * block_ids + r["n_ids"]
                if r["last"] and starts[-1] < stop:
                    ends = np.append(ends, stop)
                n = len(ends)
                starts = starts[:n]
                ended = np.ones(n, bool)
                if r["last"] and n > len(r["ends"]) // 8:
                    ended[-1] = False
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["file"]] * n, pa.string()),
                        pa.array(np.arange(r["place"], r["place"] + n, dtype=np.int64)),
                        pa.array(starts.astype(np.int64)),
                        pa.array((ends - starts).astype(np.int64)),
                        pa.array(ended),
                    ],
                    ["file", "place", "start", "n_tokens", "ended"],
                )

    return stitched.mapInArrow(spread, "file string, place long, start long, n_tokens long, ended boolean")


def document_counts(docs: DataFrame, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Flat files of ``docs`` and the counts found in them: ``doc_id, n_tokens long``, without the end id."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "flat-tokens")
    make_folder(folder)
    places = write_flat_files(docs, vocabulary, folder, end_id, doc_id, text)
    counts = count_tokens(spark, folder, end_id, encoder(vocabulary).dtype.str)
    # Both sides grow with the documents, so neither is broadcast, however small its file is.
    return places.hint("merge").join(counts, ["file", "place"]).select("doc_id", "n_tokens")
