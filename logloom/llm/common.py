"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import remove, table_path, work_dir

#: Bytes of one Arrow batch handed to a Python task.  With very long texts a
#: batch of the default 10,000 rows would not fit an executor's memory.
ARROW_BATCH_BYTES = 8 << 20

ROW_ID = "__row_id"
ROW_ID_DDL = f"`{ROW_ID}` struct<file:bigint,row:bigint>"
ROW_ID_ARROW = pa.struct([("file", pa.int64()), ("row", pa.int64())])

#: Bitmaps of rows that are broadcast at most (512 million rows).
MARK_BYTES = 64 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def bounded_batches(spark: SparkSession, max_bytes: int = ARROW_BATCH_BYTES) -> None:
    """Bound the Arrow batches of this session by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))


_SCRATCH: list[str] = []


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables stored meanwhile are removed at the end: for a result that is
    written before."""
    root = work_dir(spark, "llm", name, unique=True)
    _SCRATCH.append(root)
    try:
        yield
    finally:
        _SCRATCH.remove(root)
        remove(spark, root)


def stored(df: DataFrame, name: str, compression: str = "zstd", keep: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: later stages reread files that every executor sees, so
    a lost executor costs a reread and not a recomputation, and values that
    depend on the row order of a run (row ids, names) are fixed from here on.
    ``keep`` leaves the table out of a ``scratch`` folder.
    """
    path = work_dir(df.sparkSession, "llm", name, unique=True)
    if _SCRATCH and not keep:
        path = f"{_SCRATCH[-1]}/{path.rsplit('/llm/', 1)[1]}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows can be told by file and place in it, else a stored
    copy.  Only selections and filters of one Parquet scan can."""
    plan = docs._jdf.queryExecution().analyzed()
    kinds = [plan.getClass().getSimpleName()]
    while plan.children().size() == 1:
        plan = plan.children().apply(0)
        kinds.append(plan.getClass().getSimpleName())
    if plan.children().size() == 0 and kinds[-1] == "LogicalRelation" \
            and set(kinds[:-1]) <= {"Project", "Filter", "SubqueryAlias"}:
        try:
            docs.select(row_id(docs))
            return docs
        except AnalysisException:  # a format without row numbers
            pass
    return stored(docs, "rows")


def row_id(docs: DataFrame) -> Column:
    """The row id of a table that ``identified`` has passed."""
    at = docs.metadataColumn("_metadata")
    return F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("row")).alias(ROW_ID)


def with_row_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__row_id, id, text`` with a null text as the empty string.

    Only these columns are kept, so extra columns of any name cannot clash.
    The row id, ``struct<file, row>``, is the hash of the row's file and its
    place there: it tells apart repeated rows and null ids, and is the same in
    every scan however the files are split.
    """
    docs = identified(docs)
    return docs.select(row_id(docs), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))


def bit_set(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set; none is beyond its end."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))),
                  16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]),
                        (position.bitwiseAND(F.lit(7)) + 1).cast("int"))
    return F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))


def row_marks(rows: DataFrame) -> DataFrame:
    """``__file, __bucket, __marks``: the rows of a ``__row_id`` column as
    bitmaps without trailing zeros, an eighth of a byte per row."""
    one = F.col(f"{ROW_ID}.row") + 1  # the bitmap functions count from 1
    at = F.bitmap_bit_position(one)
    return rows.groupBy(F.col(f"{ROW_ID}.file").alias("__file"),
                        F.bitmap_bucket_number(one).alias("__bucket")).agg(
        F.bitmap_construct_agg(at).alias("__marks"), F.max(at).alias("__last")).select(
        "__file", "__bucket",
        F.substring("__marks", F.lit(1), (F.shiftright("__last", 3) + 1).cast("int")).alias("__marks"))


def keep_rows(docs: DataFrame, kept: DataFrame, max_bytes: int = MARK_BYTES,
              with_id: bool = False) -> DataFrame:
    """The rows of ``docs`` whose ``__row_id`` stands in ``kept``, with all
    their columns and, if asked for, the row id.

    ``docs`` is what the ids were taken from, after ``identified``.  The ids
    travel to the rows as bitmaps, so no text is shuffled; bitmaps of more
    than ``max_bytes`` are joined by their file instead of being broadcast.
    """
    marks = stored(row_marks(kept), "marks")
    size = marks.agg(F.sum(F.octet_length("__marks") + 32)).first()[0] or 0
    one = F.col(f"{ROW_ID}.row") + 1
    rows = docs.select("*", row_id(docs))
    # the hint of a size that was checked; without one the planner shuffles
    marks = F.broadcast(marks) if size <= max_bytes else marks.hint("merge")
    rows = rows.join(marks, (F.col(f"{ROW_ID}.file") == F.col("__file"))
                     & (F.bitmap_bucket_number(one) == F.col("__bucket"))
                     & bit_set(F.col("__marks"), F.bitmap_bit_position(one)), "left_semi")
    return rows if with_id else rows.drop(ROW_ID)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def sliced(batches: Iterator[pa.RecordBatch], text_col: str | int = "text",
           max_bytes: int = 1 << 20, max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about ``max_bytes`` of text (always
    whole rows, at least one), which bounds what a task holds as objects."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text_col)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + (n or 0) > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)
