"""Exact dedup by deterministic block naming.

A text is cut into blocks of ``block_chars`` code points.  Equal blocks get
one integer name by sorting the *contents* (no digest decides equality, so
names are free of collisions).  Adjacent names are then paired and the pairs
named in the same way, halving the length each round, until every document
is one name.  Documents are equal when number of blocks and name are equal.

Scale: a text crosses the network once.  Each task first names the blocks of
its own rows, so a block that a third of all rows share reaches the content
sort once per task; all later rounds move integers.  Pair names are joined
back between two stored tables, where adaptive execution splits a hot pair.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import (ROW_ID, ROW_ID_ARROW, bounded_batches, identified, keep_rows, sliced,
                                stored, with_row_id)

BLOCK_CHARS = 8192
#: A task forgets its block contents beyond this many characters; a block
#: seen again then gets a second local name, which the content sort merges.
LOCAL_CHARS = 32 << 20


def _local_names(id_type: pa.DataType, block_chars: int):
    """Task function: one row per block, with its content on first sight."""
    schema = pa.schema([(ROW_ID, ROW_ID_ARROW), ("id", id_type), ("sha256", pa.string()),
                        ("n", pa.int64()), ("pos", pa.int64()), ("local", pa.int64()),
                        ("block", pa.string())])

    def run(batches):
        name = TaskContext.get().partitionId() << 33
        seen: dict[str, int] = {}
        held = 0
        for batch in sliced(batches):
            out: list[tuple] = []
            for rid, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                n = max(1, -(-len(text) // block_chars))
                for pos in range(n):
                    block = text[pos * block_chars:(pos + 1) * block_chars]
                    local = seen.get(block)
                    first = local is None
                    if first:
                        if held > LOCAL_CHARS:
                            seen, held = {}, 0
                        local = seen[block] = name
                        name += 1
                        held += len(block)
                    head = pos == 0
                    out.append((rid, key if head else None, sha if head else None, n, pos,
                                local, block if first else None))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    return run


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``__row_id, id, sha256, n, name``: one row per document; equal texts
    are exactly those with equal ``(n, name)``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = with_row_id(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField(ROW_ID, rows.schema[ROW_ID].dataType), T.StructField("id", id_type),
        T.StructField("sha256", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("pos", T.LongType()), T.StructField("local", T.LongType()),
        T.StructField("block", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_type
    blocks = stored(rows.mapInArrow(_local_names(to_arrow_type(id_type), block_chars), schema),
                    "block_rows")

    # sort the contents: equal blocks take the smallest of their local names
    names = blocks.where(F.col("block").isNotNull()).select(
        "local", F.min("local").over(Window.partitionBy("block")).alias("name"))
    level = stored(blocks.drop("block").join(names, "local").drop("local"), "block_names")

    heads = level.where(F.col("pos") == 0).select(ROW_ID, "id", "sha256", "n")
    done = [level.where(F.col("n") == 1).select(ROW_ID, "name")]
    left = level.where(F.col("n") > 1).select(ROW_ID, "pos", "name", F.col("n").alias("len"))
    longest = level.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        half = F.floor(F.col("pos") / 2).cast("bigint")
        even = F.col("pos") % 2 == 0
        pairs = stored(
            left.groupBy(ROW_ID, half.alias("pos"),
                         F.ceil(F.col("len") / 2).cast("bigint").alias("len"))
            .agg(F.max(F.when(even, F.col("name"))).alias("l"),
                 F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("r")),
            "pairs")
        named = stored(pairs.select("l", "r").distinct().sortWithinPartitions("l", "r")
                       .withColumn("name", F.monotonically_increasing_id()), "pair_names")
        level = stored(pairs.join(named, ["l", "r"]).drop("l", "r"), "pair_level")
        done.append(level.where(F.col("len") == 1).select(ROW_ID, "name"))
        left = level.where(F.col("len") > 1)
        longest = -(-longest // 2)
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return heads.join(whole, ROW_ID)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``__row_id, id, keep_id, group_size, kept, sha256``.

    Of equal texts the row with the largest id stays; of repeated rows with
    that id, one (the last of the scan).  A null text counts as empty, a null
    id is smaller than any other.  Empty input gives no rows.
    """
    named = stored(name_documents(docs, id_col, text_col, block_chars), "identities")
    groups = stored(
        named.groupBy("n", "name").agg(F.count(F.lit(1)).alias("group_size"),
                                       F.max(F.struct("id", ROW_ID)).alias("keep"))
        .select("n", "name", "group_size", F.col("keep.id").alias("keep_id"),
                F.col(f"keep.{ROW_ID}").alias("keep_row")), "groups")
    return (named.join(groups, ["n", "name"])
            .select(ROW_ID, "id", "keep_id", "group_size",
                    (F.col(ROW_ID) == F.col("keep_row")).alias("kept"), "sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = identified(docs)
    return keep_rows(docs, exact_duplicates(docs, id_col, text_col).where("kept"))
