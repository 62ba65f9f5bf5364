"""Balanced sharding by sampled splitters.

Records are ordered by a key (hash of the text, then hashes of the id and of
the row), so equal texts stand together and a hot text still has many keys.
A size-weighted sample of keys gives quantile boundaries; records are
range-partitioned by them, and a range that turned out overfull is subdivided
by boundaries sampled inside it.  Ranges are small enough for one task to
sort, and there are far more of them than shards, so the exact place of a
record in bytes is its range's prefix plus its place within the range, and
that place gives the shard: sizes are near equal (law ``bytes``).

Scale: the sample and the range totals are bounded by the number of ranges
(a parameter), never by the records; only keys and sizes are shuffled, no
text.  All steps are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import ROW_ID, identified, row_id, stored, with_row_id

SHARDS = 8
#: Ranges per shard at least; sampled keys per range; records and bytes that
#: a range may hold beyond its share before it is subdivided.
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 32
MAX_RANGES = 4096
RANGE_ROWS = 1_000_000
OVERFULL = 2.0
#: A group of equal texts of at most this share of a shard is kept whole.
WHOLE_GROUP = 0.005


def _range_of(k1: Column, k2: Column, bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below the key: a binary search over the
    sorted boundary literals, as a fold over the powers of two."""
    if not bounds:
        return F.lit(0)
    b1 = F.expr("array(" + ",".join(f"{a}L" if a > -(1 << 63) else "(-9223372036854775807L - 1L)"
                                    for a, _ in bounds) + ")")
    b2 = F.expr("array(" + ",".join(f"{b}L" if b > -(1 << 63) else "(-9223372036854775807L - 1L)"
                                    for _, b in bounds) + ")")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(acc: Column, s: Column) -> Column:
        at = acc + s
        a, b = F.get(b1, at - 1), F.get(b2, at - 1)
        return F.when((at <= len(bounds)) & ((a < k1) | ((a == k1) & (b <= k2))),
                      at).otherwise(acc)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _sampled(keys: DataFrame, weight: Column, seed: int) -> DataFrame:
    """Keys drawn with probability ``weight`` (at most 1), by a hash of the key."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "k1", "k2", ROW_ID), F.lit(1 << 30)) + 0.5) / (1 << 30)
    return keys.where(u < weight).select("k1", "k2", ROW_ID, "size")


def _quantiles(sample: list[tuple[int, int]], parts: int) -> list[tuple[int, int]]:
    sample = sorted(sample)
    return [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []


def shard_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shards: int = SHARDS) -> DataFrame:
    """One row per input row: ``__row_id, id, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text plus 1 (a null text has none);
    ``slot`` counts from 0 without gaps within a shard.  Law: bytes.  Equal
    texts stay in one shard when together they are at most ``WHOLE_GROUP`` of
    a shard.  Null ids and repeated rows are records like any other; an empty
    table gives no rows.
    """
    rows = with_row_id(docs, id_col, text_col)
    raw = F.col("text").cast("binary")
    keys = stored(rows.select(
        ROW_ID, "id", (F.octet_length("text") + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64("text").alias("k1"),
        F.xxhash64(F.col("id").cast("string"), F.col(ROW_ID)).alias("k2")), "shard_keys")
    total, count = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return keys.select(ROW_ID, "id", "size", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("bigint").alias("slot"))
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-count // RANGE_ROWS)))

    drawn = ranges * SAMPLES_PER_RANGE
    p = F.lit(float(drawn)) * F.col("size") / F.lit(float(total))
    # a record larger than a sample step stands for several draws
    sample = [(r.k1, r.k2) for r in _sampled(keys, p, 1).collect()
              for _ in range(max(1, min(SAMPLES_PER_RANGE, int(drawn * r.size / total))))]
    bounds = sorted(set(_quantiles(sample, ranges)))
    # a boundary inside a group of equal texts goes to the group's start,
    # unless the group fills a range of its own
    hot = {a for (a, _), (b, _) in zip(bounds, bounds[1:]) if a == b}
    bounds = sorted({(a, b if a in hot else -(1 << 63)) for a, b in bounds})

    def totals(bs: list[tuple[int, int]]) -> list[tuple]:
        return [tuple(r) for r in keys.groupBy(_range_of(F.col("k1"), F.col("k2"), bs).alias("r"))
                .agg(F.sum("size"), F.count(F.lit(1)), F.max("size")).orderBy("r").collect()]
    found = totals(bounds)
    share, share_rows = total / ranges, max(1, count / ranges)
    for seed in (2, 3, 4):
        over = {r: (b, n) for r, b, n, most in found
                if n > 1 and (b > OVERFULL * share + most or n > OVERFULL * share_rows * 4)}
        if not over:
            break
        where = _range_of(F.col("k1"), F.col("k2"), bounds)
        weight = F.lit(0.0)
        for r, (b, n) in over.items():
            weight = F.when(F.col("r") == r, F.greatest(
                F.col("size") * (float(SAMPLES_PER_RANGE) * (b / share) / b),
                F.lit(float(SAMPLES_PER_RANGE) * (n / share_rows) / n))).otherwise(weight)
        inner: dict[int, list] = {}
        for r in (keys.withColumn("r", where).where(F.col("r").isin(list(over)))
                  .select("*", weight.alias("w"))
                  .where((F.pmod(F.xxhash64(F.lit(seed), "k1", "k2", ROW_ID), F.lit(1 << 30)) + 0.5)
                         / (1 << 30) < F.col("w")).select("r", "k1", "k2").collect()):
            inner.setdefault(r.r, []).append((r.k1, r.k2))
        for r, (b, n) in over.items():
            parts = 1 + int(max(b / share, n / share_rows / 4))
            bounds = sorted(set(bounds) | set(_quantiles(inner.get(r, []), parts)))
        found = totals(bounds)

    # prefix of rows and bytes before each range: a bounded lookup
    starts, at_bytes, at_rows = {}, 0, 0
    for r, b, n, _ in found:
        starts[r] = (at_bytes, at_rows)
        at_bytes, at_rows = at_bytes + b, at_rows + n
    size_of = max(starts) + 1
    before_bytes = F.expr("array(" + ",".join(f"{starts.get(i, (0, 0))[0]}L" for i in range(size_of)) + ")")
    before_rows = F.expr("array(" + ",".join(f"{starts.get(i, (0, 0))[1]}L" for i in range(size_of)) + ")")

    ranged = keys.withColumn("r", _range_of(F.col("k1"), F.col("k2"), bounds))
    order = Window.partitionBy("r").orderBy("k1", "k2", ROW_ID)
    placed = ranged.select(
        "*", (F.row_number().over(order) - 1).cast("bigint").alias("rn"),
        (F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
         - F.col("size")).alias("upto"))
    group = Window.partitionBy("r", "k1")
    pos = F.get(before_bytes, F.col("r")) + F.col("upto")
    placed = placed.select(
        ROW_ID, "id", "size", "text_crc32", (F.get(before_rows, F.col("r")) + F.col("rn")).alias("seq"),
        F.when(F.sum("size").over(group) <= WHOLE_GROUP * total / shards,
               F.min(pos).over(group) + F.sum("size").over(group) / 2)
        .otherwise(pos + F.col("size") / 2).alias("mid"))
    shard = F.least(F.floor(F.col("mid") * shards / F.lit(float(total))), F.lit(shards - 1)).cast("int")
    placed = stored(placed.select(ROW_ID, "id", "size", "text_crc32", "seq",
                                  shard.alias("shard")), "shard_places")
    first = {r.shard: r.seq for r in placed.groupBy("shard").agg(F.min("seq").alias("seq")).collect()}
    base = F.expr("array(" + ",".join(f"{first.get(i, 0)}L" for i in range(shards)) + ")")
    return placed.select(ROW_ID, "id", "size", "text_crc32", "shard",
                         (F.col("seq") - F.get(base, F.col("shard"))).alias("slot"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shards: int = SHARDS) -> None:
    """Write ``docs`` with all columns, one folder per shard, several files each.

    A column of the name ``shard`` in ``docs`` is replaced.  The write is
    dealt by the slot's file number too, so no shard passes through one task.
    """
    docs = identified(docs)
    rows = docs.select("*", row_id(docs)).drop("shard")
    where = shard_records(docs, id_col, text_col, shards).select(
        F.col(ROW_ID).alias("__at"), "shard", (F.col("slot") % 16).alias("__file"))
    (rows.join(where, F.col(ROW_ID) == F.col("__at")).drop(ROW_ID, "__at")
     .repartition("shard", "__file").drop("__file").write.partitionBy("shard").parquet(path))
