"""Hard negatives of anchor vectors by Fagin's threshold algorithm.

Vectors are quantised to integers, so scores are exact.  A task holds a block
of rows with one list per dimension, sorted by that component.  For an anchor
the lists are read from the end that its component's sign favours; each row
met is scored by random access.  A row not met yet scores at most the sum over
the dimensions of the anchor's component times the next value in its list.
Reading stops once this threshold is strictly below the kth score of every
window (below the window itself, where it has fewer than k rows), as a row of
equal score may still win by its id.

Two searches are made: the best rows of the anchor's label (positives), then
the best rows of other labels within the score window of each positive.  Each
runs over the anchors' own table first.  What it finds there is a lower bound
of the kth score, so tasks that search all rows stop earlier and return only
rows that may be among the best: what is merged per window follows from that
bound, not from the number of tasks.

Scale: anchors are the stated query set.  They are read in blocks of
``ANCHOR_CELLS`` components, and a block is what a broadcast holds; every
block scans the quantised rows, which are written once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logloom.llm.common import bounded_batches, stored

SCALE = 256
N_POSITIVES = 5
N_NEGATIVES = 5
#: Negatives score at least this share (percent) of the positive's score.
LEAST_PERCENT = 80
#: Components of a block of anchors, and of a task's block of rows.
ANCHOR_CELLS = 1 << 22
ROW_CELLS = 1 << 22
#: Rows read from each list at first; the depth grows fourfold.
FIRST_DEPTH = 32
#: Integers below this are exact as doubles.
EXACT = 2 ** 53
LONG = 2 ** 63


def quantised(rows: DataFrame, id_col: str, label_col: str, vector_col: str,
              anchor: Column, scale: int = SCALE) -> DataFrame:
    """``rid, id, label, vec, anchor`` of the rows that take part."""
    vector, label = F.col(vector_col), F.col(label_col)

    def unfit(x):
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))
    return rows.where(label.isNotNull() & vector.isNotNull() & ~F.exists(vector, unfit)).select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
        label.cast("string").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))


class Lists:
    """A block of vectors with a sorted list per dimension."""

    def __init__(self, vectors: list, dims: int):
        wide = np.zeros((len(vectors), dims), np.int64)
        for i, v in enumerate(vectors):
            wide[i, :len(v)] = v
        self.vec = wide
        order = np.argsort(wide, axis=0, kind="stable")
        self.value = np.ascontiguousarray(np.take_along_axis(wide, order, 0).T)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        self.top = int(max(-int(wide.min()), int(wide.max()))) if wide.size else 0
        self.exact: dict[type, np.ndarray] = {}

    def as_type(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, sorted values and anchor in a type that holds every score:
        doubles, which multiply fast, or else Python's integers."""
        most = self.top * max([abs(int(x)) for x in anchor], default=0) * max(1, len(anchor))
        kind = np.float64 if most < EXACT else object
        if kind not in self.exact:
            self.exact[kind] = (self.vec.astype(kind), self.value.astype(kind))
        return (*self.exact[kind], anchor.astype(kind))

    def search(self, anchor: np.ndarray, wanted: np.ndarray, low: list, high: list,
               k: int) -> tuple[list[np.ndarray], int]:
        """Rows of each window that may be among its k best, with the depth read.

        ``wanted`` marks the rows that count; a window holds the scores from
        ``low`` to ``high``.
        """
        vec, value, a = self.as_type(anchor)
        n = len(vec)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        open_ = [w for w in range(len(low)) if low[w] <= high[w]]
        least = min((low[w] for w in open_), default=0)
        seen = np.zeros(n, bool)
        at, score = np.zeros(0, np.int64), np.zeros(0, a.dtype)
        kth, depth, step = {w: low[w] for w in open_}, 0, FIRST_DEPTH
        while depth < n and open_:
            if len(up) + len(down):
                threshold = a[up] @ value[up, n - 1 - depth] + a[down] @ value[down, depth]
                if all(threshold < kth[w] for w in open_):
                    break
                to = min(n, depth + step)
                met = np.zeros(n, bool)
                met[self.order[up, n - to:n - depth].ravel()] = True
                met[self.order[down, depth:to].ravel()] = True
                depth, step = to, step * 4
            else:
                met, depth = np.ones(n, bool), n  # all scores are zero
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            if 2 * len(fresh) > n:
                fresh = fresh[wanted[fresh]]
                got = (vec @ a)[fresh]
            else:
                fresh = fresh[wanted[fresh]]
                got = vec[fresh] @ a
            keep = got >= least
            at, score = np.concatenate([at, fresh[keep]]), np.concatenate([score, got[keep]])
            for w in open_:
                inside = score[(score >= low[w]) & (score <= high[w])]
                if len(inside) >= k:
                    kth[w] = np.partition(inside, len(inside) - k)[len(inside) - k]
            if seen.all():
                break
        out = []
        for w in range(len(low)):
            if w not in kth:
                out.append((np.zeros(0, np.int64), score[:0]))
                continue
            inside = (score >= kth[w]) & (score <= high[w])
            out.append((at[inside], score[inside]))
        return out, depth


def _blocks(batches: Iterator[pa.RecordBatch], cells: int = ROW_CELLS) -> Iterator[pa.Table]:
    """The rows of a task in pieces of about ``cells`` components."""
    held, size = [], 0
    for b in batches:
        dims = max(1, len(b.column("vec").flatten()) // max(1, b.num_rows))
        for at in range(0, b.num_rows, max(1, cells // dims)):
            part = b.slice(at, max(1, cells // dims))
            n = len(part.column("vec").flatten())
            if held and size + n > cells:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.Table.from_batches(held)


def _search(rows: DataFrame, block, windows, same: bool, k: int) -> DataFrame:
    """``anchor, win, id, rid, score``: the best ``k`` rows of each window of a
    block of anchors.  ``windows``: per anchor the lows and highs."""
    spark = rows.sparkSession
    share = spark.sparkContext.broadcast((block, windows))
    id_type = to_arrow_type(rows.schema["id"].dataType)
    schema = pa.schema([("anchor", pa.int32()), ("win", pa.int32()), ("id", id_type),
                        ("rid", pa.int64()), ("score", pa.int64())])

    def run(batches):
        anchors, wins = share.value
        widest = max((len(a[3]) for a in anchors), default=0)
        for table in _blocks(batches):
            table = table.combine_chunks()
            vectors = table.column("vec").to_pylist()
            lists = Lists(vectors, max(widest, max(map(len, vectors))))
            rid = table.column("rid").to_numpy()
            coded = pc.dictionary_encode(table.column("label")).combine_chunks()
            label = coded.indices.to_numpy()
            code = {v: i for i, v in enumerate(coded.dictionary.to_pylist())}
            place = pc.rank(table.column("id").combine_chunks(), sort_keys="ascending",
                            null_placement="at_end", tiebreaker="dense").to_numpy()
            own = {r: i for i, r in enumerate(rid.tolist())}
            out = [[], [], [], []]
            for j, (a_rid, _, a_label, a_vec) in enumerate(anchors):
                low, high = wins[j]
                if not low:
                    continue
                wanted = (label == code.get(a_label, -1)) == same
                if a_rid in own:
                    wanted[own[a_rid]] = False
                vector = np.zeros(lists.vec.shape[1], np.int64)
                vector[:len(a_vec)] = a_vec
                found, _ = lists.search(vector, wanted, low, high, k)
                for w, (at, score) in enumerate(found):
                    best = sorted(range(len(at)), key=lambda i: (-score[i], place[at[i]], rid[at[i]]))[:k] \
                        if len(at) > 1 else list(range(len(at)))
                    out[0] += [j] * len(best)
                    out[1] += [w] * len(best)
                    out[2] += at[best].tolist() if best else []
                    out[3] += [max(-LONG, min(LONG - 1, int(s))) for s in (score[best] if best else [])]
            take = pa.array(out[2], pa.int64())
            yield from pa.table(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()),
                 table.column("id").take(take), table.column("rid").take(take),
                 pa.array(out[3], pa.int64())], schema=schema).to_batches()
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("rid", "id", "label", "vec").mapInArrow(
        run, f"anchor int, win int, id {kind}, rid bigint, score bigint")
    order = Window.partitionBy("anchor", "win").orderBy(
        F.col("score").desc(), F.col("id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _raised(found: DataFrame, windows: list, k: int) -> list:
    """Windows whose lows are raised to the kth score found so far."""
    out = [(list(low), list(high)) for low, high in windows]
    for r in found.where(F.col("rank") == k).select("anchor", "win", "score").collect():
        out[r.anchor][0][r.win] = max(out[r.anchor][0][r.win], r.score)
    return out


def _anchor_blocks(anchors: DataFrame, cells: int = ANCHOR_CELLS) -> Iterator[list[tuple]]:
    block, size = [], 0
    for r in anchors.select("rid", "id", "label", "vec").toLocalIterator():
        if block and size + len(r.vec) + 1 > cells:
            yield block
            block, size = [], 0
        block.append((r.rid, r.id, r.label, list(r.vec)))
        size += len(r.vec) + 1
    if block:
        yield block


def mine(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", anchor: Column | None = None, scale: int = SCALE,
         n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         least_percent: int = LEAST_PERCENT) -> DataFrame:
    """``anchor_rid, anchor_id, positive_id, positive_no, rank, negative_id,
    positive_score, negative_score``.

    ``anchor`` marks the anchors (default: ids divisible by 100).  Rows with a
    null label, a null vector or a null or non-finite component take no part.
    Vectors of unequal length are filled with zeros; an empty one scores zero.
    Components beyond a long count as its ends, and scores beyond it are
    reported as its ends, though they are compared exactly.  Repeated rows and
    ids are rows like any other; null ids come last among equal scores and are
    no anchors by default.  A positive whose window holds no row of another
    label has no row in the result, and an empty table gives none.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    if anchor is None:
        anchor = F.col(id_col) % 100 == 0
    table = stored(quantised(rows, id_col, label_col, vector_col, anchor, scale), "hard_rows")
    anchors = stored(table.where("anchor"), "hard_anchors")
    results = []
    for block in _anchor_blocks(anchors):
        every = [([float("-inf")], [float("inf")]) for _ in block]
        first = _search(anchors, block, every, True, n_positives)
        positives = [[] for _ in block]
        for r in _search(table, block, _raised(first, every, n_positives), True, n_positives).collect():
            positives[r.anchor].append((r["rank"], r.id, r.score))  # n_positives per anchor at most
        windows = []
        for found in positives:
            found.sort(key=lambda p: p[0])
            windows.append(([-(-least_percent * s // 100) for _, _, s in found], [s for _, _, s in found]))
        first = _search(anchors, block, windows, False, n_negatives)
        best = stored(_search(table, block, _raised(first, windows, n_negatives), False, n_negatives),
                      "hard_negatives")
        kind = rows.schema[id_col].dataType.simpleString()
        known = spark.createDataFrame(
            [(j, w, a[0], a[1], p[1], p[2]) for j, (a, found) in enumerate(zip(block, positives))
             for w, p in enumerate(found)],
            f"anchor int, win int, anchor_rid bigint, anchor_id {kind}, positive_id {kind}, positive_score bigint")
        results.append(best.join(known, ["anchor", "win"]).select(
            "anchor_rid", "anchor_id", "positive_id", (F.col("win") + 1).alias("positive_no"), "rank",
            F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    if not results:
        kind = rows.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], (
            f"anchor_rid bigint, anchor_id {kind}, positive_id {kind}, positive_no int, rank int, "
            f"negative_id {kind}, positive_score bigint, negative_score bigint"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
