"""SimHash near-dedup with the general pigeonhole principle.

Fingerprints of 64 bits link when at most ``distance`` bits differ.  The bits
are grouped into m parts, correlated bits together, so that some parts are
far more selective than others.  Each fingerprint gets a radius t_i >= -1 per
part with sum(t_i) = distance - m + 1: any fingerprint within the distance
lies within t_i of it in at least one part (were all differences above t_i,
they would sum to more than the distance).  The radii are chosen per
fingerprint by dynamic programming over estimated candidate counts, so a
value that many fingerprints share in one part is probed little there (-1:
not at all) and more elsewhere.  Probes meet the indexed values by a shuffle
and candidates are verified on all 64 bits.

Scale: equal fingerprints are one.  Only fingerprints (8 bytes) are shuffled.
A bucket whose estimated size is over ``BUCKET`` is split into blocks that
meet pairwise, so no bucket stands in one task.  A task emits a spanning
forest of the links it verified, not the pairs.  The estimates are histograms
of at most 2^16 values per part, whatever the number of documents.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import (ROW_ID, ROW_ID_ARROW, ROW_ID_DDL, bounded_batches, identified, keep_rows,
                                sliced, stored, with_row_id)
from logloom.llm.components import connected_components, local_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Rows of a bucket that are compared in one place.
BUCKET = 4096
#: Radius that a part may have at most, and the cost of a probe (a shuffled
#: row) in candidates (a comparison of two integers).
MAX_RADIUS = 3
PROBE_COST = 50.0
HIST_BITS = 16
_M64 = (1 << 64) - 1


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a lower-cased text; no words give zero."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends]
        hashes = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])),
                             np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = hashes[at:at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``__row_id, id, fp`` (the fingerprint as a signed integer)."""
    bounded_batches(docs.sparkSession)
    rows = with_row_id(docs, id_col, text_col)
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([(ROW_ID, ROW_ID_ARROW), ("id", to_arrow_type(rows.schema["id"].dataType)),
                        ("fp", pa.int64())])

    def run(batches):
        for b in sliced(batches):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fp = np.array([simhash(t.lower(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(ROW_ID), b.column("id"), pa.array(fp)],
                                             schema=schema)
    ddl = f"{ROW_ID_DDL}, id {rows.schema['id'].dataType.simpleString()}, fp bigint"
    return rows.mapInArrow(run, ddl)


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1)) if radius >= 0 else 0


def choose_parts(n: int, distance: int = DISTANCE) -> int:
    """Number of parts: least probes and expected candidates of ``n`` evenly
    spread fingerprints (more of them ask for wider, fewer parts)."""
    def cost(m: int) -> float:
        width = BITS / m
        best = math.inf
        for t in itertools.combinations_with_replacement(range(-1, MAX_RADIUS + 1), m):
            if sum(t) == distance - m + 1:
                probes = sum(_ball(int(width), r) for r in t)
                best = min(best, probes * (PROBE_COST + n / 2 ** width))
        return best
    # parts of at most 32 bits; with more than distance + 1 parts some need not be probed
    return min(range(2, distance + 2), key=cost)


def bit_parts(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Group the bits into m parts of near equal width: start each with the
    bit most correlated to those left and add the bits closest to the part."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            b = max(left, key=lambda x: (corr[x, part].sum(), -x))
            part.append(b)
            left.remove(b)
        parts.append(sorted(part))
    return parts


def _values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for j, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << j
    return out


def _co_occurrence(batches):
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        raw = batch.column("fp").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
        total += np.rint(bits.T @ bits).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())],
                                     names=["cell", "n"])


def _histograms(parts: list[list[int]]):
    def run(batches):
        counts = [np.zeros(1 << min(len(p), HIST_BITS), np.int64) for p in parts]
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for c, p in zip(counts, parts):
                c += np.bincount(_values(fp, p[:HIST_BITS]), minlength=len(c))
        for i, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i)), pa.array(at), pa.array(c[at])],
                names=["part", "value", "n"])
    return run


def estimates(hist: np.ndarray, width: int, max_radius: int = MAX_RADIUS) -> np.ndarray:
    """``[radius, value]``: fingerprints estimated within each radius of a
    value.  Beyond ``HIST_BITS`` the further bits are taken as even."""
    seen = int(math.log2(len(hist)))
    shells = [hist.astype(np.float64)]
    idx = np.arange(len(hist))
    exact = [shells[0]]
    for r in range(1, max_radius + 1):
        # exactly r differences: each is reached from r values of r - 1
        step = sum(exact[r - 1][idx ^ (1 << b)] for b in range(seen))
        back = exact[r - 2] * (seen - r + 2) if r >= 2 else 0
        exact.append((step - back) / r)
    rest = width - seen
    out = []
    for r in range(max_radius + 1):
        out.append(sum(exact[r - s] * (math.comb(rest, s) / 2 ** rest) for s in range(min(r, rest) + 1)))
    return np.cumsum(np.maximum(out, 0), axis=0)


def allocate(fp: np.ndarray, parts: list[list[int]], est: list[np.ndarray],
             distance: int = DISTANCE) -> np.ndarray:
    """Radii ``[fingerprints, parts]`` of least estimated cost whose sum is
    ``distance - m + 1``: dynamic programming over the parts."""
    m, n = len(parts), len(fp)
    budget = distance + 1  # radii shifted by one: 0 means no probe
    best = np.full((n, budget + 1), np.inf)
    best[:, 0] = 0
    picks = []
    for p, e in zip(parts, est):
        v = _values(fp, p[:HIST_BITS])
        cost = np.zeros((n, MAX_RADIUS + 2))
        for r in range(MAX_RADIUS + 1):
            cost[:, r + 1] = PROBE_COST * _ball(len(p), r) + e[r][v]
        new = np.full_like(best, np.inf)
        pick = np.zeros((n, budget + 1), np.int8)
        for s in range(budget + 1):
            for t in range(min(s, MAX_RADIUS + 1) + 1):
                c = best[:, s - t] + cost[:, t]
                better = c < new[:, s]
                new[better, s] = c[better]
                pick[better, s] = t
        best = new
        picks.append(pick)
    out = np.zeros((n, m), np.int64)
    s = np.full(n, budget)
    for i in reversed(range(m)):
        t = picks[i][np.arange(n), s]
        out[:, i] = t - 1
        s -= t
    return out


def bucket_sizes(est: np.ndarray, width: int) -> np.ndarray:
    """Rows to expect in the bucket of each value (its probes included).  Of a
    part wider than the histogram, what a cell holds far beyond the mean is
    taken to share the further bits as well."""
    rest = max(0, width - HIST_BITS)
    if not rest:
        return est[1]
    hist = est[0] * 2.0 ** rest
    return est[1] + np.maximum(0, hist - 8 * hist.mean())


def _flips(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(1, radius + 1)
                     for c in itertools.combinations(range(width), r)], np.int64)


def _mix(*cols: np.ndarray) -> np.ndarray:
    """A 64-bit key of several integers; a collision only adds comparisons."""
    h = np.zeros(len(cols[0]), np.uint64)
    for c in cols:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _probes(parts: list[list[int]], est: list[np.ndarray], distance: int, bucket: int):
    """Task function: index and probe rows ``(key, fp, mark)`` of fingerprints;
    mark: 1 indexed, 2 probing, 4 compare within the block, block from 8 on."""
    flips = [[_flips(len(p), r) for r in range(MAX_RADIUS + 1)] for p in parts]
    crowds = [bucket_sizes(e, len(p)) for e, p in zip(est, parts)]

    def emit(i, value, fp, mark):
        seen = (1 << min(len(parts[i]), HIST_BITS)) - 1
        crowd = crowds[i][value & seen]
        blocks = np.maximum(1, np.ceil(crowd / bucket)).astype(np.int64)
        own = (_mix(fp.view(np.int64)) & np.int64(0x7FFFFFFF)) % blocks
        one = blocks == 1
        parts_ = [(value[one], fp[one], mark[one], np.zeros(one.sum(), np.int64), np.zeros(one.sum(), np.int64))]
        many = np.flatnonzero(~one)
        if len(many):
            rep = np.repeat(many, blocks[many])
            other = np.arange(len(rep)) - np.repeat(np.cumsum(blocks[many]) - blocks[many], blocks[many])
            parts_.append((value[rep], fp[rep], mark[rep], own[rep], other))
        for v, f, k, a, b in parts_:
            if len(v):
                key = _mix(np.full(len(v), i + 1), v, np.minimum(a, b), np.maximum(a, b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(f.view(np.int64)),
                     pa.array(k + np.where(a == b, 4, 0) + 8 * a)], names=["key", "fp", "mark"])

    def run(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(every), 8192):
                fp = every[at:at + 8192]
                radius = allocate(fp, parts, est, distance)
                for i, p in enumerate(parts):
                    value = _values(fp, p)
                    yield from emit(i, value, fp, np.where(radius[:, i] >= 0, 3, 1))
                    for r in range(1, MAX_RADIUS + 1):
                        at_r = np.flatnonzero(radius[:, i] == r)
                        f = flips[i][r]
                        for cut in np.array_split(at_r, max(1, len(at_r) * len(f) >> 18)):
                            if len(cut):
                                v = (value[cut][:, None] ^ f[None, :]).ravel()
                                yield from emit(i, v, np.repeat(fp[cut], len(f)), np.full(len(v), 2))
    return run


def _verified(key: np.ndarray, fp: np.ndarray, mark: np.ndarray, distance: int):
    """Linked pairs of places, for rows sorted by key: each row against the
    next, the one after, and so on, as long as the key is the same."""
    act, d = np.arange(len(key) - 1), 1
    block = mark >> 3
    while len(act):
        act = act[act + d < len(key)]
        act = act[key[act] == key[act + d]]
        a, b = act, act + d
        near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        a, b = a[near], b[near]
        meets = (((mark[a] & 1) & (mark[b] >> 1)) | ((mark[b] & 1) & (mark[a] >> 1))) & 1 == 1
        meets &= ((mark[a] & 4) != 0) | (block[a] != block[b])
        if meets.any():
            yield a[meets], b[meets]
        d += 1


def _links(distance: int):
    """Task function over rows sorted by key: a spanning forest of the links
    of whole buckets.  A bucket that a batch cuts is carried over."""
    def forest(key, fp, mark):
        label = local_components(len(fp), _verified(key, fp, mark, distance))
        # the same fingerprint stands at several places: links join them by value
        child = np.flatnonzero(label != np.arange(len(fp)))
        if len(child):
            a, b = fp[child].view(np.int64), fp[label[child]].view(np.int64)
            apart = a != b
            if apart.any():
                e = np.unique(np.stack((a[apart], b[apart]), axis=1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(e[:, 0])), pa.array(np.ascontiguousarray(e[:, 1]))],
                    names=["u", "v"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            key, fp, mark = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut == 0 and (not held or held[-1][0][-1] == key[0]):
                held.append((key, fp, mark))
                continue
            whole = [np.concatenate(x) for x in zip(*held, (key[:cut], fp[:cut], mark[:cut]))]
            yield from forest(whole[0], whole[1].view(np.uint64), whole[2])
            held = [(key[cut:], fp[cut:], mark[cut:])]
        if held:
            whole = [np.concatenate(x) for x in zip(*held)]
            yield from forest(whole[0], whole[1].view(np.uint64), whole[2])
    return run


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, parts: int | None = None,
                      bucket: int = BUCKET) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` whose components
    are those of all pairs within ``distance``."""
    spark = distinct.sparkSession
    only = distinct.select("fp")
    n = only.count()
    m = parts or choose_parts(n, distance)
    cells = only.mapInArrow(_co_occurrence, "cell bigint, n bigint").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()  # 64 x 64 cells
    together = np.zeros(BITS * BITS)
    for r in cells:
        together[r.cell] = r.n
    grouped = bit_parts(together.reshape(BITS, BITS), n, m)
    hist = [np.zeros(1 << min(len(p), HIST_BITS), np.int64) for p in grouped]
    for r in only.mapInArrow(_histograms(grouped), "part bigint, value bigint, n bigint").groupBy(
            "part", "value").agg(F.sum("n").alias("n")).collect():  # at most m x 2^16 rows
        hist[r.part][r.value] = r.n
    est = [estimates(h, len(p)) for h, p in zip(hist, grouped)]
    shared = spark.sparkContext.broadcast((grouped, est))  # bounded by m x 2^16 values

    def probe(batches):
        g, e = shared.value
        yield from _probes(g, e, distance, bucket)(batches)
    rows = only.mapInArrow(probe, "key bigint, fp bigint, mark bigint")
    # the mark in the sort makes nothing of ties; the key alone deals out the rows
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _links(distance), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per input row: ``__row_id, id, fp, component_id, keep_row``.

    ``component_id`` is the least id among all documents reachable by links,
    the document's own included; ``keep_row`` the first row with that id.  A
    null or wordless text has fingerprint zero and links like any other; a
    null id is no candidate for a component's id (null when all are null);
    repeated rows stay.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(
        F.min("id").alias("least"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", ROW_ID))
        .alias("first")), "distinct_fingerprints")
    links = fingerprint_links(distinct, distance)
    node = connected_components(links)
    labelled = distinct.join(node, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "first", F.coalesce("component", "fp").alias("component"))
    labelled = stored(labelled, "labelled")
    top = stored(labelled.groupBy("component").agg(F.min("least").alias("component_id"),
                                                   F.min("first").alias("first")), "component_ids")
    by_fp = stored(labelled.select("fp", "component").join(top, "component"), "fp_components")
    return rows.join(by_fp, "fp").select(ROW_ID, "id", "fp", "component_id",
                                         F.col(f"first.{ROW_ID}").alias("keep_row"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: the one with the least id of each
    component (the first of the scan among repeated ids)."""
    docs = identified(docs)
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    return keep_rows(docs, found.where(F.col(ROW_ID) == F.col("keep_row")))
