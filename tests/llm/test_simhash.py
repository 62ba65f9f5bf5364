import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logloom.llm import simhash
from logloom.llm.components import connected_components, local_components
from tests.llm.conftest import EDGE, dicts, table


def brute_fp(text):
    words = [w for w in _split(_lower(text or "")) if w]
    if not words:
        return 0
    n = 4
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def _split(t):
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    return t.split(" ")


def brute_components(fps, distance=4):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    fps = list(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


def test_whole_table_matches_brute_force(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.001")
    rows = [(r.doc_id, brute_fp(r.text)) for r in docs.collect()]
    comp = brute_components({f for _, f in rows})
    least = {}
    for i, f in rows:
        least[comp[f]] = min(i, least.get(comp[f], i))
    want = {i: (f, least[comp[f]]) for i, f in rows}
    got = {r["id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in dicts(simhash.near_duplicates(docs))}
    assert got == want


def test_edge_rows(edge, empty):
    found = dicts(simhash.near_duplicates(edge))
    assert len(found) == len(EDGE)
    want = sorted((brute_fp(t), i is None, i) for i, t, *_ in EDGE if i is not None)
    got = sorted((r["fp"] % (1 << 64), r["id"] is None, r["id"]) for r in found if r["id"] is not None)
    assert got == want
    zero = [r for r in found if r["fp"] == 0]
    assert {r["component_id"] for r in zero} == {2} and len(zero) == 4
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    # (id 8 stands on two rows of different components)
    assert kept.count() == len(set(brute_components({brute_fp(r[1]) for r in EDGE}).values()))


def clustered(n, seed):
    """Fingerprints with chains and dense groups of near copies."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        c = rng.getrandbits(64) & (~0 if rng.random() < 0.7 else 0xFFFF0000FFFF)
        for _ in range(rng.choice([1, 1, 1, 5, 40])):
            f = c
            for b in rng.sample(range(64), rng.randint(0, 3)):
                f ^= 1 << b
            out.add(f)
            if rng.random() < 0.1:
                c = f
    return sorted(out)


def linked(spark, fps, **kw):
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    comp = {r.node % (1 << 64): r.component % (1 << 64) for r in
            connected_components(simhash.fingerprint_links(df, **kw)).collect()}
    return {f: comp.get(f, f) for f in fps}


def same_partition(a, b):
    pair = {(a[f], b[f]) for f in a}
    return len(pair) == len({x for x, _ in pair}) == len({y for _, y in pair})


@pytest.mark.parametrize("parts", [2, 3, 4, 5])
def test_any_number_of_parts_finds_all_links(spark, parts):
    fps = clustered(600, parts)
    assert same_partition(linked(spark, fps, parts=parts), brute_components(fps))


@pytest.mark.parametrize("parts", [5, 3])
def test_buckets_split_into_blocks_lose_nothing(spark, parts):
    rng = random.Random(9)
    # all alike in three of the parts: one hot value each
    fps = sorted({rng.getrandbits(20) << 3 for _ in range(700)})
    assert same_partition(linked(spark, fps, parts=parts, bucket=16), brute_components(fps))


def test_radii_follow_the_pigeonhole_rule_and_avoid_hot_values():
    parts = [list(range(0, 16)), list(range(16, 32)), list(range(32, 48)), list(range(48, 64))]
    hist = [np.ones(1 << 16, np.int64) for _ in parts]
    hist[0][5] = 10_000_000
    est = [simhash.estimates(h, 16) for h in hist]
    fp = np.array([5, 1 << 20], np.uint64)
    radius = simhash.allocate(fp, parts, est)
    assert (radius.sum(axis=1) == 4 - 4 + 1).all()
    assert radius[0, 0] == -1


def test_estimates_count_balls():
    rng = np.random.default_rng(1)
    hist = rng.integers(0, 5, 1 << 6)
    est = simhash.estimates(hist, 6)
    for v in (0, 7, 63):
        for r in range(4):
            want = sum(hist[u] for u in range(64) if (u ^ v).bit_count() <= r)
            assert abs(est[r][v] - want) < 1e-6


def test_a_crowd_in_a_wide_part_is_seen():
    hist = np.full(1 << simhash.HIST_BITS, 10)
    hist[77] = 1_000_000
    size = simhash.bucket_sizes(simhash.estimates(hist, 21), 21)
    assert size[77] > 900_000 and size[5] < 100


def test_bit_parts_are_a_partition_that_groups_correlated_bits():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (500, 64))
    bits[:, 40] = bits[:, 3]
    parts = simhash.bit_parts((bits.T @ bits).astype(float), 500, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any(3 in p and 40 in p for p in parts)


def test_more_fingerprints_ask_for_fewer_parts():
    sizes = [simhash.choose_parts(n) for n in (10**3, 10**6, 10**8, 10**11)]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1]


def test_components_of_paths_stars_and_repeats(spark):
    path = [(i, i + 1) for i in range(50)]
    star = [(100, i) for i in range(101, 180)]
    df = spark.createDataFrame(path + star + path + [(7, 7), (301, 300)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 180)} | {301: 300}
    assert got == want
    assert connected_components(df.where(F.col("u") < 0)).count() == 0
    assert local_components(4, iter([(np.array([3]), np.array([1]))])).tolist() == [0, 1, 2, 1]
