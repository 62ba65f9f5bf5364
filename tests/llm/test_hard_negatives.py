import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logloom.llm import hard_negatives as H
from tests.llm.conftest import dicts, table

SCHEMA = "vec_id bigint, embedding array<float>, label int, rid string, vec string, anchor int"


def brute(rows, n_pos=5, n_neg=5, percent=80, every=100):
    """``rows``: (id, vector, label); all pairs, plainly."""
    fit = [(n, i, [math.floor(256 * x) for x in v], lab) for n, (i, v, lab) in enumerate(rows)
           if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = float("inf")
    for n, i, v, lab in fit:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), last if j is None else j, m, j, other)
                        for m, j, w, other in fit if m != n)
        same = [s for s in scored if s[4] == lab][:n_pos]
        for p in same:
            window = [s for s in scored if s[4] != lab
                      and percent * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:n_neg]
            out += [(i, p[3], r, s[3], -p[0], -s[0]) for r, s in enumerate(window, 1)]
    return sorted(out, key=repr)


def mined(df, **more):
    return sorted(((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"],
                    r["positive_score"], r["negative_score"]) for r in dicts(H.mine(df, **more))), key=repr)


def test_whole_table_against_all_pairs(spark):
    df = table(spark, "embeddings")
    want = brute([(r.vec_id, list(map(float, r.embedding)), r.label) for r in df.collect()])
    assert want and mined(df) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(3)
    rows = [(0, [1.0, -0.5], 1), (0, [1.0, -0.5], 1), (100, [0.0, 0.0], 2), (200, [], 1), (None, [0.9, 0.1], 2),
            (300, None, 1), (400, [1.0, None], 1), (500, [nan, 1.0], 1), (600, [inf], 1), (700, [1.0, 1.0], None),
            (800, [1.0], 1), (900, [0.3, 0.2, 0.9], 2), (900, [0.3, 0.2, 0.9], 1), (1000, [-0.0, -0.2], 3)]
    # equal vectors: ties at every place, more than the window takes
    rows += [(i, [0.5, -0.25], i % 3) for i in range(1, 40)]
    rows += [(1000 + i, [rng.choice([-.5, 0., .25, .5]) for _ in range(3)], rng.randint(1, 3)) for i in range(1, 60)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    assert mined(df) == brute(rows)
    assert mined(df, n_positives=2, n_negatives=1, least_percent=50) == brute(rows, 2, 1, 50)
    assert mined(df.where("vec_id < -1")) == []
    assert mined(df.where("vec_id = 1")) == []  # no anchors


def test_blocks_of_anchors(spark, monkeypatch):
    df = table(spark, "embeddings")
    want = mined(df)
    monkeypatch.setattr(H._anchor_blocks, "__defaults__", (70,))
    assert mined(df, anchor=F.col("vec_id") % 100 == 0) == want


def test_blocks_of_rows_hold_every_row_once():
    batches = [pa.record_batch({"rid": list(range(s, s + n)), "vec": [[1, 2]] * n})
               for s, n in ((0, 7), (7, 30), (37, 1))]
    got = [t.column("rid").to_pylist() for t in H._blocks(iter(batches), 10)]
    assert [i for b in got for i in b] == list(range(38)) and max(map(len, got)) <= 5


def test_search_is_exact_and_stops_early():
    rng = np.random.default_rng(1)
    vec = rng.integers(-9, 10, (2000, 6))
    vec[::50, 0] += 200
    lists = H.Lists([list(map(int, v)) for v in vec], 6)
    stopped = 0
    for i in range(0, 2000, 100):
        score = vec @ vec[i]
        wanted = rng.random(2000) < 0.7
        for low, high in ((float("-inf"), float("inf")), (0, int(score.max()) // 2), (5, 4)):
            (found,), depth = lists.search(vec[i], wanted, [low], [high], 5)
            inside = np.flatnonzero(wanted & (score >= low) & (score <= high))
            kth = np.sort(score[inside])[::-1][:5]
            assert len(kth) == 0 or set(inside[score[inside] >= kth[-1]]) <= set(found[0].tolist())
            stopped += 0 < depth < 2000
    assert stopped > 10


def test_scores_beyond_doubles_are_compared_exactly():
    big = 2 ** 40
    vec = [[big, 0], [big, 1], [big, -1], [big - 1, 5]]
    lists = H.Lists(vec, 2)
    ((at, score),), _ = lists.search(np.array([big, 1]), np.ones(4, bool), [float("-inf")], [float("inf")], 1)
    assert at.tolist() == [1] and score.tolist() == [2 ** 80 + 1]
