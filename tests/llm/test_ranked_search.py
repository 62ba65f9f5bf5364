import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from logloom.llm import ranked_search as R
from tests.llm.conftest import dicts, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """``docs``: (id, text) rows; ``items``: (id, text) rows."""
    counted = [(i, n, Counter(t), len(t)) for n, (i, text) in enumerate(docs) if (t := terms(text))]
    total = sum(c[3] for c in counted)
    df = Counter(t for c in counted for t in c[2])
    out = []
    for item, text in items:
        scored = []
        for i, n, tf, size in counted:
            m = 25 + 75 * size * len(counted) // total
            s = sum(math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms(text) if t in tf)
            if s > 0:
                scored.append((-s, math.inf if i is None else i, i))
        scored.sort(key=lambda s: s[:2])
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, **more):
    return sorted(((r["item_id"], r["rank"], r["id"], r["score"])
                   for r in dicts(R.search(docs, items, **more))), key=repr)


def test_whole_table_against_all_scores(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and found(docs, items) == want


def test_edge_rows(spark, edge, empty, tmp_path):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    rows = [(1, "Alpha GAMMA gamma lorem"), (2, None), (3, ""), (None, "delta text"), (5, "nowhere"),
            (5, "lorem lorem lorem ipsum"), (6, "ünïcödé 世界 😀"), (7, "lorem " * 3000 + "alpha")]
    items = spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id bigint, text string, score string, rank int")
    assert found(edge, items) == brute(docs, rows)
    assert found(edge, items, k=1) == brute(docs, rows, 1)
    assert found(empty, items) == [] and found(edge, items.where("item_id < 0")) == []
    # equal texts tie by id; more of them than places
    same = spark.createDataFrame([(i, "equal words here") for i in range(40)] + [(99, "")], "doc_id bigint, text string")
    assert found(same.repartition(4), items.limit(0)) == []
    query = spark.createDataFrame([(1, "equal here")], "item_id bigint, text string")
    assert {(r[1], r[2]) for r in found(same.repartition(4), query)} == {(i + 1, i) for i in range(10)}


def test_blocks_of_items_and_documents(spark, monkeypatch):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    want = found(docs, items)
    monkeypatch.setattr(R, "BLOCK_TERMS", 300)
    assert found(docs, items) == want


def shards(texts):
    words, doc, code, tf = R.counted(pa.array(texts))
    hashes = R.term_hashes(words.vocabulary.to_pylist())
    return list(R.signatures(doc, code, tf, hashes, len(texts)))


def test_bounds_are_never_below_the_scores(monkeypatch):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, weights=range(300, 0, -1), k=rng.choice([1, 3, 40, 900])))
             for _ in range(200)]
    texts += ["w1 " * 5000, "", "w2"]
    words = sorted(set(vocabulary))
    n = [len(terms(t)) for t in texts]
    df = np.array([sum(w in t.split() for t in texts) for w in words])
    items = [(i, [(w, rng.randint(1, 3)) for w in rng.sample(words, rng.randint(1, 30))]) for i in range(20)]
    items.append((99, [("absent", 1)]))
    queries = R.Queries(items, words + ["absent"], np.append(df, 0), sum(x > 0 for x in n), sum(n))
    exact = np.concatenate([s for _, s in queries.scores(pa.array(texts))])
    for cells in (R.CELLS, 64):
        monkeypatch.setattr(R, "CELLS", cells)
        monkeypatch.setattr(R, "SHARD_DOCS", 4096 if cells > 64 else 16)
        assert (np.concatenate([s for _, s in queries.scores(pa.array(texts))]) == exact).all()
        slack, seen = 0, 0
        for members, width, bits, levels in shards(texts):
            bound = np.concatenate([b for _, b in queries.bounds(np.array(n)[members], width, levels, bits.tobytes())])
            assert (bound >= exact[:, members]).all()
            slack += bound.sum() / max(1, exact[:, members].sum())
            seen += len(members)
        assert seen == sum(x > 0 for x in n)
    assert exact[20].sum() == 0


def test_large_sums_stay_exact():
    weights = np.array([[2.0 ** 40, 3.0]])
    parts = np.array([[2.0 ** 30], [7.0]])
    assert R.exact_product(weights, parts).tolist() == [[2 ** 70 + 21]]
    assert R.length_norm(np.array([10 ** 9]), 10 ** 12, 10 ** 14).tolist() == [25 + 75 * 10 ** 9 // 100]
