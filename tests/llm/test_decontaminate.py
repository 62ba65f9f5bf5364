import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import decontaminate as D
from tests.llm.conftest import EDGE, dicts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, n=10):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        p = words(t)
        for win in {tuple(p[i:i + n]) for i in range(max(1, len(p) - n + 1))} if p else ():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(s):
    a = np.array(s, np.int64)
    assert D.suffix_array(a).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=300))
def test_wavelet_ranks(s):
    a = np.array(s, np.int64)
    tree = D.WaveletMatrix(a, 4)
    for i in {0, 1, len(s) // 2, len(s)}:
        for v in (0, 3, 12):
            assert tree.rank(np.array([v]), np.array([i]))[0] == s[:i].count(v)
    sym, r = tree.access_rank(np.arange(len(s)))
    assert sym.tolist() == s and r.tolist() == [s[:i].count(x) for i, x in enumerate(s)]


def test_search_and_locate_every_occurrence():
    rng = random.Random(3)
    docs = [[rng.randint(0, 3) for _ in range(rng.choice([0, 1, 50, 200]))] for _ in range(20)]
    docs += [docs[-1]] * 5
    first = np.cumsum([0, *map(len, docs)])
    index = D.FMIndex(np.array(sum(docs, []), np.int64), first, 4)
    for phrase in ([0], [1, 2], [3, 3, 0], [0, 1, 2, 3, 0]):
        lo, hi = index.search(np.array([[-1] * (5 - len(phrase)) + phrase]), np.array([len(phrase)]))
        at = index.locate(np.arange(lo[0], hi[0]))
        doc = np.searchsorted(index.doc_start, at, side="right") - 1
        got = sorted(zip(doc.tolist(), (at - doc - first[doc]).tolist()))
        want = [(d, i) for d, x in enumerate(docs) for i in range(len(x) - len(phrase) + 1)
                if x[i:i + len(phrase)] == phrase]
        assert got == want


def test_documents_match_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "C", "dé", "e1"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 10, 12, 25]))))
             for i in range(12)] + [(None, "zz yy"), (13, None), (2, "a b, b A")]
    docs = []
    for i in range(60):
        t = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 30]))]
        if rng.random() < 0.5:
            t += words(rng.choice(items)[1])
            t += [rng.choice(vocab)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(t)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    named = [("" if i is None else i, t) for i, t in items]
    for block in (D.BLOCK_WINDOWS, 7):  # one pass, and several
        found = dicts(D.contamination(df, bench, block_windows=block)
                      .withColumn("hit", D.n_hit("spans")))
        got = {r["id"]: (r["n_words"], r["hit"], r["items"]) for r in found}
        assert got == {i: brute(t, named) for i, t in docs}


def test_spans_are_cut_and_clean_texts_stay(spark, edge, empty):
    passage = " ".join(f"word{i}" for i in range(30))
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, f"Clean, début! {passage.upper()}; the end.", 7), (2, passage, 7), (3, "clean  text", 7),
         (4, None, 7)], "doc_id bigint, text string, n_chars int")
    out = {r["doc_id"]: r for r in dicts(D.remove_contamination(docs, bench))}
    assert set(out) == {1, 3, 4}
    assert out[1]["text"] == "Clean, début! \n; the end."
    assert out[1]["n_chars"] == len(out[1]["text"])
    assert out[3] == {"doc_id": 3, "text": "clean  text", "n_chars": 7}
    assert out[4]["text"] is None
    kept = D.remove_contamination(edge, bench)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)
    assert D.contamination(empty, bench).count() == 0
    assert D.contamination(edge, bench.where("item_id < 0")).where("size(spans) > 0").count() == 0


def test_a_cut_that_joins_another_passage_is_cut_again(spark):
    first, second = "aa " * 5 + "bb " * 5, " ".join(f"w{i}" for i in range(10))
    bench = spark.createDataFrame([(1, first), (2, second)], "item_id bigint, text string")
    text = "start w0 w1 w2 w3 w4 " + first + "w5 w6 w7 w8 w9 end"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    out = dicts(D.remove_contamination(docs, bench))
    assert words(out[0]["text"]) == ["start", "end"]


def test_empty_shard():
    n, hits = D.find_in_shard(pa.array(["", ""]), D.Phrases([("a b", "1")]))
    assert n.tolist() == [0, 0] and hits == {}
