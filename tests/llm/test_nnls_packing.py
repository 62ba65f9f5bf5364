import itertools
import zlib
from collections import defaultdict

import numpy as np

from logloom.llm import nnls_packing as N
from logloom.llm.queries import tokenizer_path
from tests.llm.conftest import dicts, table
from tests.llm.test_packing import reference_ids


def check(rows, ids, capacity):
    """Every id lies in one piece, sequences are gapless and need no padding."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r[N.ROW_ID]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(docs) == len(ids)
    pool = sorted(tuple(i) for i in ids)
    got = []
    for parts in docs.values():
        parts.sort(key=lambda r: r["start"])
        text = []
        for r in parts:
            assert r["start"] == len(text) and r["length"] > 0
            piece = np.frombuffer(r["ids"], "<u4")
            assert len(piece) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
            text += piece.tolist()
        assert {r["doc_tokens"] for r in parts} == {len(text)}
        got.append(tuple(text))
    assert sorted(got) == pool
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    return len(seqs)


def test_whole_table(spark):
    docs = table(spark, "documents")
    rows = dicts(N.pack(docs, tokenizer_path(), with_ids=True))
    ids = reference_ids([r.text or "" for r in docs.collect()])
    assert check(rows, ids, 2048) <= sum(map(len, ids)) // 2048 + 11


def test_edge_rows_and_small_chunks(spark, edge, empty):
    ids = reference_ids([r.text or "" for r in edge.collect()])
    for chunk in (1, 500, 1 << 20):
        rows = dicts(N.pack(edge, tokenizer_path(), capacity=64, chunk_tokens=chunk, with_ids=True))
        check(rows, ids, 64)
    assert [r["length"] for r in rows if r["id"] == 2] == [1]
    assert N.pack(empty, tokenizer_path()).count() == 0
    assert "ids" not in N.pack(edge, tokenizer_path()).columns


def test_combinations_are_all_shallow_ones():
    for capacity in (1, 2, 7, 24):
        lengths, times = N.combinations(capacity)
        got = [tuple(sorted(itertools.chain.from_iterable([n] * k for n, k in zip(ls, ks) if n)))
               for ls, ks in zip(lengths.tolist(), times.tolist())]
        assert len(got) == len(set(got))

        def parts(total, most):
            if total == 0:
                yield ()
            for n in range(min(total, most), 0, -1):
                for more in parts(total - n, n):
                    yield (*more, n)
        want = {p for p in parts(capacity, capacity) if len(p) <= 3 or len(set(p)) <= 2}
        assert set(got) == want


def test_repeats_reach_the_least_squares():
    rng = np.random.default_rng(2)
    lengths, times = N.combinations(12)
    matrix = np.zeros((13, len(lengths)))
    for c, (ls, ks) in enumerate(zip(lengths, times)):
        np.add.at(matrix[:, c], ls, ks)
    matrix[0] = 0
    for _ in range(5):
        hist = rng.integers(0, 4000, 13)
        hist[0] = 0
        x = N.repeats(lengths, times, hist, rounds=3000)
        rest = hist - matrix @ x
        slope = matrix.T @ rest
        assert (x >= 0).all()
        # no step of half a repeat or more is left in any column
        norm = (matrix ** 2).sum(0)
        assert (np.abs(np.maximum(slope / norm, -x)) < 0.5).all()


def test_solutions_stay_within_the_histogram_and_fill_windows():
    rng = np.random.default_rng(3)
    for capacity, n in ((64, np.clip(np.exp(rng.normal(3, 1, 5000)).astype(int), 1, 64)),
                        (2048, np.clip(np.exp(rng.normal(6.3, 1, 8000)).astype(int), 1, 2048)),
                        (2048, np.full(100, 700))):
        hist = np.bincount(n, minlength=capacity + 1)
        taken, left = N.solve(hist, capacity)
        got = left.copy()
        for ls, ks, count in taken:
            assert sum(a * k for a, k in zip(ls, ks)) == capacity and count > 0
            for a, k in zip(ls, ks):
                got[a] += k * count
        assert (got == hist).all() and (left >= 0).all()
        tokens = np.arange(capacity + 1)
        if len(set(n.tolist())) > 1:
            assert (left * tokens).sum() < 0.1 * (hist * tokens).sum()


def test_windows_end_in_powers_of_two():
    assert N.windows(2048 * 2 + 1000, 2048).tolist() == [2048, 4096, 4608, 4864, 4992, 5056, 5088, 5096]
    assert N.windows(0, 2048).tolist() == []
