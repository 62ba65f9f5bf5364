"""Packing by non-negative least squares over shallow length combinations.

A task takes its documents in chunks of a bounded number of tokens.  The
chunk's pieces are counted by length, and the combinations that fill a window
exactly are enumerated: one, two or three lengths, or repeats of two lengths.
How often each is to be repeated is the least-squares solution of
``combinations x repeats = histogram`` with no repeat below zero, found by
coordinate descent: a round settles the columns of greatest gain that share
no length, so each is minimised exactly.  Repeats are rounded within what the
histogram holds; what is left is solved again while that fills windows.  The
residual pieces are packed greedily, longest first, and cut where a window
ends; the last part of a window goes into sequences of powers of two, which
need no padding.

Scale: one pass over the documents, nothing is shuffled, stored or sent to the
driver, and a chunk, not the task, bounds the memory.  Sequences never reach
across chunks, which costs at most one window cut into powers of two per chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from logloom.llm.common import ROW_ID, ROW_ID_ARROW, ROW_ID_DDL, bounded_batches, sliced, with_row_id
from logloom.llm.packing import END_ID, SLICE_BYTES, _tokenizer

CAPACITY = 2048
#: Tokens of the documents that are packed together in a task.
CHUNK_TOKENS = 8 << 20
#: Rounds of coordinate descent in a solution, and columns weighed in a round.
ROUNDS = 60
COLUMNS = 6000
#: Solutions one after the other, each of what the one before has left.
SOLUTIONS = 8

_COMBINATIONS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def combinations(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and repeats (3 each, unused ones zero) of every combination of
    up to three pieces, and of two lengths repeated, that fills a window."""
    if capacity in _COMBINATIONS:
        return _COMBINATIONS[capacity]
    found = [np.array([[capacity, 0, 0, 1, 0, 0]])]
    for a in range(1, capacity):  # three different lengths, a > b > c
        b = np.arange(max(1, (capacity - a) // 2), min(a, capacity - a))
        c = capacity - a - b
        b, c = b[(c >= 1) & (c < b)], c[(c >= 1) & (c < b)]
        one = np.ones_like(b)
        found.append(np.column_stack([one * a, b, c, one, one, one]))
    for a in range(1, capacity):
        for k in range(1, capacity // a + 1):
            rest = capacity - a * k
            if rest == 0:
                found.append(np.array([[a, 0, 0, k, 0, 0]]))
                continue
            j = np.arange(1, rest + 1)
            j = j[rest % j == 0]
            b = rest // j
            j, b = j[b < a], b[b < a]
            zero, one = np.zeros_like(b), np.ones_like(b)
            found.append(np.column_stack([one * a, b, zero, one * k, j, zero]))
    table = np.concatenate(found)
    _COMBINATIONS[capacity] = table[:, :3], table[:, 3:]
    return _COMBINATIONS[capacity]


def repeats(lengths: np.ndarray, times: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS,
            columns: int = COLUMNS) -> np.ndarray:
    """Non-negative least squares: how often to take each combination."""
    x = np.zeros(len(lengths))
    rest = hist.astype(float)
    rest[0] = 0
    weight = times.astype(float)
    norm = (weight ** 2).sum(1)
    for _ in range(rounds):
        slope = (weight * rest[lengths]).sum(1)
        step = np.maximum(slope / norm, -x)
        gain = step * (2 * slope - step * norm)
        gain[np.abs(step) < 0.5] = 0  # less than what rounding decides
        best = np.argpartition(-gain, min(columns, len(gain) - 1))[:columns] if len(gain) > columns \
            else np.arange(len(gain))
        best = best[gain[best] > 0]
        if not len(best):
            break
        best = best[np.argsort(-gain[best], kind="stable")]
        taken, chosen = [False] * len(rest), []
        for i, (a, b, c) in zip(best.tolist(), lengths[best].tolist()):
            if not (taken[a] or (b and taken[b]) or (c and taken[c])):
                taken[a] = True
                if b:
                    taken[b] = True
                if c:
                    taken[c] = True
                chosen.append(i)
        chosen = np.array(chosen)
        x[chosen] += step[chosen]
        np.subtract.at(rest, lengths[chosen], times[chosen] * step[chosen, None])
        rest[0] = 0
    return x


def solve(hist: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[list[int], list[int], int]], np.ndarray]:
    """``(lengths, repeats of each, times)`` of the combinations taken, and the
    histogram of what is left."""
    left = hist.astype(np.int64).copy()
    all_lengths, all_times = combinations(capacity)
    out = []
    for _ in range(SOLUTIONS):
        some = left > 0
        some[0] = True
        fits = some[all_lengths].all(1)
        lengths, times = all_lengths[fits], all_times[fits]
        if not len(lengths):
            break
        x = np.rint(repeats(lengths, times, left)).astype(np.int64)
        taken = 0
        for i in np.argsort(-x, kind="stable")[:int((x > 0).sum())].tolist():
            ls = [n for n in lengths[i].tolist() if n]
            ks = [k for k in times[i].tolist() if k]
            count = min(int(x[i]), *(int(left[n]) // k for n, k in zip(ls, ks)))
            if count > 0:
                out.append((ls, ks, count))
                for n, k in zip(ls, ks):
                    left[n] -= k * count
                taken += count
        if not taken:
            break
    return out, left


def windows(tokens: int, capacity: int) -> np.ndarray:
    """Where sequences end that hold so many tokens without padding: windows,
    then powers of two."""
    sizes = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        sizes.append(1 << (rest.bit_length() - 1))
        rest -= sizes[-1]
    return np.cumsum(np.array(sizes, np.int64))


def place(length: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """Where pieces go: ``piece, cut, size, sequence, offset``, a row for each
    part of a piece (``cut``: the piece's tokens before the part)."""
    hist = np.bincount(length, minlength=capacity + 1)
    by_length = np.argsort(length, kind="stable")
    used = np.cumsum(hist) - hist  # next of each length in by_length
    sequence, offset = np.full(len(length), -1, np.int64), np.zeros(len(length), np.int64)
    taken, _ = solve(hist, capacity)
    at = 0
    for ls, ks, count in taken:
        before = 0
        for n, k in zip(ls, ks):
            rows = by_length[used[n]:used[n] + k * count]
            used[n] += k * count
            number = np.arange(k * count)
            sequence[rows] = at + number // k
            offset[rows] = before + number % k * n
            before += n * k
        at += count
    whole = np.flatnonzero(sequence >= 0)
    rest = by_length[sequence[by_length] < 0][::-1]  # longest first
    end = np.cumsum(length[rest])
    stops = windows(int(end[-1]), capacity) if len(rest) else np.zeros(0, np.int64)
    edges = np.union1d(end, stops)
    begin = np.concatenate(([0], edges[:-1])) if len(edges) else edges
    of = np.searchsorted(end, begin, side="right")
    window = np.searchsorted(stops, begin, side="right")
    starts = end - length[rest]
    opens = np.concatenate(([0], stops[:-1])) if len(stops) else stops
    return (np.concatenate([whole, rest[of]]),
            np.concatenate([np.zeros(len(whole), np.int64), begin - starts[of]]),
            np.concatenate([length[whole], edges - begin]),
            np.concatenate([sequence[whole], at + window]),
            np.concatenate([offset[whole], begin - opens[window]]))


def _chunks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, tokens: int):
    """``(rows, ids, sizes)`` of documents that hold about ``tokens`` together."""
    enc = _tokenizer(tokenizer)
    rows, ids, sizes, held = [], [], [], 0
    for batch in sliced(batches, max_bytes=SLICE_BYTES):
        if not batch.num_rows:
            continue
        flat, n = enc.encode(batch.column("text"))
        flat = np.insert(flat, np.cumsum(n), end_id)
        rows.append(batch.select([ROW_ID, "id"]))
        ids.append(flat.astype("<u4"))
        sizes.append(n + 1)
        held += len(flat)
        if held >= tokens:
            yield pa.Table.from_batches(rows), np.concatenate(ids), np.concatenate(sizes)
            rows, ids, sizes, held = [], [], [], 0
    if rows:
        yield pa.Table.from_batches(rows), np.concatenate(ids), np.concatenate(sizes)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, chunk_tokens: int = CHUNK_TOKENS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``__row_id, id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, if asked for, ``ids`` (little-endian unsigned
    32-bit token ids, the training data itself).

    A null or empty text is the end id alone.  Every sequence is full or holds
    a power of two of tokens, so none needs padding.  Null ids and repeated
    rows are documents like any other; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = with_row_id(docs, id_col, text_col)
    id_type = to_arrow_type(rows.schema["id"].dataType)
    fields = [(ROW_ID, ROW_ID_ARROW), ("id", id_type), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
              ("offset", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)

    def run(batches):
        sequences = TaskContext.get().partitionId() << 40
        for docs_of, ids, sizes in _chunks(batches, tokenizer, end_id, chunk_tokens):
            parts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), parts)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            begin = nth * capacity
            length = np.minimum(capacity, sizes[doc] - begin)
            piece, cut, size, sequence, offset = place(length, capacity)
            doc, start = doc[piece], begin[piece] + cut
            flat = (np.cumsum(sizes) - sizes)[doc] + start
            raw = memoryview(ids.tobytes())
            spans = [raw[4 * s:4 * (s + n)] for s, n in zip(flat.tolist(), size.tolist())]
            take = pa.array(doc)
            columns = [docs_of.column(ROW_ID).take(take), docs_of.column("id").take(take),
                       pa.array(start), pa.array(size), pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                       pa.array(sizes[doc]), pa.array(sequence + sequences), pa.array(offset)]
            if with_ids:
                columns.append(pa.array([bytes(s) for s in spans], pa.binary()))
            yield from pa.table(columns, schema=schema).to_batches(max_chunksize=20_000)
            sequences += int(sequence.max()) + 1
    ddl = (f"{ROW_ID_DDL}, id {rows.schema['id'].dataType.simpleString()}, start bigint, length bigint, "
           "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
           + (", ids binary" if with_ids else ""))
    return rows.mapInArrow(run, ddl)
