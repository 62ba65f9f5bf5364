"""Packing of token pieces by a configuration linear program.

Pieces of one length are alike, so the problem is the histogram of lengths
(at most ``capacity`` counts, whatever the corpus).  The configuration LP has
a variable for every way to fill a sequence; it is solved by multiplicative
weights: a length weighs more the less of its demand is covered, and the
pricing problem - the fullest configuration by weight - is a knapsack dynamic
program over the capacity.  Each priced configuration is taken a whole number
of times, and what that rounding leaves over is packed best fit, longest
first, on the histogram too.

Scale: the histogram and the configurations are the only things on the
driver; both are bounded by the capacity.  Texts are tokenised where they are
read.  A piece gets its number among the pieces of its length from its task's
counter plus the counts of the tasks before, so no length, however frequent,
is numbered in one place; the number gives the sequence and the offset.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import (ROW_ID, ROW_ID_ARROW, ROW_ID_DDL, bounded_batches, sliced, stored,
                                with_row_id)

CAPACITY = 4096
END_ID = 1
#: Rounds of the multiplicative weights, knapsack tables at most, strength of
#: the weights, and preference of long pieces.
ROUNDS = 8
PRICINGS = 150
ETA = 4.0
GREED = 1.05
#: Distinct words that a Python worker remembers per generation (it keeps two).
CACHE_WORDS = 250_000
#: Text that is encoded at a time.
SLICE_BYTES = 4 << 20
#: ASCII signs (the apostrophe aside) between a letter and white space are a
#: token run of their own.
STOPPED = r"([a-z])([!-&(-/:-@\[-`{-~]+)(\s|\z)"

_TOKENIZERS: dict[str, "ChunkTokenizer"] = {}


class ChunkTokenizer:
    """Token ids of texts, encoding each distinct word once.

    Texts are cut at ASCII white space.  The vocabulary's normaliser and
    splitter never join characters across white space and drop it, so the
    chunks encode alone as in their text; so do a letter and the stops behind
    it.  ASCII letters are lower-cased first, as the normaliser does anyway.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in chunks, where letters are lower-cased
        #: Texts that hold one of these are encoded whole, by the plain call.
        self.plain = Tokenizer.from_file(path)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Little-endian ids of distinct words, from memory where known."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in older]
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[w] = np.array(e.ids, "<u4").tobytes()
        return [known[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        whole = np.zeros(len(texts), bool)
        for word in self.special:
            whole |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False).astype(bool)
        if not whole.any():
            return self._chunked(texts)
        flat, sizes = self._chunked(pc.if_else(pa.array(whole), "", texts))
        found = self.plain.encode_batch(texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False)
        ids = [np.array(e.ids, flat.dtype) for e in found]
        at = np.cumsum(sizes)[whole]
        sizes[whole] = [len(i) for i in ids]
        return np.insert(flat, np.repeat(at, sizes[whole]), np.concatenate(ids)), sizes

    def _chunked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts without special tokens."""
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), STOPPED, r"\1 \2\3")
        chunks = pc.ascii_split_whitespace(plain)
        offsets = chunks.offsets.to_numpy()
        coded = chunks.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        ids = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), "<u4")
        begin = np.cumsum(size) - size
        at = coded.indices.to_numpy().astype(np.int64)
        n = size[at] if len(at) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(n)))
        take = np.repeat(begin[at] - total[:-1], n) + np.arange(total[-1]) if len(at) else np.zeros(0, np.int64)
        return flat[take], total[offsets[1:]] - total[offsets[:-1]]


def _tokenizer(path: str) -> ChunkTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``__row_id, id, piece, start, length, ids_crc32, task,
    nth``; ``nth`` counts the task's pieces of that length from 0."""
    bounded_batches(docs.sparkSession)
    rows = with_row_id(docs, id_col, text_col)
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        enc = _tokenizer(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64).tolist()
        for batch in sliced(batches, max_bytes=SLICE_BYTES):
            ids, sizes = enc.encode(batch.column("text"))
            raw = ids.astype("<u4").tobytes()
            tail = end_id.to_bytes(4, "little")
            src, piece, start, length, crc, nth, at = [], [], [], [], [], [], 0
            for d, n in enumerate(sizes.tolist()):
                doc = raw[4 * at:4 * (at + n)] + tail
                at += n
                for k, s in enumerate(range(0, n + 1, capacity)):
                    part = doc[4 * s:4 * (s + capacity)]
                    ln = len(part) // 4
                    src.append(d)
                    piece.append(k)
                    start.append(s)
                    length.append(ln)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[ln])
                    seen[ln] += 1
            take = pa.array(src, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW_ID).take(take), batch.column("id").take(take),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array([task] * len(src), pa.int32()), pa.array(nth, pa.int64())],
                schema=pa.schema([(ROW_ID, ROW_ID_ARROW), ("id", id_type), ("piece", pa.int32()),
                                  ("start", pa.int64()), ("length", pa.int64()),
                                  ("ids_crc32", pa.int64()), ("task", pa.int32()),
                                  ("nth", pa.int64())]))
    ddl = (f"{ROW_ID_DDL}, id {rows.schema['id'].dataType.simpleString()}, piece int, "
           "start bigint, length bigint, ids_crc32 bigint, task int, nth bigint")
    return rows.mapInArrow(run, ddl)


def price(value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack over the lengths with a finite value: for every room
    the length to put in next (0: leave a place empty) so that the sum of
    values is the greatest."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    finite = np.flatnonzero(np.isfinite(value))
    if not len(finite):
        return pick
    low, high = int(finite[0]), int(finite[-1])
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        top = min(c, high)
        if top >= low:
            gain = best[c - top:c - low + 1][::-1] + value[low:top + 1]
            k = int(gain.argmax())
            if gain[k] > best[c]:
                best[c], pick[c] = gain[k], low + k
    return pick


def filling(pick: list[int], room: int) -> list[int]:
    """The lengths that the knapsack puts into a room."""
    out = []
    while room > 0:
        if pick[room]:
            out.append(pick[room])
            room -= pick[room]
        else:
            room -= 1
    return out


def configurations(hist: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS,
                   pricings: int = PRICINGS, eta: float = ETA) -> list[tuple[dict[int, int], int]]:
    """``(configuration, times)`` that cover a histogram of lengths exactly.

    Every round brings each length's coverage to its share.  The knapsack
    table prices a column for each length still short of it at once: that
    length with the best filling of the room beside it.  When demand for a
    filling runs out, weights are renewed and priced again.
    """
    left = hist.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []
    if left[capacity]:
        out.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    demand, lengths = left.copy(), np.arange(len(left)).astype(float)

    def priced() -> list[int]:
        covered = 1 - left / np.maximum(demand, 1)
        # slightly more than in proportion to the length: of configurations that
        # are equally full, the longer pieces first, as short ones fill any gap
        value = np.where(left > 0, lengths ** GREED * np.exp(-eta * covered), -np.inf)
        return price(value, capacity).tolist()
    for t in range(rounds):
        if not left.any():
            break
        pick, fresh, pricings = priced(), True, pricings - 1
        for n in np.flatnonzero(left)[::-1].tolist():
            while True:
                short = -(-int(demand[n]) * (t + 1) // rounds) - int(demand[n] - left[n])
                if short <= 0:
                    break
                config: dict[int, int] = defaultdict(int)
                for m in [n, *filling(pick, capacity - n)]:
                    config[m] += 1
                times = min(-(-short // config[n]), *(int(left[m]) // k for m, k in config.items()))
                if times > 0 and (fresh or sum(m * k for m, k in config.items()) == capacity):
                    out.append((dict(config), times))
                    for m, k in config.items():
                        left[m] -= k * times
                    fresh = False
                elif fresh or pricings <= 0:
                    break  # no whole column: best fit packs what is left
                else:
                    pick, fresh, pricings = priced(), True, pricings - 1
    return out + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, for a histogram: open sequences of one content
    are handled together."""
    open_: dict[int, list[tuple[tuple, int]]] = {}  # room -> [(content, times)]
    rooms = np.zeros(capacity + 1, bool)
    for n in np.flatnonzero(left)[::-1].tolist():
        need = int(left[n])
        while need:
            fits = np.flatnonzero(rooms[n:])
            if len(fits):
                room = n + int(fits[0])
                content, times = open_[room].pop()
                if not open_[room]:
                    rooms[room] = False
                used = min(times, need)
                if used < times:
                    open_.setdefault(room, []).append((content, times - used))
                    rooms[room] = True
                new = (content, n)
                to = room - n
            else:
                # as many pieces of this length as a sequence takes
                each = min(capacity // n, need)
                used = need // each
                new = ()
                for _ in range(each):
                    new = (new, n)
                open_.setdefault(capacity - n * each, []).append((new, used))
                rooms[capacity - n * each] = True
                need -= used * each
                continue
            open_.setdefault(to, []).append((new, used))
            rooms[to] = True
            need -= used
    out = []
    for group in open_.values():
        for content, times in group:
            config: dict[int, int] = defaultdict(int)
            while content:
                content, n = content
                config[n] += 1
            out.append((dict(config), times))
    return out


def places(configs: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Which pieces (length, number) go where: sorted ranges of numbers with
    the first sequence, the pieces per sequence and the first offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for config, times in configs:
        offset = 0
        for n in sorted(config, reverse=True):
            k = config[n]
            rows.append((n, used[n], sequence, k, offset))
            used[n] += k * times
            offset += n * k
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 48) + table[:, 1], "first": table[:, 1],
            "sequence": table[:, 2], "each": table[:, 3], "offset": table[:, 4]}


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: ``__row_id, id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A null or empty text is the end id alone.  Only documents over
    ``capacity`` ids are cut.  Null ids and repeated rows are documents like
    any other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    # counts of the tasks before, per length: a row per task and length at most
    counts = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    hist = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        hist[r.length] = r.n
    before = stored(counts.select("task", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before")), "piece_starts")
    table = spark.sparkContext.broadcast(places(configurations(hist, capacity, rounds)))

    def locate(batches):
        t = table.value
        for b in batches:
            length = b.column("length").to_numpy()
            number = b.column("nth").to_numpy() + b.column("before").to_numpy()
            at = np.searchsorted(t["key"], (length << 48) + number, side="right") - 1
            rest = number - t["first"][at]
            each = t["each"][at]
            keep = [b.column(c) for c in (ROW_ID, "id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(t["sequence"][at] + rest // each),
                        pa.array(t["offset"][at] + (rest % each) * length)],
                names=[ROW_ID, "id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    kind = pieces.schema["id"].dataType.simpleString()
    return pieces.join(before, ["task", "length"]).select(
        ROW_ID, "id", "piece", "start", "length", "ids_crc32", "nth", "before").mapInArrow(
        locate, f"{ROW_ID_DDL}, id {kind}, piece int, start bigint, length bigint, "
                "ids_crc32 bigint, sequence_id bigint, offset bigint")
