"""Benchmark decontamination by an FM-index per training shard.

A shard is a bounded slice of the documents of one task.  Its words become
integers over the shard's own vocabulary; the suffixes are sorted (prefix
doubling, only unsettled suffixes again), and the Burrows-Wheeler transform
goes into a wavelet matrix of packed bits with rank counts.  All benchmark
phrases search backwards at once: each word narrows every phrase's suffix
range by two ranks.  Occurrences are located by walking to the nearest
sampled suffix position, and their word ranges are merged into spans.

Scale: documents are read once and not shuffled.  Phrases are distinct
windows of the benchmark, taken in blocks of a bounded number; a benchmark of
one block (the usual case) needs one pass and no merge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import (ROW_ID, ROW_ID_ARROW, ROW_ID_DDL, bounded_batches, sliced, stored,
                                text_or_empty, with_row_id)
from logloom.llm.tokens import ALNUM, Words

WINDOW = 10
#: Windows searched in one pass (broadcast; about 100 bytes each).
BLOCK_WINDOWS = 500_000
#: Text of one shard; a longer document is a shard of its own.
SHARD_BYTES = 4 << 20
#: Every so many positions of a document a suffix position is stored.
SAMPLE = 8


class Ranks:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Ranks of any symbol, one bit plane per symbol bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.planes: list[tuple[int, Ranks, int]] = []
        for b in reversed(range(bits)):
            ones = (symbols >> b) & 1 == 1
            zeros = len(symbols) - int(ones.sum())
            self.planes.append((b, Ranks(ones), zeros))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position i."""
        lo = np.zeros_like(i)
        for b, plane, zeros in self.planes:
            one = (symbol >> b) & 1 == 1
            r_lo, r_i = plane.rank(lo), plane.rank(i)
            lo = np.where(one, zeros + r_lo, lo - r_lo)
            i = np.where(one, zeros + r_i, i - r_i)
        return i - lo

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and its rank there."""
        symbol, lo = np.zeros_like(i), np.zeros_like(i)
        for b, plane, zeros in self.planes:
            one = plane.get(i)
            r_lo, r_i = plane.rank(lo), plane.rank(i)
            lo = np.where(one, zeros + r_lo, lo - r_lo)
            i = np.where(one, zeros + r_i, i - r_i)
            symbol |= one.astype(np.int64) << b
        return symbol, i - lo


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ranks that are settled stay."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    sorted_s = s[order]
    new = np.concatenate(([True], sorted_s[1:] != sorted_s[:-1])) if n else np.zeros(0, bool)
    group = np.flatnonzero(new)[np.cumsum(new) - 1] if n else np.zeros(0, np.int64)
    rank = np.empty(n + 1, np.int64)
    rank[order] = group
    rank[n] = -1
    step = 1
    single = new & np.concatenate((new[1:], [True])) if n else new
    todo = np.flatnonzero(~single)  # places in the order whose group is open
    while len(todo):
        suffix = order[todo]
        key = rank[np.minimum(suffix + step, n)] + 1 + rank[suffix] * (n + 1)
        by = np.argsort(key, kind="stable")
        order[todo] = suffix = suffix[by]
        key = key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        group = todo[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[suffix] = group
        todo = todo[~(new & np.concatenate((new[1:], [True])))]
        step *= 2
    return order


class FMIndex:
    """FM-index of the word sequences of several documents.

    ``codes`` are the words of all documents, ``first`` the place of each
    document's first word.  Each document ends in a separator of its own when
    suffixes are sorted (so equal documents sort quickly); all separators are
    symbol 0 in the index.
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, n_codes: int):
        docs = len(first) - 1
        n = len(codes) + docs
        place = np.arange(len(codes)) + np.repeat(np.arange(docs), np.diff(first))
        text = np.zeros(n, np.int64)
        text[place] = codes + 1
        self.doc_start = first[:-1] + np.arange(docs)
        ends = first[1:] + np.arange(docs)
        distinct = np.full(n, docs, np.int64)
        distinct[ends] = np.arange(docs)
        sa = suffix_array(np.where(text > 0, text + docs - 1, distinct))
        bwt = text[sa - 1]  # before the first suffix stands the last separator
        self.sigma = n_codes + 1
        counts = np.bincount(text, minlength=self.sigma)
        self.less = np.concatenate(([0], np.cumsum(counts)))
        self.tree = WaveletMatrix(bwt, max(1, int(self.sigma - 1).bit_length()))
        start = np.zeros(n, bool)
        start[self.doc_start] = True
        sampled = start[sa] | (sa % SAMPLE == 0)
        self.marks, self.samples = Ranks(sampled), sa[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, given as codes right-aligned in a matrix."""
        k = len(phrases)
        lo, hi = np.zeros(k, np.int64), np.full(k, self.less[-1], np.int64)
        width = phrases.shape[1]
        for j in range(width):
            live = np.flatnonzero((j < lengths) & (lo < hi))
            if not len(live):
                break
            sym = phrases[live, width - 1 - j] + 1
            lo[live] = self.less[sym] + self.tree.rank(sym, lo[live])
            hi[live] = self.less[sym] + self.tree.rank(sym, hi[live])
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: step back until a sampled one."""
        rows = rows.copy()
        out = np.full(len(rows), -1, np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            cur = rows[todo]
            hit = self.marks.get(cur)
            out[todo[hit]] = self.samples[self.marks.rank(cur[hit])] + steps
            todo = todo[~hit]
            if len(todo):
                sym, r = self.tree.access_rank(rows[todo])
                rows[todo] = self.less[sym] + r
            steps += 1
        return out


class Phrases:
    """Distinct windows of benchmark items, over their own vocabulary."""

    def __init__(self, pairs: list[tuple[str, str]]):
        windows = sorted({w for w, _ in pairs})
        place = {w: i for i, w in enumerate(windows)}
        self.items: list[list[str]] = [[] for _ in windows]
        for w, item in pairs:
            self.items[place[w]].append(item)
        split = [w.encode("utf-8", "surrogatepass").split(b" ") for w in windows]
        words = sorted({x for s in split for x in s})
        code = {x: i for i, x in enumerate(words)}
        self.words = pa.array(words, pa.large_binary())
        self.lengths = np.array([len(s) for s in split], np.int64)
        width = max([1, *self.lengths])
        self.codes = np.full((len(windows), width), -1, np.int64)
        for i, s in enumerate(split):
            self.codes[i, width - len(s):] = [code[x] for x in s]


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges (overlapping or touching ones become one)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return start[at], reach[np.concatenate((at[1:] - 1, [len(start) - 1]))]


def find_in_shard(texts: pa.Array, phrases: Phrases):
    """Per text: ``n_words``, merged word spans, merged byte spans, items."""
    words = Words(texts, ALNUM)
    n_words = np.diff(words.first)
    hits: dict[int, tuple] = {}
    code = pc.fill_null(pc.index_in(phrases.words, value_set=words.vocabulary), -1)
    code = code.to_numpy(zero_copy_only=False).astype(np.int64)
    # a word that the shard lacks rules its phrases out
    inside = phrases.codes >= 0
    mapped = np.where(inside, code[np.where(inside, phrases.codes, 0)] if len(code) else -1, 0)
    possible = np.flatnonzero(np.where(inside, mapped >= 0, True).all(axis=1)) if len(code) else np.zeros(0, np.int64)
    if len(words.code) and len(possible):
        index = FMIndex(words.code, words.first, len(words.vocabulary))
        lo, hi = index.search(mapped[possible], phrases.lengths[possible])
        found = hi - lo
        which = np.repeat(possible, found)
        rows = np.repeat(lo, found) + np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
        at = index.locate(rows)
        doc = np.searchsorted(index.doc_start, at, side="right") - 1
        at = at - doc  # separators before it
        order = np.argsort(doc, kind="stable")
        doc, at, which = doc[order], at[order], which[order]
        for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else []:
            d = int(doc[part[0]])
            s, e = _merge(at[part], at[part] + phrases.lengths[which[part]])
            items = sorted({i for w in set(which[part].tolist()) for i in phrases.items[w]})
            base = words.first[d]
            hits[d] = ((s - base).tolist(), (e - base).tolist(),
                       (words.start[s] - words.offsets[d]).tolist(),
                       (words.end[e - 1] - words.offsets[d]).tolist(), items)
    return n_words, hits


_SPAN = "array<struct<start:bigint,end:bigint,byte_start:bigint,byte_end:bigint>>"


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct ``(window, item)`` pairs; the words of a window space-joined.
    A null or wordless item has none; a null id counts as ''."""
    words = F.filter(F.split(F.translate(text_or_empty(text_col), _UPPER, _UPPER.lower()),
                             r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    n = F.size("w")
    last = F.greatest(n - window, F.lit(0))
    return (benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             words.alias("w")).where(n > 0)
            .select("item", F.explode(F.transform(
                F.sequence(F.lit(1), last + 1),
                lambda i: F.array_join(F.slice(F.col("w"), i, F.lit(window)), " "))).alias("window"))
            .distinct())


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per input row: ``__row_id, id, n_words, spans, items``.

    ``spans`` are the merged ranges of words (and of bytes) that lie in an
    occurrence of a benchmark window, ``items`` the sorted ids of the items
    whose windows occur.  A null text has no words.  Null ids and repeated
    rows stay; an empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = with_row_id(docs, id_col, text_col)
    pairs = benchmark_windows(benchmark, item_col, item_text_col, window)
    blocks = max(1, -(-pairs.count() // block_windows))
    from pyspark.sql.pandas.types import to_arrow_type
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                               ("byte_start", pa.int64()), ("byte_end", pa.int64())]))
    out = pa.schema([(ROW_ID, ROW_ID_ARROW), ("id", to_arrow_type(rows.schema["id"].dataType)),
                     ("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])
    ddl = (f"{ROW_ID_DDL}, id {rows.schema['id'].dataType.simpleString()}, n_words bigint, "
           f"spans {_SPAN}, items array<string>")

    def search(block):
        def run(batches):
            phrases = block.value
            for batch in sliced(batches, max_bytes=SHARD_BYTES, max_rows=1 << 20):
                n_words, hits = find_in_shard(batch.column("text"), phrases)
                spans, items = [], []
                for d in range(batch.num_rows):
                    h = hits.get(d)
                    spans.append([dict(zip(("start", "end", "byte_start", "byte_end"), x))
                                  for x in zip(*h[:4])] if h else [])
                    items.append(h[4] if h else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(ROW_ID), batch.column("id"), pa.array(n_words, pa.int64()),
                     pa.array(spans, span), pa.array(items, pa.list_(pa.string()))], schema=out)
        return run
    passes = []
    for b in range(blocks):
        passes.append(rows.mapInArrow(search(_block(pairs, b, blocks)), ddl))
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    return every.groupBy(ROW_ID).agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        merged_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def merged_spans(spans: Column) -> Column:
    """Union of spans found in several passes."""
    def step(acc: Column, s: Column) -> Column:
        top = F.element_at(acc, -1)
        joined = F.struct(top["start"].alias("start"), F.greatest(top["end"], s["end"]).alias("end"),
                          top["byte_start"].alias("byte_start"),
                          F.greatest(top["byte_end"], s["byte_end"]).alias("byte_end"))
        return F.when((F.size(acc) > 0) & (top["end"] >= s["start"]),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))) \
            .otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(_SPAN), step)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without byte ranges; a cut leaves a line end."""
    raw, out, at = text.encode(), [], 0
    for start, end in spans:
        out.append(raw[at:start])
        at = end
    return b"\n".join([*out, raw[at:]]).decode()


def _cut(block, at: int, chars: int | None):
    """Task function: rows with the removal spans of a block of windows cut
    out of column ``at`` until none has a hit; rows of which no word is left go."""
    def run(batches):
        phrases = block.value
        for batch in sliced(batches, at, max_bytes=SHARD_BYTES, max_rows=1 << 20):
            texts = pc.fill_null(batch.column(at).cast(pa.string()), "")
            changed: dict[int, str] = {}
            gone: set[int] = set()
            rows = np.arange(batch.num_rows)
            while len(rows):
                n_words, hits = find_in_shard(texts, phrases)
                again = []
                for d in sorted(hits):
                    row, (starts, ends, byte_starts, byte_ends, _) = int(rows[d]), hits[d]
                    if sum(ends) - sum(starts) == n_words[d]:
                        gone.add(row)
                        continue
                    changed[row] = _without(texts[d].as_py(), list(zip(byte_starts, byte_ends)))
                    again.append(row)
                rows = np.array(again, np.int64)
                texts = pa.array([changed[r] for r in again], pa.string())
            if changed:
                columns = list(batch.columns)
                for c, value in ((at, lambda t: t), (chars, len)):
                    if c is not None:
                        kind = batch.schema.field(c).type
                        put = pa.array([value(changed[r]) for r in sorted(changed)]).cast(kind)
                        mask = np.zeros(batch.num_rows, bool)
                        mask[sorted(changed)] = True
                        columns[c] = pc.replace_with_mask(columns[c], pa.array(mask), put)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            if gone:
                batch = batch.filter(pa.array([r not in gone for r in range(batch.num_rows)]))
            yield batch
    return run


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text",
                         window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with the removal spans cut out of their texts.

    A cut leaves a line end, so that no words run together.  What stood
    before and behind a cut may itself make a benchmark window, so a text that
    was cut is searched again until it has no hit.  Documents with no hit keep
    their text byte for byte; a document of which no word is left goes.
    ``n_chars``, where there is one, follows the new text.

    A benchmark of one block of windows is cut where the documents are read;
    more blocks are cut one after the other, with a stored table between, and
    again until no block changes a row.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    pairs = benchmark_windows(benchmark, item_col, item_text_col, window)
    blocks = max(1, -(-pairs.count() // block_windows))
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(rows: DataFrame, b: int) -> DataFrame:
        block = _block(pairs, b, blocks)
        return rows.mapInArrow(_cut(block, docs.columns.index(text_col), chars), docs.schema)

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col)),
                              F.bit_xor(F.xxhash64(text_col))).first())
    if blocks == 1:
        return cut(docs, 0)
    before = None
    while (now := state(docs)) != before:
        before = now
        for b in range(blocks):
            docs = stored(cut(docs, b), "cut")
    return docs


def _block(pairs: DataFrame, b: int, blocks: int):
    mine = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b)
    return pairs.sparkSession.sparkContext.broadcast(Phrases([(r.window, r.item) for r in mine.collect()]))
