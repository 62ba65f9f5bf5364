"""Ranked lexical search by bit-sliced Bloom signatures.

Index: a task takes its documents in slices.  Each document's terms go into a
Bloom signature whose width follows their number; documents of one width form
a shard, stored bit-sliced: a row of bits per signature position, a bit per
document.  A term that stands 2^l times or more is also entered at level l.

Search: the slices at a term's positions, ANDed, give the documents that may
hold it; the highest level found bounds how often.  With the document's exact
length this bounds the term's part of the score, and the weighted sum of these
slices bounds the score of every document: a Bloom signature errs on one side
only.  The documents of the highest bounds are scored exactly first, the kth
of these scores is the mark to reach, and every document whose bound reaches
it for any item is scored exactly from its text.  Bounds only exclude
documents that provably have no place, so the result is exact.

Scale: texts are read where they lie and never shuffled; the documents to be
scored are named to the scans by bitmaps.  Items are the stated query set,
taken in blocks of ``BLOCK_TERMS`` terms, which bounds every broadcast and
what reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logloom.llm.common import (ROW_ID, ROW_ID_ARROW, ROW_ID_DDL, bounded_batches, identified, keep_rows,
                                sliced, stored, text_or_empty, with_row_id)
from logloom.llm.tokens import ALNUM, Words

K = 10
#: Signature bits per entry, positions per entry, and entries at the least.
BITS = 10
HASHES = 4
LEAST_BITS = 64
#: Text of one slice of documents.
SLICE_BYTES = 8 << 20
#: Terms of the items searched in one pass, and items scored together.
BLOCK_TERMS = 200_000
ITEMS_AT_ONCE = 256
#: Documents of a shard, and cells (terms x documents) bounded or scored at a time.
SHARD_DOCS = 4096
CELLS = 1 << 22

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def positions(hashes: np.ndarray, level: int | np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """``[entries, HASHES]`` bit positions of terms at a level."""
    salt = np.atleast_1d(level).astype(np.uint64) + np.uint64(1)
    h = hashes ^ (np.uint64(0x9E3779B97F4A7C15) * salt)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    step = (h >> np.uint64(33)) | np.uint64(1)
    at = h[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * step[:, None]
    at ^= at >> np.uint64(29)
    return (at % np.broadcast_to(np.asarray(width, np.uint64), (len(h),))[:, None]).astype(np.int64)


def widths(entries: np.ndarray) -> np.ndarray:
    """Signature width of a document by its entries, in steps of a half power of two."""
    need = np.maximum(LEAST_BITS, BITS * entries)
    return np.ceil(2 ** (np.ceil(2 * np.log2(need)) / 2)).astype(np.int64)


def counted(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts and how often each stands in each: ``doc, code, tf``
    sorted by document."""
    words = Words(texts, ALNUM)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    size = max(1, len(words.vocabulary))
    key, tf = np.unique(owner * size + words.code, return_counts=True)
    return words, key // size, key % size, tf


def part(tf, m: np.ndarray) -> np.ndarray:
    """A term's part of the score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms, exact however large the corpus."""
    if len(n) and 75 * int(n.max()) * docs >= 1 << 63:
        return np.array([25 + 75 * int(x) * docs // terms for x in n], np.int64)
    return 25 + 75 * n.astype(np.int64) * docs // max(1, terms)


def signatures(doc: np.ndarray, code: np.ndarray, tf: np.ndarray, hashes: np.ndarray,
               docs: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, int]]:
    """``documents, width, bits [width, documents / 8], levels`` of each shard."""
    level = np.floor(np.log2(np.maximum(tf, 1))).astype(np.int64)
    rep = level + 1
    at = np.repeat(np.arange(len(doc)), rep)
    of = np.arange(len(at)) - np.repeat(np.cumsum(rep) - rep, rep)
    owner = doc[at]
    entries = np.bincount(owner, minlength=docs)
    width = widths(entries)
    some = np.flatnonzero(entries > 0)
    groups = [(w, some[width[some] == w]) for w in np.unique(width[some]).tolist()]
    for w, members in [(w, m[i:i + SHARD_DOCS]) for w, m in groups for i in range(0, len(m), SHARD_DOCS)]:
        place = np.full(docs, -1)
        place[members] = np.arange(len(members))
        mine = np.flatnonzero(place[owner] >= 0)
        where = positions(hashes[code[at[mine]]], of[mine], w)
        bits = np.zeros((w, -(-len(members) // 8) * 8), np.uint8)
        bits[where.ravel(), np.repeat(place[owner[mine]], HASHES)] = 1
        yield members, w, np.packbits(bits, axis=1, bitorder="little"), int(of[mine].max()) + 1


_INDEX = ("files array<bigint>, places array<bigint>, n array<bigint>, width int, levels int, "
          "bits binary, terms array<int>, df array<bigint>")


def build_index(docs: DataFrame, terms: list[str], text_col: str = "text", id_col: str = "doc_id",
                index: bool = True) -> DataFrame:
    """One row per shard of documents: their row ids and lengths and the
    bit-sliced signatures; the first shard of a slice also has the number of
    its documents that hold each of ``terms`` (by place in the list)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    share = spark.sparkContext.broadcast([t.encode() for t in terms])

    def run(batches):
        asked = pa.array(share.value, pa.large_binary())
        for batch in sliced(batches, max_bytes=SLICE_BYTES, max_rows=1 << 16):
            words, doc, code, tf = counted(batch.column("text"))
            n = np.diff(words.first)
            term = pc.index_in(words.vocabulary, value_set=asked).to_numpy(zero_copy_only=False)
            held = np.bincount(code, minlength=len(words.vocabulary)) if len(code) else np.zeros(0, np.int64)
            known = np.flatnonzero(~np.isnan(term.astype(float)))
            stats = (term[known].astype(np.int32), held[known].astype(np.int64))
            ids = batch.column(ROW_ID)
            files, places = (ids.field(i).to_numpy() for i in (0, 1))
            shards = []
            if index and len(code):
                hashes = term_hashes(words.vocabulary.to_pylist())
                shards = [(m, w, b.tobytes(), lv) for m, w, b, lv in
                          signatures(doc, code, tf, hashes, batch.num_rows)]
            elif len(code):
                shards = [(np.flatnonzero(n > 0), 0, b"", 0)]
            for i, (members, w, bits, levels) in enumerate(shards):
                first = i == 0
                yield pa.RecordBatch.from_pydict({
                    "files": [files[members]], "places": [places[members]],
                    "n": [n[members].astype(np.int64)], "width": pa.array([w], pa.int32()),
                    "levels": pa.array([levels], pa.int32()), "bits": pa.array([bits], pa.binary()),
                    "terms": pa.array([stats[0] if first else []], pa.list_(pa.int32())),
                    "df": pa.array([stats[1] if first else []], pa.list_(pa.int64()))})
    return with_row_id(docs, id_col, text_col).mapInArrow(run, _INDEX)


class Queries:
    """Items of a block as term weights."""

    def __init__(self, items: list[tuple], terms: list[str], df: np.ndarray, docs: int, total: int):
        self.terms = [t.encode() for t in terms]
        self.hashes = term_hashes(self.terms)
        self.docs, self.total = docs, total
        weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
        place = {t: i for i, t in enumerate(terms)}
        self.items = []
        for _, counts in items:
            at = np.array([place[t] for t, _ in counts], np.int64)
            self.items.append((at, np.array([weight[place[t]] * k for t, k in counts], np.int64)))
        self.present = df > 0

    def groups(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First item, the terms used, and ``[items, terms]`` weights."""
        for at in range(0, len(self.items), ITEMS_AT_ONCE):
            some = self.items[at:at + ITEMS_AT_ONCE]
            used = np.unique(np.concatenate([t for t, _ in some])) if some else np.zeros(0, np.int64)
            used = used[self.present[used]]
            table = np.zeros((len(some), len(used)))
            for i, (t, w) in enumerate(some):
                keep = self.present[t]
                table[i, np.searchsorted(used, t[keep])] = w[keep]
            yield at, used, table

    def bounds(self, n: np.ndarray, width: int, levels: int, bits: bytes):
        """``first item, [items, documents]`` upper bounds of all scores."""
        m = length_norm(n, self.docs, self.total)
        rows = np.frombuffer(bits, np.uint8).reshape(width, -1)
        tops = [part(2 ** (level + 1) - 1, m) for level in range(levels)]
        for at, used, table in self.groups():
            where = [positions(self.hashes[used], level, width) for level in range(levels)]
            step = max(8, CELLS // max(1, len(used)) // 8 * 8)
            found = [exact_product(table, self._parts(
                rows[:, lo // 8:(lo + step) // 8], where, [t[lo:lo + step] for t in tops], len(n[lo:lo + step])))
                for lo in range(0, len(n), step)]
            yield at, np.concatenate(found, axis=1)

    @staticmethod
    def _parts(rows: np.ndarray, where: list, tops: list, docs: int) -> np.ndarray:
        """``[terms, documents]`` bounds of the terms' parts."""
        held, below, bound = None, np.zeros(docs, np.int64), np.zeros((len(where[0]), docs))
        for at, top in zip(where, tops):
            found = rows[at[:, 0]]
            for k in range(1, HASHES):
                found = found & rows[at[:, k]]
            held = found if held is None else held & found  # a level counts only above the one below
            if not held.any():
                break
            bound += np.unpackbits(held, axis=1, bitorder="little", count=docs) * (top - below).astype(float)
            below = top
        return bound

    def scores(self, texts: pa.Array):
        """``first item, [items, documents]`` exact scores."""
        words, doc, code, tf = counted(texts)
        m = length_norm(np.diff(words.first), self.docs, self.total)
        term = pc.index_in(words.vocabulary, value_set=pa.array(self.terms, pa.large_binary()))
        term = pc.fill_null(term, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        mine = term[code] if len(code) else np.zeros(0, np.int64)
        keep = mine >= 0
        doc, mine, value = doc[keep], mine[keep], part(tf[keep], m[doc[keep]])
        for at, used, table in self.groups():
            column = np.searchsorted(used, mine)
            fits = (column < len(used))
            fits[fits] = used[column[fits]] == mine[fits]
            column, owner, parts_ = column[fits], doc[fits], value[fits]
            step = max(8, CELLS // max(1, len(used)))
            found = []
            for lo in range(0, len(texts), step):
                a, b = np.searchsorted(owner, [lo, lo + step])
                dense = np.zeros((len(used), min(step, len(texts) - lo)))
                dense[column[a:b], owner[a:b] - lo] = parts_[a:b]
                found.append(exact_product(table, dense))
            yield at, np.concatenate(found, axis=1)


def exact_product(weights: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Integer product; by doubles where they hold every sum."""
    most = weights.sum(1).max(initial=0) * parts.max(initial=0)
    if most < 2 ** 53:
        return (weights @ parts).astype(np.int64)
    return np.array([[sum(int(a) * int(b) for a, b in zip(row, column) if a and b) for column in parts.T]
                     for row in weights], object).reshape(len(weights), parts.shape[1])


def _best_bounds(index: DataFrame, share, k: int) -> DataFrame:
    """``item, bound, __row_id``: the documents of the ``k`` highest bounds of each
    item in every task."""
    def run(batches):
        queries = share.value
        items = len(queries.items)
        best = np.zeros((items, k), np.int64)
        where = np.full((items, k, 2), -1, np.int64)
        for batch in batches:
            for files, places, n, width, levels, bits in zip(*(batch.column(c) for c in range(6))):
                ids = np.column_stack([files.values.to_numpy(), places.values.to_numpy()])
                for at, bound in queries.bounds(n.values.to_numpy(), width.as_py(), levels.as_py(), bits.as_py()):
                    rows = slice(at, at + len(bound))
                    if not (bound.max(axis=1) > best[rows].min(axis=1)).any():
                        continue
                    every = np.concatenate([best[rows], bound.astype(np.int64)], axis=1)
                    top = np.argpartition(-every, k - 1, axis=1)[:, :k]
                    which = np.arange(len(bound))[:, None]
                    new = ids[np.maximum(top - k, 0)]
                    old = where[rows][which, np.minimum(top, k - 1)]
                    where[rows] = np.where((top < k)[:, :, None], old, new)
                    best[rows] = every[which, top]
        item, _ = np.nonzero(best > 0)
        ids = where[best > 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(best[best > 0]),
             pa.StructArray.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1])], fields=list(ROW_ID_ARROW))],
            names=["item", "bound", ROW_ID])
    found = index.select("files", "places", "n", "width", "levels", "bits").mapInArrow(
        run, f"item int, bound bigint, {ROW_ID_DDL}")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), ROW_ID)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reaching(index: DataFrame, share, marks: np.ndarray) -> DataFrame:
    """``__row_id`` of the documents whose bound reaches the mark of any item."""
    level = index.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        queries, mark = share.value, level.value
        for batch in batches:
            for files, places, n, width, levels, bits in zip(*(batch.column(c) for c in range(6))):
                some = np.zeros(len(n.values), bool)
                for at, bound in queries.bounds(n.values.to_numpy(), width.as_py(), levels.as_py(), bits.as_py()):
                    some |= (bound >= mark[at:at + len(bound), None]).any(axis=0)
                yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(
                    [pa.array(files.values.to_numpy()[some]), pa.array(places.values.to_numpy()[some])],
                    fields=list(ROW_ID_ARROW))], names=[ROW_ID])
    return index.select("files", "places", "n", "width", "levels", "bits").mapInArrow(run, ROW_ID_DDL)


def _scored(docs: DataFrame, share, id_col: str, text_col: str, k: int) -> DataFrame:
    """``item, id, __row_id, score, rank``: the best ``k`` of the documents given."""
    rows = docs.select(ROW_ID, F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = to_arrow_type(rows.schema["id"].dataType)
    schema = pa.schema([("item", pa.int32()), ("id", id_type), (ROW_ID, ROW_ID_ARROW), ("score", pa.int64())])

    def run(batches):
        queries = share.value
        for batch in sliced(batches, max_bytes=SLICE_BYTES, max_rows=8192):
            if not batch.num_rows:
                continue
            place = pc.rank(batch.column("id"), sort_keys="ascending", null_placement="at_end",
                            tiebreaker="dense").to_numpy().astype(np.int64)
            ids = batch.column(ROW_ID)
            file, row = ids.field(0).to_numpy(), ids.field(1).to_numpy()
            item, at_doc, value = [], [], []
            for at, score in queries.scores(batch.column("text")):
                for i, s in enumerate(score):
                    some = np.flatnonzero(s > 0)
                    if len(some) > k:  # the kth score and all that tie with it
                        kth = np.partition(s[some], len(some) - k)[len(some) - k]
                        some = some[s[some] >= kth]
                    order = np.lexsort((row[some], file[some], place[some], -s[some].astype(np.int64)))[:k]
                    item += [at + i] * len(order)
                    at_doc += some[order].tolist()
                    value += s[some[order]].tolist()
            take = pa.array(at_doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), batch.column("id").take(take), ids.take(take),
                 pa.array(value, pa.int64())], schema=schema)
    found = rows.mapInArrow(run, f"item int, id {rows.schema['id'].dataType.simpleString()}, {ROW_ID_DDL}, "
                                 "score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), ROW_ID)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """``(item id, [(term, times)])`` of all items, in blocks."""
    words = F.filter(F.split(F.translate(text_or_empty(text_col), _UPPER, _UPPER.lower()),
                             r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    block, size = [], 0
    for r in items.select(F.col(item_col).alias("item"), words.alias("words")).toLocalIterator():
        counts: dict[str, int] = {}
        for w in r.words:
            counts[w] = counts.get(w, 0) + 1
        if block and size + len(counts) + 1 > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((r["item"], list(counts.items())))
        size += len(counts) + 1
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = K) -> DataFrame:
    """``item_id, rank, id, __row_id, score``: each item's ``k`` highest-scoring
    documents with a score above zero.

    Equal scores go by ascending id, null ids last, then by place.  A null or
    wordless text is no document and a null or wordless item has no result;
    repeated rows and ids are documents and items of their own.  Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    docs = identified(docs)
    rows = with_row_id(docs, id_col, text_col)
    item_kind = items.schema[item_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"item int, id {rows.schema['id'].dataType.simpleString()}, "
                                      f"{ROW_ID_DDL}, score bigint, rank int")
    index, results = None, []
    for block in _item_blocks(items, item_col, item_text_col):
        terms = sorted({t for _, counts in block for t, _ in counts})
        found = stored(build_index(docs, terms, text_col, id_col, index=index is None), "search_index")
        index = index if index is not None else found
        docs_n, total = found.agg(F.sum(F.size("n")), F.sum(F.aggregate(
            "n", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
        if not docs_n:
            break
        df = np.zeros(len(terms), np.int64)
        for r in (found.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms")
                  .agg(F.sum("t.df").alias("n")).collect()):  # a row per term of the block
            df[r.terms] = r.n
        share = spark.sparkContext.broadcast(Queries(block, terms, df, docs_n, total))
        first = stored(_best_bounds(index, share, k), "search_bounds")
        tried = _scored(keep_rows(docs, first, with_id=True), share, id_col, text_col, k)
        marks = np.ones(len(block), np.int64)
        for r in tried.where(F.col("rank") == k).select("item", "score").collect():  # a row per item
            marks[r["item"]] = r.score
        best = _scored(keep_rows(docs, _reaching(index, share, marks), with_id=True), share, id_col, text_col, k)
        names = spark.createDataFrame([(i, b[0]) for i, b in enumerate(block)], f"item int, item_id {item_kind}")
        results.append(stored(best, "search_results").join(names, "item"))
    if not results:
        results = [empty.join(spark.createDataFrame([], f"item int, item_id {item_kind}"), "item")]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("item_id", "rank", "id", ROW_ID, "score")
