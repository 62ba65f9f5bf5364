"""Secret scan over a trigram inverted index.

Each rule's regex is turned into a Boolean query over lower-case trigrams
that any match must contain (AND inside an alternative, OR between
alternatives).  The index holds, for every trigram of the rules' vocabulary
and every bucket of 32,768 row ids, a bitmap of the rows whose text has it.
A conjunction is the AND of its postings, a disjunction the OR; the rows left
are the candidates, and only they are checked with the regex.  A rule without
a mandatory trigram (such as a bare run of hex digits) scans all rows.

Scale: postings are bitmaps of at most 4 KB per trigram and bucket, built
with a partial aggregate, so a trigram that all rows hold costs one bit per
row; buckets, not trigrams, deal out the work, so no key is hot.  All steps
are DataFrame expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import MARK_BYTES, ROW_ID, bit_set, stored, with_row_id

BUCKET = 32768  # rows of one posting bitmap: fixed by Spark's bitmap functions


@dataclass(frozen=True)
class Rule:
    """``regex`` is tried leftmost and without overlaps; a match is a secret
    when group ``group`` has ``least`` characters or more."""
    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The three base kinds, in their order, then further formats.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", group=2, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]

#: Alternatives of one literal that are followed apart (a wider choice is
#: treated as an unknown character, which only widens the candidates).
MAX_STRINGS = 32


def _expand(node) -> tuple[set[frozenset[str]], set[str] | None]:
    """``(query, exact)`` of a parsed regex: ``query`` in disjunctive form (a
    set of trigram conjunctions, one of which every match satisfies) and the
    set of all strings it matches, or None when unbounded or too many."""
    query: set[frozenset[str]] = {frozenset()}
    exact: set[str] | None = {""}
    for op, arg in node:
        q: set[frozenset[str]] = {frozenset()}
        e: set[str] | None = None
        if op is K.LITERAL:
            e = {chr(arg).lower()} if arg < 128 else None
        elif op is K.IN:
            chars = {chr(v).lower() for o, v in arg if o is K.LITERAL and v < 128}
            if all(o is K.LITERAL and v < 128 for o, v in arg) and len(chars) <= 8:
                e = chars
        elif op is K.SUBPATTERN:
            q, e = _expand(arg[3])
        elif op is K.BRANCH:
            parts = [_close(*_expand(p)) if _expand(p)[1] is None else _expand(p) for p in arg[1]]
            if all(x[1] is not None for x in parts):
                e = set().union(*(x[1] for x in parts))
            else:
                q = set().union(*(_close(*x) for x in parts))
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
            low, high, body = arg
            if high == 1:
                inner = _expand(body)[1]
                e = None if inner is None else inner | ({""} if low == 0 else set())
            elif low == high and low <= 8:
                q, e = _expand(list(body) * low)
            elif low > 0:
                q = _close(*_expand(body))
        if exact is not None and e is not None and len(exact) * len(e) <= MAX_STRINGS:
            exact = {a + b for a in exact for b in e}
            query = _both(query, q)
        else:
            query = _both(_close(query, exact), q if e is None else {frozenset()})
            exact = e
            if e is None:
                exact = None
    return query, exact


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    return {x | y for x in a for y in b}


def _close(query: set[frozenset[str]], exact: set[str] | None) -> set[frozenset[str]]:
    """Add what the known strings demand; an alternative that demands nothing
    more makes wider ones superfluous."""
    if exact is None:
        return query
    out = _both(query, {_trigrams(s) for s in exact})
    return {x for x in out if not any(y < x for y in out)}


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Boolean trigram query of a regex: alternatives of trigram sets; an
    empty list says the regex has no mandatory trigram."""
    out = _both_strings(_parser.parse(regex))
    return [] if frozenset() in out else sorted(out, key=sorted)


def _both_strings(tree) -> set[frozenset[str]]:
    """Queries of each maximal run of known strings, joined by AND."""
    query: set[frozenset[str]] = {frozenset()}
    run: list = []
    for part in [*tree, None]:
        known = part is not None and _expand([part])[1] is not None
        if known and len(_expand([*run, part])[1] or ()) and _expand([*run, part])[1] is not None:
            run.append(part)
            continue
        if run:
            query = _both(query, _close(*_expand(run)))
        run = [part] if known else []
        if part is not None and not known:
            query = _both(query, _close(*_expand([part])))
    return {x for x in query if not any(y < x for y in query)}


def trigram_postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, file, bucket, rows``: a bitmap of rows per trigram, file and
    32,768 rows of it."""
    low = rows.select(ROW_ID, F.lower("text").alias("low"))
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    hits = low.select(ROW_ID, F.explode(held).alias("trigram")).where(F.col("trigram").isNotNull())
    # the bitmap functions count ids from 1 within a bucket
    one = F.col(f"{ROW_ID}.row") + 1
    return hits.groupBy("trigram", F.col(f"{ROW_ID}.file").alias("file"),
                        F.bitmap_bucket_number(one).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("rows"))


def candidates(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``file``, ``bucket`` and, for every rule with mandatory trigrams, the bitmap
    ``rows_<kind>`` of the rows that satisfy its query (null: none)."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    clauses = [(k, i, t) for k, q in queries.items() for i, c in enumerate(q) for t in sorted(c)]
    need = {(k, i): len(c) for k, q in queries.items() for i, c in enumerate(q)}
    postings = trigram_postings(rows, sorted({t for _, _, t in clauses}))
    by_trigram: dict[str, list[tuple[str, int]]] = {}
    for k, i, t in clauses:
        by_trigram.setdefault(t, []).append((k, i))
    wanted = F.create_map(*[x for t, cs in by_trigram.items() for x in (
        F.lit(t), F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("clause"),
                                     F.lit(need[k, i]).alias("need")) for k, i in cs]))])
    conj = (postings.select("file", "bucket", "rows", F.explode(F.element_at(wanted, F.col("trigram"))).alias("c"))
            .groupBy("file", "bucket", F.col("c.kind").alias("kind"), F.col("c.clause").alias("clause"),
                     F.col("c.need").alias("need"))
            .agg(F.bitmap_and_agg("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == F.col("need")))
    kinds = [k for k, q in queries.items() if q]
    return conj.groupBy("file", "bucket").agg(*[
        F.bitmap_or_agg(F.when(F.col("kind") == k, F.col("rows"))).alias(f"rows_{k}")
        for k in kinds])


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of ``(start, rank, end, kind)`` of a rule's matches, code points,
    end exclusive.  ``split`` gives the texts between the matches, so that
    running lengths give the places."""
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    judged = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.regex),
                                                                F.lit(rule.group))
    gaps = F.split(text, rule.regex, -1)
    parts = F.arrays_zip(F.transform(gaps, F.char_length).alias("gap"),
                         F.transform(whole, F.char_length).alias("len"),
                         F.transform(judged, F.char_length).alias("judged"))
    span = "struct<start:bigint,rank:int,end:bigint,kind:string>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast(f"array<{span}>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        s = acc["at"] + p["gap"]
        e = s + F.coalesce(p["len"], F.lit(0))
        one = F.struct(s.alias("start"), F.lit(rank).alias("rank"), e.alias("end"),
                       F.lit(rule.kind).alias("kind")).cast(span)
        good = F.coalesce(p["judged"] >= max(1, rule.least), F.lit(False))
        return F.struct(e.cast("bigint").alias("at"),
                        F.when(good, F.concat(acc["out"], F.array(one)))
                        .otherwise(acc["out"]).alias("out"))
    return F.aggregate(parts, start, step)["out"]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: list[Rule] = RULES) -> DataFrame:
    """One row per input row: ``__row_id, id, spans`` with ``spans`` an array of
    ``(start, rank, end, kind)`` sorted by start, then by the rules' order.

    A null text is empty and has no spans; null ids and repeated rows stay.
    """
    for r in rules:
        re.compile(r.regex)
    rows = with_row_id(docs, id_col, text_col)
    one = F.col(f"{ROW_ID}.row") + 1
    at = F.bitmap_bit_position(one)
    found = stored(candidates(rows, rules), "secret_candidates")
    # bitmaps travel to the texts, not the texts to the bitmaps, up to a checked size
    small = found.count() * 4096 * len(rules) <= MARK_BYTES
    found = rows.join(F.broadcast(found) if small else found.hint("merge"),
                      (F.col(f"{ROW_ID}.file") == F.col("file"))
                      & (F.bitmap_bucket_number(one) == F.col("bucket")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    each = []
    for rank, r in enumerate(rules):
        # a scan rule first looks for a run of the least length, in one pass
        maybe = (bit_set(F.col(f"rows_{r.kind}"), at) if trigram_query(r.regex)
                 else F.col("text").rlike(r.regex.removesuffix("+") + "{%d}" % r.least
                                          if r.regex.endswith("+") and r.least else r.regex))
        each.append(F.when(maybe, rule_spans(F.col("text"), r, rank)).otherwise(none))
    return found.select(ROW_ID, "id", F.array_sort(F.concat(*each)).alias("spans"))
