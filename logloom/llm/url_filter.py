"""URL filter by a bit-parallel wildcard automaton.

Every rule is a glob (``*`` any bytes, ``?`` one byte) over a canonical URL.
All globs are packed, end to end, into one multiword Shift-And mask: one bit
per glob position.  Reading a byte shifts the whole state, keeps the bits
whose position accepts the byte, and re-adds the positions that a ``*``
holds open, so all patterns advance together.  Tasks run the automaton over
many URLs at once, a byte column at a time.

Scale: the patterns are cut into blocks of ``BLOCK_WORDS`` words, a pass each,
longest rules first; URLs that a block has judged leave the passes behind it.
The URLs that a step holds follow from the words, so the states of a step stay
within ``STATE_BYTES`` however many rules there are.  The blocks are broadcast:
2 KB for 64 pattern positions.

The canonical URL is ``.host#path``: the leading dot makes ``*.org#/...`` fit
``org`` and all its subdomains and nothing else, and ``#`` stands in neither
host nor path, so host and path parts of a rule cannot mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import ROW_ID, bounded_batches

#: Words of a block of patterns, and bytes of the states of one step.
BLOCK_WORDS = 256
STATE_BYTES = 8 << 20
#: (verdict, host, path); the longest that fits decides.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Globs over the canonical URL for URLs that no rule fits: blocked on a
#: match, else allowed.
BLOCK_GLOBS = ["*#*/ads/*", "*#*/tracking/*", "*#*.exe", "*#*.zip", ".ads.*#*", ".track.*#*"]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null or when there is no ``://``."""
    raw = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Automaton:
    """Shift-And tables of several globs; ``words`` 64-bit words per state."""
    accept: np.ndarray   # [256, words]: positions that take a byte
    hold: np.ndarray     # [words]: positions kept open by a '*'
    start: np.ndarray    # [words]: state before any byte
    block_start: np.ndarray  # [words]: first bit of each glob, cleared on shifts
    skip: list[np.ndarray]   # star positions to pass over without a byte
    final: np.ndarray    # [globs]: bit that says the glob has matched


def glob_tokens(glob: str) -> list[int | str]:
    """Bytes, ``?`` and ``*`` of a glob; stars in a row are one."""
    out: list[int | str] = []
    for b in glob.encode("utf-8", "surrogatepass"):
        c = chr(b)
        if c != "*" or not out or out[-1] != "*":
            out.append(c if c in "*?" else b)
    return out


def compile_globs(globs: Sequence[str | list[int | str]]) -> Automaton:
    """Pack globs, given as text or as tokens.  Bit p of a glob with tokens
    t1..tm says 't1..tp read'; bit 0 says nothing is read.  A ``*`` token is
    passed without a byte (the bit after it follows from the bit before) and
    holds its own bit."""
    tokens = [glob_tokens(g) if isinstance(g, str) else g for g in globs]
    total = sum(len(t) + 1 for t in tokens)
    words = max(1, -(-total // 64))

    def mask(bits) -> np.ndarray:
        m = np.zeros(words, np.uint64)
        for b in bits:
            m[b // 64] |= np.uint64(1) << np.uint64(b % 64)
        return m
    accept_bits: list[list[int]] = [[] for _ in range(256)]
    hold, start, star, final = [], [], [], []
    at = 0
    for t in tokens:
        start.append(at)
        for p, tok in enumerate(t, start=1):
            if tok == "*":
                hold.append(at + p)
                star.append(at + p)
            else:
                for b in range(256) if tok == "?" else [tok]:
                    accept_bits[b].append(at + p)
        final.append(at + len(t))
        at += len(t) + 1
    return Automaton(np.stack([mask(b) for b in accept_bits]), mask(hold), mask(start),
                     mask(start), [mask(star)], np.array(final, np.int64))


def _shift(state: np.ndarray) -> np.ndarray:
    out = state << np.uint64(1)
    out[:, 1:] |= state[:, :-1] >> np.uint64(63)
    return out


def _close(state: np.ndarray, a: Automaton) -> np.ndarray:
    """A '*' may read nothing: the bit before it also sets its own bit.  Two
    stars are never adjacent, so one pass is enough."""
    return state | (_shift(state) & a.skip[0])


def match_all(texts: Sequence[bytes], a: Automaton) -> np.ndarray:
    """``[texts, globs]`` booleans; texts are handled longest first so that
    those that have ended leave the active prefix."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    ends = lengths[order]
    flat = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
    begin = np.concatenate(([0], np.cumsum(ends)[:-1])) if n else np.zeros(0, np.int64)
    state = _close(np.repeat(a.start[None, :], n, axis=0), a)
    for k in range(int(ends[0]) if n else 0):
        live = int(np.searchsorted(-ends, -k, side="left"))  # those longer than k
        cur = state[:live]
        step = (_shift(cur) & ~a.block_start & a.accept[flat[begin[:live] + k]]) | (cur & a.hold)
        state[:live] = _close(step, a)
    bits = (state[:, a.final // 64] >> (a.final % 64).astype(np.uint64)) & np.uint64(1)
    out = np.empty((n, len(a.final)), bool)
    out[order] = bits.astype(bool)
    return out


def rule_tokens(host: str, path: str) -> list[int | str]:
    """A rule fits its host and all subdomains and what its path begins; all its
    characters stand for themselves, ``*`` and ``?`` too."""
    return ["*", *f".{host}#{path}".encode("utf-8", "surrogatepass"), "*"]


def blocks_of(patterns: Sequence[list[int | str]], words: int = BLOCK_WORDS) -> list[tuple[int, Automaton]]:
    """The patterns in order, in blocks of at most so many words (a longer
    pattern is a block of its own): the first pattern's number and the block."""
    out, block, size, first = [], [], 0, 0
    for i, t in enumerate(patterns):
        if block and size + len(t) + 1 > 64 * words:
            out.append((first, compile_globs(block)))
            block, size, first = [], 0, i
        block.append(t)
        size += len(t) + 1
    return out + ([(first, compile_globs(block))] if block else [])


def first_match(texts: Sequence[bytes], blocks: list[tuple[int, Automaton]],
                state_bytes: int = STATE_BYTES) -> np.ndarray:
    """Number of the first pattern that matches each text; -1 for none."""
    out = np.full(len(texts), -1, np.int64)
    left = np.arange(len(texts))
    for first, automaton in blocks:
        step = max(1, state_bytes // (8 * automaton.accept.shape[1]))
        for at in range(0, len(left), step):
            some = left[at:at + step]
            hits = match_all([texts[i] for i in some], automaton)
            out[some] = np.where(hits.any(axis=1), first + hits.argmax(axis=1), -1)
        left = left[out[left] < 0]
        if not len(left):
            break
    return out


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: DataFrame | Sequence[tuple[str, str, str]] = tuple(RULES),
                block_globs: Sequence[str] = tuple(BLOCK_GLOBS)) -> DataFrame:
    """One row per input row: ``id, host, path, rule, verdict``.

    ``rule`` is the longest rule (host and path together) that fits, else
    null; ``verdict`` is that rule's, else ``block`` when one of
    ``block_globs`` matches, else ``allow``.  A null url, or one without
    ``://``, has an empty host and path.  Null ids and repeated rows stay.

    ``rules`` is a list or a table of ``verdict, host, path``; null hosts or
    paths are no rules, and of two verdicts on one host and path ``block``
    counts.  Rules are a filter list: they pass through the driver and are
    broadcast as automata.  Nothing is shuffled.
    """
    bounded_batches(pages.sparkSession, 2 << 20)
    if isinstance(rules, DataFrame):
        rules = [tuple(r) for r in rules.select("verdict", "host", "path").toLocalIterator()]
    rules = [r for r in rules if r[1] is not None and r[2] is not None]
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2], r[0] != "block"))
    blocks = pages.sparkSession.sparkContext.broadcast(blocks_of(
        [rule_tokens(h, p) for _, h, p in ranked] + [glob_tokens(g) for g in block_globs]))
    verdicts = np.array([v for v, _, _ in ranked] + ["block"] * len(block_globs) + ["allow"], object)
    names = np.array([h + p for _, h, p in ranked] + [None] * (len(block_globs) + 1), object)
    schema = T.StructType([T.StructField("rule", T.StringType()),
                           T.StructField("verdict", T.StringType())])
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"),
                        url_path(url).alias("path"))

    @F.pandas_udf(schema)
    def judge(urls):
        import pandas as pd
        texts = [u.encode("utf-8", "surrogatepass") for u in urls]
        first = first_match(texts, blocks.value)  # -1, none, is the last of the names
        return pd.DataFrame({"rule": names[first], "verdict": verdicts[first]})
    canonical = F.concat(F.lit("."), F.col("host"), F.lit("#"), F.col("path"))
    return base.withColumn("judged", judge(canonical)).select(
        "id", "host", "path", "judged.rule", "judged.verdict")
