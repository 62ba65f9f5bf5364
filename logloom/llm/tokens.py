"""Words of UTF-8 texts as integer arrays, without an object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A-Z counts as a-z; words are digits, letters and all bytes above 0x7F
#: (so every character beyond ASCII).
ALNUM = np.zeros(256, np.uint8)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = 1
#: Runs of word bytes (1) and runs of other visible bytes (2).
WORDPUNCT = np.full(256, 2, np.uint8)
WORDPUNCT[ALNUM == 1] = 1
WORDPUNCT[95] = 1
WORDPUNCT[[0, 9, 10, 11, 12, 13, 32]] = 0


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, and the offsets of each."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return _LOWER[raw], offsets - offsets[0]


class Words:
    """``code`` of each word in order, ``vocabulary`` the bytes of each code,
    ``start``/``end`` the byte range in the buffer, ``first[d]:first[d+1]`` the
    words of text d."""

    def __init__(self, texts: pa.Array, classes: np.ndarray):
        buf, offsets = text_buffer(texts)
        kind = classes[buf]
        edge = np.ones(len(buf) + 1, bool)
        if len(buf):
            edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
        at = np.flatnonzero(edge)
        start, end = at[:-1], at[1:]
        keep = kind[start] != 0 if len(buf) else np.zeros(0, bool)
        self.start, self.end = start[keep], end[keep]
        self.first = np.searchsorted(self.start, offsets)
        size = self.end - self.start
        stops = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size),
            [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(buf[kind != 0]))])
        coded = words.dictionary_encode()
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.vocabulary = coded.dictionary
        self.offsets = offsets
