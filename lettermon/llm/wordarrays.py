"""Words of many texts at once, as arrays: numbers of words, their texts, and what stands between them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Kinds of bytes: of a word, between words, and between words that no phrase spans.
IN_WORD, BLANK, BREAK = 0, 1, 2
#: Bytes of text that are taken up at once.
BLOCK = 1 << 22
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def byte_kinds(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(blanks)] = BLANK
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """``ids``: a number for each word in order; ``texts``: the distinct
    words by number; ``owner``: the text a word is of; ``joined``: whether
    only blanks are between a word and the one before it."""
    ids: np.ndarray
    texts: pa.Array
    owner: np.ndarray
    joined: np.ndarray


def words_of(texts: pa.Array, kinds: np.ndarray) -> Words:
    """The words of UTF-8 texts, A-Z lower-cased; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    kind = kinds[data]
    in_word = kind == IN_WORD
    start = in_word.copy()
    start[1:] &= ~in_word[:-1]
    first = at[:-1][np.diff(at) > 0]
    start[first] = in_word[first]  # a word does not go on in the next text
    places = np.flatnonzero(start)
    before = np.cumsum(in_word, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    offsets = np.append(before[places].astype(np.int64) - 1, before[-1] if len(before) else 0)
    letters = _LOWER[data[in_word]]
    words = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(places, at)))
    joined = np.zeros(len(places), bool)
    joined[1:] = owner[1:] == owner[:-1]
    if (kind == BREAK).any():
        breaks = np.cumsum(kind == BREAK, dtype=np.int32)[places]
        joined[1:] &= breaks[1:] == breaks[:-1]
    return Words(coded.indices.to_numpy(), coded.dictionary, owner, joined)


def text_blocks(batch: pa.RecordBatch, column: int = 0, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0))
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + size, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop
