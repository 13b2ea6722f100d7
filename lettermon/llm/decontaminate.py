"""Benchmark decontamination: size-partitioned MinHash containment search.

The test items are short, the documents long, so their resemblance is tiny
even where an item stands in a document word for word; what counts is
containment, the share of an item's shingles that a document has.  An item
with ``n`` shingles that is contained to a share ``c`` misses at most
``n - ceil(c n)`` of them, so any ``n - ceil(c n) + 1`` of them meet the
document at least once.  The MinHash sketch of an item is that many of its
smallest shingle hashes: long enough that no contained item is lost.

Items are partitioned by size (powers of two).  In a partition the sketches
reach up to some hash value; only those shingles of a document that hash no
higher are looked up there.  A hit makes an item a candidate of the
document, and the exact containment over all shingles decides.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .scratch import FILE, ROW, located, materialise, scratch, without
from .words import word_blocks

SHINGLE, CONTAINMENT = 5, 0.8
#: Words of test items that one pass over the documents looks for.
BLOCK_WORDS = 200_000


def _mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit values."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0x9E3779B97F4A7C15)
    v = v ^ (v >> np.uint64(29))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(32))


def _hashes(runs: np.ndarray) -> np.ndarray:
    """Hashes of rows of word numbers."""
    value = np.zeros(len(runs), np.uint64)
    for k in range(runs.shape[1]):
        value = value * np.uint64(0x100000001B3) + runs[:, k].astype(np.uint64) + np.uint64(1)
    return _mixed(value)


class ItemIndex:
    """Sketches and shingles of some test items, ``(item id, text)`` each.

    Shingles are runs of ``shingle`` words; an item with fewer words is one
    shingle of all its words, and one without words is found nowhere.
    """

    def __init__(self, items: Iterable[tuple[object, str | None]], shingle: int = SHINGLE,
                 containment: float = CONTAINMENT):
        self.containment = containment
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[object] = []
        self.sizes: list[int] = []
        #: by words of a shingle, its word numbers to the items that have it
        self.shingles: dict[int, dict[tuple[int, ...], list[int]]] = {}
        own: list[tuple[int, list[tuple[int, ...]]]] = []
        for item, text in items:
            words = [w for block in word_blocks((text or "").encode()) for w in block]
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            n = min(shingle, len(ids))
            grams = list(dict.fromkeys(tuple(ids[i:i + n]) for i in range(len(ids) - n + 1)))
            k = len(self.items)
            self.items.append(item)
            self.sizes.append(len(grams))
            for g in grams:
                self.shingles.setdefault(n, {}).setdefault(g, []).append(k)
            own.append((n, grams))
        #: by (words of a shingle, size class): the highest hash of a sketch, and all its hashes, sorted
        sketches: dict[tuple[int, int], list[np.ndarray]] = defaultdict(list)
        for n, grams in own:
            hashes = np.sort(_hashes(np.array(grams)))
            sketches[n, len(grams).bit_length()].append(hashes[:len(grams) - self.least(len(grams)) + 1])
        self.partitions = [(n, np.unique(np.concatenate(parts))) for (n, _), parts in sorted(sketches.items())]
        #: by words of a shingle, hash to the shingles with it, and all hashes
        self.by_hash: dict[int, dict[int, list[tuple[int, ...]]]] = {}
        self.all_hashes: dict[int, np.ndarray] = {}
        for n, grams in self.shingles.items():
            table, hashes = defaultdict(list), _hashes(np.array(list(grams)))
            for h, g in zip(hashes.tolist(), grams):
                table[h].append(g)
            self.by_hash[n], self.all_hashes[n] = dict(table), hashes

    def least(self, size: int) -> int:
        """Shingles of an item of ``size`` that make it contained."""
        return max(1, math.ceil(self.containment * size - 1e-9))

    def _runs(self, text: bytes | None):
        """The text's runs of known words that may be shingles: per length, hashes and word numbers."""
        longest, get = max(self.shingles), self.vocabulary.get
        tail = np.empty(0, np.int64)
        for block in word_blocks(text):
            ids = np.concatenate([tail, np.fromiter((get(w, -1) for w in block), np.int64, len(block))])
            tail = ids[max(len(ids) - longest + 1, 0):]
            known = ids >= 0
            for n in self.shingles:
                places = len(ids) - n + 1
                if places < 1:
                    continue
                whole = known[:places].copy()
                for k in range(1, n):
                    whole &= known[k:places + k]
                if len(at := np.flatnonzero(whole)):
                    runs = ids[at[:, None] + np.arange(n)]
                    yield n, _hashes(runs), runs

    def candidates(self, text: bytes | None) -> set[int]:
        """Items whose sketch meets the text, by size partition."""
        met: set[int] = set()
        for n, hashes, _ in self._runs(text):
            for words, sketch in self.partitions:
                if words == n:
                    low = hashes[hashes <= sketch[-1]]
                    for h in set(low[sketch[np.searchsorted(sketch, low)] == low].tolist()):
                        for gram in self.by_hash[n][h]:
                            met.update(self.shingles[n][gram])
        return met

    def search(self, text: bytes | None) -> list[tuple[object, int, int]]:
        """Contained items: id, shingles found, shingles."""
        met = self.candidates(text) if self.items else set()
        if not met:
            return []
        shared: dict[int, set[tuple[int, ...]]] = defaultdict(set)
        for n, hashes, runs in self._runs(text):
            for run in runs[np.isin(hashes, self.all_hashes[n])].tolist():
                for k in self.shingles[n].get(tuple(run), ()):
                    if k in met:
                        shared[k].add(tuple(run))
        return [(self.items[k], len(shared[k]), self.sizes[k]) for k in sorted(met)
                if len(shared[k]) >= self.least(self.sizes[k])]


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                 containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each row of ``docs`` and item contained in it: ``doc_id``,
    ``item_id``, ``shared`` and ``shingles`` (distinct, of the item),
    ``containment``, and the row's place ``__file``, ``__row``.

    The items, repeated ones once, go to the tasks in blocks of about
    ``block_words`` words, chosen by a hash of id and text, each with a pass
    over the documents.  A block's hits are written before the next block is
    collected, so the driver and what is sent hold one block at a time,
    whatever the number of items; one item is never cut, so a block is at
    least as long as its longest item.  Documents are never shuffled and
    long ones read a block at a time.  Ids of items keep their type.  Null
    and empty texts contain nothing and null or empty items are contained
    nowhere; repeated rows get the same answers; an empty table of either
    gives no rows.
    """
    docs = located(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), FILE, ROW)
    items = materialise(benchmark.select(
        F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct(), "items")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_words))  # a word and its space: two characters at least
    path, id_type = scratch(docs.sparkSession, "hits"), items.schema["item_id"].dataType
    arrow_type = items.limit(0).select("item_id").toArrow().schema.field("item_id").type
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        found = _search(docs, ItemIndex(sorted(map(tuple, mine.collect()), key=str), shingle, containment),
                        id_type.simpleString(), arrow_type)
        found.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _search(docs: DataFrame, index: ItemIndex, id_type: str, arrow_type: pa.DataType) -> DataFrame:
    kind = pa.list_(pa.struct([("item_id", arrow_type), ("shared", pa.int64()), ("shingles", pa.int64())]))

    @F.arrow_udf(f"array<struct<item_id: {id_type}, shared: bigint, shingles: bigint>>")
    def search(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("item_id", "shared", "shingles"), x)) for x in index.search(t)]
                         for some in slices(texts.cast(pa.large_binary())) for t in some], kind)
    return (docs.select("doc_id", FILE, ROW, F.explode(search("text")).alias("hit"))
            .select("doc_id", "hit.*", (F.col("hit.shared") / F.col("hit.shingles")).alias("containment"), FILE, ROW))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that contain an item; same columns."""
    return without(docs, lambda located_docs: materialise(
        contaminated(located_docs.drop(FILE, ROW), benchmark, **options).select(FILE, ROW).distinct(), "contaminated"))
