"""SimHash near-duplicates by segment popcounts and a grid range join.

Two fingerprints that differ in at most ``d`` bits have, cut into segments,
bit counts whose Manhattan distance is at most ``d``: every differing bit
moves one count by one.  The counts of all segments are a cell of an
integer grid, so the partners of a fingerprint lie in the cells within
distance ``d`` of its own.  Each distinct fingerprint is stored once in its
cell and looked up from the cells around it (half of them: a pair is met
from one side only); the exact bit distance then decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .components import components
from .scratch import FILE, ROW, located, materialise, without

BITS = 64
SEED = 42
#: Bytes of text that become words at once.
_BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x09-\x0D\x20]")
#: _SPREAD[x] has bit i of the byte x in its byte i.
_SPREAD = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).copy().view(np.uint64).ravel()


def _word_blocks(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, in lists of about ``size`` bytes of text each."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def _bit_counts(words: list[bytes], shingle: int) -> np.ndarray:
    """How many of the hashes of the runs of ``shingle`` words have each bit."""
    import xxhash

    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    after = list(accumulate(len(w) + 1 for w in words))
    starts, ends = [0, *after[:len(words) - shingle]], after[shingle - 1:]
    hashes = np.fromiter((digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts))
    lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    lanes = np.concatenate([lanes, np.zeros((-len(lanes) % 255, 8), np.uint64)])
    sums = lanes.reshape(-1, 255, 8).sum(axis=1)  # 255 ones at most: no byte overflows
    return sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = 3, block: int = _BLOCK) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit integer.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased;
    each run of ``shingle`` words (all words if there are fewer) is hashed
    by XXH64 with seed 42, repeats included.  A bit is 1 if more than half
    of the hashes have it; no words give 0.  The text is read in blocks of
    about ``block`` bytes, with the words that reach into the next one.
    """
    ones, n, tail = np.zeros(BITS, np.int64), 0, []
    for some in _word_blocks(text or b"", block):
        words = tail + some
        if len(words) < shingle:
            tail = words
            continue
        ones += _bit_counts(words, shingle)
        n += len(words) - shingle + 1
        tail = words[len(words) - shingle + 1:]
    if not n and tail:
        ones, n = _bit_counts(tail, len(tail)), 1
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of column ``text`` (null counts as empty) as long ``name``."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for some in slices(texts.cast(pa.large_binary())) for t in some],
                        pa.int64())
    return docs.withColumn(name, of(F.col(text).cast("string")))


def segment_edges(segments: int) -> list[int]:
    return [round(BITS * i / segments) for i in range(segments + 1)]


def cell(fp: Column, segments: int, reach: int) -> Column:
    """The grid cell of a fingerprint: its segment bit counts as digits of one number."""
    edges = segment_edges(segments)
    base = _base(segments, reach)
    out = F.lit(0).cast("long")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        bits = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        out = out + (F.bit_count(bits) + reach).cast("long") * F.lit(base ** i).cast("long")
    return out


def _base(segments: int, reach: int) -> int:
    """Digits run from 0 to the segment's bits, and ``reach`` beyond on each side."""
    return -(-BITS // segments) + 2 * reach + 1


def cell_offsets(segments: int, reach: int) -> list[int]:
    """What to add to a cell to get every cell within Manhattan distance
    ``reach``, of each two opposite ones the one whose first change is
    positive, and 0."""
    base, found = _base(segments, reach), {0}
    for steps in range(1, reach + 1):
        for dims in range(1, steps + 1):
            for where in combinations(range(segments), dims):
                for cuts in combinations(range(1, steps), dims - 1):
                    sizes = [b - a for a, b in zip((0, *cuts), (*cuts, steps))]
                    for signs in range(1 << (dims - 1)):
                        moves = [s * (-1 if i and signs >> (i - 1) & 1 else 1) for i, s in enumerate(sizes)]
                        found.add(sum(m * base ** w for m, w in zip(moves, where)))
    return sorted(found)


def segments_for(distinct: int, reach: int) -> int:
    """The number of segments with the least expected work.

    More segments mean more cells to look up from each fingerprint, fewer
    mean more fingerprints in a cell; the counts of random bits estimate
    both.  The choice changes the work only, never a result.
    """
    from math import comb

    def work(segments):
        edges = segment_edges(segments)
        meet = 1.0
        for lo, hi in zip(edges, edges[1:]):
            meet *= comb(2 * (hi - lo), hi - lo) / 4 ** (hi - lo)
        looked_up = len(cell_offsets(segments, reach))
        return looked_up * distinct * (1 + distinct * meet)
    return min((8, 10, 12, 16), key=work)


def links(fingerprints: DataFrame, fp: str, max_bits: int, segments: int) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints that differ in 1 to
    ``max_bits`` bits, each once.  ``fingerprints`` has each value once."""
    offsets = F.array(*[F.lit(x).cast("long") for x in cell_offsets(segments, max_bits)])
    here = fingerprints.select(F.col(fp).alias("b"), cell(F.col(fp), segments, max_bits).alias("cell"))
    around = (fingerprints.select(F.col(fp).alias("a"), cell(F.col(fp), segments, max_bits).alias("own"),
                                  F.explode(offsets).alias("step"))
              .select("a", (F.col("own") + F.col("step")).alias("cell"), (F.col("step") == 0).alias("same")))
    return (around.join(here.hint("shuffle_hash"), "cell")
            .where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
                   & (~F.col("same") | (F.col("a") < F.col("b"))))
            .select("a", "b"))


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   max_bits: int = 2, segments: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (long), ``component_id``
    and the row's place ``__file``, ``__row``.

    Rows are linked if their fingerprints differ in ``max_bits`` bits or
    fewer; ``component_id`` is the smallest id reachable over links.  A null
    id is never the smallest unless the whole group has none.  Null and
    empty texts have fingerprint 0 and link like others; repeated rows share
    a group; an empty table gives no rows.

    Copies collapse to one row per fingerprint before any join, so a group
    of copies of any size costs one grid entry.
    """
    marked = with_fingerprint(located(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), FILE, ROW),
                              "text", "fp", shingle).select("doc_id", "fp", FILE, ROW)
    marked = materialise(marked, "fingerprints")
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    if segments is None:
        segments = segments_for(nodes.count(), max_bits)
    member = components(links(nodes, "fp", max_bits, segments))
    reach = nodes.join(member, nodes["fp"] == member["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = reach.groupBy("root").agg(F.min("least").alias("component_id"))
    named = reach.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id", FILE, ROW)


def simhash_survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                      max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest
    ``doc_id`` (a null id last), of repeated ids the first place.  Same
    columns as ``docs``."""
    return without(docs, lambda located_docs: first_places(
        simhash_groups(located_docs.drop(FILE, ROW), doc_id, text, shingle, max_bits), "component_id"), "left_semi")


def first_places(groups: DataFrame, group: str) -> DataFrame:
    """The place of the first row of each group by (doc_id, place)."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)).alias("first")
    return groups.groupBy(group).agg(first).select(f"first.{FILE}", f"first.{ROW}")
