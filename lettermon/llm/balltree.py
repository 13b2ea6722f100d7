"""Exact ranked search by inner products in sparse ball trees.

A document is a sparse vector of its terms' impacts, an item a sparse vector
of its terms' weights, both of integers; the score is their inner product.
The vectors are dealt into ball trees: every node has the centroid of its
documents and the radius of a ball around it that holds them all.  By
Cauchy and Schwarz no document of a node scores more than
``<item, centroid> + |item| * radius``; that bound is rounded up by more than
the floating-point error it can have.  A search goes through the nodes of a
tree by falling bound and stops at the first that cannot beat the item's
worst hit so far.  Leaves are scored in 64-bit integers, so hits are exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .scratch import materialise
from .wordarrays import byte_kinds, text_blocks, words_of

#: Terms are runs of ASCII digits and letters and of non-ASCII characters.
KINDS = byte_kinds(bytes(c for c in range(128) if not chr(c).isalnum()))
TOP = 10
#: Documents of a tree and of a leaf at most.
TREE, LEAF = 2048, 32
#: Words of items that are looked for in one pass over the documents; an item with more has a pass of its own.
BLOCK_WORDS = 50_000
#: Share by which a bound is raised; doubles are off by less than 1e-12 of it for vectors of 1,000 terms and more.
SLACK = 1e-9


@dataclass
class Vectors:
    """Sparse integer rows: row ``i`` has ``columns[at[i]:at[i + 1]]`` and ``values`` likewise; none is empty."""
    at: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(at[-1]) - np.repeat(at[:-1], sizes) + np.repeat(self.at[:-1][rows], sizes)
        return Vectors(at, self.columns[place], self.values[place])

    def times(self, dense: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Inner products of rows ``first`` to ``last`` with a dense vector."""
        last = len(self) if last is None else last
        a, b = self.at[first], self.at[last]
        return np.add.reduceat(self.values[a:b] * dense[self.columns[a:b]], self.at[first:last] - a)


class BallTree:
    """A ball tree over ``vectors`` of ``width`` columns.

    ``order``: rows as the leaves have them; node ``k`` holds
    ``order[first[k]:last[k]]`` and has children ``left[k]``, ``right[k]``
    (-1 in leaves).  Equal vectors that cannot be told apart are cut in the
    middle, so a tree over any number of copies stays balanced.
    """

    def __init__(self, vectors: Vectors, width: int, leaf: int = LEAF):
        self.width = width
        order = np.arange(len(vectors))
        squares = np.add.reduceat(vectors.values.astype(float) ** 2, vectors.at[:-1]) if len(vectors) else np.zeros(0)
        self.first, self.last, self.left, self.right, self.radius, centroids = [], [], [], [], [], []

        def apart(rows: np.ndarray, own: Vectors, dense: np.ndarray) -> np.ndarray:
            """Squared distances of rows to a point, raised by their rounding error."""
            length = float(dense @ dense)
            far = squares[rows] - 2 * own.times(dense) + length
            return np.maximum(far, 0) + SLACK * (squares[rows] + length)

        def grow(a: int, b: int) -> int:
            k = len(self.first)
            rows = order[a:b]
            own = vectors.take(rows)
            centre = np.bincount(own.columns, own.values, minlength=width) / (b - a)
            far = apart(rows, own, centre)
            for x, v in zip((self.first, self.last, self.left, self.right, self.radius),
                            (a, b, -1, -1, math.sqrt(float(far.max())) * (1 + SLACK))):
                x.append(v)
            centroids.append(centre)
            if b - a > leaf:
                point = np.zeros(width)
                one = own.take(np.array([int(far.argmax())]))  # the farthest from the centre
                point[one.columns] = one.values
                to_one = apart(rows, own, point)
                point[:] = 0
                two = own.take(np.array([int(to_one.argmax())]))  # and the farthest from that
                point[two.columns] = two.values
                side = to_one <= apart(rows, own, point)
                middle = a + int(side.sum())
                if middle in (a, b):
                    middle = (a + b) // 2
                else:
                    order[a:b] = rows[np.argsort(~side, kind="stable")]
                self.left[k] = grow(a, middle)
                self.right[k] = grow(middle, b)
            return k

        if len(vectors):
            grow(0, len(vectors))
        self.order = order
        self.vectors = vectors.take(order)
        self.centroids = np.array(centroids).reshape(-1, width)
        self.radius = np.array(self.radius)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node no less than the score of any of its documents."""
        length = math.sqrt(float((weights.astype(float) ** 2).sum()))
        return (self.centroids[:, terms] @ weights.astype(float) + length * self.radius) * (1 + SLACK) + 1

    def search(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, hits: list, top: int = TOP) -> int:
        """Put the best documents into ``hits``, a heap of ``(score, -id)``
        with the worst first and at most ``top`` entries; the leaves read."""
        if not len(self.vectors) or not len(terms):
            return 0
        dense = np.zeros(self.width, np.int64)
        dense[terms] = weights
        bound, read = self.bounds(terms, weights), 0
        queue = [(-bound[0], 0)]
        while queue:
            most, k = heapq.heappop(queue)
            if len(hits) == top and -most < hits[0][0]:
                break  # an equal score may still have a smaller id
            if self.left[k] >= 0:
                for child in (self.left[k], self.right[k]):
                    heapq.heappush(queue, (-bound[child], child))
                continue
            read += 1
            a, b = self.first[k], self.last[k]
            scores = self.vectors.times(dense, a, b)
            worst = hits[0][0] if len(hits) == top else 1
            for i in np.flatnonzero(scores >= max(worst, 1)).tolist():
                hit = (int(scores[i]), -int(ids[self.order[a + i]]))
                if len(hits) < top:
                    heapq.heappush(hits, hit)
                elif hit > hits[0]:
                    heapq.heapreplace(hits, hit)
        return read


def term_vectors(docs: DataFrame, terms: list[bytes], doc_id: str, text: str) -> DataFrame:
    """``id``, ``n`` (terms of the text with repeats), and of the given
    ``terms`` those it holds: ``terms`` (their numbers) and ``tf``."""
    known = pa.array(terms, pa.large_binary())

    def count(batches):
        for batch in batches:
            for block in text_blocks(batch, 1):
                words = words_of(block.column(1), KINDS)
                size, rows = len(terms) + 1, len(block)
                n = np.bincount(words.owner, minlength=rows)
                number = pc.index_in(words.texts, known).fill_null(-1).to_numpy()[words.ids]
                mine = number >= 0
                codes, tf = np.unique(words.owner[mine] * size + number[mine], return_counts=True)
                at = pa.array(np.searchsorted(codes, np.arange(rows + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(at, pa.array((codes % size).astype(np.int32))),
                     pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int32)))], ["id", "n", "terms", "tf"])
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "id long, n long, terms array<int>, tf array<int>")


def impacts(n: np.ndarray, tf: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impacts of terms that occur ``tf`` times in a document of ``n`` terms."""
    m = 25 + (75 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _search(vectors: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], width: int, documents: int, length: int,
            top: int, tree: int, leaf: int) -> DataFrame:
    """The best hits of each task's trees: ``item``, ``doc_id``, ``score``.
    A task carries an item's hits from tree to tree, so later trees are
    searched with the bar that earlier ones have set."""
    least = -(1 << 63)

    def find(batches) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]

        def searched(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts).combine_chunks()
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(rows["terms"]).to_numpy())])
            columns = pc.list_flatten(rows["terms"]).to_numpy().astype(np.int64)
            tf = pc.list_flatten(rows["tf"]).to_numpy().astype(np.int64)
            n = np.repeat(rows["n"].to_numpy(), np.diff(at))
            own = BallTree(Vectors(at, columns, impacts(n, tf, documents, length)), width, leaf)
            # a null id comes after all others
            ids = rows["id"].fill_null(-least - 1).to_numpy()
            for hits, (_, terms, weights) in zip(best, items):
                own.search(terms, weights, ids, hits, top)

        waiting, size = [], 0
        for batch in batches:
            for at in range(0, len(batch), tree):
                part = batch.slice(at, tree)
                if size + len(part) > tree:
                    searched(waiting)
                    waiting, size = [], 0
                waiting.append(part)
                size += len(part)
        if waiting:
            searched(waiting)
        found = [(items[k][0], None if -i == -least - 1 else -i, s) for k, hits in enumerate(best) for s, i in hits]
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)],
                                         ["item", "doc_id", "score"])
    held = vectors.where(F.size("terms") > 0)
    return held.mapInArrow(find, "item long, doc_id long, score long")


def best_first(hits: DataFrame, top: int) -> DataFrame:
    """The first ``top`` hits of each item with their ``rank``: of parts of an item's hits, then of these."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = W.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    some = hits.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", top: int = TOP, block_words: int = BLOCK_WORDS, tree: int = TREE,
                  leaf: int = LEAF) -> DataFrame:
    """The ``top`` documents with the highest score above 0 for each item:
    ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, its impact
    ``10^9 tf div (1000 tf + 8 m)`` with ``m = 25 + 75 n N div L``; the score
    sums weight times impact over the item's terms with repeats.  Equal
    scores go by ascending id, null last.

    Items go to the tasks in blocks of about ``block_words`` words, chosen by
    hash; a block's pass reads the texts once and keeps only its items' terms,
    so the driver and the tasks hold one block at a time.  Ids of documents
    are integers; those of items keep their type.  Null and empty texts hold
    nothing and are found by nothing; very long ones are taken whole, in one
    task.  Repeated documents are hits each of their own; repeated items (id
    and text) count once, and texts that share an id are ranked each by
    itself.  An empty table of either gives no rows.  Other columns are not
    looked at.
    """
    kind = T.StructType([T.StructField("item", T.LongType())])
    queries = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    queries = materialise(queries.withColumn("item", F.monotonically_increasing_id()), "items")
    size = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_words))  # a word and its space: two characters at least
    found = docs.sparkSession.createDataFrame([], kind.add("doc_id", T.LongType()).add("score", T.LongType()))
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "text").orderBy("item").collect()
        if mine:
            found = found.unionByName(materialise(_block(docs, mine, doc_id, text, top, tree, leaf), "hits"))
    ranked = best_first(found, top).join(queries.select("item", "item_id"), "item")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _block(docs: DataFrame, mine: list, doc_id: str, text: str, top: int, tree: int, leaf: int) -> DataFrame:
    """Hits of the items of one block."""
    words = words_of(pa.array([r["text"] for r in mine], pa.string()), KINDS)
    width = len(words.texts)
    vectors = materialise(term_vectors(docs, words.texts.to_pylist(), doc_id, text), "vectors")
    documents, length = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(width, np.int64)
    # as many rows as the block has terms
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[r["term"]] = weight(documents, r["count"])
    queries = []
    for k, r in enumerate(mine):
        terms, repeats = np.unique(words.ids[words.owner == k], return_counts=True)
        queries.append((r["item"], terms.astype(np.int64), weights[terms] * repeats))
    return _search(vectors, queries, width, documents, max(length, 1), top, tree, leaf)
