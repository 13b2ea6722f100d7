"""Toxicity by two Kneser-Ney models of characters, one of toxic and one of ordinary texts.

Both models predict a character from the ``ORDER - 1`` before it, by
interpolated absolute discounting: counts of n-grams at the longest, of
continuations (the different n-grams that end so) below.  N-grams of more
than ``SHARED`` characters are counted for each class apart; what these leave
over goes to shorter ones that both classes share.  An expression too rare to
be known to either so costs both nearly the same, and what a class says more
often than the other tells them apart.

A text is judged by the log-likelihood of toxic over ordinary, normalised by
length: over the whole text and over its best passage of ``PASSAGE``
n-grams, so that one insult in a long text still counts.  A logistic
function of the two, fitted on rows that the counts leave out, makes them a
score from 0 to 1.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from .batches import slices
from .scratch import materialise

ORDER, SHARED = 5, 2
DISCOUNT = 0.75
PASSAGE = 16
#: Buckets of hashed n-grams and contexts in the scorer (powers of two), and the step of their log ratios.
GRAM_BITS, CONTEXT_BITS = 22, 20
STEP = 2.0 ** -10
#: Steps that a log ratio has at most.
MOST_STEPS = (1 << 15) - 1
#: Characters of text that are taken up at once, and entries of a table of n-grams of theirs.
BLOCK, DENSE = 1 << 20, 1 << 24
#: Bits for each labelled id, and in all at least and at most (as powers of two), that tell which texts may have a label.
MARK_BITS_EACH, LEAST_MARK_BITS, MOST_MARK_BITS = 16, 15, 27
#: Ids whose rows the logistic function is fitted on at most: those with the smallest hashes.
FIT_ROWS = 50_000
#: The learnable rows whose crc32 modulo ``FOLDS`` is this are left out of the counts while it is fitted.
FOLDS, TEST_FOLD, FIT_FOLD = 5, 0, 1
_FACTOR = np.uint64(0x100000001B3)
_GAP = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """The text lower-cased, runs of anything but letters and digits as one space, also at both ends."""
    return _GAP.sub(" ", f" {text.lower()} ") if text else ""


@lru_cache(maxsize=1)
def _alphanumeric() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str | None], order: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Characters of texts made plain, long ones in parts that overlap: for
    each group of parts the codes, the parts' first places and the end, the
    numbers of their texts and how many n-grams of a part the one before it
    had too.  Parts shorter than an n-gram are left out."""
    def raw() -> Iterator[list[tuple[int, str, bool]]]:
        group, size = [], 0
        for k, text in enumerate(texts):
            text = text.lower() if text else ""
            for at in range(0, len(text), BLOCK):
                piece = text[at:at + BLOCK]
                group.append((k, (" " if at == 0 else "") + piece + (" " if at + BLOCK >= len(text) else ""), at > 0))
                size += len(piece)
                if size >= BLOCK:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    before = np.zeros(0, np.uint32)  # the end of a text that goes on in the next group
    for group in raw():
        codes = np.frombuffer("".join(p for _, p, _ in group).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not group[0][2]:
            before = before[:0]
        codes = np.concatenate([before, codes])
        at = np.cumsum([0, *(len(p) for _, p, _ in group)])
        at[1:] += len(before)
        codes = np.where(_alphanumeric()[codes], codes, np.uint32(32))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        keep[at[:-1]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])
        codes, at = codes[keep], kept[at]
        again = np.zeros(len(group), np.int64)
        again[0] = max(len(before) - order + 1, 0)
        before = codes[max(at[-2], at[-1] - overlap):]
        long = np.diff(at) >= order
        if not long.all():
            codes, at = codes[np.repeat(long, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at)[long])])
        if long.any():
            yield codes, at, np.array([k for k, _, _ in group])[long], again[long]


def _ranked(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at each place as a number, and the characters of each
    number (a row).  Numbers grow a character at a time and stay dense, so
    all tables are small."""
    there = np.zeros(int(codes.max(initial=0)) + 1, bool)
    there[codes] = True
    letters, number = np.flatnonzero(there), np.cumsum(there, dtype=np.int32) - 1
    ids, base = number[codes], max(len(letters), 1)
    rank, chars = ids, letters[:, None]
    for n in range(2, order + 1):
        size = len(chars) * base
        code = rank[:len(codes) - n + 1].astype(np.int32 if size < 1 << 31 else np.int64) * base + ids[n - 1:]
        if size <= DENSE:
            there = np.zeros(size, bool)
            there[code] = True
            known = np.flatnonzero(there)
            number = np.empty(size, np.int32)
            number[known] = np.arange(len(known))
            rank = number[code]
        else:
            known, rank = np.unique(code, return_inverse=True)
        chars = np.column_stack([chars[known // base], letters[known % base]])
    return rank, chars


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return v ^ (v >> np.uint64(32))


def _hashed(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of characters."""
    value = np.zeros(len(chars), np.uint64)
    for k in range(chars.shape[1]):
        value = value * _FACTOR + chars[:, k].astype(np.uint64) + np.uint64(1)
    return _mixed(value)


def _counted(codes: np.ndarray, at: np.ndarray, kind: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of some parts by the parts' ``kind`` (0 to 3):
    kinds, characters (a row each) and counts."""
    rank, chars = _ranked(codes, order)
    whole = np.ones(len(codes), bool)  # where an n-gram begins that ends in the same part
    for k in range(1, order):
        whole[at[1:] - k] = False
    of = np.repeat(kind, np.diff(at))[:len(rank)].astype(np.int64) * len(chars) + rank
    n = np.bincount(of[whole[:len(rank)]], minlength=4 * len(chars))
    found = np.flatnonzero(n)
    return found // len(chars), chars[found % len(chars)], n[found]


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """Of ``rows`` (text, toxic, fit: whether the fit will use it) how often
    each n-gram occurs: ``gram``, ``toxic``, ``ordinary``, and the same
    without the rows of the fit, ``toxic_less``, ``ordinary_less``."""
    names = ["toxic", "ordinary", "toxic_less", "ordinary_less"]

    def count(batches):
        for batch in batches:
            for texts, toxic, fit in zip(*(slices(batch.column(c)) for c in range(3))):
                kind = np.array([(0 if t else 2) + bool(f) for t, f in zip(toxic, fit)])
                for codes, at, owner, again in _pieces(texts, order, order - 1):
                    kinds, letters, n = _counted(codes, at, kind[owner], order)
                    grams = letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([grams[i:i + order].encode("utf-8", "replace").decode() for i in range(0, len(grams), order)]),
                         *(pa.array(np.where(which, n, 0)) for which in (kinds < 2, kinds > 1, kinds == 0, kinds == 2))],
                        ["gram", *names])
    found = rows.mapInArrow(count, "gram string, " + ", ".join(f"{x} long" for x in names))
    return found.groupBy("gram").agg(*(F.sum(x).alias(x) for x in names))


def _totals(level: DataFrame, size: int, columns: list[str]) -> DataFrame:
    """Per context (all but the last character) the sum of each column and how many of its n-grams have any."""
    return level.groupBy("model", F.substring("gram", 1, size - 1).alias("context")).agg(
        *(F.sum(c).alias(f"{c}_total") for c in columns),
        *(F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in columns))


def log_ratios(grams: DataFrame, order: int = ORDER, shared: int = SHARED,
               discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """Log probabilities of toxic over ordinary, from counts ``toxic`` and
    ``ordinary`` of the n-grams of each ``model``: ``gram``, ``n``, ``ratio`` of those of more
    than ``shared`` characters that occur in a class, and of the contexts
    what to add to the ratio of the next shorter n-gram if they go on in a
    way that neither class has.  A context that a class does not know
    predicts as the next shorter one does."""
    classes = ["toxic", "ordinary"]
    level = grams.select("model", "gram", *classes, (F.col("toxic") + F.col("ordinary")).alias("n")).where("n > 0")
    levels = {order: level.withColumn("both", F.col("n"))}
    for size in range(order - 1, 0, -1):  # continuations: the different longer n-grams that end so
        levels[size] = levels[size + 1].groupBy("model", F.substring("gram", 2, size).alias("gram")).agg(
            *(F.sum((F.col(c) > 0).cast("long")).alias(c) for c in classes), F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("both"))
    chance, seen, unseen = None, [], []
    for size in range(1, order + 1):
        columns = ["both"] if size <= shared else classes
        totals = _totals(levels[size], size, columns)
        here = levels[size].withColumn("context", F.substring("gram", 1, size - 1)).join(totals, ["model", "context"])
        if chance is None:
            here = here.withColumn("below_both", 1 / F.col("both_types"))
        else:
            below = chance.select("model", F.col("gram").alias("shorter"), *(
                F.col("p_both" if size <= shared + 1 else f"p_{c}").alias(f"below_{c}") for c in columns))
            here = here.withColumn("shorter", F.substring("gram", 2, size - 1)).join(below, ["model", "shorter"])

        def left(c: str) -> Column:  # what discounting leaves to the shorter n-grams
            return F.when(F.col(f"{c}_total") > 0, discount * F.col(f"{c}_types") / F.col(f"{c}_total")).otherwise(1.0)

        def likely(c: str) -> Column:
            own = F.when(F.col(c) > 0, (F.col(c) - discount) / F.col(f"{c}_total")).otherwise(0.0)
            return own + left(c) * F.col(f"below_{c}")
        chance = here.select("model", "gram", "n", *(likely(c).alias(f"p_{c}") for c in columns))
        if size > shared:
            chance = materialise(chance, f"chances-{size}")
            seen.append(chance.select("model", "gram", "n", F.ln(F.col("p_toxic") / F.col("p_ordinary")).alias("ratio")))
            unseen.append(totals.select("model", F.col("context").alias("gram"), (F.col("toxic_total") + F.col("ordinary_total")).alias("n"),
                                        F.ln(left("toxic") / left("ordinary")).alias("ratio")))
    return reduce(DataFrame.unionByName, seen), reduce(DataFrame.unionByName, unseen)


@dataclass
class RatioTable:
    """Log ratios in steps by hash bucket; ``tags`` tell apart what shares a
    bucket (0: nothing there).  ``rest`` and ``rest_steps`` have the n-grams
    whose bucket another one took, by their whole hash, in its order."""
    steps: np.ndarray
    tags: np.ndarray
    rest: np.ndarray
    rest_steps: np.ndarray

    @classmethod
    def empty(cls, bits: int) -> RatioTable:
        return cls(np.zeros(1 << bits, np.int16), np.zeros(1 << bits, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.int16))

    @classmethod
    def of(cls, hashes: np.ndarray, steps: np.ndarray, n: np.ndarray, bits: int) -> RatioTable:
        """All n-grams of some hashes; the most frequent of a bucket is found the fastest."""
        out = cls.empty(bits)
        bucket, tag = cls.places(hashes, bits)
        order = np.lexsort((hashes, -n, bucket))
        first = np.ones(len(order), bool)
        first[1:] = bucket[order[1:]] != bucket[order[:-1]]
        most, rest = order[first], order[~first]
        out.steps[bucket[most]], out.tags[bucket[most]] = steps[most], tag[most]
        rest = rest[np.argsort(hashes[rest], kind="stable")]
        out.rest, out.rest_steps = hashes[rest], steps[rest]
        return out

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        return hashes >> np.uint64(64 - bits), (hashes & np.uint64(0x7F)).astype(np.uint8) + np.uint8(1)

    def get(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps, and which of the hashes are there."""
        bucket, tag = self.places(hashes, len(self.tags).bit_length() - 1)
        steps, known = self.steps[bucket], self.tags[bucket] == tag
        if len(self.rest):
            shared = np.flatnonzero(self.tags[bucket])
            at = np.minimum(np.searchsorted(self.rest, hashes[shared]), len(self.rest) - 1)
            there = self.rest[at] == hashes[shared]
            steps[shared[there]], known[shared[there]] = self.rest_steps[at[there]], True
        return steps, known


def ratio_tables(ratios: DataFrame, bits: int) -> dict[int, RatioTable]:
    """The table of each model's ``ratios``, with all its n-grams however
    many share a bucket.  The driver gets three numbers for each different
    n-gram of the labelled texts; a scorer keeps 3 bytes a bucket and 10 for
    each n-gram whose bucket is taken."""
    @F.arrow_udf("long")
    def hashed(grams: pa.Array) -> pa.Array:
        texts = grams.to_pylist()
        hashes, sizes = np.zeros(len(texts), np.uint64), np.array([len(g) for g in texts])
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            codes = np.frombuffer("".join(texts[i] for i in own).encode("utf-32-le"), np.uint32)
            hashes[own] = _hashed(codes.reshape(-1, size))
        return pa.array(hashes.view(np.int64))
    steps = F.rint(F.greatest(F.lit(-MOST_STEPS), F.least(F.lit(MOST_STEPS), F.col("ratio") / STEP))).cast("short")
    found, tables = ratios.select("model", hashed("gram").alias("hash"), steps.alias("steps"), "n").toArrow(), {}
    of, hashes, steps, n = (found[c].to_numpy() for c in ("model", "hash", "steps", "n"))
    for k in np.unique(of):
        own = of == k
        tables[int(k)] = RatioTable.of(hashes[own].view(np.uint64), steps[own], n[own], bits)
    return tables


@dataclass
class ToxicityModel:
    """``grams``, ``contexts``: log ratios; ``fit``: the logistic function's constant and weights of the two features."""
    grams: RatioTable
    contexts: RatioTable
    order: int = ORDER
    shared: int = SHARED
    fit: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def ratios(self, chars: np.ndarray) -> np.ndarray:
        """The log ratios, in steps, of the last characters of some n-grams (a row of codes each)."""
        steps = np.zeros(len(chars), np.int32)
        for size in range(self.shared + 1, self.order + 1):  # from the shortest that differ between the classes
            value, known = self.grams.get(_hashed(chars[:, self.order - size:]))
            more, after = self.contexts.get(_hashed(chars[:, self.order - size:-1]))
            steps = np.where(known, value, steps + np.where(after, more, 0))
        return steps

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: the mean log ratio of its n-grams, and the largest
        sum of ``PASSAGE`` n-grams in a row over ``PASSAGE``.  Texts without n-grams have 0, 0."""
        total, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        best = np.full(len(texts), np.iinfo(np.int64).min)
        for codes, at, owner, again in _pieces(texts, self.order, self.order - 1 + PASSAGE):
            rank, chars = _ranked(codes, self.order)
            sums = np.concatenate([[0], np.cumsum(self.ratios(chars)[rank], dtype=np.int64)])
            first, sizes = at[:-1], np.diff(at) - self.order + 1  # a part's n-grams
            np.add.at(total, owner, sums[first + sizes] - sums[first + np.minimum(again, sizes)])
            np.add.at(count, owner, np.maximum(sizes - again, 0))
            most = sums[first + sizes] - sums[first]  # of parts that are shorter than a passage
            long = np.flatnonzero(sizes >= PASSAGE)
            if len(long):
                passages = np.append(sums[PASSAGE:] - sums[:-PASSAGE], 0)
                bounds = np.column_stack([first[long], first[long] + sizes[long] - PASSAGE + 1]).ravel()
                most[long] = np.maximum.reduceat(passages, bounds)[::2]
            np.maximum.at(best, owner, most)
        best[count == 0] = 0
        return np.stack([total / np.maximum(count, 1), best / PASSAGE], axis=1) * STEP

    def scores(self, texts: list[str | None]) -> np.ndarray:
        at = self.features(texts) @ np.array(self.fit[1:]) + self.fit[0]
        return 1 / (1 + np.exp(-at))


def logistic(features: np.ndarray, labels: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Constant and weights of a logistic function by Newton's method; more
    of a feature never makes a text less toxic."""
    used = [0, 1]
    while True:
        x = np.column_stack([np.ones(len(features)), features[:, used]])
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            flat = np.diag([0.0, *[ridge] * len(used)]) + 1e-9 * np.eye(len(w))
            w = w + np.clip(np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + flat, x.T @ (labels - p) - flat @ w), -5, 5)
        if (w[1:] >= 0).all():
            out = {0: 0.0, 1: 0.0} | dict(zip(used, w[1:].tolist()))
            return float(w[0]), out[0], out[1]
        used = [u for u, v in zip(used, w[1:]) if v >= 0]


def _feature_columns(text: Column, model: ToxicityModel) -> Column:
    kind = pa.struct([("whole", pa.float64()), ("passage", pa.float64())])

    @F.arrow_udf("struct<whole: double, passage: double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([{"whole": a, "passage": b} for some in slices(texts) for a, b in model.features(some).tolist()], kind)
    return features(text.cast("string"))


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is never learned from.  A null id has no label."""
    return F.coalesce(fold(doc_id) == TEST_FOLD, F.lit(False))


def maybe_marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``id`` is in ``marks``, and a few others:
    what need not be moved to a join with them.

    The ids of ``marks`` are bits of at most ``2 ** MOST_MARK_BITS`` by their
    hash, in pieces that every task gets; a row whose bit is not set has no
    mark.  Ids of types that are not equal exactly as their hashes are (or
    differ between the tables) leave all rows."""
    kind = docs.schema["id"].dataType
    if kind != marks.schema["id"].dataType or not (isinstance(kind, IntegralType) or kind == StringType()):
        return docs
    bits = min(max((MARK_BITS_EACH * marks.count()).bit_length(), LEAST_MARK_BITS), MOST_MARK_BITS)
    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - bits) + 1  # buckets of 32,768 bits count places from 1
    pieces = (marks.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits")))
    at = F.bitmap_bit_position(F.col("__place"))
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return (docs.withColumn("__place", place).withColumn("__bucket", F.bitmap_bucket_number("__place"))
            .join(F.broadcast(pieces), "__bucket").where(there).select(*docs.columns))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          order: int = ORDER) -> ToxicityModel:
    """The model of all rows of ``docs`` with a label that may be learned from.

    Rows without a label take no part; an id with several labels is toxic if
    one of them is.  All such rows are counted; the logistic function is
    fitted on ``FIT_ROWS`` of them at most, against counts without those.
    Without toxic or without ordinary rows the score is the toxic rows' share.
    """
    marks = (labels.select(F.col("doc_id").alias("id"), F.col(label).alias("mark")).where("mark IS NOT NULL AND id IS NOT NULL")
             .groupBy("id").agg((F.max("mark") > 0).alias("toxic")))
    marks = materialise(marks, "marks")
    rows = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"),
                                                (fold(doc_id) == FIT_FOLD).alias("fit"))
    rows = materialise(maybe_marked(rows, marks).join(marks, "id"), "labelled")
    n, toxic, fit_n, fit_toxic = rows.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("toxic"), 1)), F.count(F.when(F.col("fit"), 1)),
        F.count(F.when(F.col("fit") & F.col("toxic"), 1))).first()
    if toxic in (0, n):
        share = toxic / n if n else 0.0
        none = RatioTable.empty(1)
        return ToxicityModel(none, none, order, fit=(math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0, 0.0))
    grams = materialise(gram_counts(rows.select("text", "toxic", "fit"), order), "grams")

    apart = fit_toxic not in (0, fit_n) and toxic - fit_toxic not in (0, n - fit_n)
    # model 0 is of all rows, model 1 of those that the fit leaves
    counts = [F.struct(F.lit(0).alias("model"), "toxic", "ordinary")]
    if apart:
        counts.append(F.struct(F.lit(1).alias("model"), F.col("toxic_less").alias("toxic"), F.col("ordinary_less").alias("ordinary")))
    seen, unseen = log_ratios(grams.select("gram", F.inline(F.array(*counts))), order)
    by_gram, by_context = ratio_tables(seen, GRAM_BITS), ratio_tables(unseen, CONTEXT_BITS)
    none = RatioTable.empty(1)
    model, first = (ToxicityModel(by_gram.get(k, none), by_context.get(k, none), order) for k in (0, int(apart)))
    own = rows.where("fit") if apart else rows
    ids = own.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)  # no text meets in one task
    some = own.join(F.broadcast(ids), "id", "left_semi")  # their number is bounded, the texts' size is not
    measured = some.select(_feature_columns(F.col("text"), first).alias("f"), "toxic").select("f.*", "toxic").toArrow()
    features = np.column_stack([measured["whole"].to_numpy(), measured["passage"].to_numpy()])
    model.fit = logistic(features, measured["toxic"].to_numpy(zero_copy_only=False).astype(float))
    return model


def toxicity(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
             label: str = "toxic", model: ToxicityModel | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to
    1, higher: label 1 likelier), ``predicted`` (1 from a score of 0.5 on),
    ``whole`` and ``passage`` (the two log ratios).

    Without a ``model`` one is learned from ``labels`` (``doc_id`` and
    ``label``) of the rows that are not held out.  Null and empty texts have
    log ratios 0 and the score of such; very long texts are taken in parts
    that overlap, with the same result; repeated rows get the same answer, so
    there are no ties to break; an empty table gives no rows.  Other columns
    are not looked at.
    """
    model = model or learn(docs, labels, doc_id, text, label)
    base, whole, passage = model.fit
    at = F.lit(base) + F.col("f.whole") * whole + F.col("f.passage") * passage
    return (docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"),
                        _feature_columns(F.col(text), model).alias("f"))
            .withColumn("score", 1 / (1 + F.exp(-at)))
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "f.whole", "f.passage"))
