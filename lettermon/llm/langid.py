"""Language ID by error-correcting output codes over character n-grams.

Every language has a codeword; a binary classifier per bit tells, from the
character n-grams of a text, which side of that bit its language is on.  A
text gets the language whose codeword loses least against the bits'
margins, each bit weighted by how well it separates that language
(loss-weighted decoding).  A runner-up nearly as close makes the answer
ambiguous.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .scratch import materialise

UNKNOWN = "und"
MAX_N = 3
BUCKET_BITS = 15
#: Characters of text that are turned into n-grams at once.
BLOCK = 1 << 18
#: Languages whose n-grams a task counts at once, and entries of a dense table that a task holds.
LANGUAGES_AT_ONCE = 64
ENTRIES = 1 << 20
#: Margins are summed in steps of this size, so that the order of the sum does not matter.
STEP = 2.0 ** -40


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_blocks(texts: list[str], bucket_bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of the lower-cased texts: arrays of text numbers and buckets.

    Runs of anything but letters count as one space, also at both ends.
    Texts over ``BLOCK`` characters go in pieces; the last characters of one
    stand before the next, so no n-gram is lost and none is added.
    """
    def pieces():
        group, size = [], 0
        for k, text in enumerate(texts):
            text = text.lower()
            for at in range(0, len(text), BLOCK):
                piece = text[at:at + BLOCK]
                group.append((k, (" " if at == 0 else "") + piece + (" " if at + BLOCK >= len(text) else ""), at > 0))
                size += len(piece)
                if size >= BLOCK:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    before = np.zeros(0, np.uint32)  # the last letters and spaces of a text that goes on in the next group
    for group in pieces():
        lengths = np.array([len(p) for _, p, _ in group])
        codes = np.frombuffer("".join(p for _, p, _ in group).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not group[0][2]:
            before = before[:0]
        goes_on = len(before)
        codes = np.concatenate([before, codes])
        lengths[0] += goes_on
        owner = np.repeat(np.array([k for k, _, _ in group]), lengths)
        start = np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes = np.where(_letters()[codes], codes, np.uint32(32))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (start[1:] != start[:-1])
        codes, owner, start = codes[keep], owner[keep], start[keep]
        before = codes[start == start[-1]][1 - MAX_N:]
        value = np.zeros(len(codes), np.uint32)
        for n in range(1, MAX_N + 1):
            if len(codes) < n:
                break
            last = len(codes) - n + 1
            value = value[:last] * np.uint32(0x01000193) + codes[n - 1:] + np.uint32(n)
            whole = start[:last] == start[n - 1:]
            whole[:max(goes_on - n + 1, 0)] = False  # those that were there before
            hashed = (value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1)
            yield owner[:last][whole], (hashed >> np.uint32(32 - bucket_bits))[whole]


def codewords(classes: int, seed: int = 7, tries: int = 200) -> np.ndarray:
    """A codeword of +1 and -1 for each class.

    Up to seven classes: every two-way split of the classes is a bit.  More:
    the random code with the largest least distance of ``tries``, of
    ``10 log2(classes)`` bits (Allwein et al. 2000).  From 200 classes on the
    first random code without equal codewords or constant bits is taken.
    """
    if classes <= 7:
        splits = range(1, 1 << max(classes - 1, 0))
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(classes)],
                        np.int8).reshape(classes, len(splits))
    rng, best, most = random.Random(seed), None, -1
    bits = int(np.ceil(10 * np.log2(classes)))
    if classes > 200:  # pairs are too many to compare, and far apart by chance
        draw = np.random.Generator(np.random.PCG64(seed))
        while best is None:
            code = draw.integers(0, 2, (classes, bits), np.int8) * np.int8(2) - np.int8(1)
            packed = np.packbits(code > 0, axis=1)
            if len(np.unique(packed, axis=0)) == classes and (np.abs(code.sum(axis=0, dtype=np.int64)) < classes).all():
                best = code
        return best
    for _ in range(tries):
        code = np.array([[rng.choice((-1, 1)) for _ in range(bits)] for _ in range(classes)], np.int8)
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = int(apart[~np.eye(classes, dtype=bool)].min())
        if least > most and (np.abs(code.sum(axis=0)) < classes).all():
            best, most = code, least
    return best


def bit_weights(counts: np.ndarray, totals: np.ndarray, code: np.ndarray,
                smoothing: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (a row per bucket, a column per bit) of some buckets, and their
    part of the mean margins (a row per language, a column per bit).

    ``counts`` has a row per language and a column per bucket; ``totals`` are
    the languages' smoothed sums over all buckets.
    """
    rates = (counts + smoothing) / totals[:, None]
    weights = np.zeros((counts.shape[1], code.shape[1]))
    for b in range(code.shape[1]):
        weights[:, b] = (np.log(rates[code[:, b] > 0].mean(axis=0))
                         - np.log(rates[code[:, b] < 0].mean(axis=0)))
    return weights, rates @ weights


@dataclass
class LanguageModel:
    """``weights``: a row per n-gram bucket, a column per bit; ``scale``: the
    usual margin of a bit; ``trust``: the weight of each bit for each language."""
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray
    ambiguous_below: float = 0.1

    @classmethod
    def from_counts(cls, languages: list[str], counts: np.ndarray, smoothing: float = 0.5,
                    ambiguous_below: float = 0.1) -> LanguageModel:
        """``counts``: n-gram counts, a row per language and a column per bucket.

        A bit's classifier weighs an n-gram by its log odds between the
        languages on both sides, every language counting alike however many
        rows it has.  The mean margin of a language follows from the counts.
        """
        code = codewords(len(languages))
        weights, margins = bit_weights(counts, (counts + smoothing).sum(axis=1), code, smoothing)
        return cls.from_weights(languages, code, weights, margins, ambiguous_below)

    @classmethod
    def from_weights(cls, languages: list[str], code: np.ndarray, weights: np.ndarray, margins: np.ndarray,
                     ambiguous_below: float = 0.1) -> LanguageModel:
        """``margins``: the mean margin of a language's n-grams, a column per bit."""
        scale = np.abs(margins).mean(axis=0) if len(languages) else np.ones(code.shape[1])
        scale[scale == 0] = 1.0
        trust = np.maximum(code * margins / scale, 1e-6)
        trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-300)
        return cls(languages, code, weights.astype(np.float32), scale, trust, ambiguous_below)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, score from 0 to 1 and whether another is nearly as close.

        A text that is null or has no letter is ``und`` with score 0, as is
        every text if no language was learned; a single language is certain.
        """
        known = [k for k, t in enumerate(texts) if has_letter(t)]
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, False)] * len(texts)
        if not self.languages or not known:
            return out
        bits = self.code.shape[1]
        sums, grams = np.zeros((len(known), bits)), np.zeros(len(known))
        if bits:
            for owner, bucket in ngram_blocks([texts[k] for k in known], self.weights.shape[0].bit_length() - 1):
                if len(owner):
                    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    np.add.at(sums, owner[cuts], np.add.reduceat(self.weights[bucket], cuts, axis=0, dtype=np.float64))
                    np.add.at(grams, owner[cuts], np.diff(np.r_[cuts, len(owner)]))
        margin = sums / np.maximum(grams, 1)[:, None] / self.scale
        right, wrong = np.log1p(np.exp(-2 * margin)), np.log1p(np.exp(2 * margin))
        far = np.empty((len(known), len(self.languages)))
        some = max(1, ENTRIES // max(self.code.size, 1))
        for at in range(0, len(known), some):
            loss = np.where(self.code > 0, right[at:at + some, None, :], wrong[at:at + some, None, :])
            far[at:at + some] = (loss * self.trust[None, :, :]).sum(axis=2)
        near = np.exp(-4 * (far - far.min(axis=1, keepdims=True)))
        share = near / near.sum(axis=1, keepdims=True)
        for row, k in enumerate(known):
            best = int(far[row].argmin())
            second = np.delete(share[row], best).max(initial=0.0)
            out[k] = (self.languages[best], float(share[row, best]),
                      bool(share[row, best] - second < self.ambiguous_below))
        return out


def counted(rows: DataFrame, languages: list[str], bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """N-gram counts of ``rows`` (text, language), those above zero: ``lang``
    (its place in ``languages``), ``bucket``, ``n``.

    A task holds the counts of ``LANGUAGES_AT_ONCE`` languages at most and
    hands them on before it takes up another.
    """
    number, size = {x: k for k, x in enumerate(languages)}, 1 << bucket_bits

    def count(batches):
        mine: dict[int, np.ndarray] = {}

        def handed_on():
            at = [np.flatnonzero(n) for n in mine.values()]
            lang = np.repeat(np.fromiter(mine, np.int64, len(mine)), [len(x) for x in at])
            out = pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.int64()), pa.array(np.concatenate([*at, np.zeros(0, np.int64)]), pa.int64()),
                 pa.array(np.concatenate([*(n[x] for n, x in zip(mine.values(), at)), np.zeros(0, np.int64)]), pa.int64())],
                ["lang", "bucket", "n"])
            mine.clear()
            return out
        for batch in batches:
            for texts, langs in zip(slices(batch.column(0)), slices(batch.column(1))):
                by_lang: dict[int, list[str]] = {}
                for t, x in zip(texts, langs):
                    by_lang.setdefault(number[x], []).append(t)
                for k, own in by_lang.items():
                    if k not in mine:
                        if len(mine) == LANGUAGES_AT_ONCE:
                            yield handed_on()
                        mine[k] = np.zeros(size, np.int64)
                    for _, bucket in ngram_blocks(own, bucket_bits):
                        mine[k] += np.bincount(bucket, minlength=size)
        yield handed_on()
    return (rows.mapInArrow(count, "lang long, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", bucket_bits: int = BUCKET_BITS,
          smoothing: float = 0.5) -> LanguageModel:
    """The model of all rows of ``docs`` with a language and a text; every
    language is learned, however rare.

    The counts stay on Spark, a row per language and n-gram bucket that
    occur together.  They are turned into weights a block of buckets at a
    time, the smaller the more languages there are.  What reaches the driver
    is the model itself: buckets by bits and languages by bits, and the bits
    grow with the logarithm of the languages.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    size = 1 << bucket_bits
    if not languages:
        return LanguageModel.from_counts([], np.zeros((0, size)))
    code = codewords(len(languages))
    counts = materialise(counted(rows, languages, bucket_bits), "ngrams")
    totals = np.full(len(languages), smoothing * size)
    for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[r["lang"]] += r["n"]
    width = 1 << min(max((ENTRIES // len(languages)).bit_length() - 1, 0), max(bucket_bits - 5, 0))
    kind = pa.schema([("of", pa.string()), ("id", pa.int64()), ("weights", pa.list_(pa.float64())),
                      ("margins", pa.list_(pa.int64()))])

    def block(found: pa.Table) -> pa.Table:
        first = found["block"][0].as_py() * width
        dense = np.zeros((len(languages), width))
        found = found.filter(found["n"].is_valid())
        dense[found["lang"].to_numpy(), found["bucket"].to_numpy() - first] = found["n"].to_numpy()
        weights, margins = bit_weights(dense, totals, code, smoothing)
        margins = np.rint(margins / STEP).astype(np.int64)
        return pa.table([["bucket"] * width + ["lang"] * len(languages),
                         [*range(first, first + width), *range(len(languages))],
                         [*weights, *[None] * len(languages)], [*[None] * width, *margins]], schema=kind)
    # every block has a row, also one without any count
    blocks = (counts.withColumn("block", F.floor(F.col("bucket") / width))
              .unionByName(spark.range(size // width).select(F.col("id").alias("block")), allowMissingColumns=True))
    parts = materialise(blocks.groupBy("block").applyInArrow(
        block, "of string, id long, weights array<double>, margins array<long>"), "bit-weights")
    weights, margins = np.zeros((size, code.shape[1])), np.zeros(code.shape)
    for r in parts.where("of = 'bucket'").select("id", "weights").toLocalIterator():
        weights[r["id"]] = r["weights"]
    summed = (parts.where("of = 'lang'").select("id", F.posexplode("margins").alias("bit", "margin"))
              .groupBy("id", "bit").agg(F.sum("margin").alias("margin")))
    for r in summed.toLocalIterator():
        margins[r["id"], r["bit"]] = r["margin"] * STEP
    return LanguageModel.from_weights(languages, code, weights, margins)


def predicted(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``ambiguous`` for a text column."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("struct<lang_pred: string, score: double, ambiguous: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        found = [x for some in slices(texts) for x in model.predict(some)]
        return pa.array([dict(zip(("lang_pred", "score", "ambiguous"), x)) for x in found], kind)
    return predict(text.cast("string"))


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row's id falls into the fold that is never learned from.  A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             model: LanguageModel | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``,
    ``score``, ``ambiguous``.

    Without a ``model`` one is learned from the rows that are not held out.
    A null text or one without a letter is ``und`` with score 0; of languages
    that tie the first in alphabetical order is taken and the answer is
    ambiguous; very long texts are read whole, in pieces that lose no n-gram;
    repeated rows get the same answer; an empty table gives no rows.  Other
    columns are not looked at.
    """
    model = model or learn(docs.where(~held_out(doc_id)), text, lang)
    return (docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"),
                        predicted(F.col(text), model).alias("p"))
            .select("doc_id", "held_out", "p.*"))
