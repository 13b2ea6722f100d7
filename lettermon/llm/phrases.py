"""Phrase mining by Toivonen's method: a sample proposes, full passes decide.

A phrase can only be frequent if the phrases it has without its last and
without its first word are.  A sample, mined level by level with a lowered
threshold, proposes phrases.  One pass over all texts then counts exactly
the proposed phrases and their negative border: those that were not
proposed but whose two shorter phrases were (every word is on it).  The
border need not be written out: a phrase of it that does not occur has count 0,
so a task tells by the two shorter phrases whether one that occurs is on it.
The border is long, so the pass has two steps: counts by hash, which are never
too small, then the exact counts of the phrases whose hash occurs often enough.

A border phrase that turns out to be frequent is a failure of the sample,
and what holds it may be frequent too.  An expansion pass counts every
phrase that holds a failure, was not counted yet and has frequent words only
(those are known: every word was counted).  That closes the search: a
frequent phrase that the first pass did not count holds a shortest frequent
one that was not proposed, and the first pass did count that one and made it
a failure.

What was proposed goes to the tasks as a bitmap of hashes of bounded size.
A phrase that meets a set bit by chance is counted without need; none that
was proposed is missed, so results do not depend on the bitmap's size.
Counts are of the phrases themselves, not of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import materialise
from .wordarrays import BLOCK, Words, byte_kinds, text_blocks, words_of

BREAKS = b".,;:!?\n\x0b\x0c\r"
KINDS = byte_kinds(b" \t", BREAKS)
MAX_WORDS, LEAST, TOP = 4, 30, 2000
#: Share of the rows that the sample has, and of its expected count that a proposal needs there.
SAMPLE, LOWERED = 0.2, 0.5
#: Bits of a bitmap: so many for each proposed phrase, and in all at least and at most (as powers of two).
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 16, 28
#: Lowest bits of a hash that counts by hash leave out: what is left is enough to tell phrases apart and is less to move.
SPARED = 16
#: In so many parts, by hash, the full pass counts: of all phrases that one task meets it keeps only a part's at once.
PARTS = 2
#: Bytes of text that are counted at once: a task's memory, and how often a phrase is handed on.
BYTES_AT_ONCE = 1 << 21
UNKNOWN = "und"
_U = np.uint64


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> _U(27))) * _U(0x94D049BB133111EB)
    return v ^ (v >> _U(31))


def text_hashes(texts: pa.Array) -> np.ndarray:
    """A 64-bit hash of each of some non-empty byte strings."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, _U)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]].astype(_U) + _U(1)
    at = at - at[0]
    lengths = np.diff(at)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, _U))
    place = np.arange(len(data)) - np.repeat(at[:-1], lengths)
    return _mixed(np.add.reduceat(data * powers[place], at[:-1]) + lengths.astype(_U))


def _seeds(langs: pa.Array) -> np.ndarray:
    return _mixed(text_hashes(pc.binary_join_element_wise(langs.cast(pa.binary()), b"", b"l")))


def _longer(keys: np.ndarray, word_keys: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a word more."""
    return _mixed(keys * _U(0x9E3779B97F4A7C15) + word_keys)


def phrase_key(lang: Column, phrase: Column) -> Column:
    """The hash that the tasks know a phrase (words joined by a space) by."""
    @F.arrow_udf("long")
    def key(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        if not len(phrases):
            return pa.array([], pa.int64())
        name, words = langs.dictionary_encode(), pc.split_pattern(phrases.cast(pa.string()), " ")
        size = pc.list_value_length(words).to_numpy()
        first = np.cumsum(size) - size
        seeds = np.repeat(_seeds(name.dictionary)[name.indices.to_numpy()], size)
        word_keys = _mixed(text_hashes(pc.list_flatten(words)) ^ seeds)
        keys = word_keys[first]
        for m in range(1, int(size.max())):
            more = np.flatnonzero(size > m)
            keys[more] = _longer(keys[more], word_keys[first[more] + m])
        return pa.array(keys.view(np.int64))
    return key(lang, phrase)


def dense(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different codes (below ``size``) in order, and the number of each place's code among them."""
    if size > 1 << 24:
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    known = np.flatnonzero(there)
    number = np.empty(size, np.int32)
    number[known] = np.arange(len(known), dtype=np.int32)
    return known, number[codes]


class Bitmap:
    """Set of hashes with false positives: a hash sets two of ``2 ** bits``
    bits, named by its highest bits and by those above the lowest ``SPARED``."""

    def __init__(self, bits: int, packed: np.ndarray | None = None):
        self.bits = bits
        self.packed = np.zeros(1 << (bits - 3), np.uint8) if packed is None else packed

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = self._set(keys >> _U(64 - self.bits))
        some = np.flatnonzero(found)
        found[some] = self._set((keys[some] >> _U(SPARED)) & _U((1 << self.bits) - 1))
        return found

    def _set(self, place: np.ndarray) -> np.ndarray:
        return (self.packed[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & np.uint8(1) != 0


#: Bytes of the bitmaps that Spark's ``bitmap_construct_agg`` builds.
_CHUNK = 4096


def bitmap_of(phrases: DataFrame) -> Bitmap:
    """The bitmap of the ``key`` column, put together on Spark; what reaches
    the driver is the bitmap, at most ``2 ** MOST_BITS`` bits."""
    wanted = BITS_EACH * max(phrases.count(), 1)
    bits = min(max(wanted.bit_length(), LEAST_BITS), MOST_BITS)
    places = F.array(F.shiftrightunsigned(F.col("key"), 64 - bits), 
                     F.shiftrightunsigned(F.col("key"), SPARED).bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
    out = Bitmap(bits)
    # bucket numbers count from 1, bit positions from 0, of buckets of 32,768 bits
    chunks = (phrases.select(F.explode(F.transform(places, lambda x: x + 1)).alias("place"))
              .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    for r in chunks.toLocalIterator():
        at = (r["bucket"] - 1) * _CHUNK
        out.packed[at:at + _CHUNK] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _long_texts_cut(texts: list[bytes], limit: int) -> Iterator[bytes]:
    """Texts over ``limit`` bytes in parts that end at a break; no phrase spans a break."""
    stop = set(BREAKS)
    for text in texts:
        at = 0
        while len(text) - at > limit:
            end = at + limit
            while end < len(text) and text[end] not in stop:
                end += 1
            yield text[at:end]
            at = end
        yield text[at:]


@dataclass
class Expansion:
    """What an expansion pass is for: ``failures`` of the border, and all frequent ``words``."""
    failures: Bitmap
    words: Bitmap


class PhraseCounter:
    """Counts phrases of up to ``max_words`` words in batches of texts.

    Every word is eligible, and a longer phrase if its two shorter ones are
    eligible and ``proposed``.  Eligible phrases are counted (``level``: only
    those of so many words; ``part``, a number and of how many: only those
    hashes): by hash, or, those whose hash is in ``often``, exactly.  With ``expansion`` those are counted that are not eligible,
    hold a failure and have frequent words only.
    """

    def __init__(self, proposed: Bitmap | None, max_words: int = MAX_WORDS, level: int | None = None,
                 often: Bitmap | None = None, expansion: Expansion | None = None, part: tuple[int, int] = (0, 1)):
        self.proposed, self.max_words, self.level, self.often, self.expansion = proposed, max_words, level, often, expansion
        self.part = part

    def _in_part(self, keys: np.ndarray) -> np.ndarray:
        which, parts = self.part
        return (keys >> _U(SPARED)) % _U(parts) == _U(which)

    def count(self, langs: pa.Array, words: Words) -> Iterator[pa.RecordBatch]:
        """Batches of ``key`` (without its ``SPARED`` lowest bits) and ``n`` or,
        of exact counts, of ``lang``, ``phrase``, ``words`` (0: all words) and ``n``."""
        lang = pc.fill_null(langs.cast(pa.string()), UNKNOWN).dictionary_encode()
        names, size = lang.dictionary, max(len(words.texts), 1)
        of = lang.indices.to_numpy()[words.owner]
        if self.often and not self.expansion:
            n = np.bincount(of, minlength=len(names))
            yield self._rows(names, np.arange(len(names)), pa.array([b""] * len(names), pa.large_binary()), 0, n)
        if not len(words.ids):
            return
        pair, ids = dense(of.astype(np.int64) * size + words.ids, len(names) * size)
        langs_of, texts = pair // size, words.texts.take(pa.array(pair % size))
        word_keys = _mixed(text_hashes(words.texts)[pair % size] ^ _seeds(names)[langs_of])
        self._block = (names, langs_of, texts)
        total = len(ids)
        joined = np.append(words.joined, False)
        at, keys = np.arange(total), word_keys[ids]  # places of eligible phrases of k words, and their hashes
        touched = np.zeros(total + 1, bool)
        if self.expansion:
            usual = np.append(self.expansion.words.has(word_keys)[ids], False)
        for k in range(1, self.max_words + 1):
            eligible = np.zeros(total + 1, bool)
            eligible[at] = True
            if self.expansion:
                # touched: holds a failure and only frequent words; before: of the two shorter phrases
                wanted = np.flatnonzero(touched[:total] & ~eligible[:total]) if k > 1 else at[:0]
                touched[at] |= self.expansion.failures.has(keys) & (usual[at] if k == 1 else True)
            else:
                wanted = at if self.level in (None, k) else at[:0]
            if self.expansion:
                yield from self._counted(ids, wanted, k)
            elif self.often:
                yield from self._counted(ids, wanted[self.often.has(keys)], k)
            elif len(wanted):
                if k == 1:
                    own = self._in_part(word_keys)
                    found, n = word_keys[own], np.bincount(ids, minlength=len(texts))[own]
                else:
                    found, n = np.unique(keys[self._in_part(keys)], return_counts=True)
                found = (found >> _U(SPARED)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["key", "n"])
            if k in (self.max_words, self.level):
                return
            extends = np.zeros(total + 1, bool)
            if self.proposed is not None:
                extends[at] = self.proposed.has(keys)
            on = at[extends[at] & extends[at + 1]]
            if k == 1:
                on = on[joined[on + 1]]
            on = on[on + k < total]
            spot = np.searchsorted(at, on)
            at, keys = on, _longer(keys[spot], word_keys[ids[on + k]])
            if self.expansion:
                whole = joined[1:] & usual[:-1] & usual[1:] if k == 1 else whole[:-1] & whole[1:]
                whole = np.append(whole, False)
                touched[:-1] |= touched[1:]
                touched &= whole[:total + 1]

    def _counted(self, ids: np.ndarray, at: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
        """Counts of the phrases of ``k`` words that begin at the places ``at``."""
        if not len(at):
            return
        names, langs_of, texts = self._block
        base = len(texts)
        if k == 1:
            n = np.bincount(ids[at], minlength=base)
            parts = [np.flatnonzero(n)]
            n = n[parts[0]]
        elif base ** k < 1 << 62:
            code = ids[at].astype(np.int64)
            for m in range(1, k):
                code = code * base + ids[at + m]
            code, n = np.unique(code, return_counts=True)
            parts = []
            for _ in range(k):
                code, last = np.divmod(code, base)
                parts.insert(0, last)
        else:
            rows, n = np.unique(np.column_stack([ids[at + m] for m in range(k)]), axis=0, return_counts=True)
            parts = list(rows.T)
        phrase = texts.take(pa.array(parts[0]))
        for p in parts[1:]:
            phrase = pc.binary_join_element_wise(phrase, texts.take(pa.array(p)), pa.scalar(b" ", pa.large_binary()))
        yield self._rows(names, langs_of[parts[0]], phrase, k, n)

    @staticmethod
    def _rows(names, lang, phrase, k, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(lang)), phrase.cast(pa.binary()).cast(pa.string()), pa.array(np.full(len(lang), k, np.int32)),
             pa.array(np.asarray(n, np.int64))], ["lang", "phrase", "words", "n"])


def _blocks(counter: PhraseCounter):
    """What ``mapInArrow`` runs: the counter over blocks of texts."""
    def count(batches):
        for batch in batches:
            for block in text_blocks(batch, size=BYTES_AT_ONCE):
                texts, langs = block.column(0).cast(pa.large_binary()), block.column(1)
                if len(texts) == 1 and texts[0].is_valid and len(texts[0].as_py()) > BLOCK:
                    for part in _long_texts_cut([texts[0].as_py()], BLOCK):
                        yield from counter.count(langs, words_of(pa.array([part], pa.large_binary()), KINDS))
                else:
                    yield from counter.count(langs, words_of(texts, KINDS))
    return count


def often(rows: DataFrame, proposed: Bitmap | None, least: int, max_words: int = MAX_WORDS, level: int | None = None,
          parts: int = 1) -> DataFrame:
    """Hashes (``key``) of eligible phrases that occur ``least`` times, all phrases of a hash together.

    With ``parts`` the texts are read so often, each time for the hashes of a
    part: what a task has to add up before the shuffle gets shorter, and no
    hash is in two parts."""
    def of(which: int) -> DataFrame:
        counter = PhraseCounter(proposed, max_words, level, part=(which, parts))
        found = rows.mapInArrow(_blocks(counter), "key long, n long")
        return found.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return reduce(DataFrame.unionByName, map(of, range(parts))).select(F.shiftleft("key", SPARED).alias("key"))


def counted(rows: DataFrame, proposed: Bitmap | None, least: int, max_words: int = MAX_WORDS, among: Bitmap | None = None,
            expansion: Expansion | None = None) -> DataFrame:
    """Exact counts of ``rows`` (text, lang): ``lang``, ``phrase``,
    ``words``, ``n`` of the eligible phrases whose hashes are ``among``
    those, or of those of the ``expansion``, if they occur ``least`` times.  The row of 0 words has all words of a language
    and stays however few they are."""
    counter = PhraseCounter(proposed, max_words, often=among, expansion=expansion)
    found = rows.mapInArrow(_blocks(counter), "lang string, phrase string, words int, n long")
    return (found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least) | (F.col("words") == 0)))


def sampled(rows: DataFrame, least: int, max_words: int, share: float, seed: int = 11) -> DataFrame:
    """The hashes (``key``) of the phrases that a sample of the rows proposes, mined level by level."""
    sample = materialise(rows.sample(share, seed), "phrase-sample")
    low = max(1, int(least * share * LOWERED))
    found, proposed = None, None
    for k in range(1, max_words):  # phrases of all words extend to nothing, so they need no proposal
        more = materialise(often(sample, proposed, low, max_words, k), f"sample-{k}")
        found = more if found is None else found.unionByName(more)
        proposed = bitmap_of(found)
    return found


def _has(bitmap: Bitmap, key: Column) -> Column:
    @F.arrow_udf("boolean")
    def has(keys: pa.Array) -> pa.Array:
        return pa.array(bitmap.has(keys.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)))
    return has(key)


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, max_words: int = MAX_WORDS,
             sample: float = SAMPLE, proposals: DataFrame | None = None) -> DataFrame:
    """All phrases of up to ``max_words`` words that occur ``least`` times in
    a language, with their exact counts: ``lang``, ``phrase``, ``words``,
    ``n``; the row of 0 words has the language's number of words.

    ``proposals`` (``key``) takes the place of the sample's.  The result does
    not depend on them; only if a frequent phrase was not proposed there is
    an expansion pass.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    proposed = bitmap_of(sampled(rows, least, max_words, sample) if proposals is None else proposals)
    among = bitmap_of(materialise(often(rows, proposed, least, max_words, parts=PARTS), "often"))
    found = materialise(counted(rows, proposed, least, max_words, among), "phrases")
    keyed = materialise(found.where(F.col("words").between(1, max_words - 1)).select(
        "words", phrase_key(F.col("lang"), F.col("phrase")).alias("key")), "phrase-keys")
    failures = materialise(keyed.where(~_has(proposed, F.col("key"))), "failures")
    if not failures.isEmpty():
        expansion = Expansion(bitmap_of(failures), bitmap_of(keyed.where("words = 1")))
        found = found.unionByName(materialise(counted(rows, proposed, least, max_words, expansion=expansion), "phrases"))
    return found.select("lang", "phrase", "words", "n")


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def scored(found: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang``, ``phrase``,
    ``words``, ``a``, ``l``, ``r``, ``score``.

    A cut's score is ``2000000 a / (l + r)`` rounded down, computed in
    decimals of 38 digits.  Both parts of a frequent phrase are frequent, so
    the joins lose nothing.
    """
    parts = F.split("phrase", " ")
    cuts = (found.where("words > 1")
            .select("lang", "phrase", "words", F.col("n").alias("a"), parts.alias("parts"),
                    F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "words", "a", "k",
                    F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest")))
    counts = found.where("words > 0")
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
            .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]))
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV "
                   "(CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    return (cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "words", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"))


def covering(found: DataFrame) -> DataFrame:
    """For each phrase inside longer candidates the largest count of those: ``lang``, ``phrase``, ``longer``."""
    parts = F.split("phrase", " ")
    inside = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1),
                              lambda i: F.array_join(F.slice("parts", i, k), " "))))
    return (found.where("words > 2").select("lang", "words", "n", parts.alias("parts"))
            .select("lang", "n", F.explode(F.array_distinct(inside)).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 max_words: int = MAX_WORDS, sample: float = SAMPLE, cover: int = 80) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank`` (from 1),
    ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased, texts split at ``.,;:!?`` and line ends into pieces,
    pieces at spaces and tabs into words.  Phrases of 2 to ``max_words``
    words that occur ``least`` times in a language are candidates, scored by
    their weakest cut; one that lies inside a longer candidate with at least
    ``cover`` percent of its count goes.  The first ``top`` of each language
    come back, by score and count (largest first), then phrase (byte order).

    A null text counts as empty, a null language as ``und``; empty texts and
    an empty table give no rows; repeated rows count each time; ties in all
    but the phrase are told apart by it.  A very long text is taken in parts
    that end at a break, so no phrase is lost; only a piece without any break
    stays whole.  Other columns are not looked at.  Counts up to 2^62 and
    products up to 38 digits are exact.
    """
    found = materialise(frequent(docs, text, lang, least, max_words, sample), "frequent")
    best = scored(found).join(covering(found), ["lang", "phrase"], "left")
    stays = F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * cover)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: the first of each of its parts, then the first of these
    part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    first = best.where(stays).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    total = found.where("words = 0").select("lang", F.col("n").alias("n"))
    return (first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top).join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
