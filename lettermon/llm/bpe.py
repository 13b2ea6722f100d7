"""BPE encoding of long texts by tree concatenation, and decoding.

A long text is halved down to leaves, which are encoded on their own, in
parallel.  Two neighbours are joined by encoding a window of
tokens around the cut anew.  If the new tokens meet the left neighbour's
and the right neighbour's own, at least a margin away from the cut, all
beyond those meeting points stands; else the window grows.  In the end it
holds both sides whole, so every join ends.

Why meeting is enough: a BPE encoding is right exactly if each two
neighbouring tokens are, and every neighbourhood of the result was one in
the encoding of a side or of the window.  The margin is longer than the
longest special token or contraction, the only things that are matched
across neighbourhoods.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices

#: Characters of a leaf at most, and of a text that is encoded as a tree at least.
LEAF, TREE_OVER = 1 << 12, 1 << 15
WINDOW = 8
_SPACE = re.compile(r"[ \t\r\n]+")
_VOCABULARIES: dict[int, dict[int, str]] = {}


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding; one per Python worker.

    Leaves are encoded by two threads unless ``RAYON_NUM_THREADS`` says
    otherwise: Spark's tasks use the cores already.
    """
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _starts_cleanly(ch: str) -> bool:
    """Whether a text may be cut before ``ch``: it never composes with what stands before it."""
    return not unicodedata.category(ch).startswith("M") and not 0x1160 <= ord(ch) <= 0x11FF


class TreeEncoder:
    """Encodes as ``tokenizer`` does.

    Texts over ``over`` characters (``leaf`` at least) become a tree of leaves
    of ``leaf`` characters at most.  If the tokenizer drops spaces, shorter texts are encoded word by
    word, where a word is what stands between spaces and line ends: no rule
    of such a tokenizer reaches across those, so the ids of a text are those
    of its words in order.
    The ids of words are kept, as most words come again: up to ``memory`` of
    them, and as many older ones.
    """

    def __init__(self, tokenizer, leaf: int = LEAF, window: int = WINDOW, memory: int = 250_000, over: int = 0):
        self.tok, self.leaf, self.window, self.memory = tokenizer, max(leaf, 2), window, memory
        self.over = max(over, self.leaf)
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers: a third of a list's memory
        self.older: dict[str, bytes] = {}
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.by_word = not any(c.isspace() for t in special for c in t) and self._drops_spaces()
        self.margin = 1 + max([3, *map(len, special)])  # 3: the longest contraction that a pattern names

    def _drops_spaces(self) -> bool:
        def ids(text):
            return self.tok.encode(text, add_special_tokens=False).ids
        return not ids(" \t\r\n") and ids("a, b\n c") == ids("a,") + ids("b") + ids("c")

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [self._tree(t) if len(t) > self.over else self._words(t) if self.by_word
                else self.tok.encode(t, add_special_tokens=False).ids for t in texts]

    def _words(self, text: str) -> list[int]:
        words = _SPACE.split(text)
        if new := set(words).difference(self.known):
            if len(self.known) + len(new) > self.memory:
                self.older, self.known, new = self.known, {}, set(words)
            seen = {w: self.older[w] for w in new if w in self.older}
            self.known.update(seen)
            unseen = list(new.difference(seen))
            for at in range(0, len(unseen), 500):
                self._learn(unseen[at:at + 500])
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32).tolist()

    def _learn(self, words: list[str]) -> None:
        """Encode words in one go; the characters that tokens stand for tell whose they are."""
        found = self.tok.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, np.int32).tobytes()
        starts = np.fromiter((s for s, _ in found.offsets), np.int64, len(found))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
        self.known.update((w, ids[a:b]) for w, a, b in zip(words, cuts, cuts[1:]))

    def _cuts(self, text: str, lo: int, hi: int) -> list[int]:
        """Where the halves of ``text[lo:hi]`` and of its halves begin."""
        if hi - lo <= self.leaf:
            return []
        middle = (lo + hi) // 2
        cut = next((c for c in range(middle, hi) if _starts_cleanly(text[c])), None)
        if cut is None:
            cut = next((c for c in range(middle - 1, lo, -1) if _starts_cleanly(text[c])), None)
        if cut is None:
            return []  # nothing but marks: the piece stays whole
        return [*self._cuts(text, lo, cut), cut, *self._cuts(text, cut, hi)]

    def _tree(self, text: str) -> list[int]:
        edges = [0, *self._cuts(text, 0, len(text)), len(text)]
        parts = []
        leaves = self.tok.encode_batch([text[a:b] for a, b in zip(edges, edges[1:])], add_special_tokens=False)
        for leaf, a in zip(leaves, edges):
            parts.append((leaf.ids, [(s + a, e + a) for s, e in leaf.offsets]))
        while len(parts) > 1:  # a level of the tree: each two neighbours become one
            up, edges_up = [], [edges[0]]
            for k in range(0, len(parts) - 1, 2):
                up.append(self._join(text, parts[k], parts[k + 1], *edges[k:k + 3]))
                edges_up.append(edges[k + 2])
            if len(parts) % 2:
                up.append(parts[-1])
                edges_up.append(edges[-1])
            parts, edges = up, edges_up
        return parts[0][0]

    def _join(self, text, left, right, begin, cut, end):
        """The tokens of ``text[begin:end]`` from those of both sides of ``cut``:
        ids, and the characters each stands for."""
        (lid, lat), (rid, rat), size = left, right, self.window
        while True:
            whole_left, whole_right = size >= len(lid), size >= len(rid)
            first, last = max(len(lid) - size, 0), min(size, len(rid))
            a = begin if whole_left else lat[first][0]
            b = end if whole_right else rat[last - 1][1]
            if (not whole_left and not (_starts_cleanly(text[a]) and lat[first - 1][1] <= a)
                    or b < end and not _starts_cleanly(text[b])):
                size *= 2
                continue
            new = self.tok.encode(text[a:b], add_special_tokens=False)
            nid, nat = new.ids, [(s + a, e + a) for s, e in new.offsets]
            # the window begins with the left side's own token, off the cut
            meets = whole_left or bool(nid) and nid[0] == lid[first] and nat[0] == lat[first] \
                and lat[first][1] <= cut - self.margin
            tail = (len(nid), len(rid)) if whole_right else self._meet(rid, rat, last, nid, nat, cut)
            if meets and tail:
                m, j = tail
                return lid[:first] + nid[:m] + rid[j:], lat[:first] + nat[:m] + rat[j:]
            size *= 2

    def _meet(self, rid, rat, last, nid, nat, cut):
        """The last place, off the cut and before the window's end, where the
        window and the right side have the same token."""
        place = {(rid[j], rat[j]): j for j in range(last - 1)}
        for m in range(len(nid) - 2, 0, -1):
            j = place.get((nid[m], nat[m]))
            # the tokens before end where it begins: the bytes of a character stay together
            if (j is not None and nat[m][0] >= cut + self.margin and nat[m - 1][1] <= nat[m][0]
                    and (j == 0 or rat[j - 1][1] <= rat[j][0])):
                return m, j
        return None


def decode_batch(tok, batch: list[list[int]]) -> list[str]:
    """``tok.decode(ids, skip_special_tokens=False)`` of each list.  Without a
    decoder that is the tokens joined by spaces."""
    if tok.decoder is not None:
        return tok.decode_batch(batch, skip_special_tokens=False)
    tokens = _vocabulary(tok)
    return [" ".join([tokens[i] for i in ids if i in tokens]) for ids in batch]


def _vocabulary(tok) -> dict[int, str]:
    found = _VOCABULARIES.get(id(tok))
    if found is None:
        found = _VOCABULARIES[id(tok)] = {i: t for t, i in tok.get_vocab(with_added_tokens=True).items()}
    return found


@lru_cache(maxsize=4)
def load_encoder(path: str, leaf: int, over: int) -> TreeEncoder:
    return TreeEncoder(load_tokenizer(path), leaf, over=over)


@lru_cache(maxsize=1)
def _decimals() -> list[str]:
    return list(map(str, range(1 << 18)))


BPE_TYPE = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
_DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def token_ids(text: Column, path: str, leaf: int = LEAF, over: int = TREE_OVER) -> Column:
    """Ids of a text column (null: none) by the tokenizer file at ``path``,
    which every executor has."""
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = load_encoder(path, leaf, over)
        return pa.array([ids for some in slices(texts) for ids in encoder.encode_batch([t or "" for t in some])],
                        pa.list_(pa.int32()))
    return encode(text.cast("string"))


def decoded(ids: Column, path: str) -> Column:
    """Texts of a column of ids, special tokens kept."""
    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        return pa.array(decode_batch(load_tokenizer(path), [r or [] for r in rows.to_pylist()]), pa.string())
    return decode(ids)


def round_trip_digest(text: Column, path: str, leaf: int = LEAF, over: int = TREE_OVER, rows: int = 256) -> Column:
    """Struct of ``n_tokens``, ``ids_sha256`` (decimal ids joined by one
    space) and ``decoded_sha256`` of a text column, ``rows`` texts at a time:
    the ids never leave the task."""
    @F.arrow_udf(BPE_TYPE)
    def digest(texts: pa.Array) -> pa.Array:
        encoder, decimal, out = load_encoder(path, leaf, over), _decimals(), []
        for some in slices(texts, rows):
            batch = encoder.encode_batch([t or "" for t in some])
            for ids, back in zip(batch, decode_batch(encoder.tok, batch)):
                out.append({"n_tokens": len(ids),
                            "ids_sha256": hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest(),
                            "decoded_sha256": hashlib.sha256(back.encode()).hexdigest()})
        return pa.array(out, _DIGEST)
    return digest(text.cast("string"))


def encode_round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                      leaf: int = LEAF, over: int = TREE_OVER) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``.  A null or empty text has no tokens and the digests
    of the empty string; null and repeated ids keep their rows; a very long
    text is encoded whole, in one task; an empty table gives no rows.  Other
    columns are not looked at."""
    return (docs.select(F.col(doc_id).alias("doc_id"), round_trip_digest(F.col(text), path, leaf, over).alias("d"))
            .select("doc_id", "d.*"))
