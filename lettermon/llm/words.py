"""Words of a text: runs of ASCII digits, letters a-z (A-Z lower-cased) and non-ASCII characters."""

from __future__ import annotations

from collections.abc import Iterator

#: Every ASCII byte that is neither a digit nor a letter becomes a space; bytes of longer characters stay.
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
BLOCK = 1 << 20


def word_blocks(text: bytes | None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, in lists of about ``size`` bytes
    of text each, so that a very long text never becomes one list."""
    if not text:
        return
    plain = text.translate(_TABLE)
    at, end = 0, len(plain)
    while at < end:
        cut = plain.find(b" ", at + size)
        cut = end if cut < 0 else cut
        yield plain[at:cut].split()
        at = cut
