"""Splitting text before the merges of a byte-level vocabulary, for a whole batch at once.

The split is the usual one of byte-level vocabularies: contractions, runs of letters, of
digits or of other signs, each with one leading blank, and runs of white space without
the blank that the next piece takes. It is expressed on arrays of character classes.
"""

from __future__ import annotations

import numpy as np
import regex

from tidegate.llm.textkit import Texts

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
_CLASSES = ((regex.compile(r"\p{L}"), LETTER), (regex.compile(r"\p{N}"), DIGIT), (regex.compile(r"\s"), SPACE))
#: The contractions that are pieces of their own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def char_class(char: str) -> int:
    return next((kind for pattern, kind in _CLASSES if pattern.match(char)), OTHER)


_ASCII = np.array([char_class(chr(i)) for i in range(128)], np.uint8)


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place and code point of every character of a UTF-8 buffer."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    first = buf[lead].astype(np.int32)
    points = first.copy()
    for low, high, extra, bits in ((0xC0, 0xE0, 1, 0x1F), (0xE0, 0xF0, 2, 0x0F), (0xF0, 0xF8, 3, 0x07)):
        which = np.flatnonzero((first >= low) & (first < high))
        value = first[which] & bits
        for k in range(1, extra + 1):
            value = (value << 6) | (buf[lead[which] + k] & 0x3F)
        points[which] = value
    return lead, points


def classes(points: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.uint8)
    ascii_ = points < 128
    out[ascii_] = _ASCII[points[ascii_]]
    wide = np.flatnonzero(~ascii_)
    if len(wide):
        low = int(points[wide].min())
        seen = np.zeros(int(points[wide].max()) - low + 1, bool)
        seen[points[wide] - low] = True
        table = np.zeros(len(seen), np.uint8)
        for p in np.flatnonzero(seen):
            table[p] = char_class(chr(low + int(p)))
        out[wide] = table[points[wide] - low]
    return out


#: Classes of bytes: those of ASCII characters; others get their character's.
_BYTES = np.concatenate((_ASCII, np.full(128, OTHER, np.uint8)))


def _byte_classes(buf: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of a UTF-8 buffer is of."""
    kind = _BYTES[buf]
    wide = np.flatnonzero(buf >= 0x80)
    if len(wide):
        lead, points = code_points(np.append(buf[wide], np.zeros(3, np.uint8)))  # a text may end within a character
        lead = lead[:-2]
        kind[wide[lead[0] :]] = np.repeat(classes(points[:-3]), np.diff(lead))
    return kind


def piece_starts(texts: Texts) -> np.ndarray:
    """Byte places at which a piece starts; a text's end ends its last piece."""
    buf, n = texts.buf, len(texts.buf)
    if not n:
        return np.zeros(0, np.int64)
    kind = _byte_classes(buf)
    opens = np.zeros(n + 1, bool)  # a text starts here
    opens[texts.start] = True
    opens[n] = True
    change = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change[1:n] |= opens[1:n]
    start = change[:n].copy()
    solid = kind != SPACE
    # a piece takes one blank before it
    head = np.flatnonzero(start & solid & ~opens[:n])
    joined = head[buf[head - 1] == 0x20]
    start[joined] = False
    start[joined - 1] = True
    # the last white space before a solid character is no part of the run before it
    run_end = np.flatnonzero(~solid & change[1:] & ~opens[1:])
    for _ in range(3):  # to its first byte
        run_end = run_end - ((buf[run_end] & 0xC0) == 0x80)
    start[run_end] = True
    # contractions: a lone apostrophe that no blank precedes, and the letters after it
    quote = np.flatnonzero(buf == 0x27)
    quote = quote[start[quote] & change[quote]]
    for suffix in CONTRACTIONS:
        here = quote[quote + len(suffix) < n]
        for k, letter in enumerate(suffix, 1):
            here = here[(buf[here + k] == ord(letter)) & ~opens[here + k]]
        start[here + 1] = False
        after = here + 1 + len(suffix)
        start[after[after < n]] = True
    return np.flatnonzero(start)
