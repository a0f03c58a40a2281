"""Cutting a text into chunks that byte-level BPE treats independently of each other.

The pre-token pattern never matches across the border of ``one space + a run
of non-spaces``, nor inside a run of spaces other than before its last
character. Chunks are therefore unions of whole pre-tokens, and results per
chunk can be kept and reused.
"""

from __future__ import annotations

import re

import numpy as np

# The code points with Unicode's White_Space property.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_WORD = re.compile(f"[^{WHITE}]+")

chunks = _CHUNK.findall
words = _WORD.findall

MARKS = ".,;:!?"
_WHITE_LEADS = np.isin(np.arange(256), (0xC2, 0xE1, 0xE2, 0xE3))


def _of(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in characters])


_IS_WHITE, _IS_MARK, _IS_LETTER = _of("\t\n\v\f\r "), _of(MARKS), np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def keeps_letters_whole(pattern: str) -> bool:
    """Whether a chunk of ASCII letters, or of a space and such letters, is always one pre-token, and ``MARKS`` after it begin a new one.

    So it is where the first alternative that can begin with a letter or a space
    takes a whole run of letters; the space matters where chunks have one.
    """
    for part in pattern.split("|"):
        if part in (" ?\\p{L}+", "[\\p{L}]+"):
            return True
        if not part.startswith("'"):
            return False
    return False


def holds_wide_white(data: np.ndarray) -> np.ndarray:
    """Places of UTF-8 bytes where white space beyond ASCII begins."""
    at = np.flatnonzero(_WHITE_LEADS[data])
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    lead, one, two = padded[at], padded[at + 1], padded[at + 2]
    general = (one == 0x80) & ((two <= 0x8A) | np.isin(two, (0xA8, 0xA9, 0xAF))) | (one == 0x81) & (two == 0x9F)
    white = (lead == 0xC2) & np.isin(one, (0x85, 0xA0)) | (lead == 0xE1) & (one == 0x9A) & (two == 0x80)
    return at[white | (lead == 0xE2) & general | (lead == 0xE3) & (one == 0x80) & (two == 0x80)]


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Which UTF-8 bytes belong to a letter below U+0250."""
    letter = _IS_LETTER[data]
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    lead, one = data[at], np.append(data, np.uint8(0))[at + 1]
    at = at[(lead != 0xC9) & ((lead != 0xC3) | (one != 0x97) & (one != 0xB7)) | (lead == 0xC9) & (one < 0x90)]  # not the signs of multiplication and division
    letter[at] = letter[np.minimum(at + 1, len(data) - 1)] = True
    return letter


def chunk_starts(data: np.ndarray, begins: np.ndarray, cut_marks: bool) -> np.ndarray:
    """Where the chunks of texts begin whose UTF-8 bytes lie one after the other, each text from one of ``begins``; white space is ASCII.

    ``cut_marks``: also before a mark that ends the chunk's first letters (below U+0250), which is where a pre-token ends.
    """
    white, first = _IS_WHITE[data], np.zeros(len(data), bool)
    first[begins] = True
    start = first.copy()
    start[1:] |= white[1:] & ~white[:-1]
    start[:-1] |= white[:-1] & ~white[1:] & ~first[1:]  # a run's last character goes with what follows
    start[1:] |= ~white[1:] & white[:-1] & (data[:-1] != 32)
    starts = np.flatnonzero(start)
    if not cut_marks or not len(data):
        return starts
    letter = latin_letters(data)
    marks = np.flatnonzero(_IS_MARK[data[1:]] & letter[:-1] & ~start[1:]) + 1
    others = np.flatnonzero(~letter)  # one is the mark itself
    of = starts[np.searchsorted(starts, marks, "right") - 1]
    of += data[of] == 32
    marks = marks[others[np.searchsorted(others, of)] == marks]
    start[marks] = True
    return np.flatnonzero(start)
