"""Ids as the public ``tokenizers`` library gives them, with results kept per chunk and per pre-token.

The library's whole-text call repeats normalising, splitting and merging for
every word. Here a text is cut into chunks (``chunks``), a chunk seen before is
one dictionary lookup, and a new pre-token goes to the library's own BPE
model. Whatever could be treated differently by two Unicode versions (letters
beyond Latin) and every text that holds a special token's string is given to
the library whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from .chunks import MARKS, chunk_starts, chunks, holds_wide_white, keeps_letters_whole, latin_letters, words
from .common import Memo, byte_column, droppable

LATIN_END = "ɐ"
CHUNK_ENTRIES, PIECE_ENTRIES = 400_000, 50_000  # words and words with marks need no memo of pieces
UNIT_BYTES = 16 << 20  # of texts that are cut at once
UNITS_BYTES = 64 << 20  # of distinct units kept with their ids
_NOT_PLAIN = re.compile("[^\\x00-\u012f\u0131-\u024f]")  # beyond Latin, or a capital whose lower case is two characters


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes for
    U+0100 onwards in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class LibraryCodec:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.folds = spec["normalizer"] is not None  # composed, lower-cased, white space dropped
        if self.folds:
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.cut = words if self.folds else chunks
        self.whole_letters = keeps_letters_whole(pattern)
        self.symbols = byte_symbols()
        self.model = self.tokenizer.model
        self.piece_memo = Memo(self._encode_piece, PIECE_ENTRIES)
        self.memo = Memo(self._encode_chunk, CHUNK_ENTRIES)
        self.units = self.unit_ids = pa.array([], pa.large_binary())  # distinct ones of past texts, and their ids
        self.special_bytes = [s.encode() for s in self.specials]
        self.letters_plain = self.whole_letters and all(any(not c.isalpha() and c != " " for c in s) for s in self.specials)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, mapped: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        return self._merged(piece.encode().decode("latin-1").translate(self.symbols))

    def _encode_chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            word = chunk.rstrip(MARKS)
            letters = word[1:] if word[:1] == " " else word
            if self.whole_letters and letters.isalpha():
                if len(word) < len(chunk):
                    return self.memo[word] + self.memo[chunk[len(word):]]
                if len(letters) < len(word):
                    return self._merged(self.symbols[32] + letters)  # a letter stands for itself
                return self._merged(letters.lower() if self.folds else letters)
        elif max(chunk) >= LATIN_END:
            return self._whole(chunk)
        if self.folds:
            chunk = unicodedata.normalize("NFC", chunk).lower()
        return b"".join(map(self.piece_memo.__getitem__, self.pieces(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers, without added special tokens."""
        if any(s in text for s in self.specials):
            return self._whole(text)
        if self.folds and not _NOT_PLAIN.search(text):
            text = text.lower()  # as the tokenizer does; capitalised words then share an entry
        return b"".join(map(self.memo.__getitem__, self.cut(text)))

    def _encode_units(self, units: pa.Array) -> pa.Array:
        """Of new units: chunks, their letters or what follows them; or whole texts that can't be cut as bytes.

        Those of letters, the most by far, go to the model with few steps of Python's for each.
        """
        data, ends = byte_column(units)
        plain = np.zeros(len(units), bool)
        if self.letters_plain:
            fine = latin_letters(data)
            fine[ends[:-1]] |= (data[ends[:-1]] == 32) & (np.diff(ends) > 1)
            plain = np.logical_and.reduceat(fine, ends[:-1])
        others = units.filter(pa.array(~plain))
        data, ends = byte_column(units.filter(pa.array(plain)))
        mapped, at = data.tobytes().decode("latin-1").translate(self.symbols), ends.tolist()
        found = [[t.id for t in self.model.tokenize(mapped[i:j])] for i, j in zip(at[:-1], at[1:], strict=True)]
        after = np.cumsum([0, *map(len, found)], dtype=np.int64) * 4
        flat = np.fromiter(itertools.chain.from_iterable(found), "<u4", int(after[-1]) // 4)
        letters = pa.Array.from_buffers(pa.large_binary(), len(found), [None, pa.py_buffer(after), pa.py_buffer(flat)])
        rest = pa.array([self.encode(u.decode()) for u in others.to_pylist()], pa.large_binary())
        order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        return pa.concat_arrays([letters, rest]).take(pa.array(order))

    def _ids_of(self, units: pa.Array) -> pa.Array:
        """Ids of distinct units; what is kept gives way to the latest when it is full."""
        kept = len(self.units)
        place = pc.index_in(units, self.units)
        new = pc.is_null(place)
        fresh = units.filter(new)
        if len(fresh):
            self.units = pa.concat_arrays([self.units, fresh])
            self.unit_ids = pa.concat_arrays([self.unit_ids, self._encode_units(fresh)])
        at = place.fill_null(0).to_numpy().astype(np.int64)
        at[new.to_numpy(zero_copy_only=False)] = np.arange(kept, len(self.units))
        ids = self.unit_ids.take(pa.array(at))
        if self.units.nbytes + self.unit_ids.nbytes > UNITS_BYTES:
            self.units, self.unit_ids = units, ids
        return ids

    def _uncut(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Numbers of the texts, each from one of ``begins``, that hold a special token's string or white space beyond ASCII."""
        found, whole = holds_wide_white(data).tolist(), data.tobytes()
        for special in self.special_bytes:
            at = whole.find(special)
            while at >= 0:
                found.append(at)
                at = whole.find(special, at + 1)
        return np.unique(np.searchsorted(begins, found, "right") - 1)

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """What :meth:`encode` gives for each text of a column without nulls; equal chunks of many texts are looked up once."""
        if self.folds:
            yield from map(self.encode, texts.to_pylist())
            return
        data, ends = byte_column(texts.cast(pa.large_binary()))
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + UNIT_BYTES, "right")) - 1)
            yield from self._encode_rows(data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row])
            row = stop

    def _encode_rows(self, data: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        if not len(data):
            yield from [b""] * (len(ends) - 1)
            return
        full = np.flatnonzero(np.diff(ends))
        begins = ends[full]
        starts = chunk_starts(data, begins, self.whole_letters)
        uncut = self._uncut(data, begins)
        if len(uncut):
            of = np.searchsorted(begins, starts, "right") - 1
            starts = starts[~np.isin(of, uncut) | (starts == begins[of])]
        offsets = np.append(starts, len(data))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        ids, after = byte_column(self._ids_of(units.dictionary).take(units.indices))
        cuts = after[np.searchsorted(starts, ends)]
        ids, cuts = ids.tobytes(), cuts.tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[a:b]


@functools.lru_cache(maxsize=4)
def library_codec(path: str) -> LibraryCodec:
    """One per worker process and tokenizer file."""
    return LibraryCodec(path)


droppable(library_codec.cache_clear)
