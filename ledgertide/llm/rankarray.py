"""BPE with word ends, encoding and decoding (operator 12).

A word is held as two contiguous arrays: its parts, whose places are the
boundaries between them, and at each boundary the rank of the merge of the two
parts beside it. The smallest rank is looked for by a scan, leftmost on ties;
its merge deletes that boundary, and only the ranks at the two boundaries next
to it are looked up again. A scan costs next to nothing
while the array is short, which nearly every word is. A word of more than
``SHORT`` parts keeps its parts linked and its ranks in a heap, because scans
of a word of any length would cost its square; both give the same tokens.

Ranks belong to pairs of parts, not to their joined string: this kind of
vocabulary has one way to make each token. Texts are normalised and split into
words as the tokenizer's file says. Up to U+024F this is done here; beyond,
the tokenizer's own normaliser and splitter are asked, whose Unicode version
may differ from Python's.

Encoding and decoding are one map over rows: no shuffle, and no state but memos
of bounded size.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .chunks import words
from .common import Memo, droppable, map_batches, positional
from .library import byte_symbols

DEFAULT_TOKENIZER = "word_bpe_49k.json"
SHORT = 256
WORD_ENTRIES, CHUNK_ENTRIES, KEY_CHARS = 200_000, 300_000, 48
SLICE_ROWS = 256
NONE, GONE = 1 << 62, 1 << 31

_LATIN = re.compile("[^\\x00-ɏ]")
_PLAIN = re.compile("[^\\x00-įı-ɏ]")  # U+0130 in lower case is two characters

Ranks = dict[int, int]  # by left id << 32 | right id


def merge_short(parts: list[int], ranks: Ranks, made: list[int]) -> list[int]:
    """Ids after all merges of one word, given and changed as the ids of its symbols; ``made[rank]`` is a merge's result.

    ``near[i]`` is the rank at the boundary between ``parts[i]`` and its right neighbour.
    """
    rank_of = ranks.get
    near = [rank_of(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
    while near and (low := min(near)) != NONE:
        i = near.index(low)
        parts[i] = part = made[low]
        del near[i], parts[i + 1]
        if i:
            near[i - 1] = rank_of(parts[i - 1] << 32 | part, NONE)
        if i < len(near):
            near[i] = rank_of(part << 32 | parts[i + 1], NONE)
    return parts


def merge_long(parts: list[int], ranks: Ranks, made: list[int]) -> list[int]:
    """The same for a word of any length, in time n log n."""
    n, rank_of = len(parts), ranks.get
    following, before = [*range(1, n + 1), n], list(range(-1, n))

    def entry(left: int) -> tuple[int, int, int, int] | None:
        if (right := following[left]) >= n:
            return None
        pair = parts[left] << 32 | parts[right]
        rank = rank_of(pair, NONE)
        return None if rank == NONE else (rank, left, right, pair)

    heap = [e for e in map(entry, range(n)) if e]
    heapify(heap)
    while heap:
        rank, left, right, pair = heappop(heap)
        if following[left] != right or parts[left] << 32 | parts[right] != pair:
            continue  # one of the two parts has merged meanwhile
        parts[left], parts[right] = made[rank], GONE
        following[left] = after = following[right]
        before[after], following[right] = left, n
        for part in (before[left], left):
            if part >= 0 and (e := entry(part)):
                heappush(heap, e)
    return [p for p in parts if p != GONE]


class WordCodec:
    """Encoder and decoder for one tokenizer file with word ends."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = vocab = model["vocab"] | added
        self.ranks: Ranks = {}
        self.made = []
        for rank, (left, right) in enumerate(pairs):
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.token = [""] * (max(self.id_of.values()) + 1)
        for token, i in self.id_of.items():
            self.token[i] = token
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))) or "(?!)")
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.symbols = byte_symbols()
        self.word_memo = Memo(self._encode_word, WORD_ENTRIES, KEY_CHARS)
        self.chunk_memo = Memo(self._encode_chunk, CHUNK_ENTRIES, KEY_CHARS)

    def ids(self, symbols: str) -> list[int]:
        """Token ids of one word, given as the characters that stand for its bytes."""
        parts = [self.id_of[c] for c in symbols[:-1]]
        parts.append(self.id_of[symbols[-1] + self.suffix])
        return (merge_short if len(parts) <= SHORT else merge_long)(parts, self.ranks, self.made)

    def _encode_word(self, symbols: str) -> bytes:
        return array("I", self.ids(symbols)).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        """A run without white space: normalising and splitting never look past it."""
        if _LATIN.search(chunk):
            mapped = [word for word, _ in self.split(self.normalise(chunk))]
        else:
            mapped = [w.encode().decode("latin-1").translate(self.symbols) for w in self.pieces(chunk.lower())]
        return b"".join(map(self.word_memo.__getitem__, mapped))

    def _encode_plain(self, text: str) -> bytes:
        if not _PLAIN.search(text):
            text = text.lower()  # as each chunk would be; capitalised words then share an entry
        return b"".join(map(self.chunk_memo.__getitem__, words(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; an added token's string is that token."""
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [self._encode_plain(text[at:found.start()]), array("I", [self.id_of[found[0]]]).tobytes()]
            at = found.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Token strings with one space between, as a file without a decoder asks; ids of no token are left out."""
        numbers = memoryview(ids).cast("I").tolist()
        try:
            return " ".join(map(self.token.__getitem__, numbers))
        except IndexError:
            return " ".join([self.token[i] for i in numbers if i < len(self.token)])


@functools.lru_cache(maxsize=4)
def codec(path: str) -> WordCodec:
    """One per worker process and tokenizer file."""
    return WordCodec(path)


droppable(codec.cache_clear)


def _mapped(df: DataFrame, source: str, tokenizer: str | None, fill: str | bytes | None,
            new: dict[str, tuple[str, pa.DataType, Callable]]) -> DataFrame:
    """``df`` with ``new`` columns (name: type, Arrow type, function of codec and list so far) made from ``source`` in one map."""
    path = tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER)
    names, inner = positional(df)
    at = names.index(source)
    kept = [i for i, n in enumerate(names) if n not in new]
    value = F.col(f"c{at}") if fill is None else F.coalesce(F.col(f"c{at}"), F.lit(fill))
    kinds, makers = [pa_type for _, pa_type, _ in new.values()], [make for *_, make in new.values()]
    added = [f"d{j}" for j in range(len(new))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                column, made = part.column(part.num_columns - 1).to_pylist(), []
                for kind, make in zip(kinds, makers, strict=True):
                    column = [None if x is None else make(code, x) for x in column]  # each from the one before
                    made.append(pa.array(column, kind))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*part.schema.names[:-1], *added])

    schema = ", ".join([f"c{i} {inner.schema[i].dataType.simpleString()}" for i in kept]
                       + [f"{a} {kind}" for a, (kind, *_) in zip(added, new.values(), strict=True)])
    mapped = map_batches(inner.select(*[f"c{i}" for i in kept], value.alias("source")), run, schema)
    return mapped.toDF(*[names[i] for i in kept], *new)


def encode(df: DataFrame, text: str = "text", tokenizer: str | None = None, out: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Add ``out``: each text's token ids as little-endian unsigned 32-bit integers (binary).

    With ``decoded`` also that column: what these ids decode to, made in the
    same pass. A null or empty text has no ids and decodes to the empty string.
    Every row of the input gives one row with all its other columns, whatever
    their names; columns named ``out`` or ``decoded`` are replaced. Repeated
    rows are encoded alike.
    """
    new = {out: ("binary", pa.binary(), lambda code, t: code.encode(t))}
    if decoded:
        new[decoded] = ("string", pa.string(), lambda code, ids: code.decode(ids))
    return _mapped(df, text, tokenizer, "", new)


def decode(df: DataFrame, ids: str = "ids", tokenizer: str | None = None, out: str = "decoded") -> DataFrame:
    """Add ``out``: the text that ``ids`` stands for, special tokens kept (null ids give null)."""
    return _mapped(df, ids, tokenizer, None, {out: ("string", pa.string(), lambda code, x: code.decode(x))})


def op12_rank_array(documents: DataFrame) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    coded = encode(documents.select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
