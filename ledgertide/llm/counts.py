"""Token counts at every prefix by dynamic programming (operator 7).

For a pre-token, ``count[i]`` is the exact number of BPE tokens of its first
``i`` bytes. The encoding of a prefix ends in exactly one token ``t`` that may
follow the last token ``s`` of the prefix before it; ``t`` may follow ``s`` when
merging their joined bytes gives back just these two. So ``count[i] =
count[i - len(t)] + 1``, each position looks only at earlier ones, and no prefix
is encoded twice. Which pairs may stand together is kept in a table. A table is
filled on demand: the count of a whole pre-token asks only for the prefixes its
recurrence reaches, a budget that runs out inside it asks for the others.

A text's count is the sum over its pre-tokens, and how much of a text fits a
token budget is read off the same tables.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import merge_bytes
from .chunks import chunks
from .common import Memo, carried, carried_and, droppable, map_batches, released, text_or_empty
from .library import byte_symbols

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
PAIR_ENTRIES = 1_500_000


class PrefixCounter:
    """Counts for one byte-level tokenizer file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        byte_of = {ord(c): b for b, c in byte_symbols().items()}

        def raw(token: str) -> bytes:
            return token.translate(byte_of).encode("latin-1")

        singles = sorted(raw(t) for t in spec["model"]["vocab"] if len(t) == 1)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {b: i for i, b in enumerate(singles)}
        for left, right in pairs:
            self.rank.setdefault(raw(left) + raw(right), len(self.rank))
        self.longest = max(map(len, self.rank))
        self.token = list(self.rank)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or "(?!)")
        self.pieces = regex.compile(pattern).findall
        self.follows = Memo(self._follows, PAIR_ENTRIES, 2)
        self.piece_memo = Memo(lambda piece: self.piece_count(piece.encode()))
        self.memo = Memo(lambda chunk: sum(map(self.piece_memo.__getitem__, self.pieces(chunk))))

    def _follows(self, pair: tuple[int, int]) -> bool:
        left, right = pair
        return merge_bytes(self.token[left] + self.token[right], self.rank) == [left, right]

    def _fill(self, piece: bytes, stop: int, last: list[int | None], count: list[int]) -> None:
        """Enter the last token and the count of the first ``stop`` bytes, and of the shorter prefixes these rest on."""
        rank_of, follows, longest = self.rank.get, self.follows, self.longest
        tried: dict[int, int] = {}  # where the search for a prefix's last token goes on
        asked = [stop]
        while asked:
            stop = asked[-1]
            start = tried.get(stop) or max(0, stop - longest)
            while True:
                token = rank_of(piece[start:stop])
                if token is not None:
                    if start and last[start] is None:
                        tried[stop] = start
                        asked.append(start)
                        break
                    if not start or follows[last[start], token]:
                        last[stop], count[stop] = token, count[start] + 1
                        asked.pop()
                        break
                start += 1

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of the first ``0, 1, … len`` bytes of one pre-token."""
        last, count = [None] * (len(piece) + 1), [0] * (len(piece) + 1)
        for stop in range(1, len(piece) + 1):
            if last[stop] is None:
                self._fill(piece, stop, last, count)
        return count

    def piece_count(self, piece: bytes) -> int:
        """Tokens of one pre-token."""
        last, count = [None] * (len(piece) + 1), [0] * (len(piece) + 1)
        self._fill(piece, len(piece), last, count)
        return count[-1]

    def count(self, text: str) -> int:
        """Tokens of a whole text; the string of a special token is one token."""
        if any(s in text for s in self.specials):
            return sum(sum(map(self.memo.__getitem__, chunks(part))) for part in self.special.split(text)) \
                + len(self.special.findall(text))
        return sum(map(self.memo.__getitem__, chunks(text)))

    def count_and_fit(self, text: str, limit: int) -> tuple[int, int]:
        """``count`` and ``fit`` of a text, its chunks looked up once."""
        if any(s in text for s in self.specials):
            n = self.count(text)
            return n, len(text) if n <= limit else self.fit(text, limit)
        parts = chunks(text)
        sizes = list(map(self.memo.__getitem__, parts))
        n = sum(sizes)
        return n, len(text) if n <= limit else self._cut(parts, sizes, limit)

    def fit(self, text: str, limit: int) -> int:
        """Characters of a prefix within ``limit`` tokens; a special token's string is kept or left out whole."""
        at, left = 0, limit
        for part in self.special.splititer(text):
            if (n := self.count(part)) > left:
                return at + self.fitting(part, left)
            at, left = at + len(part), left - n
            if (special := self.special.match(text, at)) and special.end() > at:
                if not left:
                    return at
                at, left = special.end(), left - 1
        return at

    def fitting(self, text: str, limit: int) -> int:
        """Characters of a longest prefix within ``limit`` tokens, for a text without special strings that has more.

        It ends inside the pre-token in which the budget runs out, where that
        pre-token's table allows, and never after a lone leading space or inside
        a contraction, because such a tail would be split differently.
        """
        parts = chunks(text)
        return self._cut(parts, map(self.memo.__getitem__, parts), limit)

    def _cut(self, parts: list[str], sizes: Iterable[int], limit: int) -> int:
        used = 0
        for over, n in enumerate(sizes):
            if used + n > limit:
                break
            used += n
        at = sum(map(len, parts[:over]))
        for piece in self.pieces(parts[over]):
            inside = self.prefix_counts(piece.encode())
            if used + inside[-1] <= limit:
                at, used = at + len(piece), used + inside[-1]
                continue
            if piece[0] != "'":
                ends = accumulate((len(c.encode()) for c in piece), initial=0)
                lone = 1 if piece[0] == " " and not piece.isspace() else 0
                at += max((i for i, e in enumerate(ends) if i != lone and used + inside[e] <= limit), default=0)
            break
        return at


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One per worker process and tokenizer file."""
    return PrefixCounter(path)


droppable(counter.cache_clear)


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars`` to every row.

    ``fit_chars`` tells how many leading characters stay within ``limit``
    tokens, cut inside a pre-token by its prefix table. A null text counts as
    empty: no bytes, no tokens. Existing columns of these names are replaced;
    repeated rows are counted alike.
    """
    path = tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER)
    new = ("n_bytes", "n_tokens", "over_limit", "fit_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            both = [counts.count_and_fit(t, limit) for t in texts]
            n, fit = [b[0] for b in both], [b[1] for b in both]
            columns = [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                       pa.array([k > limit for k in n], pa.bool_()), pa.array(fit, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *new])

    names, texts = carried(df, text=text)
    prepared = texts.select("carried", text_or_empty("text").alias("__text"))
    fields = carried_and(prepared, "n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint")
    return released(map_batches(prepared, run, fields), names, new)


def op7_prefix_counts(documents: DataFrame) -> DataFrame:
    """Exact token counts of every document."""
    return count_tokens(documents.select("doc_id", "text")).drop("text")
