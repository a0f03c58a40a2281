"""Language-model scoring by context-tree weighting over binary-decomposed bytes (operator 2).

A text is a stream of bytes: its words, each ended by a space, then one end
symbol. A byte is eight binary decisions. Each decision has a context tree over
the bytes before it in the stream, across words (the stream's start is padded
with zero bytes). A node at depth ``d`` holds how often either bit followed
these ``d`` bytes in the training texts.
Its Krichevsky-Trofimov estimate and what its children give are weighted half
and half, recursively, which mixes the estimates of all depths. Scoring walks
from the deepest node a context has up to the root; a context never seen goes by
its longest seen suffix. The code length is minus the sum of the logarithms.

A gram is a byte with its context. Texts share most of their grams, so a block
of documents counts and asks for its distinct grams only.

Spark's part is questions and answers, all packed into binary columns: blocks of
documents ask word shards (by the word's hash) for counts of words and context
shards (by the last three bytes of the context) for chances of grams; answers
travel back. Questions travel once: a context shard keeps its own, as one row,
until the top of the tree is known. Only the nodes above depth three meet in one place: executors sum
those of depth two, by decision, and the driver gets each once, 32 bytes for
each of the decisions that occur after two bytes (at most 255 * 256**2, 535 MB). Shards and blocks grow in number with the input; a hot word or
context is one entry per asker.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, block_count, bounded_batches, frugal, library_on_workers, packed, stored, total_bytes, unpacked, unused_returned
from .langid import remainder
from .wordhash import mixed

DEPTH = 6  # context bytes
SHARED = 3  # context bytes that decide a context's shard; nodes above are merged in one place
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 24 << 20
GROUP_BATCH_BYTES = 4 << 20  # of a group's rows, on their way to the worker
WINDOW = 1 << 20  # bytes of a block whose grams are held at once
WORDS_AT_ONCE = 1 << 16
GRAMS_AT_ONCE = 1 << 18  # of a shard, whose nodes are held at once
FEW = 64  # counts below this have their logarithms in a table
END = b"\n"
LN10 = float(np.log(10))

ASKED = "block int, kind string, shard int, keys binary, counts binary"
TOLD = "block int, kind string, shard int, answer binary, tokens bigint, known bigint"


def table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[f[1]]) for c, f in zip(columns, fields, strict=True)], names=[f[0] for f in fields])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for ``x >= 0.5``: Stirling's series after a shift by eight."""
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    y = x + 8
    series = (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


_FEW_KT = _log_kt(*np.divmod(np.arange(FEW * FEW, dtype=np.float64), FEW))
_FEW_KT[0] = 0.0  # of nothing seen, without the series' error


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    few = np.maximum(zeros, ones) < FEW
    out = _FEW_KT[np.where(few, zeros * FEW + ones, 0).astype(np.int64)]
    out[~few] = _log_kt(zeros[~few], ones[~few])
    return out


def first_of(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[:len(values)])


@dataclass
class Level:
    """Nodes of one depth: sorted keys (decision, context), counts, log of the weighted probability, own weight."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    own: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> Level:
        """Merge rows of equal keys; ``below``: logs of the children's weighted probabilities, none for leaves."""
        if (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys, kind="stable")
            keys, zeros, ones = keys[order], zeros[order], ones[order]
            below = None if below is None else below[order]
        starts = first_of(keys)
        found, zeros, ones = keys[starts], np.add.reduceat(zeros, starts), np.add.reduceat(ones, starts)
        own = log_kt(zeros, ones)
        if below is None:
            return Level(found, zeros, ones, own, np.ones(len(found)))
        under = np.add.reduceat(below, starts)
        weighted = np.logaddexp(own, under) - np.log(2)
        return Level(found, zeros, ones, weighted, np.exp(own - np.log(2) - weighted))

    def parents(self) -> np.ndarray:
        """Keys without the farthest byte; they are sorted too."""
        return self.keys >> np.uint64(8)


def decision(symbol: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k``-th decision's place in the byte's binary tree, and its outcome."""
    return (np.uint64(1 << k) | symbol >> np.uint64(8 - k)), (symbol >> np.uint64(7 - k) & np.uint64(1)).astype(bool)


def node_keys(grams: np.ndarray, depth: int, place: np.ndarray) -> np.ndarray:
    context = grams >> np.uint64(64 - 8 * depth) if depth else np.zeros(len(grams), np.uint64)
    return place << np.uint64(8 * depth) | context


def deep_levels(grams: np.ndarray, counts: np.ndarray, depth: int, ks: Iterable[int] = range(8)) -> list[Level]:
    """Levels ``SHARED … depth`` (as a list by depth, shallowest first), of all decisions or of the ``ks``-th, whose nodes meet no others."""
    return list(levels_up(grams, counts, depth, ks))[::-1]


def levels_up(grams: np.ndarray, counts: np.ndarray, depth: int, ks: Iterable[int]) -> Iterator[Level]:
    """The same levels one by one, deepest first, so that who needs the last holds two at most."""
    symbol, leaves = grams & np.uint64(255), []
    for k in ks:  # keys of later decisions are larger
        place, one = decision(symbol, k)
        leaves.append(Level.of(node_keys(grams, depth, place), np.where(one, 0.0, counts), np.where(one, counts, 0.0), None))
    level = Level(*(np.concatenate([getattr(leaf, f) for leaf in leaves]) for f in ("keys", "zeros", "ones", "weighted", "own")))
    del leaves
    yield level
    for _ in range(depth - SHARED):
        level = Level.of(level.parents(), level.zeros, level.ones, level.weighted)
        yield level


def top_levels(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> list[Level]:
    """Levels ``0 … SHARED - 1`` from what the shards give for depth ``SHARED - 1``."""
    level = Level.of(keys, zeros, ones, below)
    levels = [level]
    for _ in range(SHARED - 1):
        level = Level.of(level.parents(), level.zeros, level.ones, level.weighted)
        levels.append(level)
    return levels[::-1]


def chances(grams: np.ndarray, levels: list[Level], ks: Iterable[int] = range(8)) -> np.ndarray:
    """Natural log of the weighted probability of each gram's last byte, or of its ``ks``-th decisions, given the bytes before it."""
    symbol, total = grams & np.uint64(255), np.zeros(len(grams))
    for k in ks:
        place, one = decision(symbol, k)
        p, known = np.full(len(grams), 0.5), np.zeros(len(grams), bool)
        for depth in range(len(levels) - 1, -1, -1):
            level = levels[depth]
            if not len(level.keys):
                continue
            keys = node_keys(grams, depth, place)
            at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            there = level.keys[at] == keys
            zeros, ones = level.zeros[at], level.ones[at]
            estimate = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1)
            own = np.where(known, level.own[at], 1.0)
            p = np.where(there, own * estimate + (1 - own) * p, p)
            known |= there
        total += np.log(p)
    return total


def chances_by_runs(grams: np.ndarray, counts: np.ndarray, depth: int, top: list[Level], k: int) -> np.ndarray:
    """What :func:`chances` gives for the ``k``-th decisions of sorted distinct ``grams`` whose counts (or none) the tree below ``top`` holds.

    Sorted by decision and context, a node is a run of grams at every depth, so
    that paths are followed by the numbers of runs, not searched for.
    """
    place, one = decision(grams & np.uint64(255), k)
    keys = node_keys(grams, depth, place)
    order = np.argsort(keys, kind="stable")
    keys, ones = keys[order], np.where(one, counts, 0.0)[order]
    level = Level.of(keys, counts[order] - ones, ones, None)
    leaf = np.repeat(np.arange(len(level.keys)), np.diff(first_of(keys), append=len(keys)))
    p, known = np.full((2, len(level.keys)), 0.5), np.zeros(len(level.keys), bool)

    def mix(node: np.ndarray, level: Level, there: np.ndarray) -> None:
        """Weigh what the nodes say against what lies below them; ``node`` of each leaf."""
        n = level.zeros + level.ones
        there, own = there[node], np.where(known, level.own[node], 1.0)
        for bit, times in enumerate((level.zeros, level.ones)):
            p[bit] = np.where(there, own * ((times + 0.5) / (n + 1))[node] + (1 - own) * p[bit], p[bit])
        known[there] = True

    node = np.arange(len(level.keys))
    for d in range(depth, SHARED - 1, -1):
        if d < depth:
            above = level.parents()
            node = np.repeat(np.arange(len(first_of(above))), np.diff(first_of(above), append=len(above)))[node]
            level = Level.of(above, level.zeros, level.ones, level.weighted)
        mix(node, level, level.zeros + level.ones > 0)
    found = level.keys
    for upper in top[::-1]:
        found = found >> np.uint64(8)
        if len(upper.keys):
            at = np.minimum(np.searchsorted(upper.keys, found), len(upper.keys) - 1)
            met = Level(found, *(getattr(upper, f)[at] for f in ("zeros", "ones", "weighted", "own")))
            mix(node, met, upper.keys[at] == found)
    total = np.empty(len(grams))
    total[order] = np.log(np.where(one[order], p[1][leaf], p[0][leaf]))
    return total


def stream_of(text: bytes) -> bytes:
    """The start symbol, then each lower-cased word and a space; the end is added where bytes are coded."""
    words = text.lower().split()
    return b"\0" + b" ".join([*words, b""]) if words else b"\0"


def windows(streams: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(gram, stream)`` of every coded byte in runs of bounded size: its context, nearest byte highest, and the byte itself lowest."""
    gap = bytes(depth - 1)
    data = np.frombuffer(gap + (END + gap).join(streams) + END, np.uint8)
    edges = np.cumsum([0, *(len(s) + depth for s in streams)])  # gap, start, text and end of each stream
    context = np.uint64(2**64 - 2 ** (64 - 8 * depth))
    for at in range(0, len(data), WINDOW):
        stop = min(len(data), at + WINDOW)
        low, high = int(np.searchsorted(edges, at, "right")) - 1, int(np.searchsorted(edges, stop))
        inside = np.diff(np.clip(edges[low:high + 1], at, stop))
        coded = np.ones(stop - at, bool)
        uncoded = (edges[low:high, None] + np.arange(depth)).ravel() - at
        coded[uncoded[(uncoded >= 0) & (uncoded < stop - at)]] = False
        back = np.concatenate([data[max(at - depth, 0):stop][::-1], np.zeros(8 + depth, np.uint8)])
        before = np.ndarray(stop - at, ">u8", back, 1, (1,))  # the eight bytes before each place, nearest first
        grams = before[::-1].astype(np.uint64) & context | data[at:stop]
        yield grams[coded], np.repeat(np.arange(low, high), inside)[coded]


def grams_of(streams: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of few streams as one."""
    grams, stream = zip(*windows(streams, depth), strict=True)
    return np.concatenate(grams), np.concatenate(stream)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    every, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0), *counts])
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    starts = first_of(every)
    return every[starts], np.add.reduceat(n, starts)


def distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, sorted, and how often each occurs; ``grams`` is sorted in place."""
    grams.sort()
    starts = first_of(grams).astype(np.int32 if len(grams) < 2**31 else np.int64)
    return grams[starts], np.diff(starts, append=starts.dtype.type(len(grams))).astype(np.uint32)


def _counted_grams(streams: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of streams, sorted, and how often each occurs; windows gather in one array of bounded size."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    held, at = np.empty(min(sum(map(len, streams)), BLOCK_BYTES + WINDOW), np.uint64), 0
    for grams, _ in windows(streams, depth) if streams else ():
        if at + len(grams) > len(held):
            found = distinct(held[:at])
            keys.append(found[0])
            counts.append(found[1])
            at = 0
        held[at:at + len(grams)] = grams
        at += len(grams)
    found = distinct(held[:at])
    if len(keys) == 1:
        return found
    del held
    return merged([*keys, found[0]], [*counts, found[1]])


def with_uncounted(grams: np.ndarray, counts: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sorted lists of distinct grams as one; those that occur among ``others`` only have no count."""
    at = np.searchsorted(grams, others)
    new = np.append(grams, np.uint64(0))[at] != others
    new |= at == len(grams)
    at, others = at[new], others[new]
    return np.insert(grams, at, others), np.insert(counts, at, 0)


def word_shard(word: bytes, shards: int) -> int:
    return zlib.crc32(word) % shards


def words_of(text: bytes) -> list[bytes]:
    """The lower-cased words and last the end, an empty word."""
    return [*text.lower().split(), b""]


def _dealt(texts: list[bytes], shards: int) -> tuple[list[bytes], list[tuple[int, slice]], np.ndarray, np.ndarray]:
    """Distinct words by shard and in order, each shard's part of them, the number of every word of the texts among them, and words per text."""
    per_text, run, runs = np.zeros(len(texts), np.int64), [], []
    for i, text in enumerate(texts):  # few words at once are held as Python's own objects
        run += words_of(text)
        per_text[i] = len(run) + sum(map(len, runs))
        if len(run) >= WORDS_AT_ONCE or i == len(texts) - 1:
            runs.append(pa.array(run, pa.large_binary()))
            run = []
    per_text = np.diff(per_text, prepend=0)
    coded = pa.concat_arrays(runs).dictionary_encode()
    del runs
    order = pc.sort_indices(coded.dictionary).to_numpy()
    words = coded.dictionary.take(pa.array(order)).to_pylist()
    shard = np.fromiter((word_shard(w, shards) for w in words), np.int64, len(words))
    by_shard = np.argsort(shard, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order[by_shard]] = np.arange(len(words))
    cuts = [*first_of(shard[by_shard]).tolist(), len(words)]
    parts = [(int(shard[by_shard[a]]), slice(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [words[i] for i in by_shard.tolist()], parts, number[coded.indices.to_numpy()], per_text


def _by_context(grams: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of distinct sorted grams by context shard, and each shard's part of it."""
    starts = first_of(grams >> np.uint64(64 - 8 * SHARED))  # grams of one context lie together and go together
    shard = (mixed(grams[starts] >> np.uint64(64 - 8 * SHARED)) % np.uint64(shards)).astype(np.int64)
    by_shard = np.argsort(shard, kind="stable")
    shard, lengths = shard[by_shard], np.diff(starts, append=len(grams))[by_shard]
    begins = np.cumsum(lengths) - lengths
    kind = np.int32 if len(grams) < 2**31 else np.int64
    order = np.repeat((starts[by_shard] - begins).astype(kind), lengths)
    order += np.arange(len(grams), dtype=kind)
    first = first_of(shard)
    cuts = [*begins[first].tolist(), len(grams)]
    return order, [(int(n), slice(a, b)) for n, a, b in zip(shard[first], cuts[:-1], cuts[1:], strict=True)]


def ask(shards: int, depth: int):
    """A block's distinct words and grams with their counts in training texts."""
    def run(docs: pa.Table) -> pa.Table:
        texts, used = docs["__text"].to_pylist(), docs["__train"].to_pylist()
        name = docs["__block"][0].as_py()
        words, parts, number, per_text = _dealt(texts, shards)
        times = np.bincount(number[np.repeat(np.array(used, bool), per_text)], minlength=len(words)).astype("<u4")
        rows = [(name, "word", shard, b"\n".join(words[part]), packed(times[part])) for shard, part in parts]
        del words, number, times
        unused_returned()
        grams, counts = _counted_grams([stream_of(t) for t, train in zip(texts, used, strict=True) if train], depth)
        other = _counted_grams([stream_of(t) for t, train in zip(texts, used, strict=True) if not train], depth)[0]
        grams, counts = with_uncounted(grams, counts, other)
        del other
        order, parts = _by_context(grams, shards)
        rows += [(name, "gram", shard, packed(grams[order[part]]), packed(counts[order[part]].astype("<u4"))) for shard, part in parts]
        del grams, counts, order
        return table(ASKED, rows)

    return run


def tell_words(asked: pa.Table) -> pa.Table:
    """Each block's training counts of its words, and once a shard's tokens and known words."""
    lists, counts = [], Counter()
    for row in asked.sort_by("block").to_pylist():
        words = row["keys"].split(b"\n")
        lists.append((row["block"], words))
        for word, n in zip(words, unpacked(row["counts"], "<u4").tolist(), strict=True):
            counts[word] += n
    tokens, known, name = sum(counts.values()), sum(n > 0 for n in counts.values()), asked["shard"][0].as_py()
    return table(TOLD, [
        (block, "word", name, packed(np.array([counts[w] for w in words], "<u8")), tokens * (not i), known * (not i))
        for i, (block, words) in enumerate(lists)])


def _lists(asked: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each block's sorted grams and their counts, one block at a time."""
    blocks, keys, counts = asked["block"].to_pylist(), asked["keys"], asked["counts"]
    for i in sorted(range(len(blocks)), key=blocks.__getitem__):
        yield blocks[i], unpacked(keys[i].as_buffer(), "<u8"), unpacked(counts[i].as_buffer(), "<u4")


def _counted(lists: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[list[slice], np.ndarray, np.ndarray]]:
    """All distinct grams of the lists, sorted, and their counts: range by range of contexts, with the place of each list's grams.

    A range takes about ``GRAMS_AT_ONCE`` grams of all lists; no context of ``SHARED`` bytes lies in two.
    """
    longest = max((grams for grams, _ in lists), key=len)
    every = max(1, GRAMS_AT_ONCE * len(longest) // max(1, sum(len(grams) for grams, _ in lists)))
    low = np.uint64(64 - 8 * SHARED)
    bounds = np.unique(longest[every::every] >> low << low)
    cuts = [[0, *np.searchsorted(grams, bounds).tolist(), len(grams)] for grams, _ in lists]
    for i in range(len(bounds) + 1):
        spans = [slice(c[i], c[i + 1]) for c in cuts]
        found = merged([grams[s] for (grams, _), s in zip(lists, spans, strict=True)],
                       [times[s].astype(np.float64) for (_, times), s in zip(lists, spans, strict=True)])
        yield spans, *found


def context_slices(grams: np.ndarray, least: int | None = None) -> Iterator[slice]:
    """Parts of sorted grams, of ``least`` and hardly more, none of which shares a context of ``SHARED`` bytes with another.

    So the nodes below the top of one part meet no others.
    """
    starts, at = first_of(grams >> np.uint64(64 - 8 * SHARED)), 0
    while at < len(grams):
        i = int(np.searchsorted(starts, at + (least or GRAMS_AT_ONCE)))
        stop = int(starts[i]) if i < len(starts) else len(grams)
        yield slice(at, stop)
        at = stop


TOP = "k int, keys binary, zeros binary, ones binary, below binary"


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, sorted, and the sums of each one's values."""
    order = np.argsort(keys, kind="stable")
    starts = first_of(keys[order])
    return [keys[order][starts], *(np.add.reduceat(v[order], starts) for v in values)]


def to_the_top(depth: int):
    """A context shard's share in the nodes of depth ``SHARED - 1``."""
    def run(asked: pa.Table) -> pa.Table:
        shares: list[list[list[np.ndarray]]] = [[] for _ in range(8)]
        for _, every, times in _counted([(grams, n) for _, grams, n in _lists(asked)]):
            grams, counts = every[times > 0], times[times > 0]
            for part in context_slices(grams):
                for k in range(8):  # one at a time, for memory
                    for level in levels_up(grams[part], counts[part], depth, [k]):
                        pass  # only the last, the shallowest
                    shares[k].append(_summed(level.parents(), level.zeros, level.ones, level.weighted))
        rows = []
        for k, parts in enumerate(shares):
            keys, *values = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else [np.zeros(0, np.uint64), *[np.zeros(0)] * 3]
            rows.append((k, *(a.tobytes() for a in _summed(keys, *values))))
        return table(TOP, rows)

    return run


def joined(parts: pa.Table) -> list[np.ndarray]:
    """Keys, zeros, ones and sums of the parts, one after the other."""
    kinds = {"keys": np.uint64, "zeros": np.float64, "ones": np.float64, "below": np.float64}
    return [np.concatenate([np.zeros(0, kind), *(np.frombuffer(b, kind) for b in parts[name].to_pylist())]) for name, kind in kinds.items()]


def meet_at_the_top(parts: pa.Table) -> pa.Table:
    """The shards' shares in the nodes of a decision, each node once."""
    return table(TOP, [(parts["k"][0].as_py(), *(a.tobytes() for a in _summed(*joined(parts))))])


def tell_chances(depth: int, top):
    def run(asked: pa.Table) -> pa.Table:
        lists, name = list(_lists(asked)), asked["shard"][0].as_py()
        answers = [np.empty(len(grams)) for _, grams, _ in lists]
        for spans, every, counts in _counted([(grams, times) for _, grams, times in lists]):
            found = np.zeros(len(every))
            for part in context_slices(every):
                for k in range(8):  # one at a time, for memory
                    found[part] += chances_by_runs(every[part], counts[part], depth, top.value, k)
            for answer, span, (_, grams, _) in zip(answers, spans, lists, strict=True):
                answer[span] = found[np.searchsorted(every, grams[span])]
        rows = []
        for i, (block, _, _) in enumerate(lists):
            rows.append((block, "gram", name, packed(answers[i]), 0, 0))
            lists[i] = answers[i] = None
        return table(TOLD, rows)

    return run


#: A context shard's share in the top, and, as one row, all that it was asked.
SETTLED = f"shard int, {TOP}, asked array<struct<block: int, keys: binary, counts: binary>>"


def settle(depth: int):
    """A context shard's share in the top, and its questions as they are, for :func:`tell_settled`."""
    share = to_the_top(depth)
    lists = pa.list_(pa.struct([("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))
    columns = pa.schema([("shard", pa.int32()), *table(TOP, []).schema, ("asked", lists)])

    def run(asked: pa.Table) -> pa.Table:
        top, name = share(asked), asked["shard"][0].as_py()
        rows = pa.StructArray.from_arrays([asked[f.name].combine_chunks().cast(f.type) for f in lists.value_type], fields=list(lists.value_type))
        whole = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows, type=lists)
        top = [pa.array([name] * len(top), pa.int32()), *top.columns, pa.nulls(len(top), lists)]
        own = [pa.array([name], pa.int32()), *(pa.nulls(1, f.type) for f in list(columns)[1:-1]), whole]
        return pa.concat_tables([pa.table(top, schema=columns), pa.table(own, schema=columns)])

    return run


def tell_settled(depth: int, top):
    """What :func:`tell_chances` gives for each context shard's row of :func:`settle`."""
    tell = frugal(tell_chances(depth, top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                rows = batch.column("asked")[i].values
                same = pa.array([shard] * len(rows), pa.int32())
                yield from tell(pa.table({"shard": same, **{c: rows.field(c) for c in ("block", "keys", "counts")}})).to_batches()

    return run


RESULT = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _base_scores(texts: list[bytes], shards: int, tokens: int, known: int, answers: dict[int, pa.Buffer]) -> list[tuple[int, int, float]]:
    """Words, known words and smoothed unigram score of texts from the answers of the word shards."""
    words, parts, number, per_text = _dealt(texts, shards)
    count = np.empty(len(words), np.int64)
    for shard, part in parts:
        count[part] = unpacked(answers[shard], "<u8")
    first = np.cumsum(per_text) - per_text
    score = np.add.reduceat(np.log10((count + 0.5) / (tokens + 0.5 * (known + 1)))[number], first)
    seen = np.add.reduceat((count > 0).astype(np.int64)[number], first)
    return list(zip(per_text.tolist(), seen.tolist(), score.tolist(), strict=True))


def _gram_scores(texts: list[bytes], shards: int, depth: int, answers: dict[int, pa.Buffer]) -> np.ndarray:
    """Log10 probabilities of texts from the answers of the context shards."""
    found, kind = [], np.uint16 if len(texts) <= 2**16 else np.int32
    for grams, stream in windows([stream_of(t) for t in texts], depth):
        order = np.argsort(grams)
        grams = grams[order]
        starts = first_of(grams)
        found.append([grams[starts], np.diff(starts, append=len(grams)).astype(np.int32), stream.astype(kind)[order]])
        del grams, stream, order, starts
    every = np.concatenate([g for g, _, _ in found])
    every.sort()
    every = every[np.concatenate([[True], every[1:] != every[:-1]])]
    for one in found:  # places take half the room of grams
        one[0] = np.searchsorted(every, one[0]).astype(np.int32 if len(every) < 2**31 else np.int64)
    order, parts = _by_context(every, shards)
    chance = np.empty(len(every))
    del every
    for shard, part in parts:
        chance[order[part]] = unpacked(answers[shard], "<f8")
    scores = np.zeros(len(texts))
    for places, times, stream in found:
        scores += np.bincount(stream, np.repeat(chance[places], times), len(texts))
    return scores / LN10


def _scored(shards: int, depth: int, tokens: int, known: int, kept: list[str]):
    """Columns ``kept`` of a block's documents and their scores."""
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        texts = docs["__text"].to_pylist()
        answers: dict[str, dict[int, pa.Buffer]] = {"word": {}, "gram": {}}
        for kind, shard, answer in zip(told["kind"].to_pylist(), told["shard"].to_pylist(), told["answer"], strict=True):
            answers[kind][shard] = answer.as_buffer()
        bases = _base_scores(texts, shards, tokens, known, answers.pop("word"))
        unused_returned()
        scores = _gram_scores(texts, shards, depth, answers.pop("gram")).tolist()
        out = [(n, seen, tokens, base, score) for (n, seen, base), score in zip(bases, scores, strict=True)]
        result = table(RESULT, out)
        return pa.table([*(docs[c] for c in kept), *result.columns], names=[*kept, *result.column_names])

    return run


def score_texts(df: DataFrame, train: Column, text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities).

    Learns from the rows for which ``train`` holds (null: it does not). Tokens
    are the words of the text with A-Z lower-cased and one end; a null text
    counts as empty and is one end. ``base_score`` is the smoothed unigram
    score, ``score`` the context-tree score. Repeated rows count as often as
    they occur and score alike; without training rows every bit has
    probability one half. Columns of these names are replaced, others stay.
    """
    new = [f.split()[0] for f in RESULT.split(", ")]
    kept = [c for c in df.columns if c not in new]
    size = total_bytes(df, text)
    blocks, shards = block_count(size, block_bytes), block_count(size, shard_bytes)
    library_on_workers(df.sparkSession)
    bounded_batches(df.sparkSession, nbytes=GROUP_BATCH_BYTES)
    spread = [f"`{c}`" for c in kept if "map<" not in df.schema[c].dataType.simpleString()]  # copies of a text go to many blocks
    docs = (
        df.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(train, F.lit(False)).alias("__train"), as_bytes(text).alias("__text"))
        .withColumn("__block", F.pmod(F.xxhash64("__text", *spread), F.lit(blocks)).cast("int"))
    )
    asked = docs.select("__text", "__train", "__block").groupBy("__block").applyInArrow(frugal(ask(shards, depth)), ASKED)
    asked = asked.persist(StorageLevel.DISK_ONLY)  # until all questions are with their shards
    counts = stored(asked.where("kind = 'word'").groupBy("shard").applyInArrow(frugal(tell_words), TOLD), "counts")
    settled = stored(asked.where("kind = 'gram'").groupBy("shard").applyInArrow(frugal(settle(depth)), SETTLED), "settled")
    asked.unpersist()
    sums = counts.agg(F.sum("tokens"), F.sum("known")).first()
    tokens, known = int(sums[0] or 0), int(sums[1] or 0)
    some = F.pmod("shard", F.lit(math.isqrt(shards) + 1))  # what shards share in the top meets in two steps, so that no task reads it all
    shares = settled.where("asked IS NULL").groupBy("k", some).applyInArrow(frugal(meet_at_the_top), TOP)
    met = shares.groupBy("k").applyInArrow(frugal(meet_at_the_top), TOP).toArrow()
    top = df.sparkSession.sparkContext.broadcast(top_levels(*joined(met)))
    told = counts.unionByName(settled.where("asked IS NOT NULL").select("shard", "asked").mapInArrow(tell_settled(depth, top), TOLD))
    # the text goes along once, as bytes; its own column tells where it is null
    whole = docs.select("__block", "__text", *[F.col(f"`{c}`").isNull().alias(c) if c == text else F.col(f"`{c}`") for c in kept])
    own = [f"`{c}` {'boolean' if c == text else df.schema[c].dataType.simpleString()}" for c in kept]
    fields = ", ".join(["__text binary", *own, RESULT])
    by_block = whole.groupBy("__block").cogroup(told.groupBy("block"))
    scored = by_block.applyInArrow(frugal(_scored(shards, depth, tokens, known, ["__text", *kept])), fields)
    back = [F.when(~F.col(f"`{c}`"), F.col("__text").cast(df.schema[c].dataType)).alias(c) if c == text else F.col(f"`{c}`") for c in kept]
    return scored.select(*back, *new)


def op2_context_tree(documents: DataFrame) -> DataFrame:
    """Scores of all documents; a fifth is held out."""
    rest = remainder("doc_id", 5)
    docs = documents.select("doc_id", "text", (rest == 1).alias("held_out"))
    return score_texts(docs, ~F.col("held_out")).drop("text")
