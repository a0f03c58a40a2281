"""Language identification (operator 4).

Byte n-grams of the letters (two to four bytes, words kept apart by a space)
are hashed to rows of an embedding table. A text is the average of its rows, a
linear softmax gives the languages. Both are trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows; a part of the sample that
is not trained on sets the softmax's temperature and the score below which a
text is rejected.

Because average and layer are linear, table and layer fold into one score per
n-gram and language for prediction; that table is broadcast, its size is fixed
by the parameters. Prediction is a map over rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, byte_column, carried_and, carried_once, map_batches, packed, released, unpacked, unused_returned

UNKNOWN = "und"
HASH_BITS = 17
ORDERS = (2, 3, 4)
DIMENSIONS = 12
SAMPLE_PER_LANGUAGE = 400  # bounds of the training sample
SAMPLE_TOTAL = 4000
EPOCHS = 12
RATE = 0.5
REJECTED_SHARE = 0.0005  # of calibration texts, whose score above chance sets the threshold
SLICE_BYTES = 1 << 20

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)  # odd multipliers


def features(folded: np.ndarray, order: int) -> np.ndarray:
    """Table rows of the n-grams that start at each byte."""
    n = len(folded) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order * 0x51ED270B & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h += folded[k:k + n]
        h *= _MIX[k]
        h ^= h >> np.uint32(15)
    h *= _MIX[0]
    return (h >> np.uint32(32 - HASH_BITS)).astype(np.int64) + (ORDERS.index(order) << HASH_BITS)


def slices(text: np.ndarray) -> Iterator[np.ndarray]:
    """A folded text in slices that overlap so far that no n-gram is lost or repeated (for the longest order)."""
    folded = _FOLD[text]
    for start in range(0, max(1, len(folded)), SLICE_BYTES):
        yield folded[start:start + SLICE_BYTES + max(ORDERS) - 1]


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a whole text and how often each occurs."""
    total = np.zeros(len(ORDERS) << HASH_BITS, np.int64)
    for part in slices(np.frombuffer(text, np.uint8)):
        for order in ORDERS:
            rows = features(part, order)[:SLICE_BYTES]
            total += np.bincount(rows, minlength=len(total))
    rows = np.flatnonzero(total)
    return rows.astype(np.int32), total[rows].astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # table row, language
    temperature: float
    threshold: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row per text, a column per language."""
        n = len(offsets) - 1
        sums, grams = np.zeros((n, len(self.languages))), np.zeros(n)
        at = 0
        while at < n:  # runs of texts of about a slice
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
            if stop == at + 1:
                parts = slices(data[offsets[at]:offsets[at + 1]])
                local = None
            else:
                parts = iter([_FOLD[data[offsets[at]:offsets[stop]]]])
                local = offsets[at:stop + 1] - offsets[at]
            for part in parts:
                for order in ORDERS:
                    rows = features(part, order)
                    if local is None:
                        rows = rows[:SLICE_BYTES]
                        sums[at] += self.scores[rows].sum(0, dtype=np.float64)
                        grams[at] += len(rows)
                        continue
                    count = np.maximum(local[1:] - local[:-1] - order + 1, 0)
                    values = np.concatenate([self.scores[rows], np.zeros((order, self.scores.shape[1]), np.float32)])
                    bounds = np.stack([local[:-1], local[:-1] + count], 1).ravel()
                    added = np.add.reduceat(values, np.minimum(bounds, len(values) - 1), axis=0)[::2]
                    sums[at:stop] += np.where(count[:, None] > 0, added, 0)
                    grams[at:stop] += count
            at = stop
        return softmax(sums / np.maximum(grams, 1)[:, None] / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Fit on ``(language, table rows, counts)``; every fifth text calibrates instead."""
    languages = sorted({r[0] for r in rows})
    if not rows:
        return Model([UNKNOWN], np.zeros((len(ORDERS) << HASH_BITS, 1), np.float32), 1.0, 0.0)
    place = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (len(ORDERS) << HASH_BITS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.5, (len(languages), DIMENSIONS)).astype(np.float32)
    data = [(place[name], at, (n / n.sum()).astype(np.float32)) for name, at, n in rows if len(at)]
    held = [d for i, d in enumerate(data) if i % 5 == 4] or data
    fit = [d for i, d in enumerate(data) if i % 5 != 4] or data
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(fit)):
            label, at, share = fit[i]
            mean = share @ table[at]
            slope = softmax(layer @ mean)
            slope[label] -= 1
            back = layer.T @ slope
            layer -= rate * np.outer(slope, mean)
            table[at] -= rate * len(at) ** 0.5 * share[:, None] * back
    scores = table @ layer.T
    raw = np.array([share @ scores[at] for _, at, share in held]).reshape(len(held), len(languages))
    truth = np.array([label for label, _, _ in held], int)

    aim = np.full((len(held), len(languages)), 1 / (len(held) + 2) / len(languages))  # one error more than was seen
    aim[np.arange(len(held)), truth] += 1 - aim.sum(1)

    def loss(t: float) -> float:
        return float(-(aim * np.log(softmax(raw / t) + 1e-300)).sum())

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    top = softmax(raw / temperature).max(1) if len(held) else np.ones(1)
    chance = 1 / len(languages)  # no score is lower
    threshold = chance + (float(np.quantile(top, REJECTED_SHARE)) - chance) / 2
    return Model(languages, scores.astype(np.float32), float(temperature), threshold)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def first_picks(rows: DataFrame) -> DataFrame:
    """Rows of ``lang`` and ``pick`` that can be among a language's first ``SAMPLE_PER_LANGUAGE`` by ``pick``, and few others.

    Picks are hashes, so that twice the sample lies below a bound that follows
    from their number. The others go where they are read: a frequent language
    sends no more texts to its ranking than a rare one.
    """
    picks = rows.groupBy("lang").agg(F.approx_count_distinct("pick")).orderBy("lang").limit(SAMPLE_TOTAL).collect()
    bounds = {lang: int(2**64 * 2 * SAMPLE_PER_LANGUAGE / n) - 2**63 for lang, n in picks if n > 2 * SAMPLE_PER_LANGUAGE}
    if not bounds:
        return rows
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    return rows.where(F.coalesce(F.col("pick") <= bound[F.col("lang")], F.lit(True)))


def fit(labelled: DataFrame, order_by: Column, text: str = "text", lang: str = "lang") -> Model:
    """Train on at most ``SAMPLE_PER_LANGUAGE`` texts of a language, ``SAMPLE_TOTAL`` in all, whole, by ``order_by``, a 64-bit hash."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("pick", "text"))
    usable = (
        labelled.where(F.col(lang).isNotNull() & (F.octet_length(text) > 0))
        .select(F.col(lang).alias("lang"), as_bytes(text).alias("text"), order_by.alias("pick"))
    )
    sample = (
        first_picks(usable).withColumn("rank", rank).where(F.col("rank") <= SAMPLE_PER_LANGUAGE)
        .orderBy("rank", "lang").limit(SAMPLE_TOTAL)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([packed(r) for r, _ in found], pa.binary()),
                 pa.array([packed(n) for _, n in found], pa.binary())], names=["lang", "at", "n"])

    rows = map_batches(sample.select("lang", "text"), run, "lang string, at binary, n binary").collect()
    model = train([(r.lang, unpacked(r.at, "<i4"), unpacked(r.n, "<f4")) for r in rows])
    del rows
    unused_returned()  # the driver outlives its training
    return model


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``rejected`` to every row.

    A text that is null or holds no letter is ``und`` with score 0 and
    rejected; a text whose calibrated score is below the model's threshold is
    rejected too but keeps its likeliest language. The text alone decides, so
    repeated rows get the same answer. Existing columns of these names are
    replaced. A model without any labelled row knows only ``und``.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    new = ("lang_pred", "score", "rejected")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            column = batch.column("__text")
            data, offsets = byte_column(column)
            letters = np.zeros(len(data) + 1, bool)
            letters[:-1] = (data | 32).astype(np.uint8) - 97 < 26
            has = np.logical_or.reduceat(letters, np.minimum(offsets[:-1], len(data))) & (offsets[1:] > offsets[:-1]) \
                if len(column) else np.zeros(0, bool)
            for i in np.flatnonzero(~has & (offsets[1:] > offsets[:-1])):
                has[i] = _LETTER.search(column[i].as_py().decode()) is not None
            p = known.probabilities(data, offsets)
            best = p.argmax(1)
            names = [known.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
            score = np.where(has, p[np.arange(len(best)), best], 0.0)
            rejected = ~has | (score < known.threshold)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names, *new])

    names, texts = carried_once(df, text)
    fields = carried_and(texts, "__text binary, lang_pred string, score double, rejected boolean")
    return released(map_batches(texts, run, fields), names, new, (text, df.schema[text].dataType))


def op4_language_id(documents: DataFrame) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    rest = remainder("doc_id", 4)
    model = fit(documents.where(rest != 2), F.xxhash64("doc_id"))
    told = identify(documents.select("doc_id", "text"), model)
    return told.select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score", "rejected")
