"""Quality classifier: Naive Bayes support vectors.

A text is the set of its hashed n-grams: byte n-grams, word n-grams and runs of one word. Each indicator is scaled by the
log ratio of its counts in the two classes, rows are brought to unit length, and a linear hinge-loss model is fitted by
dual coordinate descent. Margins of documents left out of a fit calibrate a logistic curve, so scores are chances.

The fit uses a bounded sample of labelled documents, whose indicator sets (at most 32 KiB each) come to the driver; all
texts are scored whole, in Arrow batches with a broadcast weight table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import hashed_sample, mix64, text_bytes, text_slices

#: Indicators are numbered by hashes of so many bits.
BITS = 18
WIDTH = 1 << BITS
#: Longest byte n-gram and longest word n-gram.
BYTES, WORDS = 4, 2
#: Runs of 2 to so many equal words have indicators of their own.
RUNS = 4
#: The fit takes at most so many labelled documents, of at most so many characters each.
MOST_DOCUMENTS, MOST_CHARACTERS = 4096, 200_000


@dataclass(frozen=True)
class Model:
    """Products of ratio and weight, squared ratios, the bias and the calibration curve 1 / (1 + exp(-(slope m + shift)))."""

    products: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def chance(self, margins: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * np.asarray(margins, np.float64) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _numbers(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys) >> np.uint64(64 - BITS)).astype(np.uint32)


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct indicator numbers of each text; null and empty texts have none. N-grams don't cross texts."""
    flat, ends = text_bytes(column)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    wide = flat.astype(np.uint32)
    grams, code = [], np.zeros(len(flat), np.uint32)
    for size in range(1, BYTES + 1):
        n = max(len(flat) - size + 1, 0)
        code = (code[:n] << np.uint32(8)) | wide[size - 1 : size - 1 + n] if size > 1 else wide.copy()
        grams.append(((code * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA77 & 0xFFFFFFFF)) * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS))
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    low = lower[flat]
    inside = (low != 32) & ((low < 9) | (low > 13))
    first, last = inside.copy(), inside.copy()
    if len(flat):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = ends[(ends > 0) & (ends < len(flat))]
        first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    with np.errstate(over="ignore"):
        base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(low), base)]), dtype=np.uint64)
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
        del power
        undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(low), inverse)]), dtype=np.uint64)
        words = mix64((prefix[stop] - prefix[begin]) * undo[begin] + (stop - begin).astype(np.uint64))
        del prefix, undo
        phrases, key = [], np.zeros(len(words), np.uint64)
        for size in range(1, WORDS + 1):
            n = max(len(words) - size + 1, 0)
            key = key[:n] * np.uint64(0xD6E8FEB86659FD93) + words[size - 1 : size - 1 + n]
            phrases.append(_numbers(key + np.uint64(size)))
        # Runs of equal words: the same indicator whatever the word is.
        same, runs = words[1:] == words[:-1], []
        for size in range(2, RUNS + 1):
            n = max(len(words) - size + 1, 0)
            run = same[:n].copy()
            for i in range(1, size - 1):
                run &= same[i : i + n]
            runs.append((run, _numbers(np.array([size * 7919], np.uint64))[0]))
    of = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    seen = np.zeros(WIDTH, bool)
    for a, b, p, q in zip(starts.tolist(), ends.tolist(), of[0].tolist(), of[1].tolist(), strict=True):
        for size, numbers in enumerate(grams):
            seen[numbers[a : max(b - size, a)]] = True
        for size, numbers in enumerate(phrases):
            seen[numbers[p : max(q - size, p)]] = True
        for size, (run, number) in enumerate(runs, 1):
            if run[p : max(q - size, p)].any():
                seen[number] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


def _packed(numbers: np.ndarray) -> bytes:
    """Indicator numbers as 32-bit numbers, or as one bit each where that is shorter: 32 KiB at most."""
    if len(numbers) * 4 < WIDTH // 8:
        return numbers.astype(np.uint32).tobytes()
    bits = np.zeros(WIDTH, bool)
    bits[numbers] = True
    return np.packbits(bits).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if len(data) < WIDTH // 8:
        return np.frombuffer(data, np.uint32).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def log_ratios(sets: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log((1 + count in good documents) / its sum) - the same of bad ones, for every indicator."""
    counts = [np.ones(WIDTH), np.ones(WIDTH)]
    for numbers, label in zip(sets, good, strict=True):
        counts[int(label)][numbers] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the least 1/2 |w|^2 + cost * (sum of hinge losses), by dual coordinate descent.

    Rows are (numbers, values) of unit length, to which a component of 1 is added for the bias. Stops early when all
    projected gradients of an epoch lie within 0.01.
    """
    weights, bias, alpha = np.zeros(WIDTH), 0.0, np.zeros(len(rows))
    diagonal = np.array([float(v @ v) + 1.0 for _, v in rows])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        low, high = np.inf, -np.inf
        for i in draw.permutation(len(rows)).tolist():
            numbers, values = rows[i]
            slope = signs[i] * (float(weights[numbers] @ values) + bias) - 1.0
            projected = min(slope, 0.0) if alpha[i] <= 0 else max(slope, 0.0) if alpha[i] >= cost else slope
            low, high = min(low, projected), max(high, projected)
            if projected:
                before = alpha[i]
                alpha[i] = min(max(before - slope / diagonal[i], 0.0), cost)
                step = (alpha[i] - before) * signs[i]
                weights[numbers] += step * values
                bias += step
        if high - low < 0.01:
            break
    return weights, bias


def _scaled(numbers: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = ratios[numbers]
    return numbers, values / max(float(np.sqrt(values @ values)), 1e-12)


def calibration(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least loss over margins, with targets drawn in from 0 and 1 (Platt)."""
    n = good.sum(), (~good).sum()
    targets = np.where(good, (n[0] + 1) / (n[0] + 2), 1 / (n[1] + 2))
    a, b = 1.0, float(np.log((n[0] + 1) / (n[1] + 1)))
    x = np.stack([margins, np.ones_like(margins)])

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float(np.sum(np.logaddexp(0, z) - targets * z))

    for _ in range(100):
        p = _logistic(a * margins + b)
        gradient, curvature = x @ (p - targets), (x * (p * (1 - p))) @ x.T + 1e-9 * np.eye(2)
        if np.abs(gradient).max() < 1e-7 * len(margins):
            break
        step, size = np.linalg.solve(curvature, gradient), 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
    return max(float(a), 0.0), float(b)


def fit(sets: list[np.ndarray], good: np.ndarray, cost: float = 1.0, epochs: int = 40, folds: int = 5, seed: int = 13) -> Model:
    """The model of labelled indicator sets. Where a class has fewer documents than folds, scores are its smoothed share."""
    good = np.asarray(good, bool)
    if min(good.sum(), (~good).sum()) < folds:
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(WIDTH, np.float32), np.zeros(WIDTH, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))

    def learn(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        ratios = log_ratios([sets[i] for i in chosen], good[chosen])
        weights, bias = descend([_scaled(sets[i], ratios) for i in chosen], np.where(good[chosen], 1.0, -1.0), cost, epochs, seed)
        return ratios, weights, bias

    fold = np.empty(len(good), np.int64)
    for label in (False, True):
        members = np.flatnonzero(good == label)
        fold[members] = np.arange(len(members)) % folds
    margins = np.empty(len(good))
    for f in range(folds):
        ratios, weights, bias = learn(np.flatnonzero(fold != f))
        for i in np.flatnonzero(fold == f).tolist():
            numbers, values = _scaled(sets[i], ratios)
            margins[i] = weights[numbers] @ values + bias
    slope, shift = calibration(margins, good)
    ratios, weights, bias = learn(np.arange(len(good)))
    return Model((ratios * weights).astype(np.float32), (ratios**2).astype(np.float32), bias, slope, shift)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is divisible by 5; a null key counts as an empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def fitted(documents: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS, characters: int = MOST_CHARACTERS) -> Model:
    """The model learnt from at most `most` labelled documents of at most `characters` characters that aren't held out.

    A document with several labels has the least of them; labels other than 0 and 1 are not used. Texts that are null or
    empty are not learnt from.
    """
    known = labels.where(labels["quality"].isin(0, 1)).groupBy(labels["doc_id"].alias("_id")).agg(F.min("quality").alias("_good"))
    rows = documents.where(~held_out(documents["doc_id"]) & (F.length(documents["text"]).between(1, characters)))
    rows = rows.select(documents["doc_id"].alias("_id"), documents["text"].alias("text"))
    sample = hashed_sample(rows.join(known, "_id"), most, "_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=1 << 20):
            packed = pa.array([_packed(x) for x in indicators(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("good"), packed], ["good", "packed"])

    found = sample.select(F.col("_good").cast("int").alias("good"), "text").mapInArrow(run, "good int, packed binary").collect()
    found.sort(key=lambda r: (r.packed, r.good))  # the order of rows must not change the fit
    return fit([_unpacked(r.packed) for r in found], np.array([r.good == 1 for r in found], bool))


def margins(column: pa.Array, model: Model) -> np.ndarray:
    out = np.full(len(column), model.bias)
    for i, numbers in enumerate(indicators(column)):
        norm = float(np.sqrt(model.squares[numbers].sum(dtype=np.float64)))
        if norm:
            out[i] += model.products[numbers].sum(dtype=np.float64) / norm
    return out


def scores(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents (doc_id, text); repeated rows stay.

    Only the text is scored, whole; null and empty texts get the score of the bias alone. Other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=1 << 20):
            score = shared.value.chance(margins(batch.column("text"), shared.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())], ["doc_id", "held_out", "score"])

    rows = documents.select("doc_id", held_out(documents["doc_id"]).alias("held_out"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
