"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The network is trained from labelled spans (those of the patterns in a bounded sample of windows, some of them written
without their lead character) and reads the text around each digit and each `@`: every kind has one of them, so text
further from both than `REACH` can hold no span. Such stretches are read in overlapping windows; the scores of
characters that several windows hold are averaged by their distance from the window's edges, and one best path is
decoded for the whole stretch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import hashed_sample, text_slices
from starloom.llm.lstm import Adam, both_ways, both_ways_gradients, crf_gradients, first_weights, viterbi

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)
REACH, WINDOW, STRIDE = 32, 96, 48
#: Ids of characters: ASCII as it is, then other letters, other characters and padding.
OTHER_LETTER, OTHER, PADDING, CHARACTERS = 128, 129, 130, 131
SPANS = "array<struct<kind: string, start: bigint, stop: bigint, base: boolean>>"


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @ in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1] in "._%+-" or text[begin - 1].isascii() and text[begin - 1].isalnum()):
            begin -= 1
        domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of the patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in re.finditer(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9](?:[\x20-]?[0-9])+", text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def character_ids(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ids = points.astype(np.int64)
    for k in np.flatnonzero(points > 127).tolist():
        ids[k] = OTHER_LETTER if chr(points[k]).isalpha() else OTHER
    return ids


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within REACH characters of a digit or @, merged where they meet."""
    out: list[list[int]] = []
    for m in re.finditer("[0-9@]+", text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scores(ids: np.ndarray, weights: dict) -> tuple[np.ndarray, np.ndarray, tuple, np.ndarray]:
    """Label scores (T, B, K) of windows (T, B), their states and the mask."""
    mask = (ids != PADDING).astype(np.float32)
    hidden, kept = both_ways(weights["input_f"][ids] + weights["bias_f"], weights["input_b"][ids] + weights["bias_b"], weights, mask)
    return hidden @ weights["out"] + weights["out_bias"], hidden, kept, mask


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], size: int = 16, rounds: int = 160, batch: int = 32, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights fitted to windows of text with their labelled spans. Without windows the untrained weights label nothing."""
    draw = np.random.default_rng(seed)
    weights = first_weights(CHARACTERS, size, LABELS, seed) | {"moves": np.zeros((LABELS, LABELS), np.float32)}
    weights["out_bias"][0] = 2
    if not windows:
        weights["out"][:] = 0
        return weights
    ids, labels = np.full((WINDOW, len(windows)), PADDING), np.zeros((WINDOW, len(windows)), np.int64)
    for k, (text, spans) in enumerate(windows):
        piece = character_ids(text)[:WINDOW]
        ids[: len(piece), k] = piece
        for kind, a, b in spans:
            labels[a:b, k] = 2 + 2 * KINDS.index(kind)
            labels[a, k] -= 1
    adam = Adam(weights, 0.02)
    for step in range(rounds):
        adam.rate = 0.02 * (1 - step / rounds) + 0.001
        pick = draw.integers(0, len(windows), min(batch, 4 * len(windows)))
        x, y = ids[:, pick], labels[:, pick]
        scores, hidden, kept, mask = _scores(x, weights)
        # Padding is labelled "outside", which the scores learn like any other character.
        _, up, moves = crf_gradients(scores, weights["moves"], y)
        gradients = {"moves": moves, "out": np.einsum("tbh,tbk->hk", hidden, up), "out_bias": up.sum((0, 1))}
        a, b, recurrent = both_ways_gradients(up @ weights["out"].T, kept, weights, mask)
        for way, g in (("f", a), ("b", b)):
            table = np.zeros_like(weights[f"input_{way}"])
            np.add.at(table, x.ravel(), g.reshape(-1, g.shape[2]))
            gradients |= {f"input_{way}": table, f"bias_{way}": g.sum((0, 1))}
        adam.step(gradients | recurrent)
    return weights


def label_stretches(pieces: list[str], weights: dict, batch: int = 512) -> list[np.ndarray]:
    """Labels of each stretch of text: windows scored together, then one path for each stretch."""
    ids = [character_ids(p) for p in pieces]
    starts = [(k, s) for k, x in enumerate(ids) for s in range(0, max(1, len(x) - (WINDOW - STRIDE)), STRIDE)]
    sums = [np.zeros((len(x), LABELS), np.float32) for x in ids]
    shares = [np.zeros((len(x), 1), np.float32) for x in ids]
    edge = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    for at in range(0, len(starts), batch):
        group = starts[at : at + batch]
        x = np.full((WINDOW, len(group)), PADDING)
        for j, (k, s) in enumerate(group):
            part = ids[k][s : s + WINDOW]
            x[: len(part), j] = part
        scores = _scores(x, weights)[0]
        for j, (k, s) in enumerate(group):
            n = min(WINDOW, len(ids[k]) - s)
            sums[k][s : s + n] += scores[:n, j] * edge[:n]
            shares[k][s : s + n] += edge[:n]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
    order = sorted(range(len(ids)), key=lambda k: len(ids[k]))
    at = 0
    while at < len(order):  # stretches of like length are decoded together, with a bounded number of cells
        longest = len(ids[order[min(at + batch, len(order)) - 1]])
        group = order[at : at + max(1, min(batch, (1 << 16) // max(longest, 1)))]
        steps = max(len(ids[k]) for k in group)
        scores, mask = np.zeros((steps, len(group), LABELS), np.float32), np.zeros((steps, len(group)), np.float32)
        for j, k in enumerate(group):
            scores[: len(ids[k]), j], mask[: len(ids[k]), j] = sums[k] / shares[k], 1
        path = viterbi(scores, weights["moves"], mask)
        for j, k in enumerate(group):
            out[k] = path[: len(ids[k]), j]
        at += len(group)
    return out


def _label_spans(labels: np.ndarray, piece: str, offset: int) -> list[tuple[str, int, int]]:
    """Runs of one kind, cut at begin labels; those without a digit (an @ for email) or that are blank at an end go."""
    kind, begins = (labels + 1) // 2, labels % 2 == 1
    edges = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | begins[1:], [True]])) if len(labels) else []
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if kind[a]:
            name, text = KINDS[kind[a] - 1], piece[a:b]
            if text.strip() == text and ("@" in text if name == "email" else sum("0" <= c <= "9" for c in text) >= 4):
                out.append((name, offset + int(a), offset + int(b)))
    return out


def all_spans(texts: list[str], weights: dict) -> list[list[tuple[str, int, int, bool]]]:
    """Base spans of each text and those that the network adds where no base span lies, by start and kind."""
    parts = [(k, a, b) for k, t in enumerate(texts) for a, b in stretches(t)]
    labels = label_stretches([texts[k][a:b] for k, a, b in parts], weights)
    added: list[list] = [[] for _ in texts]
    for (k, a, b), path in zip(parts, labels, strict=True):
        if path.any():
            added[k] += _label_spans(path, texts[k][a:b], a)
    out = []
    for text, more in zip(texts, added, strict=True):
        base = base_spans(text)
        rows = [(*s, True) for s in base]
        marks = sorted((a, b) for _, a, b in base)
        reach, at = -1, 0
        for kind, a, b in sorted(more, key=lambda s: s[1]):
            while at < len(marks) and marks[at][0] < b:
                reach, at = max(reach, marks[at][1]), at + 1
            if reach <= a:
                rows.append((kind, a, b, False))
        out.append(sorted(rows, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))
    return out


def labelled_windows(documents: DataFrame, most: int = 1500, texts: int = 6000) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """At most `most` windows around stretches with the base spans in them, taken from at most `texts` documents.

    Documents are those with the least hash of their text among those that hold a digit or an @, windows those with the
    least hash of their own, with the labelled ones and half of the others first. Every eighth phone loses its plus
    sign and every eighth card has its digits set apart, so that the network learns more than the patterns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            pieces, marks = [], []
            for text in batch.column("text").to_pylist():
                for a, b in stretches(text):
                    for s in range(a, b, WINDOW):
                        piece = text[s : min(b, s + WINDOW)]
                        spans = base_spans(piece)
                        pieces.append(piece)
                        marks.append([f"{k}:{x}:{y}" for k, x, y in spans])
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(marks, pa.list_(pa.string()))], ["piece", "marks"])

    usable = documents.select(documents["text"]).where(F.col("text").rlike("[0-9@]"))
    found = hashed_sample(usable, texts, "text").mapInArrow(run, "piece string, marks array<string>")
    chosen = found.withColumn("h", F.xxhash64("piece")).distinct().orderBy((F.size("marks") == 0).cast("int") * F.abs(F.col("h") % 2), "h", "piece").limit(most).collect()
    out = []
    for n, row in enumerate(chosen):
        piece, spans = row["piece"], [(k, int(a), int(b)) for k, a, b in (m.split(":") for m in row["marks"])]
        if n % 8 == 0 and len(spans) == 1 and spans[0][0] in ("phone", "card"):
            kind, a, b = spans[0]
            new = piece[a + 1 : b] if kind == "phone" else re.sub(r"(\d{4})(?=\d)", r"\1.", piece[a:b])
            piece, spans = piece[:a] + new + piece[b:], [(kind, a, a + len(new))]
        out.append((piece, [s for s in spans if s[2] <= WINDOW]))
    return out


def with_spans(rows: DataFrame, text: str, weights: dict, redacted: bool = False, only: str | None = None) -> DataFrame:
    """`_row`, the rows or `only` one of their columns, with `found`, the spans in a text column.

    If asked for, `clean` is the text with each span as <KIND>.

    Texts that are null or hold neither a digit nor an @ have no spans, and their `clean` is null: they are as they
    were. Spans of different kinds may overlap; `clean` then has the kind that begins first. Repeated rows stay.
    """

    def cleaned(value: str, spans: list) -> str:
        out, done = [], 0
        for kind, a, b, _ in spans:
            if a >= done:
                out += [value[done:a], f"<{kind.upper()}>"]
            done = max(done, b)
        return "".join([*out, value[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
        for batch in text_slices(batches, "_scan"):
            values = batch.column("_scan").to_pylist()
            some = [k for k, v in enumerate(values) if v]
            spans: list = [[] for _ in values]
            for k, found in zip(some, all_spans([values[k] for k in some], weights), strict=True):
                spans[k] = found
            named = [[dict(zip(("kind", "start", "stop", "base"), s, strict=True)) for s in x] for x in spans]
            columns = [batch.column("_row"), pa.array(named, kind)]
            if redacted:
                columns.append(pa.array([cleaned(v, s) if s else None for v, s in zip(values, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["_row", "found", "clean"][: len(columns)])

    scan = F.when(rows[text].rlike("[0-9@]"), rows[text])
    row = F.struct(*[rows[c] for c in ([only] if only else rows.columns)])
    inner = rows.select(row.alias("_row"), scan.alias("_scan"))
    fields = f"_row {inner.schema['_row'].dataType.simpleString()}, found {SPANS}" + ", clean string" * redacted
    return inner.mapInArrow(run, fields)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def fitted(documents: DataFrame) -> dict[str, np.ndarray]:
    return train(labelled_windows(documents))


def redacted_documents(documents: DataFrame, weights: dict) -> DataFrame:
    """documents with every span replaced by its kind; n_chars, if there is such a column, follows the text."""
    rows = with_spans(documents, "text", weights, redacted=True)
    text = F.coalesce("clean", "_row.text")
    columns = {"text": text, "n_chars": F.coalesce(F.length("clean").cast("bigint"), F.col("_row.n_chars"))} if "n_chars" in documents.columns else {"text": text}
    return rows.select(*[columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])
