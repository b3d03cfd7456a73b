"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased and everything but letters becomes one space; n-grams of 1
to 3 characters are hashed to ``FEATURES`` buckets. Document frequencies come from all
learning documents, by a mergeable count on Spark. The weights are learned by
follow-the-regularised-leader with L1 and L2 penalties, per coordinate learning
rates and lazily materialised weights, on a bounded, hash-drawn sample of the
labelled documents (``PER_LABEL`` of each language) and on short pieces of them; a
temperature is then fitted on sample documents that were left out, so that
scores are calibrated chances.

Cases: null texts and texts without a letter are ``und`` with score 0; rows with a
null label do not teach; with a single label all other texts get it, with no label
all get ``und``; repeated rows are treated alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.rows import labelled_sample
from paysignal.llm.words import row_slices, text_buffers

FEATURES = 1 << 16
PER_LABEL = 800
ORDERS = (1, 2, 3)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.002
EPOCHS = 2
PIECE_LETTERS = 120
UNKNOWN = "und"

_SLICE_BYTES = 1 << 20
# Odd 32-bit multipliers, one per place in an n-gram; any odd numbers do.
_PLACE = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@cache
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return table


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and counts of all n-grams, sorted by row, and which rows have a letter."""
    joined = "\0".join("" if t is None else t.replace("\0", " ") for t in texts).lower()
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = np.concatenate(([0], code, [0])).astype(np.uint32)
    row = np.cumsum(code == 0) - 1  # texts stand between zeros
    letter = _letters()[code]
    has_letter = np.bincount(row[letter], minlength=len(texts))[: len(texts)] > 0
    shown = np.where(letter | (code == 0), code, 32)
    keep = letter | (code == 0)
    keep[1:] |= letter[:-1]
    shown, row = shown[keep], row[keep]
    edge = shown == 0
    shown = np.where(edge, 32, shown).astype(np.uint32)
    keys = []
    for order in ORDERS:
        n = len(shown) - order + 1
        if n <= 0:
            continue
        h = np.full(n, order, dtype=np.uint32)
        for k in range(order):
            h = (h ^ shown[k : n + k]) * _PLACE[k]
            h ^= h >> np.uint32(15)
        # a zero closes the text before it: n-grams must not start before it and end after it
        inside = row[:n] == row[order - 1 :]
        inside &= (shown[:n] != 32) if order == 1 else True
        keys.append((row[:n][inside].astype(np.uint64) << np.uint64(16)) | (h[inside] >> np.uint32(16)).astype(np.uint64))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), has_letter
    every = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.empty(0, np.int64)
    counts = np.diff(np.append(new, len(every)))
    rows, buckets = (every[new] >> np.uint64(16)).astype(np.int64), (every[new] & np.uint64(0xFFFF)).astype(np.int64)
    fine = rows < len(texts)
    fine[fine] &= has_letter[rows[fine]]
    return rows[fine], buckets[fine], counts[fine], has_letter


def weighted(texts: list[str | None], idf: np.ndarray):
    """TF-IDF vectors of length one, as sorted (rows, buckets, values)."""
    rows, buckets, counts, has_letter = features(texts)
    values = (1 + np.log(counts)) * idf[buckets] if len(rows) else np.empty(0)
    norms = np.sqrt(np.bincount(rows, values * values, minlength=len(texts))) if len(rows) else np.zeros(len(texts))
    return rows, buckets, values / norms[rows] if len(rows) else values, has_letter


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str | None]]]:
    _, limits = text_buffers(batch.column(column))
    for lo, hi in row_slices(limits, _SLICE_BYTES):
        yield lo, hi, batch.column(column).slice(lo, hi - lo).to_pylist()


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per bucket and in all, over every row of a one-column table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for _, _, part in _texts(batch, 0):
                _, buckets, _, has_letter = features(part)
                total += np.bincount(buckets, minlength=FEATURES)
                n += int(has_letter.sum())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found, documents = np.zeros(FEATURES, dtype=np.int64), 0
    for r in counted.toLocalIterator():  # at most one row per bucket
        if r.bucket < 0:
            documents = r.n
        else:
            found[r.bucket] = r.n
    return found, documents


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket x label
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        rows, buckets, values, has_letter = weighted(texts, self.idf)
        out = np.tile(self.bias, (len(texts), 1))
        for k in range(len(self.labels)):
            out[:, k] += np.bincount(rows, values * self.weights[buckets, k], minlength=len(texts))[: len(texts)]
        return out, has_letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        logits, has_letter = self.logits(texts)
        chances = _softmax(logits / self.temperature)
        best = chances.argmax(axis=1)
        return (
            [self.labels[b] if h else UNKNOWN for b, h in zip(best, has_letter, strict=True)],
            np.where(has_letter, chances[np.arange(len(best)), best], 0.0),
        )


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_weights(
    examples: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, n_labels: int, alpha: float = ALPHA,
    beta: float = BETA, l1: float = L1, l2: float = L2, epochs: int = EPOCHS, seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader: each coordinate keeps its summed, shifted gradient and summed squares; weights
    exist only where the former exceeds the L1 penalty. Bucket ``FEATURES`` is the unpenalised bias."""
    z = np.zeros((FEATURES + 1, n_labels))
    squares = np.zeros((FEATURES + 1, n_labels))

    def current(at: np.ndarray) -> np.ndarray:
        penalty = np.where(at == FEATURES, 0.0, l1)[:, None]
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - penalty, 0.0)
        return -shrunk / ((beta + np.sqrt(squares[at])) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, x = examples[i]
            w = current(at)
            chance = _softmax(x @ w)
            chance[targets[i]] -= 1.0
            gradient = x[:, None] * chance
            more = squares[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(more) - np.sqrt(squares[at])) / alpha * w
            squares[at] = more
    every = current(np.arange(FEATURES + 1))
    return every[:-1], every[-1]


def fit_temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """Least mean negative log-likelihood, by golden section on a log scale."""

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(targets)), targets], 1e-12)).mean()

    lo, hi = np.log(0.05), np.log(20.0)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _piece(text: str, key: int) -> str:
    start = key % max(len(text) - PIECE_LETTERS, 1)
    return text[start : start + PIECE_LETTERS]


def train(
    docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
    per_label: int = PER_LABEL,
) -> Model:
    """Learns from the rows for which ``learn`` is true, and from nothing else."""
    own = docs.filter(F.coalesce(learn, F.lit(False))).select(
        F.col(id_column).alias("_id"), F.col(text_column).alias("_text"), F.col(label_column).alias("_lang"))
    found, n = document_frequencies(own.select("_text"))
    idf = np.log((1.0 + n) / (1.0 + found)) + 1.0
    taught = own.filter(F.col("_text").isNotNull())
    chosen = labelled_sample(taught.select("_id", "_lang"), "_lang", "_id", per_label).distinct()
    # at most per_label ids of each label; of repeated rows one text
    rows = taught.join(F.broadcast(chosen), ["_id", "_lang"]).groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))
    sample = sorted((r._lang, str(r._id), r._text) for r in rows.collect())
    labels = sorted({s[0] for s in sample})
    if not labels:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0))
    number = {label: i for i, label in enumerate(labels)}
    fit, held, targets, held_targets = [], [], [], []
    for lo in range(0, len(sample), 64):
        part = sample[lo : lo + 64]
        texts = [s[2] for s in part] + [_piece(s[2], 7919 * (lo + i)) for i, s in enumerate(part)]
        rows, buckets, values, has_letter = weighted(texts, idf)
        limits = np.searchsorted(rows, np.arange(len(texts) + 1))
        for i in np.flatnonzero(has_letter):
            own_part = slice(limits[i], limits[i + 1])
            example = (np.append(buckets[own_part], FEATURES), np.append(values[own_part], 1.0))
            target = number[part[i % len(part)][0]]
            kept_out = (lo + i % len(part)) % 5 == 0
            (held if kept_out else fit).append(example)
            (held_targets if kept_out else targets).append(target)
    weights, bias = train_weights(fit, np.array(targets, dtype=np.int64), len(labels))
    model = Model(labels, idf, weights.astype(np.float32), bias)
    if held and len(labels) > 1:
        logits = np.array([x[:-1] @ weights[at[:-1]] + bias for at, x in held])
        model.temperature = fit_temperature(logits, np.array(held_targets))
    return model


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (equally named columns are replaced)."""
    plain = docs.drop("lang_pred", "score")
    schema = T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    place = plain.columns.index(text_column)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = [], []
            for _, _, part in _texts(batch, place):
                found, chance = sent.value.predict(part)
                labels += found
                scores.append(chance)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return plain.mapInArrow(run, schema)
