"""Toxicity scores from subword-bag embeddings and a linear softmax, trained jointly.

A word is the bag of its character n-grams (``ORDERS``, with word edges) hashed to
``BUCKETS`` embeddings, a text is the mean of its words, and a linear softmax over that
mean gives the chance of being toxic. Misspelt and inflected words share n-grams with
the words that taught them. As a few words hardly move the mean of a long text, the
same softmax is also applied to the mean of every ``STRETCH`` consecutive words, and the
worst stretch is a second input of the score. In training, after a first pass over whole
texts, every text is represented by the stretch that is worst under the model so far, clean
texts by a drawn one and as a whole too; gradients flow into the embeddings and the
softmax alike. The model is the mean of ``FOLDS`` models that each leave out a part of the
sample; a logistic curve over both logits, fitted to what they say about that part, gives the score.

Training uses a bounded, hash-drawn sample of labelled documents (``PER_LABEL`` of each
label). As the softmax is linear, scoring needs one number per bucket.

Cases: null, empty and wordless texts have score 0; documents with a null label do not teach, documents with contradicting labels
teach both; with one label only every text gets a constant score (1 or 0); with a single example of a
label no part can be left out, and the worst stretch alone decides, uncalibrated; repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.rows import labelled_sample
from paysignal.llm.task_memory import give_back, tidy
from paysignal.llm.words import row_slices, text_buffers

BUCKETS = 1 << 18
DIM = 12
ORDERS = (3, 4, 5)
STRETCH = 3
FOLDS = 3
PER_LABEL = 2000
THRESHOLD = 0.3
LEAST_EPOCHS, LEAST_STEPS = 6, 300  # few examples are passed over more often
RATE = 0.5
_BATCH = 32
_WORDS_AT_ONCE = 20_000
CACHE_WORDS = 200_000
_SLICE_BYTES = 2 << 20
# Odd 32-bit multiplier and start of the n-gram hash; any odd numbers do.
_STEP, _START = np.uint32(0x01000193), np.uint32(0x811C9DC5)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words (each at least one) and the limits of the words in them."""
    parts = [_subwords(words[lo : lo + _WORDS_AT_ONCE]) for lo in range(0, len(words), _WORDS_AT_ONCE)]
    if not parts:
        return np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
    sizes = np.concatenate([np.diff(limits) for _, limits in parts])
    return np.concatenate([buckets for buckets, _ in parts]), np.concatenate(([0], np.cumsum(sizes)))


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    for order in ORDERS:
        n = len(code) - order + 1
        if n <= 0:
            continue
        h = np.full(n, _START + np.uint32(order), dtype=np.uint32)
        for k in range(order):
            h = (h ^ code[k : n + k]) * _STEP
            h ^= h >> np.uint32(13)
        inside = word[:n] == word[order - 1 :]
        found.append(h[inside] & np.uint32(BUCKETS - 1))
        owners.append(word[:n][inside])
    buckets, owner = np.concatenate(found).astype(np.int32), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def cut_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words (runs of letters), the word number at every place, and the limits of the rows.

    A word that only repeats the one before it is left out, so that stuttering adds no weight.
    """
    shown = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(column, "")), r"[^\pL\pM]+", " ")
    cut = pc.split_pattern(pc.utf8_trim(shown, " "), " ")
    coded = cut.flatten().dictionary_encode()
    limits = np.asarray(cut.offsets, dtype=np.int64)
    limits = limits - limits[0]
    words, places = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = np.ones(len(places), dtype=bool)
    real[1:] = places[1:] != places[:-1]
    real[limits[:-1][np.diff(limits) > 0]] = True
    if "" in words:  # a wordless row is one empty word
        real &= places != words.index("")
        words[words.index("")] = "-"
    return words, places[real], np.concatenate(([0], np.cumsum(real)))[limits]


@dataclass
class Model:
    bucket_scores: np.ndarray  # difference of the two logits per bucket
    bias: float
    slopes: tuple[float, float] = (0.0, 1.0)  # of the logits of the text and of its worst stretch
    shift: float = 0.0
    constant: float | None = None

    def __post_init__(self) -> None:
        self._cache: dict[str, float] = {}

    def forget(self) -> None:
        self._cache.clear()

    def word_scores(self, words: list[str]) -> np.ndarray:
        cache = self._cache
        new = [w for w in words if w not in cache]
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = words
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            buckets, limits = subwords(part)
            means = np.add.reduceat(self.bucket_scores[buckets], limits[:-1]) / np.diff(limits)
            cache.update(zip(part, means.tolist(), strict=True))
        return np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words))

    def logits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logits of every row: of its mean and of its worst stretch; and which rows have no word."""
        words, places, limits = cut_words(column)
        scores = self.word_scores(words)[places] if len(places) else np.empty(0)
        counts = np.diff(limits)
        total = np.concatenate(([0.0], np.cumsum(scores)))
        mean = (total[limits[1:]] - total[limits[:-1]]) / np.maximum(counts, 1)
        return np.column_stack((mean, worst_stretch(scores, limits)[0])) + self.bias, counts == 0

    def score(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        logits, wordless = self.logits(column)
        return np.where(wordless, 0.0, 1 / (1 + np.exp(-np.clip(logits @ np.array(self.slopes) + self.shift, -40, 40))))


def worst_stretch(scores: np.ndarray, limits: np.ndarray, size: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Greatest mean over any ``size`` consecutive words of a row, and where it begins.

    Shorter rows are means over ``size`` words as well, the missing ones counting zero: a lone word is no certain sign.
    """
    n_rows = len(limits) - 1
    best, where = np.zeros(n_rows), limits[:-1].copy()
    counts = np.diff(limits)
    total = np.concatenate(([0.0], np.cumsum(scores)))
    short = (counts > 0) & (counts <= size)
    best[short] = (total[limits[1:][short]] - total[limits[:-1][short]]) / size
    long = np.flatnonzero(counts > size)
    if len(long):
        windows = counts[long] - size + 1
        first = np.cumsum(windows) - windows
        at = np.repeat(limits[:-1][long] - first, windows) + np.arange(windows.sum())
        means = (total[at + size] - total[at]) / size
        best[long] = np.maximum.reduceat(means, first)
        row = np.repeat(np.arange(len(long)), windows)
        hit = np.flatnonzero(means == best[long][row])
        _, firsts = np.unique(row[hit], return_index=True)
        where[long] = at[hit[firsts]]
    return best, where


def _gradient_pass(
    rng: np.random.Generator, embeddings: np.ndarray, softmax: np.ndarray, bias: np.ndarray, squares: list[np.ndarray],
    places: np.ndarray, sub: np.ndarray, sub_limits: np.ndarray, starts: np.ndarray, sizes: np.ndarray, targets: np.ndarray,
    whole: np.ndarray,
) -> None:
    """One pass of adaptive gradient steps over examples, each a run of words at ``starts`` of ``sizes`` words."""
    order = rng.permutation(len(starts))
    for lo in range(0, len(order), _BATCH):
        pick = order[lo : lo + _BATCH]
        n = sizes[pick]
        at = np.repeat(starts[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        words = places[at]
        parts = sub_limits[words + 1] - sub_limits[words]
        buckets = sub[np.repeat(sub_limits[words] - (np.cumsum(parts) - parts), parts) + np.arange(parts.sum())]
        example = np.repeat(np.repeat(np.arange(len(pick)), n), parts)
        share = np.repeat(1.0 / parts, parts) / whole[pick][example]
        used, compact = np.unique(buckets, return_inverse=True)
        mixing = np.bincount(example * len(used) + compact, share, minlength=len(pick) * len(used)).reshape(len(pick), -1)
        own = embeddings[used]
        means = mixing @ own
        logits = means @ softmax + bias
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(pick)), targets[pick]] -= 1.0
        steps = (mixing.T @ (chance @ softmax.T), means.T @ chance, chance.sum(axis=0))
        squares[0][used] += (steps[0] ** 2).mean(axis=1)
        squares[1] += steps[1] ** 2
        squares[2] += steps[2] ** 2
        embeddings[used] -= RATE * steps[0] / np.sqrt(squares[0][used] + 1e-8)[:, None]
        softmax -= 0.1 * RATE * steps[1] / np.sqrt(squares[1] + 1e-8)
        bias -= 0.1 * RATE * steps[2] / np.sqrt(squares[2] + 1e-8)


def _folds(targets: np.ndarray) -> np.ndarray:
    fold = np.zeros(len(targets), dtype=np.int64)
    for target in (0, 1):
        fold[targets == target] = np.arange((targets == target).sum()) % FOLDS
    return fold


def _fit_without(texts: list[str | None], targets: np.ndarray, k: int, epochs: int | None = None, seed: int = 3):
    """A model that leaves fold ``k`` out, the places of the rows it can judge and its logits of them; None if nothing can be left out."""
    own = _folds(targets) == k
    if not own.any() or len(np.unique(targets[~own])) < 2:
        return None
    model = _fit([t for t, o in zip(texts, own, strict=True) if not o], targets[~own], epochs, seed)
    logits, wordless = model.logits(pa.array([t for t, o in zip(texts, own, strict=True) if o], pa.string()))
    return model, np.flatnonzero(own)[~wordless], logits[~wordless]


def _merged(found: list[tuple[Model, np.ndarray, np.ndarray]], targets: np.ndarray) -> Model:
    """The mean of models that each leave out a fold, calibrated by what they say about it."""
    model = Model(np.mean([m.bucket_scores for m, _, _ in found], axis=0, dtype=np.float32), float(np.mean([m.bias for m, _, _ in found])))
    logits, judged = np.zeros((len(targets), 2)), np.zeros(len(targets), dtype=bool)
    for _, rows, own in found:
        logits[rows], judged[rows] = own, True
    if len(np.unique(targets[judged])) == 2:
        model.slopes, model.shift = _calibrate(logits[judged], targets[judged])
    return model


def _constant(targets: np.ndarray) -> Model:
    return Model(np.zeros(BUCKETS, dtype=np.float32), 0.0, constant=float(targets[0]) if len(targets) else 0.0)


def fit(texts: list[str | None], targets: np.ndarray, epochs: int | None = None, seed: int = 3) -> Model:
    """Trains on texts with targets 0 and 1: the mean of models that each leave out a fold, calibrated by what they say about it."""
    if len(np.unique(targets)) < 2:
        return _constant(targets)
    found = [f for k in range(FOLDS) if (f := _fit_without(texts, targets, k, epochs, seed)) is not None]
    none = np.empty(0, dtype=np.int64)
    return _merged(found or [(_fit(texts, targets, epochs, seed), none, np.empty((0, 2)))], targets)


def _fit(texts: list[str | None], targets: np.ndarray, epochs: int | None, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    words, places, limits = cut_words(pa.array(texts, pa.string()))
    sub, sub_limits = subwords(words)
    counts = np.diff(limits)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIM))
    softmax, bias = rng.normal(0, 0.1, (DIM, 2)), np.zeros(2)
    squares = [np.zeros(BUCKETS), np.zeros((DIM, 2)), np.zeros(2)]
    filled = np.flatnonzero(counts > 0)
    epochs = epochs or max(LEAST_EPOCHS, -(-LEAST_STEPS * _BATCH // max(len(filled), 1)))
    size = np.minimum(counts, STRETCH)

    def word_scores() -> np.ndarray:
        per_bucket = (embeddings @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32)
        return np.add.reduceat(per_bucket[sub], sub_limits[:-1]) / np.diff(sub_limits)

    def one_pass(rows, starts, sizes, whole) -> None:
        _gradient_pass(rng, embeddings, softmax, bias, squares, places, sub, sub_limits, starts, sizes, targets[rows], whole)

    for epoch in range(epochs):
        if epoch == 0:
            one_pass(filled, limits[filled], counts[filled], counts[filled].astype(np.float64))
            continue
        _, where = worst_stretch(word_scores()[places], limits)
        clean = filled[targets[filled] == 0]
        drawn = limits[clean] + (rng.random(len(clean)) * (counts[clean] - size[clean] + 1)).astype(np.int64)
        rows = np.concatenate((filled, clean))
        one_pass(rows, np.concatenate((where[filled], drawn)), size[rows], np.full(len(rows), float(STRETCH)))
        one_pass(clean, limits[clean], counts[clean], counts[clean].astype(np.float64))
    return Model((embeddings @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _calibrate(logits: np.ndarray, targets: np.ndarray) -> tuple[tuple[float, float], float]:
    """Slopes and shift of the logistic curve of least loss with smoothed targets, by Newton steps."""
    positive = targets.sum()
    smooth = np.where(targets == 1, (positive + 1) / (positive + 2), 1 / (len(targets) - positive + 2))
    scale = np.maximum(np.abs(logits).mean(axis=0), 1e-9)
    x = np.column_stack((logits / scale, np.ones(len(logits))))
    start = np.array([0.0, 1.0, 0.0])
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        step = np.linalg.solve(hessian, x.T @ (p - smooth) + 1e-3 * (w - start))
        w = w - np.clip(step, -2, 2)
    return (float(w[0] / scale[0]), float(w[1] / scale[1])), float(w[2])


def train(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", per_label: int = PER_LABEL,
) -> Model:
    """Learns from labelled documents for which ``learn`` (on the id) is true."""
    marks = labels if learn is None else labels.filter(F.coalesce(learn, F.lit(False)))
    marks = marks.filter(F.col(label_column).isNotNull()).select(
        F.col(id_column).alias("_id"), F.when(F.col(label_column) > 0, 1).otherwise(0).alias("_mark")).distinct()
    chosen = labelled_sample(marks, "_mark", "_id", per_label)  # at most 2 * per_label ids
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(chosen), "_id")
    # repeated documents could be many: one row for each id and label
    texts = texts.groupBy("_id", "_mark").agg(F.min("_text").alias("_text"))
    return _fit_in_tasks(texts)


_FOUND = "k int, targets binary, scores binary, bias double, rows binary, logits binary"


def _fit_in_tasks(sample: DataFrame) -> Model:
    """``fit`` of the bounded sample (_id, _mark, _text), a task for each fold: the driver gets a megabyte of each, and no texts."""

    def run(group):
        import pandas as pd

        rows = sorted(zip(group["_id"], group["_mark"], group["_text"], strict=True), key=lambda r: r[:2])
        texts, targets = [r[2] for r in rows], np.array([r[1] for r in rows], dtype=np.int64)
        k = int(group["_fold"].iloc[0])
        found = None
        if len(np.unique(targets)) == 2:
            found = _fit_without(texts, targets, k)
            if found is None and k == 0:  # nothing can be left out: a model of all rows, used if no fold has one
                found, k = (_fit(texts, targets, None, 3), np.empty(0, dtype=np.int64), np.empty((0, 2))), -1
        give_back()
        model, judged, logits = found or (None, np.empty(0, dtype=np.int64), np.empty((0, 2)))
        return pd.DataFrame([{
            "k": k, "targets": targets.astype("<i8").tobytes(), "bias": model.bias if model else 0.0,
            "scores": model.bucket_scores.astype("<f4").tobytes() if model else None,
            "rows": judged.astype("<i8").tobytes(), "logits": logits.astype("<f8").tobytes()}],
            columns=["k", "targets", "scores", "bias", "rows", "logits"])

    folds = F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))).alias("_fold")
    copies = sample.select(F.col("_id").cast("string").alias("_id"), "_mark", "_text", folds)
    parts = sorted(copies.repartitionByRange(FOLDS, "_fold").groupBy("_fold").applyInPandas(run, _FOUND).collect(), key=lambda r: r.k)
    targets = np.frombuffer(parts[0].targets, dtype="<i8") if parts else np.empty(0, dtype=np.int64)
    parts = [r for r in parts if r.scores is not None]
    parts = [r for r in parts if r.k >= 0] or parts
    found = [
        (Model(np.frombuffer(r.scores, dtype="<f4"), r.bias), np.frombuffer(r.rows, dtype="<i8"),
         np.frombuffer(r.logits, dtype="<f8").reshape(-1, 2)) for r in parts]
    return _merged(found, targets) if found else _constant(targets)


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (an equally named column is replaced)."""
    plain = docs.drop("score")
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    place = plain.columns.index(text_column)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            _, limits = text_buffers(column)
            found = [sent.value.score(column.slice(lo, hi - lo)) for lo, hi in row_slices(limits, _SLICE_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(found) if found else [], pa.float64())],
                names=[*batch.schema.names, "score"])

    return plain.mapInArrow(tidy(run, after=lambda: sent.value.forget()), schema)
