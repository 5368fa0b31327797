"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is the mean of the vectors of its character n-grams (hashed into a fixed table), so
an unseen misspelling shares most of its vectors with the word it stands for. A passage of
``PASSAGE`` words is the average of its words, and a linear softmax gives its class; both
layers are trained jointly. Toxic words are few, and in the average of a long text they
would vanish, so a document is as toxic as its most toxic passage: after some epochs on
all passages, training goes on with the passages that decide. Whole texts are scored.

Training takes a bounded sample of labelled documents (``PER_CLASS`` of each class, texts
of at most ``LONGEST`` characters) to the driver, chosen by a hash of the id. Every task
gets the table reduced to one number per n-gram: the model is linear behind the average.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import remainder, slices, text_or_empty

PER_CLASS = 2_000
LONGEST = 12_000
PASSAGE = 16
LENGTHS = (3, 4, 5)
BUCKETS = 1 << 18
DIMENSIONS = 8
BATCH = 256
ALL_EPOCHS = 2
DECIDING_EPOCHS = 14
RATE = 0.15
THRESHOLD = 0.7
FOLDS = 3
HELD_OUT = 1
#: Words whose logit a task remembers.
CACHED = 300_000
#: Words hashed and texts split at once.
WORDS_AT_ONCE = 30_000
TEXTS_AT_ONCE = 300

EDGE = ".,;:!?\"'()[]{}*&%$#|"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the table of each word's character n-grams and of the word itself.

    Returns the places word by word, and how many each word has.
    """
    marked = [f"<{word.strip(EDGE)}>" for word in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(marked)), length)
    power = _POWERS[(np.arange(len(codes)) - start[owner]) % len(_POWERS)]
    found, owners = [_place(np.add.reduceat(codes * power, start))], [np.arange(len(marked))]
    for n in LENGTHS:
        if len(codes) < n:
            continue
        many = len(codes) - n + 1
        h = np.full(many, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + many]) * _MULTIPLIER
            h ^= h >> np.uint64(31)
        inside = owner[:many] == owner[n - 1 :]
        found.append(_place(h[inside]))
        owners.append(owner[:many][inside])
    places, owner = np.concatenate(found), np.concatenate(owners)
    return places[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(marked))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.random.default_rng(7).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def _place(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MULTIPLIER
    return (h >> np.uint64(46)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Logit per n-gram (class 1 less class 0), the bias, and the calibration of the largest."""

    grams: np.ndarray
    bias: float
    slope: float
    shift: float

    def learn(self, words: set[str], known: dict[str, float]) -> None:
        """Add the logits of words to those a task remembers."""
        if len(known) + len(words) > CACHED:
            known.clear()
        new = [w for w in words if w not in known]
        for i in range(0, len(new), WORDS_AT_ONCE):
            part = new[i : i + WORDS_AT_ONCE]
            places, count = buckets(part)
            sums = np.add.reduceat(self.grams[places].astype(np.float64), np.cumsum(count) - count)
            known.update(zip(part, (sums / count).tolist()))

    def largest(self, words: list[str], known: dict[str, float]) -> float:
        """Logit of the most toxic passage; the bias for a text without words.

        A word counts once in a passage, so repeating it does not add up.
        """
        if not words:
            return self.bias
        own = {word: i for i, word in enumerate(set(words))}
        values = np.fromiter((known[w] for w in own), np.float64, len(own))
        at = np.fromiter((own[w] for w in words), np.int64, len(words))
        pairs = np.unique(np.arange(len(at)) // PASSAGE * len(own) + at)
        sums = np.bincount(pairs // len(own), weights=values[pairs % len(own)])
        return float(sums.max() / PASSAGE + self.bias)

    def scores(self, texts: list[str | None], known: dict[str, float]) -> np.ndarray:
        found = []
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            docs = [words_of(t or "") for t in texts[start : start + TEXTS_AT_ONCE]]
            self.learn(set().union(*docs), known)
            found += [self.largest(words, known) for words in docs]
        x = self.slope * np.array(found, np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Trainer:
    """Embeddings and softmax weights with their Adagrad sums."""

    def __init__(self, texts: list[str], labels: np.ndarray, seed: int = 1):
        self.rng = np.random.default_rng(seed)
        self.labels = labels
        vocabulary: dict[str, int] = {}
        docs = [[vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)] for t in texts]
        words = list(vocabulary)
        parts = [buckets(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
        self.grams = np.concatenate([p[0] for p in parts])
        self.gram_count = np.concatenate([p[1] for p in parts])
        self.gram_start = np.concatenate([[0], np.cumsum(self.gram_count)])
        # Passages of all documents, padded with -1.
        rows, owner = [], []
        for i, words in enumerate(docs):
            for start in range(0, len(words), PASSAGE):
                part = list(dict.fromkeys(words[start : start + PASSAGE]))
                rows.append(part + [-1] * (PASSAGE - len(part)))
                owner.append(i)
        self.passages = np.array(rows, np.int32).reshape(-1, PASSAGE)
        self.owner = np.array(owner, np.int64)
        self.vectors = (self.rng.random((BUCKETS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
        self.vector_sums = np.full(BUCKETS, 1e-6, np.float32)
        self.weights = np.zeros((DIMENSIONS, 2), np.float32)
        self.weights[:, 1] = self.rng.normal(0, 0.5, DIMENSIONS)
        self.weights[:, 0] = -self.weights[:, 1]
        self.bias = np.zeros(2, np.float32)
        self.weight_sums, self.bias_sums = np.full_like(self.weights, 1e-6), np.full(2, 1e-6, np.float32)

    def _flat(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n-grams of passages, the passage each is in, and its share of the average."""
        at, _ = np.nonzero(passages >= 0)
        words = passages[passages >= 0]
        count = self.gram_count[words]
        which = np.repeat(np.arange(len(words)), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        share = (1.0 / (count * PASSAGE)).astype(np.float32)
        return self.grams[self.gram_start[words][which] + nth], at[which], share[which]

    def step(self, chosen: np.ndarray) -> None:
        grams, at, share = self._flat(self.passages[chosen])
        if not len(grams):
            return
        target = self.labels[self.owner[chosen]]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        mean = np.zeros((len(chosen), DIMENSIONS), np.float32)
        mean[at[starts]] = np.add.reduceat(self.vectors[grams] * share[:, None], starts)
        logits = mean @ self.weights + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(chosen)), target] -= 1
        back = p @ self.weights.T
        order = np.argsort(grams, kind="stable")
        ids, first = np.unique(grams[order], return_index=True)
        slope = np.add.reduceat((back[at] * share[:, None])[order], first)
        self.vector_sums[ids] += (slope**2).mean(axis=1)
        self.vectors[ids] -= RATE * slope / np.sqrt(self.vector_sums[ids])[:, None]
        for value, sums, g in (
            (self.weights, self.weight_sums, mean.T @ p / len(chosen)), (self.bias, self.bias_sums, p.mean(axis=0))
        ):
            sums += g**2
            value -= RATE * g / np.sqrt(sums)

    def epoch(self, chosen: np.ndarray) -> None:
        chosen = self.rng.permutation(chosen)
        for start in range(0, len(chosen), BATCH):
            self.step(chosen[start : start + BATCH])

    def gram_logits(self) -> np.ndarray:
        return self.vectors @ (self.weights[:, 1] - self.weights[:, 0])

    def passage_logits(self) -> np.ndarray:
        values = self.gram_logits()[self.grams]
        words = np.add.reduceat(values, self.gram_start[:-1]) / self.gram_count
        words = np.append(words, 0.0)  # the padding
        return words[self.passages].sum(axis=1) / PASSAGE + self.bias[1] - self.bias[0]

    def deciding(self, use: np.ndarray) -> np.ndarray:
        """The most toxic passage of each document in use."""
        logits = self.passage_logits()
        order = np.lexsort((-logits, self.owner))
        first = np.flatnonzero(np.concatenate([[True], self.owner[order][1:] != self.owner[order][:-1]]))
        best = order[first]
        return best[use[self.owner[best]]]


def train(texts: list[str], labels: np.ndarray, prevalence: float) -> Model:
    """A model from the sample; every fifth document only calibrates.

    Without both classes every score is the prevalence.
    """
    labels = np.asarray(labels, np.int64)
    flat = Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, float(np.log((prevalence + 1e-6) / (1 - prevalence + 1e-6))))
    if not len(labels) or labels.min() == labels.max() or not any(words_of(t) for t in texts):
        return flat
    trainer = Trainer(texts, labels)
    calibrates = np.arange(len(texts)) % 5 == 4
    use = ~calibrates
    for _ in range(ALL_EPOCHS):
        trainer.epoch(np.flatnonzero(use[trainer.owner]))
    for _ in range(DECIDING_EPOCHS):
        chosen = trainer.deciding(use)
        others = trainer.rng.permutation(np.flatnonzero(use[trainer.owner] & (labels[trainer.owner] == 0)))
        trainer.epoch(np.concatenate([chosen, others[: len(chosen) // 2]]))
    raw = Model(trainer.gram_logits(), float(trainer.bias[1] - trainer.bias[0]), 1.0, 0.0)
    aside, known = [words_of(t) for t, c in zip(texts, calibrates) if c], {}
    raw.learn(set().union(*aside), known)
    x = np.array([raw.largest(words, known) for words in aside])
    slope, shift = _calibrate(x, labels[calibrates], prevalence)
    return Model(raw.grams, raw.bias, slope, shift)


def _calibrate(x: np.ndarray, y: np.ndarray, prevalence: float) -> tuple[float, float]:
    """Logistic regression on one number, the classes weighted as they occur."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    share = np.where(y == 1, prevalence / max(y.mean(), 1e-9), (1 - prevalence) / max(1 - y.mean(), 1e-9))
    scale = max(float(x.std()), 1e-6)
    z, w = (x - x.mean()) / scale, np.zeros(2)
    design = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (share * (p - y)) + 0.01 * w
        curve = (design * (share * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = PER_CLASS,
) -> Model:
    """A model from a bounded sample of the labelled documents outside the held-out fold.

    Rows without id or label and rows held out are never read for training. Of a document
    labelled more than once, every label counts.
    """
    fold = remainder(id_col, FOLDS)
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & (remainder("id", FOLDS) >= 0) & (remainder("id", FOLDS) != HELD_OUT)
    )
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ids below a hash that about so many of a class lie below, so few more reach the driver.
    place = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1_000_000))
    share = {c: min(1.0, 1.2 * per_class / n) for c, n in counts.items()}
    below = F.when(F.col("label") == 1, int(share.get(1, 0) * 1_000_000) + 1).otherwise(int(share.get(0, 0) * 1_000_000) + 1)
    sample = marked.filter(place < below)
    rows = (
        docs.filter((fold >= 0) & (fold != HELD_OUT))
        .select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
        .filter(F.length("text") <= LONGEST)
        .join(F.broadcast(sample), "id")  # some 1.2 * per_class ids of each class
        .withColumn("place", F.xxhash64("id", "text", "label"))
        .toPandas().sort_values(["place", "id"], kind="stable")
    )
    rows = rows.groupby("label").head(per_class).sort_values(["place", "id"], kind="stable")
    total = sum(counts.values())
    prevalence = counts.get(1, 0) / total if total else 0.0
    return train(rows["text"].tolist(), rows["label"].to_numpy(), prevalence)


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Null texts count as empty; texts without words get the score of the bias. A null id is
    not held out and not learned from. Without labels, or with one class only, every score
    is that class's prevalence. Repeated rows give a row each. An empty table gives no
    rows. Labels, languages and sources are never read for a score.
    """
    known = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col, label_col))
    fold = remainder(id_col, FOLDS)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (fold == HELD_OUT).alias("held_out"), text_or_empty(text_col).alias("text")
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, float] = {}
        for batch in slices(batches):
            scores = known.value.scores(batch["text"].to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["held_out"], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(scored, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, without a shuffle."""
    known = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col))
    position = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, float] = {}
        for batch in slices(batches):
            scores = known.value.scores(batch.column(position).to_pylist(), words)
            yield batch.filter(pa.array(scores < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
