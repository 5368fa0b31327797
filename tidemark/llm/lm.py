"""Language-model scores: causal self-attention over subword ids, trained in numpy.

Words are cut into subword ids by a public piece file. The model reads a window of ids
and gives the next one as (class of the id) x (id within its class). The class comes from
one head of causal self-attention; the id from counts over all training documents, at the
start of a word or behind an id of the same class as the one before. Both add up to one,
so the score of a text is a probability of its ids and its end. A class is itself predicted
as (group of classes) x (class in its group), so that a place needs the exponentials of
``GROUPS`` + ``IN_GROUP`` logits and not of all ``CLASSES``. The attention adds its logits to
what counts over all training documents say of classes behind the class before.

Windows of ``WINDOW`` ids overlap by ``LEAD``. Only what follows the lead of a window is
scored, so every id is scored once and sees at least ``LEAD`` ids of what came before;
windows of many documents are multiplied together.

The base score is a smoothed unigram model over words. Its counts grow with the corpus
and are never sent to every task: each block of documents asks for its distinct words and
is answered with their counts and ids, so a word is encoded once in all.

Every training document is learned from, whole. Which ids are known, which stand alone and
which share a class follows from counts of ids and of neighbouring ids over all of them, as do
groups, of classes that stand behind like classes.
The attention, a small one of ``DIMENSIONS`` dimensions that predicts one of ``CLASSES``
classes, starts from some steps on the driver over ``SAMPLE_DOCS`` documents, drawn by a
hash of id and text (of a text with more than ``LONGEST`` characters a stretch of that
length). Then every window of every training document is learned from once: in each of
``ROUNDS`` rounds tasks descend over their share from the same weights, and Spark averages
what they moved, by how often. What is learned depends a little on how tasks cut the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import answered, for_each_block, in_blocks, unpack_raw, unpack_texts
from tidemark.llm.common import remainder, slices, staged, stretch

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS = 7
HELD_OUT = 2

WINDOW = 32
LEAD = 16
STEP = WINDOW - LEAD
DIMENSIONS = 16
#: Classes: the most frequent ids alone, the others by the company they keep, unseen ones.
ALONE = 64
CLASSES = 128
#: Classes with consecutive numbers make a group: a class is predicted as group x class in group.
IN_GROUP = 16
GROUPS = CLASSES // IN_GROUP
#: Most frequent ids whose company tells classes apart.
WIDE = 4 * ALONE
SAMPLE_DOCS = 1_600
LONGEST = 12_000
EPOCHS = 4
BATCH = 64
RATE = 0.02
#: Rates of the rounds over all training documents, and windows of a step.
ROUNDS = (0.004, 0.002, 0.001)
TOGETHER = 128
#: Words encoded at once; windows multiplied at once when scoring, and laid out at once;
#: ids whose neighbours are looked up at once, and neighbours counted at once.
WORDS_AT_ONCE = 2_000
WINDOWS_AT_ONCE = 256
WINDOWS_LAID_OUT = 16_384
IDS_AT_ONCE = 400_000
#: Bytes of words that are looked up at once.
BYTES_AT_ONCE = 16 << 20
NEIGHBOURS_AT_ONCE = 4_000_000

#: Weight of the share over all contexts.
BACK_OFF = 5.0

START = 1
END = 2
LN10 = float(np.log(10.0))


def words_of(text: bytes) -> list[bytes]:
    """Words in ASCII lower case."""
    return text.lower().split()


class Subwords:
    """Ids of words by the piece file; loaded once in a process."""

    loaded: dict[str, object] = {}

    def __init__(self, model_file: str):
        self.model_file = model_file

    def model(self):
        if self.model_file not in self.loaded:
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=self.model_file)
            names = map(processor.id_to_piece, range(processor.get_piece_size()))
            self.loaded[self.model_file] = processor, np.array([n.startswith("▁") for n in names])
        return self.loaded[self.model_file]

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has.

        Words are encoded in one text, as no piece goes on behind a space; every word then
        starts with a piece that starts with the mark of one.
        """
        processor, starts = self.model()
        flat, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), WORDS_AT_ONCE):
            part = words[i : i + WORDS_AT_ONCE]
            own = np.array(processor.encode(b" ".join(part).decode("utf-8")), np.int64)
            first = np.flatnonzero(starts[own])
            if len(first) != len(part):  # a word holds the mark itself
                each = processor.encode([w.decode("utf-8") for w in part], num_threads=1)
                own = np.array([x for ids in each for x in ids], np.int64)
                sizes.append(np.array(list(map(len, each)), np.int64))
            else:
                sizes.append(np.diff(first, append=len(own)))
            flat.append(own)
        return np.concatenate(flat), np.concatenate(sizes)

    def size(self) -> int:
        return self.model()[0].get_piece_size()

    def starts(self) -> np.ndarray:
        """Which ids start a word, the end of a text among them."""
        found = self.model()[1].copy()
        found[END] = True
        return found


# Model -----------------------------------------------------------------------------


def windows_of(
    ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, first: int = 0, last: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over sequences laid end to end, the ids they predict, and whose they are.

    Sequence i is START followed by ``counts[i]`` ids from ``starts[i]``; its window k has
    the inputs STEP * k - LEAD to STEP * (k + 1) and predicts from those behind the lead.
    Before START and behind the last id stands -1. Of the windows of all sequences, those
    from number ``first`` up to ``last`` are given.
    """
    ends = np.cumsum(windows_in(counts))
    total = int(ends[-1]) if len(ends) else 0
    number = np.arange(first, total if last is None else min(last, total))
    owner = np.searchsorted(ends, number, side="right")
    nth = number - np.concatenate([[0], ends])[owner]
    place = (nth * STEP)[:, None] + np.arange(-LEAD, STEP)[None, :]  # place 0 is START
    at = starts[owner][:, None] + place - 1
    inside = (place > 0) & (place <= counts[owner][:, None])
    inputs = np.where(inside, ids[np.where(inside, at, 0)], -1)
    inputs[place == 0] = START
    next_inside = inside_next(place[:, LEAD:], counts[owner])
    targets = np.where(next_inside, ids[np.where(next_inside, at[:, LEAD:] + 1, 0)], -1)
    return inputs, targets, owner


def windows_in(counts: np.ndarray) -> np.ndarray:
    """How many windows sequences of so many ids have."""
    return -(-counts // STEP)


def inside_next(place: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a place has a next id to predict."""
    return place < counts[:, None]


def _exponentials(x: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials in place, of values up to ``most``, and their sums over the last axis.

    A product with ones adds up short rows faster than a sum does.
    """
    np.minimum(x, most, out=x)
    np.exp(x, out=x)
    return x, np.maximum(x @ np.ones((x.shape[-1], 1), x.dtype), np.float32(1e-30))


_CAUSAL = np.where(np.arange(WINDOW)[None, :] <= np.arange(STEP)[:, None] + LEAD, 0.0, -1e9).astype(np.float32)


def _product(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Windows times a matrix, as one product."""
    return (x.reshape(-1, x.shape[-1]) @ weights).reshape(*x.shape[:-1], weights.shape[1])


#: Which columns of a row of logits are for groups, and which for the classes of one.
_PARTS = np.repeat(np.eye(2, dtype=np.float32), (GROUPS, IN_GROUP), axis=0)


def beside_each_group(top: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Values of all groups (last axis) and, for each group, those of its classes: (..., group, columns)."""
    found = np.empty((*out.shape[:-1], GROUPS, GROUPS + IN_GROUP), out.dtype)
    found[..., :GROUPS] = top[..., None, :]
    found[..., GROUPS:] = out.reshape(found.shape[:-1] + (IN_GROUP,))
    return found


def by_group(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts classes of a group together, and where in it each group stands."""
    group = (classes // IN_GROUP).astype(np.uint8)
    edges = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=GROUPS))]).tolist()
    runs = [(g, a, b) for g, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]
    return np.argsort(group, kind="stable"), runs


def class_exponentials(
    flat: np.ndarray, context: np.ndarray, group: np.ndarray, runs: list, weights: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials for all groups and for the classes of ``group``, and the sums of both.

    Rows of a group stand together. Logits are cut to bounds that exponentials can take.
    """
    logits = offsets.reshape(-1, GROUPS + IN_GROUP).take(context * GROUPS + group, axis=0)
    for g, a, b in runs:
        logits[a:b] += flat[a:b] @ weights[g]
    np.minimum(logits, 80, out=logits)
    np.maximum(logits, -80, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ _PARTS.astype(logits.dtype, copy=False)


def _hide(scores: np.ndarray, inputs: np.ndarray) -> None:
    """Take what is behind a place, and places without an id, from the scores of windows."""
    scores += _CAUSAL
    at = np.flatnonzero((inputs[:, 0] < 0) | (inputs[:, -1] < 0))
    if len(at):
        scores[at] += np.where(inputs[at] < 0, np.float32(-1e9), np.float32(0))[:, None, :]


#: Weights in rows of ``DIMENSIONS`` (or columns, where turned), and those of one dimension.
WEIGHTS = ("embedding", "position", "query", "key", "value", "top", "out")
TURNED = ("top", "out")
FLAT = ("top_bias", "bias")


@dataclass
class Attention:
    """One causal head over embedded ids, with a residual, in front of a softmax over groups of
    classes and one over the classes of a group. It adds to what the class before says alone."""

    row: np.ndarray  # id -> row of the embedding; the last row stands for ids not in the sample
    embedding: np.ndarray
    position: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    top: np.ndarray
    top_bias: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    #: Row of an id in ``prior``, which has log shares of groups and classes by the class before.
    context: np.ndarray
    prior: np.ndarray

    @classmethod
    def fresh(cls, row: np.ndarray, rows: int, classes: int, rng: np.random.Generator) -> Attention:
        def random(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        d = DIMENSIONS
        return cls(
            row, random(rows, d, scale=0.3), random(WINDOW, d, scale=0.1), *(random(d, d, scale=d**-0.5) for _ in range(3)),
            random(d, classes // IN_GROUP, scale=0.1), np.zeros(classes // IN_GROUP, np.float32),
            random(d, classes, scale=0.1), np.zeros(classes, np.float32),
            np.zeros(len(row), np.int64), np.zeros((1, GROUPS, GROUPS + IN_GROUP), np.float32),
        )

    def weights(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in (*WEIGHTS, *FLAT)}

    def with_ids(self, ids: np.ndarray, of: np.ndarray) -> Attention:
        """Also knows ``ids``: a new one starts where those of its class are on average."""
        known = len(self.embedding) - 1
        have = np.flatnonzero(self.row[:-1] < known)
        sums = np.zeros((CLASSES, DIMENSIONS), np.float32)
        np.add.at(sums, of[have], self.embedding[self.row[have]])
        centres = sums / np.maximum(np.bincount(of[have], minlength=CLASSES), 1)[:, None].astype(np.float32)
        new = np.setdiff1d(ids, have)
        row = np.full(len(self.row), known + len(new), np.int64)
        row[have] = self.row[have]
        row[new] = known + np.arange(len(new))
        return replace(self, row=row, embedding=np.concatenate([self.embedding[:-1], centres[of[new]], self.embedding[-1:]]))

    def rows(self) -> np.ndarray:
        """All weights, laid out in rows of one width; those of the embedding come first."""
        flat = np.concatenate([getattr(self, n) for n in FLAT])
        parts = [getattr(self, n).T if n in TURNED else getattr(self, n) for n in WEIGHTS]
        return np.concatenate([*parts, np.pad(flat, (0, -len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)])

    def with_rows(self, rows: np.ndarray) -> Attention:
        """A model of its own with these weights."""
        found, at, rows = {}, 0, rows.astype(np.float32)
        for name in WEIGHTS:
            weight = getattr(self, name)
            part = rows[at : at + weight.size // DIMENSIONS]
            found[name] = np.ascontiguousarray(part.T) if name in TURNED else part.copy()
            at += len(part)
        flat = rows[at:].ravel()
        for name in FLAT:
            size = getattr(self, name).size
            found[name], flat = flat[:size].copy(), flat[size:]
        return replace(self, **found)

    def never(self, empty: np.ndarray) -> None:
        """Classes without ids can never be right, nor groups without others."""
        self.bias[empty] = -1e4
        self.top_bias[empty.reshape(GROUPS, IN_GROUP).all(axis=1)] = -1e4

    def forward(self, inputs: np.ndarray) -> tuple:
        """What the gradients need: inputs, projections (keys beside values), attention and its result."""
        x = self.embedding.take(self.row.take(inputs, mode="wrap"), axis=0)
        x += self.position
        ahead = np.ascontiguousarray(x[:, LEAD:])
        q = _product(ahead, self.query * np.float32(DIMENSIONS**-0.5))
        both = _product(x, np.concatenate([self.key, self.value], axis=1))
        scores = q @ both[:, :, :DIMENSIONS].transpose(0, 2, 1)
        # A place behind the end sees only itself and START's window; it is never scored.
        _hide(scores, inputs)
        a, total = _exponentials(scores, 60)
        a /= total
        return x, ahead, q, both, a, a @ both[:, :, DIMENSIONS:]

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over places whose target is not -1, and its gradients."""
        loss, slopes, ids, own = self.slopes(inputs, targets)
        d_embedding = np.zeros_like(self.embedding)
        d_embedding[ids] = own
        return loss, {"embedding": d_embedding, **slopes}

    def slopes(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict, np.ndarray, np.ndarray]:
        """Loss, gradients, rows of the embedding that the inputs name, and the gradients of these."""
        d = DIMENSIONS
        x, ahead, q, both, a, found = self.forward(inputs)
        target = targets.ravel()
        at = np.flatnonzero(target >= 0)
        order, runs = by_group(target[at])
        at = at[order]
        group, within = np.divmod(target[at], IN_GROUP)
        flat = (found + ahead).reshape(-1, d).take(at, axis=0)
        weights = beside_each_group(self.top, self.out).transpose(1, 0, 2)
        context = self.context.take(inputs[:, LEAD:].ravel()[at])
        e, sums = class_exponentials(flat, context, group, runs, weights, self.prior + beside_each_group(self.top_bias, self.bias))
        # A row of exponentials by its sums, less one at the target, is the slope of the loss by the logits.
        e *= (1 / sums) @ _PARTS.T.astype(e.dtype, copy=False)
        cell = np.arange(0, e.size, e.shape[1]) + np.stack([group, GROUPS + within])
        right = e.ravel()[cell]
        loss = -float(np.log(right[0] * right[1] + 1e-12).mean())
        e.ravel()[cell] = right - 1
        e *= np.float32(1 / len(at))
        d_flat, d_weights, d_offsets = np.empty_like(flat), np.zeros_like(weights), np.zeros_like(weights[:, 0])
        for g, first, last in runs:
            part = e[first:last]
            np.matmul(part, weights[g].T, out=d_flat[first:last])
            d_weights[g] = flat[first:last].T @ part
            d_offsets[g] = np.ones(last - first, e.dtype) @ part
        d_h = np.zeros_like(found)
        d_h.reshape(-1, d)[at] = d_flat
        d_a = d_h @ both[:, :, d:].transpose(0, 2, 1)
        d_a -= np.einsum("bij,bij->bi", d_h, found)[:, :, None]
        d_a *= a
        d_both = np.empty_like(both)
        np.matmul(d_a.transpose(0, 2, 1), q, out=d_both[:, :, :d])
        np.matmul(a.transpose(0, 2, 1), d_h, out=d_both[:, :, d:])
        d_q = d_a @ both[:, :, :d]
        d_x = _product(d_both, np.concatenate([self.key, self.value], axis=1).T)
        d_h += _product(d_q, self.query.T * np.float32(d**-0.5))
        d_x[:, LEAD:] += d_h

        def outer(left, right):
            return left.reshape(-1, d).T @ right.reshape(-1, right.shape[-1])

        rows = self.row.take(inputs.ravel(), mode="wrap")
        order = np.argsort(rows.astype(np.uint16) if len(self.embedding) <= 1 << 16 else rows, kind="stable")
        in_order = rows[order]
        first = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        own = np.add.reduceat(d_x.reshape(-1, d).take(order, axis=0), first)
        d_key, d_value = np.split(outer(x, d_both), 2, axis=1)
        return loss, {
            "position": (np.ones(len(d_x), d_x.dtype) @ d_x.reshape(len(d_x), -1)).reshape(self.position.shape),
            "query": outer(ahead, d_q) * np.float32(d**-0.5), "key": d_key, "value": d_value,
            "top": d_weights[:, :, :GROUPS].sum(axis=0), "top_bias": d_offsets[:, :GROUPS].sum(axis=0),
            "out": d_weights[:, :, GROUPS:].transpose(1, 0, 2).reshape(self.out.shape), "bias": d_offsets[:, GROUPS:].ravel(),
        }, in_order[first], own


class Descent:
    """Steps of Adam on a model in place; a row of the embedding moves when an input names it.

    The other weights move together: they become parts of one array.
    """

    def __init__(self, model: Attention, of: np.ndarray):
        self.model = model
        self.empty = np.bincount(of, minlength=CLASSES) == 0
        weights = {n: w for n, w in model.weights().items() if n != "embedding"}
        self.names, together, at = list(weights), np.concatenate([w.ravel() for w in weights.values()]), 0
        for name, weight in weights.items():
            setattr(model, name, together[at : at + weight.size].reshape(weight.shape))
            at += weight.size
        self.moving = [(w, np.zeros_like(w), np.zeros_like(w)) for w in (model.embedding, together)]
        self.steps = 0

    def step(self, inputs: np.ndarray, targets: np.ndarray, rate: float) -> np.ndarray:
        """The rows of the embedding that moved."""
        _, slopes, ids, own = self.model.slopes(inputs, targets)
        self.steps += 1
        self._move(self.moving[1], None, np.concatenate([slopes[n].ravel() for n in self.names]), rate)
        self._move(self.moving[0], ids, own, rate)
        self.model.never(self.empty)
        return ids

    def _move(self, moving: tuple, at: np.ndarray | None, slope: np.ndarray, rate: float) -> None:
        """Move rows ``at``, or all; ``slope`` is used up."""
        weight, first, second = moving if at is None else (part.take(at, axis=0) for part in moving)
        first *= 0.9
        first += 0.1 * slope
        second *= 0.99
        slope *= slope
        slope *= 0.01
        second += slope
        width = np.sqrt(second, out=slope)
        width *= (1 - 0.99**self.steps) ** -0.5
        width += 1e-8
        move = first / width
        move *= rate / (1 - 0.9**self.steps)
        weight -= move
        if at is not None:
            for whole, part in zip(moving, (weight, first, second)):
                whole[at] = part


class LanguageModel:
    """Attention over classes, and the share of each id in its class by context (log, base e).

    For scoring, the projections of every embedded id are tables, so a window is looked up
    and only multiplied with itself and with the classes.
    """

    def __init__(self, attention: Attention, of: np.ndarray, inside: np.ndarray, starts: np.ndarray):
        self.of, self.row, self.starts = of, attention.row, starts
        # Ids with the same share in every context have one column.
        _, first, self.column = np.unique(inside, axis=1, return_index=True, return_inverse=True)
        self.inside = np.ascontiguousarray(inside[:, first])
        scale = np.float32(DIMENSIONS**-0.5)
        place, late = attention.position, attention.position[LEAD:]
        # Queries beside embeddings, and keys beside values.
        queries = np.concatenate([attention.query * scale, np.eye(DIMENSIONS, dtype=np.float32)], axis=1)
        pairs = np.concatenate([attention.key, attention.value], axis=1)
        self.late = attention.embedding @ queries, late @ queries
        self.both = attention.embedding @ pairs, place @ pairs
        self.weights = np.ascontiguousarray(beside_each_group(attention.top, attention.out).transpose(1, 0, 2))
        self.context = attention.context
        self.offsets = attention.prior + beside_each_group(attention.top_bias, attention.bias)

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each target, 0 where there is none."""
        rows = self.row.take(inputs, mode="wrap")
        late, both = self.late[0].take(rows[:, LEAD:], axis=0), self.both[0].take(rows, axis=0)
        late += self.late[1]
        both += self.both[1]
        a = late[:, :, :DIMENSIONS] @ both[:, :, :DIMENSIONS].transpose(0, 2, 1)
        _hide(a, inputs)
        a, total = _exponentials(a, 60)
        h = a @ both[:, :, DIMENSIONS:]
        h /= total
        h += late[:, :, DIMENSIONS:]
        target = targets.ravel()
        at = np.flatnonzero(target >= 0)
        order, runs = by_group(self.of[target[at]])
        at = at[order]
        target, before = target[at], inputs[:, LEAD:].ravel()[at]
        group, within = np.divmod(self.of[target], IN_GROUP)
        flat = h.reshape(-1, DIMENSIONS).take(at, axis=0)
        context = np.where(self.starts[target], CLASSES, self.of[before])
        own = self.inside[context, self.column[target]].astype(np.float64)
        e, sums = class_exponentials(flat, self.context.take(before), group, runs, self.weights, self.offsets)
        cell = np.arange(0, e.size, e.shape[1])
        own += np.log(e.ravel()[cell + group] / sums[:, 0])
        own += np.log(e.ravel()[cell + GROUPS + within] / sums[:, 1])
        found = np.zeros(targets.size)
        found[at] = own
        return found.reshape(targets.shape)

    def score(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of each sequence."""
        total = np.zeros(len(counts))
        for first in range(0, int(windows_in(counts).sum()), WINDOWS_LAID_OUT):
            inputs, targets, owner = windows_of(ids, starts, counts, first, first + WINDOWS_LAID_OUT)
            # Windows at an end of a sequence need a mask: keep them together.
            order = np.argsort((inputs[:, 0] < 0) | (inputs[:, -1] < 0), kind="stable")
            for i in range(0, len(order), WINDOWS_AT_ONCE):
                part = order[i : i + WINDOWS_AT_ONCE]
                own = self.log_probabilities(inputs[part], targets[part]).sum(axis=1)
                np.add.at(total, owner[part], own)
        return total / LN10


class Neighbours:
    """How often ids that may share a class stand beside the most frequent ids.

    A cell is (id, one of ``WIDE`` ids behind it or before it).
    """

    def __init__(self, seen: np.ndarray):
        self.kind = kind_of(len(seen))
        frequent = np.lexsort((np.arange(len(seen)), -seen))
        frequent = frequent[seen[frequent] > 0]
        self.alone, self.rest = frequent[:ALONE], frequent[ALONE:]
        self.row, self.near = np.full(len(seen), -1, np.int32), np.full(len(seen), -1, np.int32)
        self.row[self.rest] = np.arange(len(self.rest))
        self.near[frequent[:WIDE]] = np.arange(len(frequent[:WIDE]))

    def cells(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The cells of all neighbours in sequences of ``counts`` ids, laid end to end."""
        row, near = self.row[ids], self.near[ids]
        apart = np.ones(max(len(ids) - 1, 0), bool)
        ends = np.cumsum(counts)[:-1]
        apart[ends[(ends > 0) & (ends < len(ids))] - 1] = False
        found = []
        for mine, other, side in ((row[:-1], near[1:], 0), (row[1:], near[:-1], WIDE)):
            keep = (mine >= 0) & (other >= 0) & apart
            found.append(mine[keep] * np.int32(2 * WIDE) + np.int32(side) + other[keep])
        return np.concatenate(found)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells of training documents with how often they occur."""

        def counted() -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n)], names=["cell", "n"])

        held = []
        for ids, counts in learned(batches, self.kind):
            ends = np.cumsum(counts)
            for at in range(0, len(ids), IDS_AT_ONCE):
                part = ids[at : at + IDS_AT_ONCE + 1]  # the last one stands beside the next part's first
                held.append(self.cells(part, np.diff(np.clip(ends - at, 0, len(part)), prepend=0)))
                if sum(map(len, held)) > NEIGHBOURS_AT_ONCE:
                    yield counted()
                    held = []
        if held:
            yield counted()

    def classes(self, seen: np.ndarray, starts: np.ndarray, cell: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Class of every id: frequent ids alone, others by k-means over their neighbours.

        Ids that start a word and ids that do not are never in one class; the last two classes
        are for ids of either kind that were not seen. ``in_groups`` numbers classes anew.
        """
        of = np.where(starts, CLASSES - 2, CLASSES - 1)
        of[self.alone] = np.arange(len(self.alone))
        table = np.zeros(len(self.rest) * 2 * WIDE, np.float32)
        table[cell] = np.sqrt(n)
        table = table.reshape(len(self.rest), 2 * WIDE)
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)
        groups = (CLASSES - 2 - ALONE) // 2
        for kind, first in ((True, ALONE), (False, ALONE + groups)):
            mine = np.flatnonzero(starts[self.rest] == kind)
            if len(mine):
                rest = self.rest[mine]
                of[rest] = first + _grouped(table[mine], np.sqrt(seen[rest], dtype=np.float32), min(groups, len(mine)))
        return of


def classes_of(sample: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Class of every id from sequences that are at hand."""
    flat, lengths = np.concatenate([np.zeros(0, np.int64), *sample]), np.array(list(map(len, sample)), np.int64)
    seen = np.bincount(flat, minlength=len(starts))
    beside = Neighbours(seen)
    of = beside.classes(seen, starts, *np.unique(beside.cells(flat, lengths), return_counts=True))
    return in_groups(of, pairs_of(flat, lengths, of))[0]


def _grouped(table: np.ndarray, weight: np.ndarray, groups: int) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(3)
    centres = table[rng.choice(len(table), groups, replace=False, p=weight / weight.sum(dtype=np.float64))]
    for _ in range(12):
        group = np.argmax(table @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, table * weight[:, None])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centres)
    return np.argmax(table @ centres.T, axis=1)


def contexts(ids: np.ndarray, of: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What an id's share in its class depends on: the class before it, or the start of a word."""
    before = np.concatenate([[CLASSES], of[ids[:-1]]]) if len(ids) else np.zeros(0, np.int64)
    return np.where(starts[ids], CLASSES, before)


def shares(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """log share of each id in its class by context (rows), from counts by context.

    A context falls back on the share over all contexts, as if that had been seen
    ``BACK_OFF`` times; every id has been seen a tenth of a time.
    """
    mass = counts.sum(axis=0) + 0.1
    plain = mass / np.bincount(of, weights=mass, minlength=CLASSES)[of]
    found = np.empty(counts.shape, np.float32)
    for i, own in enumerate(counts):
        total = np.bincount(of, weights=own, minlength=CLASSES)
        found[i] = np.log((own + BACK_OFF * plain) / (total[of] + BACK_OFF))
    return found


def prior_of(pairs: np.ndarray) -> np.ndarray:
    """log shares of groups, and of classes in each group, by the class before (rows).

    ``pairs`` counts (class before, or ``CLASSES`` at the start of a text; class). A row falls
    back on the shares over all rows, as if those had been seen ``BACK_OFF`` times.
    """

    def logs(counts: np.ndarray) -> np.ndarray:
        mass = counts.sum(axis=0) + 0.1
        plain = mass / mass.sum(axis=-1, keepdims=True)
        return np.log((counts + BACK_OFF * plain) / (counts.sum(axis=-1, keepdims=True) + BACK_OFF))

    within = pairs.reshape(len(pairs), GROUPS, IN_GROUP)
    top, classes = logs(within.sum(axis=2)), logs(within)
    return beside_each_group(top, classes.reshape(pairs.shape)).astype(np.float32)


def with_prior(model: Attention, pairs: np.ndarray, of: np.ndarray) -> Attention:
    """``model`` on top of counts of classes behind each other."""
    context = of.copy()
    context[START] = CLASSES  # no text holds it
    return replace(model, context=context, prior=prior_of(pairs))


def pairs_of(ids: np.ndarray, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """How often a class (columns) stands behind another, or at the start of a sequence (last row)."""
    begins, found = (np.cumsum(counts) - counts)[counts > 0], np.zeros((CLASSES + 1) * CLASSES, np.int64)
    for at in range(0, len(ids), IDS_AT_ONCE):
        classes = of[ids[max(at - 1, 0) : at + IDS_AT_ONCE]]
        before, own = (np.append(CLASSES, classes[:-1]), classes) if at == 0 else (classes[:-1].copy(), classes[1:])
        before[begins[np.searchsorted(begins, at) : np.searchsorted(begins, at + len(own))] - at] = CLASSES
        found += np.bincount(before * CLASSES + own, minlength=len(found))
    return found.reshape(CLASSES + 1, CLASSES)


def in_groups(of: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes numbered anew and their ``pairs``: those that stand behind like classes make a group.

    Classes are halved along the widest direction of what stands before them, until a half is a group.
    """
    mass = pairs.sum(axis=0)
    before, weight = np.sqrt(pairs.T / np.maximum(mass, 1)[:, None]), np.sqrt(mass + 1)

    def halved(part: np.ndarray) -> list[np.ndarray]:
        if len(part) <= IN_GROUP:
            return [part]
        rows, own = before[part], weight[part, None]
        rows = rows - (rows * own).sum(axis=0) / own.sum()
        widest = np.linalg.svd(rows * np.sqrt(own), full_matrices=False)[2][0]
        part = part[np.argsort(rows @ widest, kind="stable")]
        return halved(part[: len(part) // 2]) + halved(part[len(part) // 2 :])

    order = np.concatenate(halved(np.arange(CLASSES)))
    number = np.argsort(order)
    return number[of], pairs[np.append(order, CLASSES)][:, order]


def train(sample: list[np.ndarray], of: np.ndarray) -> Attention:
    """The attention over classes, from the sampled id sequences.

    Without a sample all classes that have ids are equally likely.
    """
    size = len(of)
    known = sorted({START}.union(*(set(ids.tolist()) for ids in sample)))
    row = np.full(size + 1, len(known), np.int64)
    row[known] = np.arange(len(known))
    rng = np.random.default_rng(5)
    model = Attention.fresh(row, len(known) + 1, CLASSES, rng)
    empty = np.bincount(of, minlength=CLASSES) == 0
    model.never(empty)
    if not any(len(ids) for ids in sample):
        model.top_bias[:] = np.log(np.maximum((~empty).reshape(GROUPS, IN_GROUP).sum(axis=1), 1))
        model.top[:] = model.out[:] = 0
        model.never(empty)
        return model
    lengths = np.array([len(s) for s in sample], np.int64)
    flat = np.concatenate(sample)
    model = with_prior(model, pairs_of(flat, lengths, of), of)
    inputs, targets, _ = windows_of(flat, np.cumsum(lengths) - lengths, lengths)
    classes = np.where(targets >= 0, of[targets], -1)
    descent, total = Descent(model, of), EPOCHS * -(-len(inputs) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            done = descent.steps + 1
            descent.step(inputs[part], classes[part], RATE * min(1.0, done / 50) * (1 - 0.95 * done / total))
    return model


# Spark side ------------------------------------------------------------------------


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each block, with how often its training documents have them."""

    def rows(block: int, others: set, counts: Counter) -> pa.RecordBatch:
        words = [*counts, *others.difference(counts)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * len(words), pa.int64()), pa.array(words, pa.binary()),
                pa.array([counts.get(w, 0) for w in words], pa.int64()),
            ],
            names=["block", "word", "n"],
        )

    current, seen, counts = None, set(), Counter()
    for batch in slices(batches):
        for block, mark, text in zip(*(batch[c].to_pylist() for c in ("block", "mark", "text"))):
            if block != current and (seen or counts):
                yield rows(current, seen, counts)
                seen, counts = set(), Counter()
            current = block
            (counts if mark else seen).update(words_of(text.encode("utf-8")))
    if seen or counts:
        yield rows(current, seen, counts)


def _encoded(subwords: Subwords):
    """Each word's count and ids in one list."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = subwords.ids(batch["word"].to_pylist())
            heads = np.cumsum(sizes) - sizes
            values = np.insert(flat, heads, batch["n"].to_numpy(zero_copy_only=False))
            at = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], lists], names=["word", "n", "values"])

    return encode


def _split(counts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count of each word, all ids in a row and how many each word has, from lists of both."""
    heads = np.cumsum(counts) - counts
    return values[heads], np.delete(values, heads), counts - 1


class IdCounts:
    """How often every id occurs in every context, from the counts of words."""

    def __init__(self, of: np.ndarray, starts: np.ndarray):
        self.of, self.starts = of, starts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(self.of)
        for batch in batches:
            lists = batch["values"]
            each, flat, sizes = _split(lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy())
            n = np.repeat(each, sizes)
            cell, where = np.unique(contexts(flat, self.of, self.starts) * size + flat, return_inverse=True)
            total = np.bincount(where, weights=n, minlength=len(cell)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total)], names=["cell", "n"])


@dataclass(frozen=True)
class Unigram:
    """log10((c + 1) / (N + 1 * (V + 1))) over training tokens."""

    tokens: int
    distinct: int
    ends: int

    def log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.distinct + 1))


#: Documents of a block, some in a row: what is known of each, and the ids of all in a row.
ENCODED = (
    "ids array<long>, marks array<int>, tokens array<long>, known array<long>, base array<double>, "
    "lengths array<long>, pieces binary"
)
#: Rows of ENCODED are large: few are read at once.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4", "spark.sql.files.maxPartitionBytes": "16m"}


class Encoder:
    """Subword ids and base score of the documents of a block."""

    def __init__(self, unigram: Unigram, size: int):
        self.unigram, self.kind = unigram, kind_of(size)

    def block(self, texts: pa.Table, answers: pa.Table) -> pa.Table:
        raw, letters, lengths, values = unpack_raw(answers)
        count, pieces, sizes = _split(lengths.astype(np.int64), values)
        words = _binaries(raw, letters)
        del values, lengths
        pieces, sizes = pieces.astype(self.kind), sizes.astype(np.int32)
        begins = np.cumsum(sizes) - sizes
        base, seen = self.unigram.log10(count), count > 0
        end = float(self.unigram.log10(np.array(self.unigram.ends)))
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for marks, keys, many, own in numbered(texts, words):
            each = sizes[own]
            lengths = _sums(each, many) + 1
            # Every document ends with the end.
            ids = np.full(int(lengths.sum()), END, self.kind)
            inside = np.ones(len(ids), bool)
            inside[np.cumsum(lengths) - 1] = False
            ids[inside] = pieces[np.repeat(begins[own] - (np.cumsum(each) - each), each) + np.arange(len(ids) - len(many))]
            rows.append([
                pa.array(keys, pa.int64()), marks.values, pa.array(many + 1),
                pa.array(_sums(seen[own], many) + (self.unigram.ends > 0)), pa.array(_sums(base[own], many) + end),
                pa.array(lengths), pack(ids.tobytes()),
            ])
        *lists, packs = zip(*rows)
        at = pa.array(np.concatenate([[0], np.cumsum(list(map(len, lists[0])))]).astype(np.int32))
        columns = [pa.ListArray.from_arrays(at, pa.concat_arrays(column)) for column in lists]
        return pa.table([*columns, pa.array(packs, pa.binary())], names=["ids", "marks", "tokens", "known", "base", "lengths", "pieces"])


def _binaries(raw: bytes, sizes: np.ndarray) -> pa.Array:
    """Values of so many bytes, cut out of ``raw``."""
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(raw)])


def numbered(texts: pa.Table, words: pa.Array) -> Iterator[tuple[pa.Scalar, list, np.ndarray, np.ndarray]]:
    """Marks and ids of some documents at a time, how many words each has, and where these stand in ``words``."""

    def found() -> Iterator[tuple]:
        own = pc.index_in(pa.chunked_array([h[-1] for h in held], words.type), value_set=words).to_numpy()
        ends = np.cumsum([len(h[-1]) for h in held])  # the answer leaves out chunks without words
        for (*rest, _), part in zip(held, np.split(own, ends[:-1])):
            yield *rest, part

    held, size = [], 0
    for marks, (keys, packed) in zip(texts["marks"], unpack_texts(texts)):
        split = list(map(words_of, packed))
        many = np.array(list(map(len, split)), np.int64)
        held.append((marks, keys, many, pa.array(list(chain.from_iterable(split)), words.type)))
        size += held[-1][-1].nbytes
        if size > BYTES_AT_ONCE:
            yield from found()
            held, size = [], 0
    if held:
        yield from found()
    held.clear()
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of runs of so many values."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    found, some = np.zeros(len(many), kind), many > 0
    if some.any():
        found[some] = np.add.reduceat(values.astype(kind), (np.cumsum(many) - many)[some])
    return found


def kind_of(size: int) -> type:
    """Numbers that hold the ids of a piece file of ``size`` pieces."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def unpack_ids(batch: pa.RecordBatch, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the documents of each row, laid end to end, and how many each document has."""
    for lengths, pieces in zip(batch["lengths"], batch["pieces"]):
        raw = zstandard.ZstdDecompressor().decompress(pieces.as_py())
        yield np.frombuffer(raw, kind).astype(np.int64), np.array(lengths.as_py(), np.int64)


def learned(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and lengths of training documents only."""
    for batch in batches:
        for marks, (ids, lengths) in zip(batch["marks"].to_pylist(), unpack_ids(batch, kind)):
            trains = np.array(marks) == 1
            if trains.any():
                yield ids[np.repeat(trains, lengths)], lengths[trains]


class Pairs:
    """How often classes stand behind each other in training documents."""

    def __init__(self, of: np.ndarray):
        self.of, self.kind = of, kind_of(len(of))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1, CLASSES), np.int64)
        for ids, counts in learned(batches, self.kind):
            total += pairs_of(ids, counts, self.of)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total.ravel()[cell])], names=["cell", "n"])


#: A row of the weights, how many steps moved it, and its values times that.
MOVED = ", ".join(["row int", "weight double", *(f"w{i} double" for i in range(DIMENSIONS))])


class Teacher:
    """One descent over the training documents of a task, from weights that all tasks share."""

    def __init__(self, start, rate: float, kind: type):
        self.start, self.rate, self.kind = start, rate, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, of = self.start.value
        model = shared.with_rows(shared.rows())
        descent, rng = Descent(model, of), np.random.default_rng(7)
        moved = np.zeros(len(model.embedding))
        for ids, counts in learned(batches, self.kind):
            starts = np.cumsum(counts) - counts
            for first in range(0, int(windows_in(counts).sum()), WINDOWS_LAID_OUT):
                inputs, targets, _ = windows_of(ids, starts, counts, first, first + WINDOWS_LAID_OUT)
                classes = np.where(targets >= 0, of[targets], -1)
                order = rng.permutation(len(inputs))
                for i in range(0, len(order), TOGETHER):
                    part = order[i : i + TOGETHER]
                    moved[descent.step(inputs[part], classes[part], self.rate * min(1.0, (descent.steps + 1) / 50))] += 1
        if descent.steps:
            rows = model.rows().astype(np.float64)
            weight = np.concatenate([moved, np.full(len(rows) - len(moved), float(descent.steps))])
            at = np.flatnonzero(weight)
            sums = (rows[at] * weight[at, None]).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(weight[at]), *map(pa.array, np.ascontiguousarray(sums))],
                names=["row", "weight", *(f"w{i}" for i in range(DIMENSIONS))],
            )


def taught(encoded: DataFrame, model: Attention, of: np.ndarray) -> Attention:
    """``model`` after every training document was learned from, each in one of the rounds."""
    spark = encoded.sparkSession
    kind = kind_of(len(of))
    values = [f"w{i}" for i in range(DIMENSIONS)]
    for nth, rate in enumerate(ROUNDS):
        start = spark.sparkContext.broadcast((model, of))
        share = encoded.filter(F.pmod(F.xxhash64("ids"), F.lit(len(ROUNDS))) == nth)
        moved = share.select("marks", "lengths", "pieces").mapInArrow(Teacher(start, rate, kind), MOVED)
        sums = staged(moved.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("weight", *values))), "weights", **FEW_ROWS)
        # At most a row for every id of the piece file and the few others.
        found, rows = sums.toArrow(), model.rows()
        if found.num_rows:
            weight = found["weight"].to_numpy()
            rows[found["row"].to_numpy()] = np.stack([found[c].to_numpy() / weight for c in values], axis=1)
        model = model.with_rows(rows)
        start.unpersist()
    return model


class Scorer:
    """Both scores of encoded documents."""

    def __init__(self, tokens: int, model, kind: type):
        self.tokens, self.model, self.kind = tokens, model, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (ids, lengths) in enumerate(unpack_ids(batch, self.kind)):
                keys, marks, tokens, known, base = (batch[c][i].values for c in ("ids", "marks", "tokens", "known", "base"))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys, pa.array(marks.to_numpy() == 0), tokens, known, pa.array([self.tokens] * len(keys), pa.int64()),
                        base, pa.array(self.model.value.score(ids, np.cumsum(lengths) - lengths, lengths)),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )


def lowest(drawn: list, many: int) -> list:
    """The ``many`` rows whose hash is lowest: a cut by id would leave out the highest ids."""
    return sorted(drawn, key=lambda r: (r["place"], r["id"], r["text"]))[:many]


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL,
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(id as text) modulo 7 is 2, and those with a null id, are not
    learned from; only the former and the latter are reported as held out. Null texts
    count as empty; an empty text is scored for its end. Words that differ only in the
    white space around them are the same text. Without training documents all words and
    ids are equally unlikely. Repeated rows give a row each, and count each. An empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    fold = remainder(id_col, FOLDS)
    learns = (fold >= 0) & (fold != HELD_OUT)
    subwords = Subwords(model_file)
    rows = in_blocks(docs, id_col, text_col, learns)
    wanted = staged(
        rows.select("block", "mark", "text").mapInArrow(_wanted, "block long, word binary, n long"), "wanted"
    )
    counts = staged(
        wanted.groupBy("word").agg(F.sum("n").alias("n"))
        .mapInArrow(_encoded(subwords), "word binary, n long, values array<long>"),
        "words",
    )
    totals = counts.filter("n > 0").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = rows.filter("mark = 1").count()
    unigram = Unigram((totals["n"] or 0) + ends, totals["v"] + (ends > 0), ends)

    # The documents with the lowest hashes. Only hashes are sorted to find where to cut; rows
    # that share an id and a text share the hash, so what reaches the driver is limited besides.
    place = F.xxhash64(F.lit("sample"), "id", "text").alias("place")
    learned = rows.filter("mark = 1")
    cut = learned.select(place).orderBy("place").limit(sample_docs).agg(F.max("place")).first()[0]
    drawn = (
        learned.select("id", "text", place).filter(F.col("place") <= F.lit(cut))
        .select("place", "id", stretch(F.col("text"), LONGEST, F.col("place")).alias("text"))
        .orderBy("place", "id", "text").limit(sample_docs).collect()
    ) if cut is not None else []
    sample = []
    for r in lowest(drawn, sample_docs):
        ids, _ = subwords.ids(words_of(r["text"].encode("utf-8")))
        sample.append(np.append(ids, END))
    starts = subwords.starts()
    size, kind = len(starts), kind_of(len(starts))
    packed = answered(wanted.select("block", "word"), counts.select("word", "values"), "word-counts")
    encoded = staged(for_each_block(rows, packed, Encoder(unigram, size).block, ENCODED), "encoded")

    # What follows is summed into at most (ids of the piece file) x (2 x WIDE), or x (classes + 1), cells.
    words = counts.filter("n > 0").select("values")
    seen = np.zeros(size, np.int64)
    _sums_into(seen, words.mapInArrow(_seen(size), "cell int, n long"))
    seen[END] += ends
    beside = Neighbours(seen)
    neighbours = np.zeros(len(beside.rest) * 2 * WIDE, np.int64)
    _sums_into(neighbours, encoded.select("marks", "lengths", "pieces").mapInArrow(beside, "cell int, n long"), **FEW_ROWS)
    cell = np.flatnonzero(neighbours)
    of = beside.classes(seen, starts, cell, neighbours[cell])
    pairs = np.zeros((CLASSES + 1, CLASSES), np.int64)
    _sums_into(pairs.ravel(), encoded.select("marks", "lengths", "pieces").mapInArrow(Pairs(of), "cell int, n long"), **FEW_ROWS)
    of, pairs = in_groups(of, pairs)
    cells = np.zeros((CLASSES + 1, size))
    _sums_into(cells.ravel(), words.mapInArrow(IdCounts(of, starts), "cell long, n long"))
    cells[CLASSES, END] = ends

    attention = train(sample, of)
    if ends:
        attention = with_prior(attention, pairs, of).with_ids(np.flatnonzero(seen), of)
        attention = taught(encoded, attention, of)
    model = spark.sparkContext.broadcast(LanguageModel(attention, of, shares(cells, of), starts))
    schema = (
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    scores = staged(encoded.mapInArrow(Scorer(unigram.tokens, model, kind), schema), "scores", **FEW_ROWS)
    return scores.withColumnRenamed("id", id_col)


def _seen(size: int):
    """How often each id occurs, from the counts of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            lists = batch["values"]
            each, flat, sizes = _split(lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy())
            total += np.bincount(flat, weights=np.repeat(each, sizes), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], names=["cell", "n"]
        )

    return count


def _sums_into(table: np.ndarray, cells: DataFrame, **settings: str) -> None:
    """Write the sum of each cell's counts."""
    for part in staged(cells.groupBy("cell").agg(F.sum("n").alias("n")), "cells", **settings).toArrow().to_batches():
        table[part["cell"].to_numpy()] = part["n"].to_numpy()
