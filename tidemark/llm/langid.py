"""Language identification with language-bitmask n-gram filters.

Every language has a Bloom filter of its character n-grams and single letters: all whose
share of the language's is at least ``LEAST_SHARE``, which is all of them in a language of
fewer than 1 / ``LEAST_SHARE``. The filters are stored bit-sliced: one table of bit masks,
whose entry at a position has a bit for every language whose filter is set there. The AND
of an n-gram's entries is the mask of all languages that contain it, found with a few
look-ups however many languages there are. Further bits say to which of them the n-gram is
telling: whose share of it is at least ``TELLING`` of any language's. A text's languages
are scored by popcount: each n-gram is divided among the languages of its mask, those that
it does not tell get ``TELLING`` of a part, less what a filter so full answers by mistake.

N-grams are counted over all training documents with map-side aggregation. The table is
sized from the number of n-grams of the largest filter, at most 1 / ``LEAST_SHARE``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import remainder, staged, text_or_empty

#: n-gram lengths in characters; words are taken with one boundary mark on either side.
LENGTHS = (2, 3, 4)
#: Share of a language's n-grams from which one is in its filter.
LEAST_SHARE = 1e-6
#: An n-gram tells a language whose share of it is this part of any language's; others get this part.
TELLING = 0.25
#: Positions of a table: at least two to this, and so many that no filter is fuller than ``FULL``.
LEAST_BITS = 18
FULL = 0.15
PROBES = 3
#: Characters whose n-grams are counted at once, and distinct n-grams held by a task.
CHARS_AT_ONCE = 1_000_000
NGRAMS_AT_ONCE = 300_000
UNDETERMINED = "und"
FOLDS = 5

BOUNDARY = 0x20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Letters:
    """Lower-case letters of a text, with every run of other characters as one boundary."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, BOUNDARY, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                self.table[code] = ord(low) if len(low) == 1 else code

    def of(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.concatenate([[BOUNDARY], self.table[codes], [BOUNDARY]]).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != BOUNDARY) | (codes[:-1] != BOUNDARY)
        codes = codes[keep]
        return codes if len(codes) > 1 else codes[:0]


_letters: list[Letters] = []


def letters(text: str) -> np.ndarray:
    if not _letters:
        _letters.append(Letters())
    return _letters[0].of(text)


def characters(codes: np.ndarray) -> np.ndarray:
    """Hashes of all letters."""
    h = (np.uint64(1) ^ codes[codes != BOUNDARY].astype(np.uint64)) * _MULTIPLIER
    h ^= h >> np.uint64(29)
    h *= _MULTIPLIER
    return h ^ (h >> np.uint64(29))


def ngrams(codes: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams that have no boundary inside (only at an end)."""
    wide = codes.astype(np.uint64)
    outside = codes == BOUNDARY
    found = []
    for n in LENGTHS:
        if len(codes) < n:
            continue
        many = len(codes) - n + 1
        h = np.full(many, n, np.uint64)
        inside = np.zeros(many, bool)
        for k in range(n):
            h = (h ^ wide[k : k + many]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                inside |= outside[k : k + many]
        if n == 2:
            inside = outside[:many] & outside[1 : 1 + many]
        found.append(h[~inside])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _positions(grams: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    for k in range(PROBES):
        yield ((grams >> np.uint64((64 - bits) * k // (PROBES - 1))) & mask).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """Bit-sliced filters: ``table[position, word]`` holds a bit for every language.

    The first half of the words says which languages contain an n-gram, the second which
    it tells. ``false_rate`` and ``false_telling`` are how often either is a mistake.
    """

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    false_telling: np.ndarray

    @classmethod
    def build(
        cls, languages: list[str], grams: dict[str, np.ndarray], telling: dict[str, np.ndarray] | None = None
    ) -> Filters:
        """``telling`` holds those of ``grams`` that tell a language; all of them if not given."""
        words = max(1, -(-len(languages) // 64))
        most = max((len(own) for own in grams.values()), default=0)
        bits = max(LEAST_BITS, int(np.ceil(np.log2(max(PROBES * most / FULL, 1)))))
        table = np.zeros((1 << bits, 2 * words), np.uint64)
        fill = np.zeros((2, len(languages)))
        for half, chosen in enumerate((grams, grams if telling is None else telling)):
            for i, language in enumerate(languages):
                own = np.zeros(1 << bits, bool)
                for at in _positions(chosen[language], bits):
                    own[at] = True
                table[own, half * words + i // 64] |= np.uint64(1) << np.uint64(i % 64)
                fill[half, i] = own.mean()
        return cls(languages, table, *fill**PROBES)

    def _found(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every n-gram the languages that contain it and those that it tells."""
        found = None
        for at in _positions(grams, len(self.table).bit_length() - 1):
            found = self.table[at] if found is None else found & self.table[at]
        half = found.shape[1] // 2
        return found[:, :half], found[:, half:]

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For every n-gram the languages that contain it."""
        return self._found(grams)[0]

    def _counts(self, codes: np.ndarray, parts: Callable[[np.ndarray], np.ndarray], overlap: int) -> np.ndarray:
        """The mean part of each language in an n-gram, corrected."""
        total, counts = 0, np.zeros(len(self.languages))
        for start in range(0, len(codes), CHARS_AT_ONCE):
            grams = parts(codes[start : start + CHARS_AT_ONCE + overlap])
            total += len(grams)
            halves = self._found(grams)
            shared = [np.bitwise_count(masks).sum(axis=1, dtype=np.float64) for masks in halves]
            weight = 1.0 / np.maximum(TELLING * shared[0] + (1 - TELLING) * shared[1], 1)
            whole = weight.sum()
            for masks, part, false in zip(halves, (TELLING, 1 - TELLING), (self.false_rate, self.false_telling)):
                for i in range(len(self.languages)):
                    bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                    # A filter answers so many n-grams by mistake that it does not contain.
                    counts[i] += part * (weight @ bit.astype(np.float64) - false[i] * whole) / (1 - false[i])
        return np.maximum(counts / max(total, 1), 0)

    def decide(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the corrected counts.

        Single letters decide where no n-gram does, the first language where they do not.
        """
        codes = letters(text) if text else np.zeros(0, np.uint32)
        if not len(codes) or not self.languages:
            return UNDETERMINED, 0.0
        for parts, overlap in ((ngrams, max(LENGTHS) - 1), (characters, 0)):
            counts = self._counts(codes, parts, overlap)
            best = int(np.argmax(counts))
            if counts[best] > 0:
                return self.languages[best], float(counts[best] / counts.sum())
        return self.languages[0], 0.0


def _parts(codes: np.ndarray) -> np.ndarray:
    return np.concatenate([ngrams(codes), characters(codes)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n), summed over as many documents as fit."""
    held: dict[str, list] = {}
    size = 0

    def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([p[0] for p in parts])
        unique, where = np.unique(grams, return_inverse=True)
        return unique, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, n = summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"],
            )

    waiting: dict[str, list[np.ndarray]] = {}
    chars = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            codes = letters(text)
            waiting.setdefault(lang, []).append(codes)
            chars += len(codes)
            if chars < CHARS_AT_ONCE:
                continue
            for name, texts in waiting.items():
                unique, n = np.unique(_parts(np.concatenate(texts)), return_counts=True)
                held.setdefault(name, []).append((unique, n))
                if len(held[name]) > 8:
                    held[name] = [summed(held[name])]
            waiting, chars = {}, 0
            size = sum(len(p[0]) for parts in held.values() for p in parts)
            if size > 9 * NGRAMS_AT_ONCE:
                yield from flush()
                held = {}
    for name, texts in waiting.items():
        unique, n = np.unique(_parts(np.concatenate(texts)), return_counts=True)
        held.setdefault(name, []).append((unique, n))
    yield from flush()


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters of the n-grams and letters of each language, over all rows with a language."""
    counts = staged(
        docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "ngrams",
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row per language
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    most = F.max("share").over(Window.partitionBy("gram"))
    rows = (
        shares.withColumn("telling", F.col("share") >= TELLING * most)
        .filter(F.col("share") >= LEAST_SHARE).select("lang", "gram", "telling").toArrow()
    )
    lang = rows["lang"].combine_chunks().dictionary_encode()
    code, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
    found, tells = rows["gram"].to_numpy().view(np.uint64), rows["telling"].to_numpy()
    grams = {name: found[code == i] for i, name in enumerate(names)}
    telling = {name: found[(code == i) & tells] for i, name in enumerate(names)}
    return Filters.build(sorted(grams), grams, telling)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score.

    Learns from the documents with a language whose crc32(id as text) modulo 5 is not 0;
    a null id is not learned from and counts as held out. Texts that are null or without
    a letter are ``und`` with score 0, and so is every text if nothing was learned. Ties
    go to the language that sorts first. Repeated rows give a row each. An empty table
    gives no rows. Other columns are not read.
    """
    fold = remainder(id_col, FOLDS)
    known = docs.sparkSession.sparkContext.broadcast(learn(docs.filter(fold > 0), text_col, lang_col))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = known.value
        for batch in batches:
            found = [filters.decide(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (fold <= 0).alias("held_out"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(predict, "id long, held_out boolean, lang_pred string, score double").withColumnRenamed(
        "id", id_col
    )
