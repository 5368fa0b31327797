"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band: frequent
enough to be no accident, rare enough to say something. Each of ``SUBSETS`` seeds orders
the lexicon at random into nested subsets (a half, a quarter, an eighth ...). Of each seed
the smallest subset that still has terms of the document is used: its distinct terms are
sorted and hashed. The fingerprint is the list of these hashes, and likeness the share of
seeds whose hashes are equal.

The lexicon is the only data sent to every task. A term in the band stands in at least
``MIN_SHARE`` of the documents, so there are at most (mean distinct terms of a document) /
``MIN_SHARE`` of them whatever the size of the corpus; more than ``MAX_LEXICON`` is an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import text_or_empty

#: The band: terms in this share of all documents, and in two documents at least.
MIN_SHARE = 0.001
MAX_SHARE = 0.1
MAX_LEXICON = 5_000_000
SUBSETS = 32
#: Distinct terms counted before a task hands its counts on.
COUNTED_AT_ONCE = 400_000
#: Id ranges for each task: tasks get ranges by hash, and many small ones even out.
RANGES_PER_TASK = 16

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SEEDS = np.random.default_rng(20240607).integers(1, 2**63, SUBSETS, dtype=np.uint64)


def terms_of(text: bytes) -> set[bytes]:
    """Distinct words in ASCII lower case without punctuation around them."""
    found = {word.strip(PUNCTUATION) for word in set(text.lower().split())}
    found.discard(b"")
    return found


def _hash(terms: set[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.sort(np.fromiter(map(digest, terms), np.uint64, len(terms)))


def _spread(terms: np.ndarray) -> np.ndarray:
    """A random place for every term under every seed."""
    x = terms[:, None] ^ _SEEDS[None, :]
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def fingerprint(text: bytes, lexicon: np.ndarray) -> str:
    """Four hexadecimal digits for each seed; zeros for a text without terms.

    A text without a term in the band is fingerprinted by all its terms.
    """
    terms = _hash(terms_of(text))
    if not len(terms):
        return "0000" * SUBSETS
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, terms), len(lexicon) - 1)
        inside = terms[lexicon[at] == terms]
        terms = inside if len(inside) else terms
    places = _spread(terms)
    # The nested subset at level k has the places below 2 ** (64 - k).
    top = np.frexp(places.min(axis=0).astype(np.float64))[1]
    kept = places < np.ldexp(1.0, top)
    return "".join(
        f"{xxhash.xxh32_intdigest(terms[kept[:, s]].tobytes()) & 0xFFFF:04x}" for s in range(SUBSETS)
    )


def likeness(a: str, b: str) -> float:
    """Share of seeds on which two fingerprints agree."""
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 4 * SUBSETS, 4)) / SUBSETS


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        terms = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
        n = np.fromiter(counts.values(), np.int64, len(counts))
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "n"])

    for batch in batches:
        for text in batch["text"].to_pylist():
            counts.update(terms_of(text))
            if len(counts) > COUNTED_AT_ONCE:
                yield flush()
                counts.clear()
    yield flush()


def build_lexicon(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""
    total = docs.count()
    counts = (
        docs.select(text_or_empty(text_col).cast("binary").alias("text"))
        .mapInArrow(_document_counts, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= max(2, total * MIN_SHARE)) & (F.col("n") <= max(2, total * MAX_SHARE)))
    )
    found = counts.select("term").limit(MAX_LEXICON + 1).toArrow()["term"].to_numpy()
    if len(found) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} terms in the band")
    return np.sort(found.astype(np.int64).view(np.uint64))


# Each document with the next one in descending order of ids -------------------------


@dataclass(frozen=True)
class Dealer:
    """Deals documents into id ranges; the first of each range follows the range before it.

    ``cuts`` are range limits (some per task), ``heads`` maps the first document of a range
    to the range that it follows. Neither grows with the documents of a range.
    """

    cuts: np.ndarray
    heads: dict

    def ranges(self, batch: pa.RecordBatch) -> np.ndarray:
        ids = batch["id"].fill_null(0).to_numpy(zero_copy_only=False)
        known = batch["id"].is_valid().to_numpy(zero_copy_only=False)
        return np.where(known, np.searchsorted(self.cuts, ids) + 1, 0).astype(np.int32)

    def firsts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The largest (id, version) of each range, by batch."""
        for batch in batches:
            best: dict = {}
            for key in zip(self.ranges(batch).tolist(), batch["id"].to_pylist(), batch["version"].to_pylist()):
                old = best.get(key[0])
                if old is None or (key[1] is not None and key[1:] > old[1:]) or (key[1] is None and key[2] > old[2]):
                    best[key[0]] = key
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in best.values()], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                names=["part", "id", "version"],
            )

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            parts = self.ranges(batch)
            ids, versions, texts = (batch[c].to_pylist() for c in ("id", "version", "text"))
            rows = [(p, False, i, v, pack(t)) for p, i, v, t in zip(parts.tolist(), ids, versions, texts)]
            rows += [(self.heads[r[2], r[3]], True, *r[2:]) for r in rows if (r[2], r[3]) in self.heads]
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                names=["part", "follows", "id", "version", "packed"],
            )


def _edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(batches: Iterator[pa.RecordBatch], lexicon: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order, each compared with its edited text and with the next row."""
    unpack = zstandard.ZstdDecompressor().decompress
    last = None  # (range, id, text, fingerprint)
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("part", "follows", "id", "packed"))
        for part, follows, key, packed in zip(*columns):
            if follows and (last is None or last[0] != part):
                continue  # a repeated follower
            raw = unpack(packed)
            text, mark = raw.decode("utf-8"), fingerprint(raw, lexicon)
            if last is not None and last[0] == part:
                edited = _edited(last[2], text).encode("utf-8")
                edited_mark = fingerprint(edited, lexicon) if last[2] else last[3]
                out.append((
                    last[1], len(last[2]), sha256(edited).hexdigest(), last[3], edited_mark,
                    likeness(last[3], edited_mark), likeness(last[3], mark),
                ))
            last = None if follows else (part, key, text, mark)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Documents follow each other by descending id, null ids last, equal ids by a hash of
    the text; after the last comes the first, so a single document follows itself. Null
    texts count as empty; texts without terms have a fingerprint of zeros and are alike.
    Repeated rows give a row each. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    lexicon = build_lexicon(docs, text_col)
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("version"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_PER_TASK * n
    quantiles = rows.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    cuts = np.unique(np.array(quantiles, np.float64)).astype(np.int64)
    plain = Dealer(cuts, {})
    firsts = (
        rows.select("id", "version").mapInArrow(plain.firsts, "part int, id long, version long")
        .groupBy("part").agg(F.max(F.struct("id", "version")).alias("head")).collect()
    )
    order = sorted(firsts, key=lambda r: -r["part"])  # one row per range
    heads = {
        (r["head"]["id"], r["head"]["version"]): order[i - 1]["part"] for i, r in enumerate(order)
    }
    dealer, known = Dealer(cuts, heads), spark.sparkContext.broadcast(lexicon)
    dealt = (
        rows.mapInArrow(dealer.deal, "part int, follows boolean, id long, version long, packed binary")
        .repartition(n, "part")
        .sortWithinPartitions("part", "follows", F.col("id").desc_nulls_last(), F.col("version").desc())
    )
    result = dealt.mapInArrow(lambda batches: _compare(batches, known.value), schema)
    return result.withColumnRenamed("id", id_col)
