"""Substring dedup with suffix automata over reference shards.

Of every word sequence of ``WINDOW`` words the first occurrence stays and later ones go.
To match each document against all earlier ones would be quadratic, so the references are
cut down to what repeats at all, and a document meets only the shards it shares text with:

1. Hashes of all windows are counted in buckets. A window whose hash occurs again names a
   *reference* (the stretch around its first occurrence) and a *candidate* (the stretch
   around a later one, with the document it was first seen in). Windows count as
   equal here if all 64 bits of their hashes are. What goes is decided on words, so a false
   one removes nothing; but of two windows with one hash only the first is a reference, and
   a repeat of the other stays. About 0.7 such pairs are expected among 5e9 windows (30 GB).
2. References go to shards of bounded size by their document, candidates to the shard of
   the document they name. In each shard a suffix automaton is built over the references
   and the candidates stream through it. Their matching statistics tell, for each word,
   the longest match that ends there and its earliest occurrence: windows that are
   matched in full at an earlier place go, joined to maximal spans.
3. Spans are joined to the documents and cut out.

Hot passages: copies inside a task's share of documents are resolved before the shuffle,
and a shard whose candidates are many is given to several tasks (its references are
repeated, its candidates dealt out), so no task holds more than a bounded share.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, staged, text_or_empty

WINDOW = 20
#: Text bytes whose windows share a bucket, reference words in a shard, candidate words a
#: task takes from a shard, and text bytes a task hashes at once.
BUCKET_BYTES = 8 << 20
SHARD_WORDS = 100_000
TASK_WORDS = 1_000_000
CHUNK_BYTES = 4 << 20
#: Bytes of a window's hash that are compared: all.
HASH_BYTES = 8
#: Stands for a null id: after all others.
LAST = 2**63 - 1

_RANDOM = np.random.default_rng(2024)
_POWERS = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_PLACES = _RANDOM.integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# Window hashes ---------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word, the same in every process."""
    found = []
    for i in range(0, len(words), 100_000):
        part = words[i : i + 100_000]
        codes = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        size = np.fromiter(map(len, part), np.int64, len(part)) + 1
        start = np.cumsum(size) - size
        at = np.arange(len(codes)) - np.repeat(start, size)
        found.append(np.add.reduceat(codes * _POWERS[at % len(_POWERS)], start))
    return _mixed(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on; the last ``width - 1`` have none."""
    many = max(0, len(words) - width + 1)
    h = np.zeros(many, np.uint64)
    for k in range(width):
        h += _mixed(words[k : k + many] * _PLACES[k % len(_PLACES)] + np.uint64(k))
    return _mixed(h)


def _pack(*columns: np.ndarray) -> bytes:
    """Sorted columns of equal length, as compressed differences."""
    parts = [np.diff(c, prepend=c.dtype.type(0)).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes, n: int, *kinds) -> list[np.ndarray]:
    raw, found, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        found.append(np.cumsum(np.frombuffer(raw[at : at + size], kind), dtype=kind))
        at += size
    return found


def _merged(ids, sources, starts, ends, gap: int):
    """Joins ranges of one document and source that are at most ``gap`` apart, sorted by start."""
    if not len(ids):
        return ids, sources, starts, ends
    order = np.lexsort((starts, sources, ids))
    ids, sources, starts, ends = ids[order], sources[order], starts[order], ends[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (sources[1:] != sources[:-1])
    # The furthest end so far within a group: groups are set far apart first.
    group = np.cumsum(new) - 1
    reach = np.maximum.accumulate(ends + group * (2**40)) - group * (2**40)
    new[1:] |= starts[1:] > reach[:-1] + gap
    at = np.flatnonzero(new)
    return ids[at], sources[at], starts[at], np.maximum.reduceat(ends, at)


class Windows:
    """Hashes the windows of a task's documents and deals them into buckets.

    A reference range has source -1 - id of its own document, so that it can be told from
    a candidate that names a document; both are ranges of window starts.
    """

    def __init__(self, width: int, buckets: int):
        self.width, self.buckets = width, buckets

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist()):
                if len(text) < 2 * self.width - 1:
                    continue
                held.append((key, text))
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield self.chunk(held)
                    held, size = [], 0
        if held:
            yield self.chunk(held)

    def chunk(self, docs: list[tuple[int, bytes]]) -> pa.RecordBatch:
        docs = sorted(set(docs))
        split = [text.split() for _, text in docs]
        count = np.fromiter(map(len, split), np.int64, len(split))
        words = np.concatenate([word_hashes(w) for w in split])
        start = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(docs)), count)
        hashes = window_hashes(words, self.width)
        whole = np.flatnonzero(owner[: len(hashes)] == owner[self.width - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        hashes = hashes[whole] >> np.uint64(64 - 8 * HASH_BYTES)
        owner = owner[whole]
        ids = np.array([key for key, _ in docs], np.int64)[owner]
        at = whole - start[owner]
        order = np.argsort(hashes, kind="stable")  # equal hashes stay in order of documents
        sorted_ = hashes[order]
        head = np.ones(len(order), bool)
        head[1:] = sorted_[1:] != sorted_[:-1]
        first = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(order) else order
        later = order[~head]
        source = first[~head]
        # The same place in another row of the same id is not an earlier one.
        same = (ids[later] == ids[source]) & (at[later] == at[source])
        sent = np.sort(np.concatenate([order[head], later[same]]))
        later, source = later[~same], source[~same]
        rows = [self._buckets(hashes[sent], ids[sent], at[sent])]
        refs = np.unique(source)
        for mine, names in ((later, ids[source]), (refs, -1 - ids[refs])):
            own = _merged(ids[mine], names, at[mine], at[mine] + self.width, 0)
            rows.append(_table(
                part=_part_of(own[0], self.buckets), id=own[0], source=own[1],
                start=own[2].astype(np.int32), end=own[3].astype(np.int32),
            ))
        found = pa.concat_tables(rows).combine_chunks().to_batches()
        return found[0] if found else _table(part=[]).to_batches()[0]

    def _buckets(self, hashes, ids, at) -> pa.Table:
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        used = [b for b in range(self.buckets) if edges[b] < edges[b + 1]]
        blobs, sizes = [], []
        for b in used:
            own = order[edges[b] : edges[b + 1]]
            low = hashes[own].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
            blobs.append(np.ascontiguousarray(low).tobytes() + _pack(ids[own], at[own].astype(np.int32)))
            sizes.append(len(own))
        return _table(part=used, blob=blobs, n=sizes)


COLUMNS = {"part": pa.int32(), "id": pa.int64(), "source": pa.int64(), "start": pa.int32(), "end": pa.int32(), "n": pa.int32(), "blob": pa.binary()}
SCHEMA = "part int, id long, source long, start int, end int, n int, blob binary"


def _table(**columns) -> pa.Table:
    size = len(next(iter(columns.values())))
    return pa.table({c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in COLUMNS.items()})


def _part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """Where the ranges of a document are gathered."""
    return (_mixed(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _resolve(rows: pa.Table, parts: int) -> pa.Table:
    """Windows of one bucket that occur again, dealt by document; ranges pass through."""
    if rows["blob"][0].as_py() is None:
        return rows.select(list(COLUMNS))
    hashes, ids, at = [], [], []
    for blob, n in zip(rows["blob"].to_pylist(), rows["n"].to_pylist()):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :HASH_BYTES] = np.frombuffer(blob[: n * HASH_BYTES], np.uint8).reshape(n, HASH_BYTES)
        hashes.append(wide.view(np.uint64).ravel())
        own = _unpack(blob[n * HASH_BYTES :], n, np.int64, np.int32)
        ids.append(own[0])
        at.append(own[1])
    hashes, ids, at = np.concatenate(hashes), np.concatenate(ids), np.concatenate(at)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    few = order[again]
    few = few[np.lexsort((at[few], ids[few], hashes[few]))]
    hashes, ids, at = hashes[few], ids[few], at[few].astype(np.int64)
    head = np.ones(len(few), bool)
    head[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(few) else few
    early = (ids == ids[first]) & (at == at[first])
    sources = np.where(early, -1 - ids, ids[first])
    part = _part_of(ids, parts)
    order = np.lexsort((at, sources, ids, part))
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    used = [p for p in range(parts) if edges[p] < edges[p + 1]]
    blobs = []
    for p in used:
        own = order[edges[p] : edges[p + 1]]
        blobs.append(_pack(ids[own], sources[own], at[own].astype(np.int32)))
    return _table(part=used, blob=blobs, n=[int(edges[p + 1] - edges[p]) for p in used])


def _join_ranges(rows: pa.Table, width: int) -> pa.Table:
    """Ranges of the documents of one part, those a word or more apart kept apart."""
    ids, sources, starts, ends = ([] for _ in range(4))
    for blob, n in zip(rows["blob"].to_pylist(), rows["n"].to_pylist()):
        if blob is not None:
            own = _unpack(blob, n, np.int64, np.int64, np.int32)
            ids.append(own[0])
            sources.append(own[1])
            starts.append(own[2].astype(np.int64))
            ends.append(own[2].astype(np.int64) + width)
    plain = rows.filter(pa.compute.is_null(rows["blob"]))
    for column, found in (("id", ids), ("source", sources), ("start", starts), ("end", ends)):
        found.append(plain[column].to_numpy().astype(np.int64))
    own = _merged(*(np.concatenate(x) for x in (ids, sources, starts, ends)), 0)
    return pa.table({
        "id": own[0], "source": np.where(own[1] < 0, own[0], own[1]), "reference": own[1] < 0,
        "start": own[2].astype(np.int32), "end": own[3].astype(np.int32),
    })


# Suffix automaton ------------------------------------------------------------------


class Automaton:
    """Suffix automaton over word sequences; states know where their words first ended."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends = [-1]

    def _state(self, length: int, link: int, edges: dict[int, int], end: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(end)
        return len(self.link) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state for words that end in ``word`` behind ``at``, taken out of ``target``."""
        if self.length[target] == self.length[at] + 1:
            return target
        new = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]), self.ends[target])
        self.link[target] = new
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def add(self, words: list[int], end: int) -> None:
        """Add a sequence whose first word has number ``end``; sequences come in order."""
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                new = self._state(self.length[last] + 1, 0, {}, end)
                at = last
                while at >= 0 and word not in self.next[at]:
                    self.next[at][word] = new
                    at = self.link[at]
                if at >= 0:
                    self.link[new] = self._split(at, word, self.next[at][word])
                last = new
            end += 1

    def matches(self, words: list[int], width: int) -> Iterator[tuple[int, int]]:
        """(place, number) of each word that ends a match of ``width`` words; the number is
        that of the word that ended their earliest occurrence."""
        follow, link, length, ends = self.next, self.link, self.length, self.ends
        state = size = 0
        for place, word in enumerate(words):
            target = follow[state].get(word)
            while target is None and state:
                state = link[state]
                size = length[state]
                target = follow[state].get(word)
            if target is None:
                continue
            state, size = target, size + 1
            if size >= width:
                at = state
                while length[link[at]] >= width:
                    at = link[at]
                # Only the last words count: keep to the state that stands for them.
                state, size = at, min(size, length[at])
                yield place, ends[at]


def _match_shard(rows: pa.Table, width: int) -> pa.Table:
    """Spans of the candidates of one shard that occur earlier in its references."""
    columns = [rows[c].to_pylist() for c in ("reference", "id", "version", "start", "words")]
    refs = sorted({(i, s, w) for r, i, _, s, w in zip(*columns) if r})
    numbers: dict[bytes, int] = {}
    automaton, first, keys, starts, total = Automaton(), [], [], [], 0
    for key, start, text in refs:
        words = [numbers.setdefault(w, len(numbers)) for w in text.split(b" ")]
        automaton.add(words, total)
        first.append(total)
        keys.append(key)
        starts.append(start)
        total += len(words)
    first = np.array(first, np.int64)
    found: list[tuple] = []
    for reference, key, version, start, text in zip(*columns):
        if reference:
            continue
        words = [numbers.get(w, -1) for w in text.split(b" ")]
        hits = list(automaton.matches(words, width))
        if not hits:
            continue
        place, number = (np.array(x, np.int64) for x in zip(*hits))
        which = np.searchsorted(first, number, side="right") - 1
        begins = np.array(starts, np.int64)[which] + number - first[which] - width + 1
        own = start + place - width + 1
        of = np.array(keys, np.int64)[which]
        begin = own[(of < key) | ((of == key) & (begins < own))]
        if len(begin):
            new = np.ones(len(begin), bool)
            new[1:] = begin[1:] > begin[:-1] + width
            at = np.flatnonzero(new)
            lasts = begin[np.append(at[1:] - 1, len(begin) - 1)]
            found += [(key, version, int(b), int(e) + width) for b, e in zip(begin[at], lasts)]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.table({c: pa.array([f[i] for f in found], t) for i, (c, t) in enumerate(zip(("key", "version", "start", "end"), kinds))})


# Spark side ------------------------------------------------------------------------


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The planned ranges of each document as rows of words, references for every task of their shard."""
    names = ("shard", "turn", "reference", "id", "version", "start", "words")
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    for batch in slices(batches):
        rows = []
        for key, version, text, plan in zip(*(batch[c].to_pylist() for c in ("key", "version", "text", "plan"))):
            words = text.split()
            for part in plan:
                piece = b" ".join(words[part["start"] : part["end"]])
                turns = range(part["tasks"]) if part["reference"] else [key % part["tasks"]]
                rows += [(part["shard"], t, part["reference"], key, version, part["start"], piece) for t in turns]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names)
        )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts, removed, digests, kept = [], [], [], []
        for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
            words = text.split()
            gone = np.zeros(len(words), bool)
            for span in spans or ():
                gone[span["start"] : span["end"]] = True
            left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
            counts.append(len(words))
            removed.append(int(gone.sum()))
            digests.append(sha256(left).hexdigest())
            kept.append(left)
        columns = [batch["id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["id", "n_words", "n_removed", "kept_sha256"]
        if "with_text" in batch.schema.names:
            columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _spans(rows: DataFrame, width: int, shard_words: int, task_words: int) -> DataFrame:
    """(key, version, start, end) of the words that occur earlier."""
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-size // BUCKET_BYTES))
    hashed = rows.select("key", "text").mapInArrow(Windows(width, buckets), SCHEMA)
    # Ranges that a task found by itself pass the buckets by.
    lane = F.when(F.col("blob").isNull(), F.lit(buckets)).otherwise(F.lit(0)) + F.col("part")
    resolved = hashed.withColumn("lane", lane).groupBy("lane").applyInArrow(
        lambda rows: _resolve(rows, buckets), SCHEMA
    )
    plan = staged(
        resolved.groupBy("part").applyInArrow(
            lambda rows: _join_ranges(rows, width), "id long, source long, reference boolean, start int, end int"
        ),
        "ranges",
    )
    words = plan.filter("reference").agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    plan = plan.withColumn("shard", F.pmod(F.xxhash64("source"), F.lit(shards)))
    tasks = plan.groupBy("shard").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(~F.col("reference"), F.col("end") - F.col("start"))) / task_words))
        .cast("int").alias("tasks")
    )
    plans = plan.join(tasks, "shard").groupBy(F.col("id").alias("key")).agg(
        F.collect_list(F.struct("reference", "start", "end", "shard", "tasks")).alias("plan")
    )
    pieces = rows.join(plans, "key").select("key", "version", "text", "plan").mapInArrow(
        _cut_out, "shard long, turn int, reference boolean, id long, version long, start int, words binary"
    )
    return pieces.groupBy("shard", "turn").applyInArrow(
        lambda t: _match_shard(t, width), "key long, version long, start int, end int"
    )


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, with_text: bool = False,
    shard_words: int = SHARD_WORDS, task_words: int = TASK_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256, and the kept text if asked for.

    Null texts count as empty: no words, and the digest of an empty text. Texts of fewer
    than ``width`` words lose nothing. A null id comes after all others. Rows that share an
    id are one document: the same place in each is no earlier place, so repeated rows give
    the same row each. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("key"),
        F.xxhash64(text_or_empty(text_col)).alias("version"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    spans = staged(_spans(rows, width, shard_words, task_words), "spans")
    lists = spans.groupBy("key", "version").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(lists, ["key", "version"], "left").select("id", "text", "spans")
    schema = "id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        joined, schema = joined.withColumn("with_text", F.lit(True)), schema + ", kept binary"
    result = joined.mapInArrow(_removed, schema).withColumnRenamed("id", id_col)
    return result.withColumn("kept", F.decode("kept", "UTF-8")) if with_text else result
