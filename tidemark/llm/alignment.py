"""Cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes. Where tokens of both end at one byte a *group* ends, and
an A and a B token are *linked* where their byte ranges overlap. Between two neighbouring
ends, of either side, there is exactly one link, so the links of a text are read off the
merged ends. The count of a pair of ids is the number of documents that hold it linked.

Counting is external. A task turns its documents into (pair, document, links) records and,
when it holds ``RUN_RECORDS`` of them, spills a *run*: records sorted by pair and cut by a
radix of the A id, each part one zstd-compressed row. A run's *head*, its distinct pairs
with their numbers of documents, is what is counted: heads of one radix meet in a k-way heap
merge, at most some ``FAN`` at a time, whose merged heads are merged again until one is left
for each radix. It is in side-major order, all pairs of an A id side by side, so the highest
count of every A id falls out of one pass. The counts then stream back the same way, to the
heads that were merged and so to the runs, whose records hand them to the documents.

A frequent pair is one entry of a head, however many documents hold it, so heads are bounded
by the product of the vocabularies, and a task holds ``FAN`` parts of heads or one run.
Nothing but the number of runs reaches the driver.

Texts are cut at single spaces between other characters, where no token of either side goes
on, and a worker tokenizes and aligns a distinct piece once as long as it remembers it.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, staged

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"

#: Records of a run, parts of a run, and heads that are merged at a time (on average).
RUN_RECORDS = 500_000
RADIX = 128
FAN = 256
#: Pieces of text and characters of them that a task remembers.
PIECES_HELD, CHARS_HELD = 500_000, 12 << 20
#: Documents that are aligned at once.
DOCS_AT_ONCE = 100
#: The row of a run that holds what is known of its documents.
DOCUMENTS = -1

# The bytes that byte-level vocabularies write as themselves.
AS_THEMSELVES = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPACE = "▁"
BETWEEN = re.compile(r" (?<!\s\s)(?=\S)")

RUNS = "run long, radix int, head binary, records binary"
HEADS = "run long, radix int, head binary"
ANSWERS = "run long, radix int, answer binary"
PAIR_TABLE = "a_id int, b_id int, documents long, best boolean"
ROWS = (
    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


# Tokenizers -----------------------------------------------------------------------------


class Tokenizers:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        others = [byte for byte in range(256) if byte not in AS_THEMSELVES]
        byte_of = {chr(byte): byte for byte in AS_THEMSELVES} | {chr(256 + i): byte for i, byte in enumerate(others)}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            known = all(c in byte_of for c in token)
            self.a_bytes[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.sizes = [np.array([len(raw) for raw in own], np.int64) for own in (self.a_bytes, self.b_bytes)]
        with open(a_file, encoding="utf-8") as file:
            spec = json.load(file)
        by_words = (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)
        #: Whether no token of either side reaches over a space behind another character.
        self.local = bool(
            by_words and spec["normalizer"] is None and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        )

    def cut(self, text: str) -> list[str]:
        """Pieces that joined by spaces give the text, and can be tokenized each by itself."""
        if not self.local:
            return [text]
        parts = BETWEEN.split(text)
        if len(parts) > 1 and not parts[0]:  # a space at the start belongs to what follows
            parts[:2] = [" " + parts[1]]
        return parts

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [found.ids for found in self.a.encode_batch([" " + p for p in parts], add_special_tokens=False)]
        return a, self.b.encode(parts, num_threads=1)

    def together(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of both sides for all parts in a row, and how many each part has, from one text.

        None if a part cannot stand between single spaces, or does not get its own bytes back.
        """
        if not self.local or any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            return None
        text = " ".join(parts)
        raw = f" {text}".encode("utf-8", "surrogatepass")
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        found = []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        for own, of, sizes in zip(ids, (self.a_bytes, self.b_bytes), self.sizes):
            if b"".join(map(of.__getitem__, own)) != raw:
                return None
            flat = np.array(own, np.int64)
            at = np.cumsum(sizes[flat])
            last = np.searchsorted(at, ends)
            if (at[last] != ends).any():
                return None
            found.append((flat, np.diff(last + 1, prepend=0)))
        return found


# Alignment ------------------------------------------------------------------------------


@dataclass
class Aligned:
    """Numbers of tokens, groups and links of some texts, the links of all, and the groups."""

    exact: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray
    groups: list[str]


def _one_by_one(parts: list[str], tokenizers: Tokenizers) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """As ``Tokenizers.together``, and which parts get their bytes back; the others have no ids."""
    sides = tokenizers.encode(parts)
    exact = np.zeros(len(parts), bool)
    for i, (part, a, b) in enumerate(zip(parts, *sides)):
        raw = f" {part}".encode("utf-8", "surrogatepass")
        exact[i] = (
            b"".join(map(tokenizers.a_bytes.__getitem__, a)) == raw == b"".join(map(tokenizers.b_bytes.__getitem__, b))
        )
        if not exact[i]:
            a.clear()
            b.clear()
    return exact, [
        (np.array([i for one in side for i in one], np.int64), np.array([len(one) for one in side], np.int64))
        for side in sides
    ]


def align(parts: list[str], tokenizers: Tokenizers) -> Aligned:
    """Alignment of each text; one whose tokens do not give its bytes has none."""
    together = tokenizers.together(parts)
    exact, sides = _one_by_one(parts, tokenizers) if together is None else (np.ones(len(parts), bool), together)
    ids = [flat for flat, _ in sides]
    ends = [np.cumsum(sizes[flat]) for flat, sizes in zip(ids, tokenizers.sizes)]
    owner = [np.repeat(np.arange(len(parts)), many) for _, many in sides]
    every = np.union1d(*ends)
    common = np.intersect1d(*ends, assume_unique=True)
    at = [np.searchsorted(own, every) for own in ends]
    pairs = ids[0][at[0]] * len(tokenizers.b_bytes) + ids[1][at[1]]
    in_part = owner[0][at[0]]
    last = owner[0][np.searchsorted(ends[0], common)]
    counts = np.stack([np.bincount(x, minlength=len(parts)) for x in (*owner, last, in_part)])
    return Aligned(exact, counts, pairs, _written(ids, ends, owner, common, len(parts)))


def _written(ids, ends, owner, common, parts: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each part: groups in order, the A ids of each before its B ids."""
    group = np.concatenate([2 * np.searchsorted(common, ends[0]), 2 * np.searchsorted(common, ends[1]) + 1])
    order = np.argsort(group, kind="stable")
    group, part = group[order], np.concatenate(owner)[order]
    after = np.full(len(group), ",", object)
    turn = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
    after[turn & (group % 2 == 0)] = "|"
    after[turn & (group % 2 == 1)] = ";"
    tokens = [f"{i}{mark}" for i, mark in zip(np.concatenate(ids)[order].tolist(), after.tolist())]
    edges = np.searchsorted(part, np.arange(parts + 1)).tolist()
    return ["".join(tokens[a:b])[:-1] for a, b in zip(edges, edges[1:])]


class Remembered:
    """Alignments of the pieces of text seen lately, by number."""

    #: By tokenizer files: a worker's tasks go on with what earlier ones know.
    loaded: dict[tuple[str, str], Remembered] = {}

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    @classmethod
    def of(cls, a_file: str, b_file: str) -> Remembered:
        if (a_file, b_file) not in cls.loaded:
            cls.loaded[a_file, b_file] = cls(Tokenizers(a_file, b_file))
        return cls.loaded[a_file, b_file]

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.exact, self.counts = np.zeros(0, bool), np.zeros((4, 0), np.int64)
        self.pairs, self.groups, self.chars = np.zeros(0, np.int64), [], 0

    def learn(self, parts: set[str]) -> None:
        if len(self.number) > PIECES_HELD or self.chars > CHARS_HELD:
            self.clear()
        new = [part for part in parts if part not in self.number]
        if not new:
            return
        # Those that cannot stand between spaces go last, and are tokenized by themselves.
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        odd = [p for p in new if not p or p[0].isspace() or p[-1].isspace()]
        for part in (plain, odd):
            if part:
                self._add(part)

    def _add(self, new: list[str]) -> None:
        found = align(new, self.tokenizers)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.exact = np.concatenate([self.exact, found.exact])
        self.counts = np.concatenate([self.counts, found.counts], axis=1)
        self.pairs = np.concatenate([self.pairs, found.pairs])
        self.groups += found.groups
        self.chars += sum(map(len, new))
        self.starts = np.cumsum(self.counts[3]) - self.counts[3]

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs linked in some pieces, and which of the given pieces holds each."""
        sizes = self.counts[3][numbers]
        which = np.repeat(np.arange(len(numbers)), sizes)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.pairs[self.starts[numbers][which] + nth], which


# Runs -----------------------------------------------------------------------------------


def radix_of(pairs: np.ndarray, b_size: int) -> np.ndarray:
    """The part of a run that a pair is in; pairs of one A id share it."""
    x = (pairs // b_size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(RADIX)).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, compressed one after the other."""
    sizes = np.array([len(arrays[0])], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.tobytes() for x in (sizes, *arrays)))


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in types:
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    return out


class Spill:
    """Records held by a task, and the rows of a run made of them."""

    def __init__(self, b_size: int, first_run: int):
        self.b_size, self.run = b_size, first_run
        self.clear()

    def clear(self) -> None:
        self.docs, self.records, self.held = [], [], 0
        self.n_docs = 0

    def add(self, docs: list[tuple], records: np.ndarray) -> None:
        """Documents, and (document among them, pair, links) rows."""
        self.records.append(records + np.array([[self.n_docs], [0], [0]]))
        self.docs += docs
        self.n_docs += len(docs)
        self.held += records.shape[1]

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        columns = list(zip(*self.docs))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        known = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list("iabglhx"))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, known.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(known)
        rows = [(DOCUMENTS, sink.getvalue().to_pybytes(), None)]
        doc, pair, links = np.concatenate(self.records, axis=1)
        radix = radix_of(pair, self.b_size)
        order = np.lexsort((doc, pair, radix))
        doc, pair, links, radix = doc[order], pair[order], links[order], radix[order]
        edges = np.searchsorted(radix, np.arange(RADIX + 1)).tolist()
        for part, (start, end) in enumerate(zip(edges, edges[1:])):
            if start == end:
                continue
            new = np.flatnonzero(np.concatenate([[True], pair[start + 1 : end] != pair[start : end - 1]]))
            many = np.diff(np.append(new, end - start))
            head = _pack(pair[start:end][new], many)
            rows.append((part, head, _pack(doc[start:end].astype(np.int32), links[start:end].astype(np.int32))))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([self.run] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
            ],
            names=["run", "radix", "head", "records"],
        )
        self.run += 1
        self.clear()


def _described(a_file: str, b_file: str, keep_groups: bool, run_records: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered.of(a_file, b_file)
        tokenizers = known.tokenizers
        b_size = len(tokenizers.b_bytes)
        pair_count = len(tokenizers.a_bytes) * b_size
        spill = Spill(b_size, TaskContext.get().partitionId() << 32)
        for batch in slices(batches, DOCS_AT_ONCE):
            texts = [tokenizers.cut(text) if text else [] for text in batch["text"].to_pylist()]
            known.learn(set().union(*texts))
            docs, numbers, owner = [], [], []
            for i, (doc_id, parts) in enumerate(zip(batch["id"].to_pylist(), texts)):
                at = np.fromiter(map(known.number.__getitem__, parts), np.int64, len(parts))
                if not len(at) or not known.exact[at].all():
                    docs.append((doc_id, 0, 0, 0, 0, "", ""))
                    continue
                groups = ";".join([known.groups[k] for k in at.tolist()])
                docs.append((
                    doc_id, *known.counts[:, at].sum(axis=1).tolist(), sha256(groups.encode()).hexdigest(),
                    groups if keep_groups else "",
                ))
                numbers.append(at)
                owner.append(np.full(len(at), i))
            records = np.zeros((3, 0), np.int64)
            if numbers:
                pairs, which = known.links(np.concatenate(numbers))
                distinct, links = np.unique(np.concatenate(owner)[which] * pair_count + pairs, return_counts=True)
                records = np.stack([distinct // pair_count, distinct % pair_count, links])
            spill.add(docs, records)
            if spill.held >= run_records:
                yield from spill.rows()
        yield from spill.rows()

    return describe


# Counting -------------------------------------------------------------------------------


def merged(heads: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of sorted heads and the sums of their counts, by a heap over the heads."""
    width = len(heads)
    heap = heapq.merge(*[(pairs * width + i).tolist() for i, (pairs, _) in enumerate(heads)])
    order = np.fromiter(heap, np.int64, sum(len(pairs) for pairs, _ in heads))
    pairs, source = order // width, order % width
    counts = np.empty(len(order), np.int64)
    for i, (_, own) in enumerate(heads):
        counts[source == i] = own
    new = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return pairs[new], np.add.reduceat(counts, new)


def best_of(pairs: np.ndarray, counts: np.ndarray, b_size: int) -> np.ndarray:
    """Whether each pair's count is the highest of its A id; pairs are in side-major order."""
    a = pairs // b_size
    new = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    top = np.maximum.reduceat(counts, new)
    return counts == np.repeat(top, np.diff(np.append(new, len(a))))


def _table(run, radix, **blobs) -> pa.Table:
    return pa.table({
        "run": pa.array(run, pa.int64()), "radix": pa.array(radix, pa.int32()),
        **{name: pa.array(blob, pa.binary()) for name, blob in blobs.items()},
    })


def _merge(rows: pa.Table) -> pa.Table:
    """The heads of one group and radix as one."""
    heads = [_unpack(blob, np.int64, np.int64) for blob in rows["head"].to_pylist()]
    return _table([rows["group"][0].as_py()], [rows["radix"][0].as_py()], head=[_pack(*merged(heads))])


def _judge(b_size: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for blob in batch["head"].to_pylist():
                pairs, counts = _unpack(blob, np.int64, np.int64)
                out.append(_pack(pairs, counts, best_of(pairs, counts, b_size)))
            yield pa.RecordBatch.from_arrays(
                [batch["run"], batch["radix"], pa.array(out, pa.binary())], names=["run", "radix", "answer"]
            )

    return judge


def _hand_down(rows: pa.Table, answer: pa.Table) -> pa.Table:
    """What is known of a merged head, for each of the heads that went into it."""
    pairs, counts, best = _unpack(answer["answer"][0].as_py(), np.int64, np.int64, bool)
    out = []
    for blob in rows["head"].to_pylist():
        own, _ = _unpack(blob, np.int64, np.int64)
        at = np.searchsorted(pairs, own)
        out.append(_pack(own, counts[at], best[at]))
    return _table(rows["run"].to_pylist(), rows["radix"].to_pylist(), answer=out)


def _hand_out(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a run with what its records bring them."""
    answer_of = dict(zip(answers["radix"].to_pylist(), answers["answer"].to_pylist()))
    known, parts = None, []
    for radix, head, records in zip(*(rows[c].to_pylist() for c in ("radix", "head", "records"))):
        if radix == DOCUMENTS:
            known = pa.ipc.open_stream(head).read_all()
        else:
            parts.append((radix, head, records))
    n_best, count_sum = np.zeros((2, known.num_rows), np.int64)
    for radix, head, records in parts:
        _, many = _unpack(head, np.int64, np.int64)
        doc, links = _unpack(records, np.int32, np.int32)
        _, counts, best = _unpack(answer_of[radix], np.int64, np.int64, bool)
        np.add.at(n_best, doc, links * np.repeat(best, many))
        np.add.at(count_sum, doc, links * np.repeat(counts, many))
    return pa.table({
        "id": known["i"], "n_a": known["a"], "n_b": known["b"], "n_groups": known["g"], "n_links": known["l"],
        "n_best": n_best, "count_sum": count_sum, "groups_sha256": known["h"], "groups": known["x"],
    })


# Spark side -----------------------------------------------------------------------------


def spilled(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
    keep_groups: bool = False, run_records: int = RUN_RECORDS,
) -> DataFrame:
    """The runs of all documents, written to the shared folder."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return staged(rows.mapInArrow(_described(a_file, b_file, keep_groups, run_records), RUNS), "runs")


def counted(runs: DataFrame, b_file: str = B_FILE, fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """Heads of every round of merging, and the answer to the last one of each radix."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    rounds = [runs.filter(F.col("radix") != DOCUMENTS).select("run", "radix", "head")]
    left = runs.filter(F.col("radix") == DOCUMENTS).count()
    while True:
        left = -(-left // fan)
        grouped = rounds[-1].withColumn("group", F.pmod(F.xxhash64("run"), F.lit(max(left, 1))))
        rounds[-1] = grouped
        rounds.append(staged(grouped.groupBy("group", "radix").applyInArrow(_merge, HEADS), "heads"))
        if left <= 1:
            return rounds, rounds[-1].mapInArrow(_judge(b_size), ANSWERS)


def pair_table(runs: DataFrame, b_file: str = B_FILE, fan: int = FAN) -> DataFrame:
    """(a_id, b_id, documents, best) of every linked pair of ids in some runs."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["answer"].to_pylist():
                pairs, counts, best = _unpack(blob, np.int64, np.int64, bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((pairs // b_size).astype(np.int32)), pa.array((pairs % b_size).astype(np.int32)),
                        pa.array(counts), pa.array(best),
                    ],
                    names=["a_id", "b_id", "documents", "best"],
                )

    return counted(runs, b_file, fan)[1].mapInArrow(spread, PAIR_TABLE)


def aligned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
    keep_groups: bool = False, run_records: int = RUN_RECORDS, fan: int = FAN,
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``keep_groups`` adds the groups themselves (``a1,a2|b1;a3|b2,b3``). A null or empty text,
    and one whose tokens do not give its bytes back, has no tokens: zeros and an empty string.
    Every row is a document, repeated ones and those without an id too. Texts are read whole;
    a task holds the pieces of some, so a very long one is held by one task. An empty table
    gives no rows. Other columns are not read.
    """
    runs = spilled(docs, id_col, text_col, a_file, b_file, keep_groups, run_records)
    rounds, answers = counted(runs, b_file, fan)
    for heads in reversed(rounds[:-1]):
        answers = staged(
            heads.groupBy("group", "radix").cogroup(answers.groupBy("run", "radix")).applyInArrow(_hand_down, ANSWERS),
            "answers",
        )
    rows = runs.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_hand_out, ROWS)
    return rows.withColumnRenamed("id", id_col).drop(*([] if keep_groups else ["groups"]))
