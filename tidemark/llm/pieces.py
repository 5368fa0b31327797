"""SentencePiece encoding and decoding over a relational lattice.

A text is cut where no piece can cross: into *units*, mostly the letters of a word with
the space before it. Each distinct unit is encoded once: its substrings of bounded length
are exploded and joined by equality to the piece table, which gives the lattice; the edges
are grouped by unit and folded by a higher-order ``aggregate`` into the cuts of the unit.

* ``merge``, for piece files of the byte-pair kind such as the public one: their scores
  are ranks, not log probabilities, so the best path of added scores is not what the
  model says. The fold takes the edges by rank and joins two neighbours where an edge
  spans exactly the two; a 64-bit mask holds the cuts that are left.
* ``viterbi``, for unigram files: the fold keeps the best score of every position.

Units longer than the mask, and long runs of spaces, where joining two neighbours can
make a better rank possible again, are merged by the same rule with a heap.

Encoded units return to their documents by blocks: documents of consecutive rows, sized
to fit a task. Each block asks for its distinct units, and the answers meet the block's
packed texts in one cogroup. No unit, however frequent, has more than one row per block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.blocks import answered, for_each_block, in_blocks, unpack_raw, unpack_texts
from tidemark.llm.common import slices, staged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark that stands for a space, and the longest unit that the mask fold takes.
SPACE = "▁"
MASK_CHARS = 60
#: From this many spaces in a row on, ranks of merges need not rise.
SPACE_RUN = 15
#: Units whose edges a task groups in memory before it sorts them instead (some 500 bytes each).
HASHED = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
HASHED_UNITS = 100_000
#: Units of a block whose ids are looked up at once.
UNITS_AT_ONCE = 40_000


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model: normal pieces with id and score, and the ids of bytes."""

    normal: dict[str, tuple[int, float]]
    first_byte: int
    control: frozenset[int]
    kind: str

    @classmethod
    def load(cls, model_file: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal, control, first_byte = {}, set(), None
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                first_byte = i if first_byte is None else first_byte
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                control.add(i)
            else:
                normal[model.id_to_piece(i)] = (i, model.get_score(i))
        if first_byte is None:
            raise ValueError("the model has no byte pieces: texts would not decode exactly")
        ranks = all(score == int(score) for _, score in normal.values())
        return cls(normal, first_byte, frozenset(control), "merge" if ranks else "viterbi")

    @property
    def longest(self) -> int:
        return max(map(len, self.normal), default=1)

    def classes(self) -> list[set[str]]:
        """Characters that pieces connect: side by side in a piece, directly or by way of others."""
        if any(SPACE in p.lstrip(SPACE) for p in self.normal):
            raise ValueError("pieces that go on behind a space are not supported")
        group: dict[str, set[str]] = {}
        for piece in self.normal:
            inner = set(piece) - {SPACE}
            if len(piece) > 1 and inner:
                joined = set().union(inner, *(group[c] for c in inner if c in group))
                group.update(dict.fromkeys(joined, joined))
        return [set(own) for own in sorted({"".join(sorted(own)) for own in group.values()})]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(piece, score, rank from the best score on) of pieces that join characters."""
        ranks = {score: i for i, score in enumerate(sorted({s for _, s in self.normal.values()}, reverse=True))}
        rows = [(p, s, ranks[s]) for p, (_, s) in self.normal.items() if len(p) > 1 or self.kind == "viterbi"]
        return spark.createDataFrame(rows, "piece string, score double, rank int")

    def decoder(self) -> list[bytes]:
        """The bytes of every id; control pieces stand for nothing."""
        found = [b""] * (max([i for i, _ in self.normal.values()] + list(self.control) + [self.first_byte + 255]) + 1)
        for piece, (i, _) in self.normal.items():
            found[i] = piece.replace(SPACE, " ").encode("utf-8")
        for b in range(256):
            found[self.first_byte + b] = bytes([b])
        return found


class Cutter:
    """Cuts texts into units, many at once.

    A unit is a run of characters of one class with the spaces before it, or spaces alone,
    or one character of no class. No piece reaches from one unit into the next.
    """

    MARK, ALONE = 0, 1

    def __init__(self, pieces: Pieces):
        self.of = np.full(0x110000, self.ALONE, np.uint16)
        self.of[ord(SPACE)] = self.MARK
        for i, own in enumerate(pieces.classes()):
            self.of[[ord(c) for c in own]] = i + 2

    def cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """All texts in a row as the model sees them, the start, length and hash of each unit,
        and how many units each text has.

        Spaces are marked and one is put in front of a text, as the model does.
        """
        whole = "".join([SPACE + t for t in texts if t]).replace(" ", SPACE)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.of[codes]
        size = np.fromiter(((len(t) + 1) if t else 0 for t in texts), np.int64, len(texts))
        ends = np.cumsum(size)
        new = np.ones(len(codes), bool)
        if len(codes):
            here, before = kind[1:], kind[:-1]
            apart = (here == self.ALONE) | (before == self.ALONE)
            new[1:] = apart | ((here != before) & (before != self.MARK))
            new[ends[:-1][ends[:-1] < len(codes)]] = True
        start = np.flatnonzero(new)
        length = np.diff(start, append=len(codes))
        counts = np.diff(np.searchsorted(start, ends), prepend=0)
        return whole, start, length, part_hashes(codes, length), counts


_POWERS = np.random.default_rng(11).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def part_hashes(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the parts that make up a row of characters."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    start = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(start, lengths)
    h = np.add.reduceat(codes * _POWERS[place % len(_POWERS)], start)
    h = (h + lengths.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


# Lattice ---------------------------------------------------------------------------


def lattice(units: DataFrame, pieces: Pieces, edge: Column) -> DataFrame:
    """(unit, n, edges): ``edge`` of every piece that stands in a unit from ``s`` to ``e``, in order."""
    least = 1 if pieces.kind == "viterbi" else 2
    starts = units.withColumn("n", F.length("unit")).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - least, F.lit(0))))
    )
    last = F.least(F.col("s") + F.lit(pieces.longest), F.col("n"))
    spans = starts.withColumn("e", F.explode(F.sequence(F.least(F.col("s") + least, last), last)))
    table = F.broadcast(pieces.frame(units.sparkSession))  # as large as the model
    edges = spans.withColumn("piece", F.expr("substring(unit, s + 1, e - s)")).join(table, "piece")
    return edges.groupBy("unit", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _packed_edge() -> Column:
    """rank, s and e in one number that orders like them."""
    return F.expr(f"(rank * {MASK_CHARS + 4} + s) * {MASK_CHARS + 4} + e")


def _merge_cuts() -> Column:
    """Mask of the cuts that are left: bit k is a cut before character k.

    An edge joins the two parts it spans, if there are just two: both its ends are cuts and
    one cut lies between.
    """
    base = MASK_CHARS + 4
    s, e = f"cast((x div {base}) % {base} as int)", f"cast(x % {base} as int)"
    inside = f"(shiftleft(1L, {e}) - shiftleft(1L, {s} + 1))"
    joins = f"bit_count(m & {inside}) = 1 AND bit_get(m, {s}) = 1 AND bit_get(m, {e}) = 1"
    fold = f"aggregate(edges, shiftleft(1L, n + 1) - 1L, (m, x) -> if({joins}, m & ~{inside}, m))"
    return F.array(F.expr(fold))


def _viterbi_cuts(worst: float) -> Column:
    """Cut positions behind a -1: the best way to each position, then back from the end.

    Edges come in order of their ends. A character without a piece costs ``worst``.
    """
    way = "named_struct('score', b[x.s].score + x.score, 'at', x.s)"
    one = f"named_struct('score', b[k - 1].score + {worst}D, 'at', k - 1)"
    step = (
        f"(b, k) -> aggregate(filter(edges, x -> x.e = k), concat(b, array({one})), "
        f"(b, x) -> if(b[x.s].score + x.score > b[k].score, concat(slice(b, 1, k), array({way})), b))"
    )
    start = "array(named_struct('score', 0D, 'at', -1))"
    best = f"aggregate(sequence(1, n), {start}, {step})"
    back = (
        f"aggregate(sequence(1, n), named_struct('b', {best}, 'cuts', array(n)), (a, k) -> if(a.cuts[0] <= 0, a, "
        "named_struct('b', a.b, 'cuts', concat(array(a.b[a.cuts[0]].at), a.cuts))), "
        "a -> transform(filter(a.cuts, c -> c > 0 AND c < n), c -> bigint(c)))"
    )
    return F.concat(F.array(F.lit(-1).cast("long")), F.expr(back))


def cuts_of(values: list[int], n: int) -> list[int]:
    """Positions inside a unit from its answer: a mask, or -1 and the positions."""
    if values[0] < 0:
        return values[1:]
    mask = values[0]
    return [k for k in range(1, n) if mask >> k & 1]


def merge_by_heap(n: int, edges: list[dict]) -> list[int]:
    """-1 and the cuts of one unit: neighbours with the best rank are joined, the leftmost of equal ones first."""
    rank = {(x["s"], x["e"]): x["rank"] for x in edges}
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(rank[s, s + 2], s, s + 1, s + 2) for s in range(n - 1) if (s, s + 2) in rank]
    heapq.heapify(heap)
    gone = [False] * (n + 1)
    while heap:
        _, s, middle, e = heapq.heappop(heap)
        if gone[s] or gone[middle] or end[s] != middle or end[middle] != e:
            continue
        gone[middle] = True
        end[s] = e
        if e < n:
            before[e] = s
            if (s, end[e]) in rank:
                heapq.heappush(heap, (rank[s, end[e]], s, e, end[e]))
        if s > 0 and (before[s], e) in rank:
            heapq.heappush(heap, (rank[before[s], e], before[s], s, e))
    return [-1, *(k for k in range(1, n) if not gone[k])]


def _by_heap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts = [merge_by_heap(n, edges) for n, edges in zip(batch["n"].to_pylist(), batch["edges"].to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["unit"], pa.array(cuts, pa.list_(pa.int64()))], names=["unit", "cuts"])


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, cuts) for distinct, non-empty units; see ``cuts_of``. A unit without edges is left out."""
    if pieces.kind == "viterbi":
        worst = min(score for _, score in pieces.normal.values()) - 10
        edges = lattice(units, pieces, F.struct("e", "s", "score"))
        return edges.select("unit", _viterbi_cuts(worst).alias("cuts"))
    long = (F.length("unit") > MASK_CHARS) | F.col("unit").contains(SPACE * SPACE_RUN)
    usual = lattice(units.filter(~long), pieces, _packed_edge())
    rest = lattice(units.filter(long), pieces, F.struct("rank", "s", "e"))
    return usual.select("unit", _merge_cuts().alias("cuts")).unionByName(
        rest.mapInArrow(_by_heap, "unit string, cuts array<long>")
    )


# Documents -------------------------------------------------------------------------


class Wanted:
    """The distinct units of each block that a task reads; a block is held as hashes and bytes."""

    def __init__(self, cutter: Cutter):
        self.cutter = cutter

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, found = None, np.zeros(0, np.uint64), []
        for batch in slices(batches):
            blocks, texts = batch["block"].to_numpy(zero_copy_only=False), batch["text"].to_pylist()
            edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                if blocks[a] != current:
                    yield from self.rows(current, found)
                    current, known, found = int(blocks[a]), np.zeros(0, np.uint64), []
                whole, start, length, hashes, _ = self.cutter.cut(texts[a:b])
                # The same hash is the same unit; if not, the round trip of a text would fail.
                hashes, first = np.unique(hashes, return_index=True)
                at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                new = known[at] != hashes if len(known) else np.ones(len(hashes), bool)
                found.append(_strings(whole, start[first[new]], length[first[new]]))
                known = np.sort(np.concatenate([known, hashes[new]]))
        yield from self.rows(current, found)

    @staticmethod
    def rows(block: int | None, found: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        for units in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(units), block, np.int64)), units], names=["block", "word"]
            )


def _strings(whole: str, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The parts of a text from ``start`` (characters) on."""
    raw = np.frombuffer(whole.encode("utf-8"), np.uint8)
    place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    begin, size = place[start], place[start + length] - place[start]
    ends = np.cumsum(size)
    data = raw[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


class Vocabulary:
    """Ids of many parts of units at once, and the bytes of many ids."""

    def __init__(self, pieces: Pieces):
        names = list(pieces.normal)
        ids = np.array([pieces.normal[n][0] for n in names], np.int64)
        self.first_byte = pieces.first_byte
        letters = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        hashes = part_hashes(letters, np.fromiter(map(len, names), np.int64, len(names)))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")
        parts = pieces.decoder()
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def encode(self, text: str, size: np.ndarray, is_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units that make up the text, and how many each unit has.

        ``size`` is the length of each unit; ``is_cut`` tells for every character whether a
        part starts with it. A part that is no piece is one character and gives its bytes.
        """
        if not len(size):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        begins = np.flatnonzero(is_cut)
        lengths = np.diff(begins, append=len(text))
        hashes = part_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), lengths)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        ids, times = self.ids[at], np.ones(len(begins), np.int64)
        strangers = np.flatnonzero(~known).tolist()
        raw = [text[begins[i]].encode("utf-8") for i in strangers]
        times[strangers] = list(map(len, raw))
        flat = np.repeat(ids, times)
        ends = np.cumsum(times)
        for i, own in zip(strangers, raw):
            flat[ends[i] - len(own) : ends[i]] = [self.first_byte + b for b in own]
        first = np.searchsorted(begins, np.cumsum(size) - size)
        return flat.astype(np.int32), np.add.reduceat(times, first)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids in a row."""
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.bytes[at].tobytes()


class Assembler:
    """Encodes the documents of a block from its answered units, and decodes them again."""

    def __init__(self, pieces: Pieces, cutter: Cutter, with_ids: bool):
        self.vocabulary, self.cutter, self.with_ids = Vocabulary(pieces), cutter, with_ids

    def _units(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the block's units, and of each the first id and the number of ids."""
        raw, bytes_of, sizes, values = unpack_raw(answers)
        byte_at = np.concatenate([[0], np.cumsum(bytes_of, dtype=np.int64)]).tolist()
        value_at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
        hashes, flat, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a in range(0, len(sizes), UNITS_AT_ONCE):
            b = min(a + UNITS_AT_ONCE, len(sizes))
            found = self._encoded(
                raw[byte_at[a] : byte_at[b]], bytes_of[a:b], sizes[a:b], values[value_at[a] : value_at[b]]
            )
            for own, part in zip((hashes, flat, counts), found):
                own.append(part)
        hashes, flat, count = (np.concatenate(own) for own in (hashes, flat, counts))
        order = np.argsort(hashes)
        return hashes[order], flat, np.stack([(np.cumsum(count) - count)[order], count[order]])

    def _encoded(self, raw: bytes, bytes_of, sizes, values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of some units, their ids in a row, and how many each has."""
        text, units = raw.decode("utf-8"), len(sizes)
        ahead = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters up to each byte
        ends = np.concatenate([[0], ahead])[np.cumsum(bytes_of, dtype=np.int64)]
        length = np.diff(ends, prepend=0)
        start = ends - length
        place = np.arange(len(text)) - np.repeat(start, length)
        value_at = np.cumsum(sizes, dtype=np.int64) - sizes
        # Without an edge every character is a part: all cuts are set.
        masks = np.full(units, 2**63 - 1, np.int64)
        masks[sizes > 0] = values[value_at[sizes > 0]]
        is_cut = (np.repeat(masks, length) >> np.minimum(place, 62)) & 1 == 1
        for i in np.flatnonzero(masks < 0).tolist():  # cuts are listed
            own = np.zeros(length[i], bool)
            own[[0, *cuts_of(values[value_at[i] : value_at[i] + sizes[i]].tolist(), int(length[i]))]] = True
            is_cut[start[i] : start[i] + length[i]] = own
        flat, count = self.vocabulary.encode(text, length, is_cut)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return part_hashes(codes, length), flat, count

    def block(self, texts: pa.Table, answers: pa.Table) -> pa.Table:
        known, flat, at = self._units(answers)
        rows: list[tuple] = []
        pieces = [np.zeros(0, np.int32)]
        for keys, packed in unpack_texts(texts):
            _, _, _, hashes, counts = self.cutter.cut([t.decode("utf-8") for t in packed])
            which = np.searchsorted(known, hashes) if len(known) else np.zeros(0, np.int64)
            begins, sizes = at[0][which], at[1][which]
            ends = np.cumsum(sizes)
            ids = flat[np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
            last = np.concatenate([[0], ends])[np.cumsum(counts)]
            for key, text, a, b in zip(keys, packed, [0, *last[:-1].tolist()], last.tolist()):
                own = ids[a:b]
                back = self.vocabulary.decode(own)[1:]  # without the space put in front
                rows.append((key, len(own), sha256(own.astype("<i4").tobytes()).hexdigest(), back == text))
            if self.with_ids:
                pieces.append(ids)
        kinds = [("id", pa.int64()), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_())]
        columns = {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)}
        if self.with_ids:
            ends = np.concatenate([[0], np.cumsum([r[1] for r in rows], dtype=np.int64)]).astype(np.int32)
            columns["pieces"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pieces)))
        return pa.table(columns)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL, with_ids: bool = False
) -> DataFrame:
    """One row per document: id, n_pieces, ids_sha256 (of little-endian 32-bit ids), round_trip.

    ``with_ids`` adds the ids. ``round_trip`` tells whether the decoded ids are the text
    again; it fails only for texts that hold the character U+2581 itself, which the model
    cannot tell from a space. Null texts count as empty; an empty text has no pieces. Null
    ids and repeated rows give a row each. An empty table gives no rows. Other columns are
    not read.
    """
    pieces = Pieces.load(model_file)
    cutter = Cutter(pieces)
    rows = in_blocks(docs, id_col, text_col)
    wanted = staged(rows.select("block", "text").mapInArrow(Wanted(cutter), "block long, word string"), "wanted")
    units = wanted.select(F.col("word").alias("unit")).distinct()
    encoded = staged(encode_units(units, pieces), "units", **{HASHED: str(HASHED_UNITS)})
    found = encoded.select(F.col("unit").alias("word"), F.col("cuts").alias("values"))
    schema = "id long, n_pieces long, ids_sha256 string, round_trip boolean" + (", pieces array<int>" if with_ids else "")
    assembler = Assembler(pieces, cutter, with_ids)
    whole = for_each_block(rows, answered(wanted, found, "answers"), assembler.block, schema)
    return whole.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "pieces", text_col: str = "text", model_file: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its ids; null ids give a null text, bytes that are no UTF-8 a replacement mark."""
    found = Pieces.load(model_file).decoder()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [
                None if ids is None else b"".join([found[i] for i in ids])[1 if ids else 0 :].decode("utf-8", "replace")
                for ids in batch[ids_col].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string())], names=[*batch.schema.names, text_col])

    kept = encoded.select(*[c for c in encoded.columns if c != text_col])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(texts, f"{fields}, `{text_col}` string")
