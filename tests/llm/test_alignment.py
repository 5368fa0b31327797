import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame, prose
from tidemark.llm import alignment

ODD = [
    (200, "  two spaces  inside\n\nand lines \t tabs ", "en", "a", 1), (201, " one", "en", "a", 1),
    (202, "<|endoftext|> <s> </s> <unk> <0x41> it's we'll 12345", "en", "a", 1), (203, "mark ▁ here", "en", "a", 1),
    (204, "日本語のテキスト 中文 　wide\xa0space 🙂 é é", "fr", "b", 1), (205, "a" * 700 + " " * 90 + "b", "en", "a", 1),
    (206, "don't don't don't the the the", "en", "a", 1), (207, " ", "en", "a", 1), (208, "\n", "en", "a", 1),
    (209, "x \x1c y \x85 z\r\nw", "en", "a", 1),
]


def tokens_by_hand():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.A_FILE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=alignment.B_FILE)
    table = {}
    other = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            table[chr(byte)] = byte
        else:
            table[chr(256 + other)] = byte
            other += 1

    def cut(text):
        left, right = [], []
        for i in a.encode(" " + text, add_special_tokens=False).ids:
            left.append((i, bytes(table[c] for c in a.id_to_token(i))))
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if b"".join(t for _, t in left) != raw or b"".join(t for _, t in right) != raw:
            return [], []
        return left, right

    return cut


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def by_hand(rows):
    cut = tokens_by_hand()
    docs, held = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = map(spans, cut(text) if text else ([], []))
        # A pair overlaps when each begins before the other ends; neighbours only are tried.
        links, start = [], 0
        for i, s, e in a:
            while start < len(b) and b[start][2] <= s:
                start += 1
            k = start
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        parts, low = [], 0
        for end in common:
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)]
            parts.append("|".join(inside))
            low = end
        docs.append((doc_id, len(a), len(b), len(common), links, ";".join(parts)))
        held.update(set(links))
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, groups in docs:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((
            str(doc_id), n_a, n_b, n_groups, len(links), sum(held[p] == top[p[0]] for p in links),
            sum(held[p] for p in links), digest,
        ))
    table = sorted((i, j, n, n == top[i]) for (i, j), n in held.items())
    return sorted(out), table, {str(d[0]): d[5] for d in docs}


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def collected(df):
    return sorted((str(r.doc_id), *[r[c] for c in COLUMNS[1:]]) for r in df.collect())


@pytest.mark.parametrize("run_records, fan", [(500_000, 256), (300, 2), (40, 3)])
def test_rows_equal_brute_force(spark, run_records, fan):
    rows = awkward_rows() + ODD
    want, table, groups = by_hand(rows)
    docs = frame(spark, rows).repartition(5)
    got = alignment.aligned(docs, run_records=run_records, fan=fan)
    assert got.columns == COLUMNS
    assert collected(got) == want
    runs = alignment.spilled(docs, run_records=run_records)
    assert sorted(tuple(r) for r in alignment.pair_table(runs, fan=fan).collect()) == table
    texts = {str(r.doc_id): r.groups for r in alignment.aligned(docs, keep_groups=True).collect()}
    assert texts == groups


def test_remembered_pieces_may_be_forgotten_at_any_time(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 80)), "en", "a", 1) for i in range(80)]
    want, _, _ = by_hand(rows)
    tokenizers = alignment.Tokenizers(alignment.A_FILE, alignment.B_FILE)
    monkeypatch.setattr(alignment, "PIECES_HELD", 5)
    known = alignment.Remembered(tokenizers)
    for row, expected in zip(sorted(rows, key=lambda r: str(r[0])), want):
        parts = tokenizers.cut(row[1])
        assert " ".join(parts) == row[1]
        known.learn(set(parts))
        at = np.array([known.number[p] for p in parts])
        assert tuple(known.counts[:, at].sum(axis=1)) == expected[1:5]


def test_cutting_changes_no_token():
    tokenizers = alignment.Tokenizers(alignment.A_FILE, alignment.B_FILE)
    rng = random.Random(4)
    letters = ["a", "b", "'s", "12", " ", " ", "  ", "\n", "\t", "é", "日", ".", "　", "\xa0", "\x1f", "🙂", "n't"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        a, b = tokenizers.encode(tokenizers.cut(text))
        assert sum(a, []) == tokenizers.a.encode(" " + text, add_special_tokens=False).ids
        assert sum(b, []) == tokenizers.b.encode(text)


def test_heap_merge_sums_and_marks_the_highest():
    rng = np.random.default_rng(0)
    heads = []
    total = Counter()
    for _ in range(7):
        pairs = np.unique(rng.integers(0, 60, rng.integers(1, 50)))
        counts = rng.integers(1, 5, len(pairs))
        heads.append((pairs, counts))
        for p, c in zip(pairs.tolist(), counts.tolist()):
            total[p] += c
    pairs, counts = alignment.merged(heads)
    assert dict(zip(pairs.tolist(), counts.tolist())) == total
    best = alignment.best_of(pairs, counts, 10)
    for p, c, b in zip(pairs.tolist(), counts.tolist(), best.tolist()):
        assert b == (c == max(n for q, n in total.items() if q // 10 == p // 10))


def test_hot_text_and_empty_table(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "the same words").alias("text"))
    got = alignment.aligned(docs, run_records=500)
    assert got.filter("n_links > 0").count() == 2000
    row = got.filter("doc_id = 1").first()
    assert row.count_sum == 2000 * row.n_links
    assert got.filter("groups_sha256 = '' AND n_a = 0 AND count_sum = 0").count() == 1000
    assert alignment.aligned(empty(spark)).collect() == []
