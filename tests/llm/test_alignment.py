"""Linked tokens against a plain reading of both tokenizer files."""

from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF
from tokenizers import Tokenizer

from scoreloom.llm import alignment
from scoreloom.llm.common import prepare
from scoreloom.llm.queries import CATALOG, alignment_tokenizers

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain_byte_level():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in letters}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    return tokenizer, byte_of


def brute(rows):
    first, byte_of = plain_byte_level()
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def spelled(piece):
        if piece.startswith("<0x") and len(piece) == 6:
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    docs, holders, links = [], defaultdict(set), Counter()
    for n, (key, text) in enumerate(rows):
        a = first.encode(" " + text, add_special_tokens=False) if text else None
        ids_a = a.ids if text else []
        ids_b = second.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in t) for t in a.tokens] if text else []
        bytes_b = [spelled(second.id_to_piece(i)) for i in ids_b]
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            docs.append((key, [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        groups, i, j = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((ids_a[i:x], ids_b[j:y]))
            i, j = x, y
        pairs = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        for pair, times in pairs.items():
            holders[pair].add(n)
            links[pair] += times
        docs.append((key, ids_a, ids_b, groups, pairs))
    most: dict = {}
    for (x, _), held in holders.items():
        most[x] = max(most.get(x, 0), len(held))
    out = []
    for key, ids_a, ids_b, groups, *pairs in docs:
        pairs = pairs[0] if pairs else {}
        best = sum(n for p, n in pairs.items() if len(holders[p]) == most[p[0]])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        hashed = sha256(text.encode()).hexdigest() if groups else ""
        total = sum(n * len(holders[p]) for p, n in pairs.items())
        out.append((key, len(ids_a), len(ids_b), len(groups), sum(pairs.values()), best, total, hashed))
    return out, {p: (len(h), links[p], len(h) == most[p[0]]) for p, h in holders.items()}


ODD = [
    (None, "no key"), (1, None), (2, ""), (3, " "), (4, "\n\n  \t"), (5, "the same"), (5, "the same"), (6, "a ▁ b"),
    (7, "<|endoftext|> <s> </s> <unk>"), (8, "日本語のテキスト 한국어 ไทย"), (9, "é é ﬁ ½ 👩‍👩‍👧 ​"), (10, "x" * 5000),
    (11, "ab " * 40000), (12, "\x00\x01 nul"), (13, "q7Zr9wP2LmX0vB5nYtK8" * 30), (14, "  two  spaces   three "), (15, " " * 3000),
    (16, "don't we'll I'M 12345 3.14159"), (17, "　wide\xa0blank"), (18, "�﻿ mark"),
]


def run(spark, rows, pieces=3):
    prepare(spark)
    df = spark.createDataFrame([(k, t, "a", 1, "c") for k, t in rows], "doc_id bigint, text string, a string, slot int, chunk string")
    documents, pairs = alignment.align_tokens(df.repartition(pieces), alignment_tokenizers())
    got = sorted((tuple(r) for r in documents.select(*NAMES).collect()), key=repr)
    return got, {(r.a, r.b): (r.documents, r.links, r.best) for r in pairs.collect()}


def test_odd_texts(spark):
    docs, pairs = brute(ODD)
    got, counted = run(spark, ODD)
    assert got == sorted(docs, key=repr)
    assert counted == pairs
    assert run(spark, []) == ([], {})


def test_no_tokens_at_all(spark):
    docs, _ = brute(ODD[1:3])
    assert run(spark, ODD[1:3])[0] == sorted(docs, key=repr)


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_POSTINGS", 200)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    rows = [(i, f"{'common words here ' * (i % 9)} number {i % 13}") for i in range(300)] + ODD
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    documents, pairs = alignment.align_tokens(df, alignment_tokenizers())
    docs, want = brute(rows)
    assert sorted((tuple(r) for r in documents.select(*NAMES).collect()), key=repr) == sorted(docs, key=repr)
    assert {(r.a, r.b): (r.documents, r.links, r.best) for r in pairs.collect()} == want
    prepare(spark)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs, _ = brute(rows)
    got = CATALOG["op12_tokenizer_alignment"].run(spark, SF)
    assert tuple(got.columns) == NAMES
    assert sorted(map(tuple, got.collect())) == sorted(docs)


@pytest.mark.parametrize("slots", [[], [0], [3, 9, 65535], list(range(0, 65536, 3)), list(range(65536))])
def test_bitmaps(slots):
    dense, bits = alignment.bitmap(np.asarray(slots, np.int64), 1 << 16)
    assert alignment.numbers_in(dense, bits).tolist() == slots
    assert len(bits) <= min(2 * len(slots), 8192)


def test_ranks_give_the_ids_of_the_file():
    """Every character, in several surroundings."""
    tokenizers = alignment_tokenizers()
    fast = alignment.ByteLevel(tokenizers.byte_level, tokenizers.pattern)
    assert fast.ranks is not None
    for start in range(0, 0x110000, 4096):
        chars = [chr(c) for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000]
        text = " ".join(f"a{c}b {c}{c} 1{c}.{c}\n" for c in chars)
        if text:
            assert fast.encode(text[:100_000]).tolist() == fast.own.encode(text[:100_000], add_special_tokens=False).ids
