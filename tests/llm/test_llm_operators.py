"""Each operator against brute force on small fixtures: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm import (
    ann,
    byte_bpe,
    components,
    jaccard,
    language_id,
    line_dedup,
    packing,
    token_counts,
    topk,
    url_filters,
    warc,
)
from scoreloom.llm.common import prepare
from scoreloom.llm.queries import packing_tokenizer


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


DOCS = [
    (1, "The quick brown fox jumps over the lazy dog.\nIt was a line of some length, it was indeed."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "No key, but a text that is long enough to be a line of its own."),
    (5, "word " * 5000),
    (6, "Ünïcode ß und 漢字 and emoji 🙂🙂 <|endoftext|> don't stop"),
    (1, "The quick brown fox jumps over the lazy dog.\nIt was a line of some length, it was indeed."),
    (7, "x" * 3000),
    (8, "it was a line of some length, it was indeed.\r\nThe end"),
]


def frame(spark, rows, kind="doc_id bigint, text string"):
    """The rows with columns whose names the operators use themselves."""
    names = ("key", "node", "ids", "host", "token", "group", "row", "line", "tokens", "chars", "removed", "start", "vector")
    return spark.createDataFrame(rows, kind).withColumns({n: F.lit("clash") for n in names})


def shingle_sets(docs):
    out = []
    for key, text in docs:
        words = (text or "").encode().lower().split()
        out.append((key, frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()))
    return out


def brute_components(docs):
    sets = [(k, s) for k, s in shingle_sets(docs) if k is not None]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        least[root(i)] = min(k, least.get(root(i), k))
    return sorted((k, len(s), least[root(i)]) for i, (k, s) in enumerate(sets))


def near_copies(seed, groups, copies, words=60):
    rng = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            docs.append(" ".join(text))
    rng.shuffle(docs)
    return list(enumerate(docs, 100))


def test_near_duplicates(spark):
    docs = DOCS + [(9, "one two three"), (10, "ONE  two\tthree"), (11, "one two three four")] + near_copies(1, 6, 5)
    # an id with two texts: one equals that of a smaller id, the other is close to a third
    other = " ".join(f"z{i}" for i in range(50))
    docs += [(300, "a b c d e f g"), (301, "A b c d e f g"), (301, other), (302, other + " end")]
    got = jaccard.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got)) == brute_components(docs)


def test_near_duplicates_in_crowded_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 450)
    monkeypatch.setattr(jaccard, "PURE", 4)
    docs = near_copies(2, 2, 60)
    got = jaccard.near_duplicates(frame(spark, docs)).collect()
    want = brute_components(docs)
    assert sorted(map(tuple, got)) == want
    assert 2 < len({c for _, _, c in want}) < len(docs)


def test_small_pools_are_one_block(spark):
    nodes = spark.createDataFrame([(i, i % 2, False) for i in range(20)], "node bigint, pool bigint, pure boolean")
    sets = spark.createDataFrame([(i, bytearray(8 * (10 + 20 * i))) for i in range(20)], "node bigint, tokens binary")
    dealt = jaccard._blocks(nodes, sets, jaccard.SIMILAR).collect()
    assert len(dealt) == 20 and len({r.block for r in dealt}) == 2 == len({(r.pool, r.block) for r in dealt})


def test_groups_under_a_token(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(12), i, rng.randrange(4), 9) for i in range(30)] + [(99, 5, 7, 9)]
    live = jaccard._live(spark.createDataFrame(rows, "token bigint, node bigint, `group` bigint, n bigint")).collect()
    under = {t: [r for r in rows if r[0] == t] for t, *_ in rows}
    assert sorted((r.token, r.node, r.group, r.n) for r in live) == sorted(r for r in rows if len(under[r[0]]) > 1)
    assert all(r.m == len({g for _, _, g, _ in under[r.token]}) for r in live)
    assert sorted((r.token, r.group) for r in live if r.head) == sorted({(r.token, r.group) for r in live})


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in got} == {x: root(x) for x in linked}


def test_token_counts_follow_edits(vocabulary):
    encode = vocabulary.encoding().encode_ordinary
    find, rng = regex.compile(token_counts._CUT).search, random.Random(3)
    count = lambda texts: [len(encode(t)) for t in texts]
    texts = [t for _, t in DOCS if t is not None] + [" ".join(rng.choice(["a", "bc.", "été", "12"]) for _ in range(900)) for _ in range(20)]
    for text in texts:
        ends = token_counts.cut_points(text, find, 100)
        starts = [0, *ends[:-1]]
        chars = [b - a for a, b in zip(starts, ends, strict=True)]
        tokens = count([text[a:b] for a, b in zip(starts, ends, strict=True)])
        assert sum(tokens) == len(encode(text))
        for _ in range(3):
            edits = []
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(text) + 1)
                edits.append((at, at + rng.choice([0, 1, 60, 700]), rng.choice(["", " ", "ab", " x y", "\n\n"])))
            want = text
            for start, end, new in reversed(token_counts.merged(edits, len(text))):
                want = want[:start] + new + want[end:]
            text, chars, tokens, _ = token_counts.edited(text, chars, tokens, edits, count)
            assert (text, sum(chars), sum(tokens)) == (want, len(want), len(encode(want)))


def test_token_counts_of_rows(spark, vocabulary):
    edits = F.array(F.struct(F.lit(-3).alias("start"), F.lit(2).alias("end"), F.lit("New ").alias("new")), F.lit(None))
    counted = token_counts.count_tokens(frame(spark, DOCS), vocabulary)
    rows = token_counts.apply_edits(counted.withColumn("edits", edits), vocabulary).select("doc_id", "text", "tokens").collect()
    encode = vocabulary.encoding().encode_ordinary
    assert len(rows) == len(DOCS)
    for (key, text), row in zip(DOCS, rows, strict=True):
        want = None if text is None else "New " + text[2:]
        assert (row.doc_id, row.text) == (key, want)
        assert (row.tokens is None) if want is None else sum(row.tokens) == len(encode(want))


def within(a, b, limit):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1] <= limit


def test_line_facts(spark):
    # more of one letter than four bits count, within two edits and beyond
    lines = ["e" * 40 + " x", "e" * 42 + " x", "e" * 58 + " x", "tea " * 16 + "end", "tea " * 15 + "te end", "tee " * 16 + "end"]
    docs = list(enumerate(lines))
    got = {r.doc_id for r in line_dedup.repeated_lines(frame(spark, docs)).collect()}
    assert got == {j for j, y in docs for i, x in docs[:j] if within(x, y, 2)} == {1, 4}
    rows = frame(spark, docs).select(F.col("doc_id").alias("key"), "text")
    none = line_dedup.exact_repeats(rows)
    # a line carries what the join reads and nothing else
    assert set(line_dedup._distinct_lines(rows, none, 5).columns) == {"key", "text_hash", "line_no", "line", "id", "length", "counts"}


def test_line_dedup(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde fgh é") for _ in range(rng.randrange(40, 60))) for _ in range(12)]
    lines = []
    for _ in range(90):
        line = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(line))
            line[at : at + rng.randrange(2)] = rng.choice(["", "x", "y z"])
        lines.append("".join(line))
    docs = DOCS + [(100 + i, "\n".join(lines[3 * i : 3 * i + 3])) for i in range(30)]
    df = frame(spark, docs)
    found = line_dedup.repeated_lines(df)
    got = {(r.doc_id, i) for r in found.collect() for i in r.lines}
    places = sorted({(k, i, x) for k, t in docs if k is not None and t is not None for i, x in enumerate(t.split("\n")) if x.strip()})
    near = lambda x, y: x == y or min(len(x), len(y)) >= line_dedup.MIN_CHARS and abs(len(x) - len(y)) <= 2 and within(x, y, 2)
    want = {(k, i) for n, (k, i, x) in enumerate(places) for _, _, y in places[:n] if near(x, y)}
    assert got == want and want
    cleaned = line_dedup.without_lines(df, found).select("doc_id", "text", "removed").collect()
    for (key, text), row in zip(sorted(docs, key=str), sorted(cleaned, key=lambda r: str((r[0], r[1]))), strict=True):
        assert row.text == (text and "\n".join(x for i, x in enumerate(text.split("\n")) if (key, i) not in got))


def test_large_group_of_near_lines(spark):
    """Lines of one sentence, each with a word or two of its own: the first candidates are not always near."""
    rng = random.Random(9)
    sentence = "the quick brown fox jumps over the lazy dog and runs away from it"
    lines = ["".join(rng.choice("xyz") if rng.random() < 0.04 else c for c in sentence) for _ in range(120)]
    docs = [(i, line) for i, line in enumerate(lines)]
    got = {r.doc_id for r in line_dedup.repeated_lines(frame(spark, docs)).collect()}
    want = {i for i, x in enumerate(lines) if any(x == y or abs(len(x) - len(y)) <= 2 and within(x, y, 2) for y in lines[:i])}
    assert got == want and 20 < len(want) < 119


def test_removed_has_a_name_of_its_own(spark):
    docs = spark.createDataFrame([(1, "a line\na line", 7), (2, None, 8)], "doc_id int, text string, removed int")
    found = line_dedup.repeated_lines(docs)
    got = {r.doc_id: (r.removed, r.gone) for r in line_dedup.without_lines(docs, found, removed="gone").collect()}
    assert got == {1: (7, 1), 2: (8, 0)}


def test_byte_bpe_round_trip_in_chunks(spark, vocabulary):
    docs = DOCS + [(20, "many words and 123 numbers, " * 60), (21, "a b" * 200 + "z" * 700)]
    encoding = vocabulary.encoding()
    for chunk, overlap in ((1 << 16, 1 << 10), (200, 40)):
        encoded = byte_bpe.encode(frame(spark, docs), vocabulary, chunk=chunk, overlap=overlap)
        rows = byte_bpe.decode(encoded, vocabulary).collect()
        got = sorted(((r.doc_id, byte_bpe.unpacked(r.ids), bytes(r.decoded)) for r in rows), key=str)
        want = sorted(((k, encoding.encode_ordinary(t or ""), (t or "").encode()) for k, t in docs), key=str)
        assert got == want


URLS = [
    (1, "http://A.Example.com/en/x/"), (2, None), (3, "no url"), (4, "https://www.example.com/en/"), (5, "ftp://news.net/fr/1?q#f"),
    (6, "http://news.net/it/1"), (7, "http://NEWS.net/it/1/"), (8, "http://example.com?x"), (9, "http://com/"), (None, "http://b.org/z"), (6, "http://news.net/it/1"),
]


def test_url_filters(spark):
    rules = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/fr/"))
    pages = frame(spark, URLS, "page_id bigint, url string").drop("host").withColumn("path", F.lit(1))
    listed = spark.createDataFrame([("news.net/it/1",), (None,), ("news.net/it/1",), ("c.org",)], "a string")
    rows = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, listed, rules).collect()}
    assert rows == {
        (1, "a.example.com", "/en/x/", "example.com/en/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "www.example.com", "/en/", "www.example.com/en/", "allow"), (5, "news.net", "/fr/1", "net/fr/", "block"),
        (6, "news.net", "/it/1", None, "block"), (7, "news.net", "/it/1/", None, "block"), (8, "example.com", "", None, "allow"),
        (9, "com", "/", "com/", "allow"), (None, "b.org", "/z", None, "allow"),
    }
    with pytest.raises(ValueError):
        url_filters.judge(pages, listed, [("allow", "a", "/"), ("block", "a", "/")])


def test_bloom_filter_has_no_false_negatives(spark):
    listed = spark.range(2000).selectExpr("concat('h', id) address")
    bloom = url_filters.build_filter(listed, 64)
    probed = url_filters.may_hold(spark.range(6000).selectExpr("concat('h', id) address", "id"), bloom, 64, False)
    row = probed.agg(F.count_if(F.expr("maybe and id < 2000")).alias("hit"), F.count_if(F.expr("maybe and id >= 2000")).alias("false")).first()
    assert row.hit == 2000 and row["false"] < 400


def test_warc_round_trip(spark):
    long = "é" * 600
    pages = [(1, "http://a/", long), (2, None, long), (3, "http://b/\r\nx", "tiny"), (4, "http://c/", "tiny"), (5, "u", None), (6, "u", "<p>\r\n\r\nWARC/1.1</p>" * 99), (None, "u", long)]
    folder = warc.archive_folder(spark)
    warc.write_warc(frame(spark, pages, "page_id bigint, url string, html string"), folder, file_records=3)
    read = warc.read_warc(spark, folder)
    store = warc.store_records(read)
    rows = {(warc_id, kind, refers, digest) for warc_id, kind, refers, digest in store.headers.select("record_id", "record_type", "refers_to", "digest").collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = {(f"urn:page:{k}" if k else "urn:page:null", "revisit" if k == 1 else "response", "urn:page:2" if k == 1 else None, sha(t)) for k, _, t in pages}
    assert rows == want
    assert store.payloads.count() == len({sha(t) for _, _, t in pages})
    closing = b"\r\n\r\n"
    exact = sorted(bytes(r.header) + bytes(r.payload or b"") + closing for r in read.collect())
    assert sorted(bytes(r.record) for r in store.records().collect()) == exact


def clean_vectors(rows):
    return {k: np.asarray(v, float) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all()}


def some_vectors(n=700, width=8):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=width).round(3).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)]  # ties
    odd = [None, [], [float("nan")] * width, [1.0, None] * (width // 2), [float("inf")] * width, [0.0] * width]
    return rows + [(2000 + i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), (5, rows[5][1])]


def best_of(vectors, key, k, kind):
    mine = vectors[key]
    scored = sorted((-kind(mine @ v), j) for j, v in vectors.items() if j != key)
    return [(key, i, j, -s) for i, (s, j) in enumerate(scored[:k], 1)]


def test_exact_topk(spark):
    rows = some_vectors()
    df = frame(spark, rows, "vec_id bigint, embedding array<double>")
    got = topk.search(df, F.col("vec_id") % 100 == 0, 5, 1024.0, block=128, query_block=3).collect()
    whole = {k: np.floor(1024 * v) for k, v in clean_vectors(rows).items()}
    want = [r for key in sorted(whole) if key % 100 == 0 for r in best_of(whole, key, 5, int)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_beyond_doubles(spark):
    rows = [(100, [3e13, 1.0]), (1, [2e13, 7.0]), (2, [2e13, 5.0]), (3, [-1e15, 0.0])]
    got = topk.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 100, 3, 1.0).collect()
    top = (1 << 63) - 1
    assert [tuple(r) for r in got] == [(100, 1, 1, top), (100, 2, 2, top), (100, 3, 3, -top - 1)]


def test_nearest_neighbours(spark):
    rows = some_vectors()
    df = frame(spark, rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, ann.search(df, F.col("vec_id") % 20 == 0, 10).collect()))
    vectors = {k: v for k, v in clean_vectors(rows).items() if v.any()}
    want = [r for key in sorted(vectors) if key % 20 == 0 for r in best_of(vectors, key, 10, float)]
    found = {(r[0], r[2]) for r in got}
    assert len(found & {(r[0], r[2]) for r in want}) >= 0.9 * len(want)
    for query, _, other, score in got:
        assert score == pytest.approx(vectors[query] @ vectors[other], abs=1e-12)
    assert [r[1] for r in got] == [i for _, g in itertools.groupby(r[0] for r in got) for i in range(1, len(list(g)) + 1)]


def test_packing(spark):
    tokenizer = packing_tokenizer()
    reference = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    special = [(28, "a <|endoftext|> b<|startoftext|>c <|endoftext|>"), (29, "<|startoftext|>")]
    assert reference.encode(special[0][1], add_special_tokens=False).ids == [320, 49407, 321, 49406, 322, 49407]
    docs = DOCS + special + [(30 + i, f"Document {i} on topic {i % 3}, éa ß. Und " * (i + 1)) for i in range(25)]
    rows = packing.pack(frame(spark, docs), tokenizer, window=64, shard_tokens=500, partition_tokens=2000).collect()
    want = sorted((k, tuple([*reference.encode(t or "", add_special_tokens=False).ids, 2])) for k, t in docs if k not in (None, 1))
    got = {}
    for r in sorted((r for r in rows if r.doc_id not in (None, 1)), key=lambda r: (r.doc_id, r.start)):
        ids = byte_bpe.unpacked(r.ids)
        assert len(ids) == r.length and r.start == len(got.get(r.doc_id, ()))
        got[r.doc_id] = got.get(r.doc_id, ()) + tuple(ids)
    assert sorted(got.items()) == want
    assert sum(r.length for r in rows) == sum(len(reference.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n & (n - 1) == 0 and n <= 64 for n in sequences.values())


def test_plain_words_equal_the_tokenizer():
    tokenizer = packing_tokenizer()
    plain, rng = packing._PlainWords(tokenizer.file), random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGXYZßäöüéèñçÀÖØÿªµº"
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) + rng.choice(["", ",", "."]) for _ in range(5000)}
    words = [w for w in words if plain.takes(w)]
    want = {w: np.asarray(e.ids, "<u2").tobytes() for w, e in zip(words, tokenizer._load().encode_batch(words, add_special_tokens=False), strict=True)}
    assert plain.encode(words, "<u2") == want
    assert not any(map(plain.takes, ["", ".", "a1", "it's", "İ", "a b", "..."]))


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs.where("doc_id % 2 = 0"), ("de", "en", "es", "fr"))
    found = language_id.identify(docs.where("doc_id % 2 = 1"), model, host=F.col("source")).join(docs, "doc_id")
    row = found.agg(F.avg((F.col("language") == F.col("lang")).cast("int")).alias("right"), F.avg(F.col("kept").cast("int")).alias("kept")).first()
    assert row.right >= 0.95 and row.kept >= 0.95
    odd = frame(spark, [*DOCS, (50, "\x01\x02 ~~~ @@@ {}{}{} ^^^ ``` 0x9 \x05" * 20)]).drop("host")
    rows = {(r.doc_id, r.language, r.kept) for r in language_id.identify(odd, model, declared=F.lit("en-US"), address=F.lit("http://a.de/x")).collect()}
    assert {(2, "und", False), (3, "und", False), (4, "und", False), (50, "und", False)} <= rows
    assert (1, "en", True) in rows


def test_evidence_of_markup_address_and_host(spark):
    assert language_id.fit(spark.createDataFrame([], "text string, lang string"), ("de", "en")).likelihoods("abc").shape == (3,)
    even = language_id.TextModel(("de", "en"), np.log(np.full((language_id.BUCKETS, 3), 1 / language_id.BUCKETS)))
    rows = [(1, "t", "<html lang='de'>", "http://x.org/en/a", "h"), (2, "t", "<html>", "http://x.de/", "h"), (3, "t", None, None, "h")]
    df = spark.createDataFrame(rows, "doc_id int, text string, html string, url string, h string")
    got = language_id.identify(df, even, declared=language_id.declared_in(F.col("html")), address=F.col("url"), host=F.col("h"))
    assert {r.doc_id: r.language for r in got.collect()} == {1: "de", 2: "de", 3: "de"}


def test_empty_tables(spark, vocabulary):
    docs, none = frame(spark, []), spark.createDataFrame([], "a string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    model = language_id.fit(docs.withColumn("lang", F.lit("en")), ("en", "de"))
    folder = warc.archive_folder(spark)
    warc.write_warc(pages, folder)
    results = [
        jaccard.near_duplicates(docs),
        token_counts.count_tokens(docs, vocabulary),
        line_dedup.repeated_lines(docs),
        byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary),
        url_filters.judge(pages, none, ()),
        warc.store_records(warc.read_warc(spark, folder)).records(),
        ann.search(vectors, F.col("vec_id") > 0, 3),
        topk.search(vectors, F.col("vec_id") > 0, 3, 8.0),
        packing.pack(docs, packing_tokenizer()),
        language_id.identify(docs, model),
    ]
    assert [df.count() for df in results] == [0] * len(results)


def test_packing_encodes_few_units_in_one_call(monkeypatch):
    import pyarrow as pa

    from scoreloom.llm import packing
    from scoreloom.llm.queries import packing_tokenizer

    texts = pa.array(["one two three, four five. six", "x1 y2 z3 a-b c_d", "", "one again\nand more words"])
    tokenizer = packing_tokenizer()
    kind = packing.id_kind(tokenizer)
    whole = tokenizer.encoder(kind)(texts)
    calls = []
    plain = packing._PlainWords.encode
    monkeypatch.setattr(packing._PlainWords, "encode", lambda self, words, kind: calls.append(len(words)) or plain(self, words, kind))
    monkeypatch.setattr(packing, "AT_ONCE", 2)
    assert tokenizer.encoder(kind)(texts) == whole
    assert len(calls) > 2 and max(calls) == 2


def test_packing_takes_words_with_marks_in_one_call():
    import string

    tokenizer = packing_tokenizer()
    plain, rng = packing._PlainWords(tokenizer.file), random.Random(11)
    tails = [m * n for m in string.punctuation for n in (1, 2, 3)] + ["".join(rng.choice(string.punctuation) for _ in range(rng.randrange(1, 6))) for _ in range(2000)]
    words = sorted({rng.choice(["a", "Über", "naïve", "don", "endoftext", "ÿµ", "it"]) + tail for tail in tails})
    taken = [w for w in words if plain.takes(w)]
    assert all(map(plain.takes, ["a%%%", "Über!!", "it,.", "ÿµ#"]))
    assert not any(c in w for w in taken for c in "'<|>") and len(taken) > 500
    want = {w: np.asarray(e.ids, "<u2").tobytes() for w, e in zip(taken, tokenizer._load().encode_batch(taken, add_special_tokens=False), strict=True)}
    assert plain.encode(taken, "<u2") == want


def test_packing_lists_units_and_columns():
    import pyarrow as pa

    for units in ([], [""], ["", "a", "", "é,"], ["a"]):
        assert packing._listed(pa.array(units, pa.string())) == units
        values = [u.encode() for u in units]
        assert packing._column(values).to_pylist() == values


def test_letters_are_counted_in_what_is_left(spark):
    # each step looks at what the steps before have left of the line, and the counts are those of the whole line
    assert "replace(replace(line, 'e'), 't')" in line_dedup._COUNTS
    rng = random.Random(3)
    lines = ["", "e", "éé xyz"] + ["".join(rng.choice("etaonirshldcumfp é.xE") for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select("line", F.expr(line_dedup._COUNTS)).collect()
    for line, counts in rows:
        assert [counts >> 4 * i & 15 for i in range(16)] == [line.count(c) % 16 for c in line_dedup._LETTERS]


def test_tokens_of_bytes_and_of_characters(spark):
    # a segment is known by the same hash whether the line has other characters than ASCII or not
    line = "the same long segment of a line, and then another part of it, and the end"
    docs = [(1, line), (2, line[:-2] + "é" + line[-1]), (3, line[:-30] + "xyz" + line[-30:-4]), (4, "ß" + line[1:])]
    got = {r.doc_id for r in line_dedup.repeated_lines(frame(spark, docs)).collect()}
    assert got == {j for j, y in docs for i, x in docs if i < j and within(x, y, 2)} == {2, 4}
