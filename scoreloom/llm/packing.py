"""Packing of documents into windows with lexical neighbours.

Documents become token ids once. A sharded BM25 index over those ids then finds, for the document
that opens a window, the unused documents most like it, and the window is filled with them in that
order; the last one is cut and what is left of it opens the next window. So every window is full.

Shards come from the order of the documents by their rarest term: neighbours in that order are
in one shard, a partition is read as a stream, and a task holds one shard at a time. Statistics of
the terms cover all documents; their table has a row per id of the vocabulary at most.
"""

from __future__ import annotations

import json
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import add_columns, release_memory
from scoreloom.session import materialize

WINDOW = 4096
#: Tokens of a shard, held by a task at a time, and of a partition.
SHARD_TOKENS = 1 << 19
PARTITION_TOKENS = 1 << 23
#: Units of text whose ids a task remembers.
REMEMBERED = 500_000
#: Units encoded in one call; what that takes on the way is far more than their ids.
AT_ONCE = 1 << 14
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class WordTokenizer:
    """A tokenizer file whose pre-tokens never hold white space, and the id that ends a document."""

    file: bytes
    end_id: int

    @classmethod
    def read(cls, path: str, end_id: int) -> WordTokenizer:
        with open(path, "rb") as file:
            return cls(file.read(), end_id)

    def size(self) -> int:
        found = self._load().get_vocab_size()
        release_memory()  # the driver keeps what loading took otherwise
        return found

    def _load(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_buffer(self.file)

    def encoder(self, kind: str):
        """A function from a column of texts to packed ids. Runs without blanks are encoded once and remembered."""
        tokenizer, plain, known = self._load(), _PlainWords(self.file), {}
        end = np.asarray([self.end_id], kind).tobytes()
        # what reading the file took is as much as a batch and its ids
        release_memory()

        def learn(new: list[str]) -> None:
            words, rest = [], []
            for unit in new:
                (words if plain.takes(unit) else rest).append(unit)
            for some in _slices(words):
                known.update(plain.encode(some, kind))
            for some in _slices(rest):
                for unit, found in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    known[unit] = np.asarray(found.ids, kind).tobytes()

        def encode(texts: pa.Array) -> list[bytes]:
            if len(known) > REMEMBERED:
                known.clear()
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            coded = cut.flatten().dictionary_encode()
            units = _listed(coded.dictionary)
            learn([u for u in units if u not in known])
            packed = _column([known[u] for u in units]).take(coded.indices)
            ends = np.frombuffer(packed.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist()
            data = packed.buffers()[2]
            data = data.to_pybytes() if data is not None else b""
            return [data[a:b] + end for a, b in zip(ends[:-1], ends[1:], strict=True)]

        return encode


def _slices(units: list[str]) -> Iterator[list[str]]:
    return (units[i : i + AT_ONCE] for i in range(0, len(units), AT_ONCE))


def _listed(units: pa.Array) -> list[str]:
    """Strings without blanks as Python's, by one split of all of them, which is far faster than one by one."""
    if not len(units):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


def _column(values: list[bytes]) -> pa.Array:
    ends = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)), out=ends[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))])


class _PlainWords:
    """The same merges on plain words, many in one call: Latin-1 letters, then ASCII marks or nothing.

    Such a word is one pre-token (two with the marks), lower case changes it letter by letter and
    normalisation leaves it alone. A zero byte stands for the end of a word, as the suffix does in the file.
    """

    SUFFIX = "</w>"
    #: All but the apostrophe and what special tokens are written with.
    MARKS = "".join(c for c in string.punctuation if c not in "'<|>")
    _TAIL = re.compile(f"[{re.escape(MARKS)}]+")

    def __init__(self, file: bytes):
        import tiktoken

        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in letters]
        byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = json.loads(file)
        special = {t["content"] for t in vocabulary["added_tokens"]}
        ranks = {}
        for token, number in vocabulary["model"]["vocab"].items():
            if token not in special:
                core = token.removesuffix(self.SUFFIX)
                ranks[bytes(byte_of[c] for c in core) + b"\0" * (core != token)] = number
        self.encoding = tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
        self.closes = np.zeros(max(ranks.values()) + 1, bool)
        self.closes[[n for t, n in ranks.items() if len(t) > 1 and t.endswith(b"\0")]] = True

    @classmethod
    def takes(cls, unit: str) -> bool:
        core = unit.rstrip(cls.MARKS)
        return core.isalpha() and (core.isascii() or max(core) <= "\xff")

    def encode(self, words: list[str], kind: str) -> dict[str, bytes]:
        if not words:
            return {}
        # marks stand at the ends of words only
        text = self._TAIL.sub("\0\\g<0>", "\0".join(words).lower()) + "\0"
        ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        pieces = np.fromiter((2 if w[-1] in self.MARKS else 1 for w in words), np.int64, len(words))
        ends = np.flatnonzero(self.closes[ids])[np.cumsum(pieces) - 1] + 1
        data, width = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
        cuts = [0, *(ends * width).tolist()]
        return {w: data[a:b] for w, a, b in zip(words, cuts[:-1], cuts[1:], strict=True)}


def tokens_of(docs: DataFrame, tokenizer: WordTokenizer, key: str, text: str) -> DataFrame:
    """``(key, lead, ids)``: ids packed as the narrowest integers that hold the vocabulary, and the greatest of them.

    Vocabularies number their tokens from common to rare, so the lead is the rarest term of the document.
    """
    kind = id_kind(tokenizer)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def make():
        encode = tokenizer.encoder(kind)

        def work(batch):
            ids = encode(batch.column("text"))
            leads = [int(np.frombuffer(x, kind).max()) for x in ids]
            return [pa.array(leads, pa.int32()), pa.array(ids, pa.binary())]

        return work

    return add_columns(rows, make, "lead int, ids binary", drop=("text",))


def id_kind(tokenizer: WordTokenizer) -> str:
    return "<u2" if max(tokenizer.size(), tokenizer.end_id + 1) <= 1 << 16 else "<u4"


@dataclass(frozen=True)
class Terms:
    """Statistics over all documents: weight of each id, mean length, number of tokens."""

    idf: np.ndarray
    mean_length: float
    tokens: int


def term_statistics(tokens: DataFrame, kind: str, vocabulary: int) -> Terms:
    """Document frequencies of all ids. What reaches the driver is bounded by the vocabulary."""

    def count(batches):
        seen, docs, total = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                ids = np.frombuffer(ids, kind)
                seen[np.unique(ids)] += 1
                docs, total = docs + 1, total + len(ids)
        terms = np.flatnonzero(seen)
        rows = [*zip(terms.tolist(), seen[terms].tolist(), strict=True), (-1, docs), (-2, total)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["term", "n"])

    counts = tokens.select("ids").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {row.term: row.n for row in counts.collect()}
    docs, total = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(vocabulary, np.float64)
    for term, n in found.items():
        df[term] = n
    return Terms(np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32), total / max(docs, 1), total)


def _weights(ids: np.ndarray, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a document and their BM25 weights."""
    found, tf = np.unique(ids, return_counts=True)
    norm = K1 * (1 - B + B * len(ids) / terms.mean_length)
    return found, (terms.idf[found] * (tf * (K1 + 1) / (tf + norm))).astype(np.float32)


class _Index:
    """Postings of one shard: for each id the documents that have it, with weights."""

    def __init__(self, docs: list[np.ndarray], terms: Terms):
        parts = [_weights(ids, terms) for ids in docs]
        lengths = [len(p[0]) for p in parts]
        term = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.doc = np.repeat(np.arange(len(docs)), lengths)[order]
        self.weight = np.concatenate([p[1] for p in parts])[order] if parts else np.zeros(0, np.float32)
        self.first = np.searchsorted(term[order], np.arange(len(terms.idf) + 1))
        self.size = len(docs)

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for the distinct ids of ``query``."""
        query = np.unique(query)
        start, count = self.first[query], self.first[query + 1] - self.first[query]
        at = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        return np.bincount(self.doc[at], self.weight[at], self.size)


class _Packer:
    """Windows of one partition. Pieces are (key, ids of the document, start, stop)."""

    def __init__(self, terms: Terms, window: int):
        self.terms, self.window = terms, window
        self.open: list[tuple] = []
        self.filled, self.seed = 0, None
        self.done: list[list[tuple]] = []

    def put(self, doc: tuple, start: int) -> int:
        """Take as much as fits; where the rest of the document starts."""
        key, ids = doc
        stop = min(len(ids), start + self.window - self.filled)
        if not self.open:
            self.seed = ids[start:]
        self.open.append((key, ids, start, stop))
        self.filled += stop - start
        if self.filled == self.window:
            self.done.append(self.open)
            self.open, self.filled = [], 0
        return stop

    def shard(self, docs: list[tuple]) -> None:
        starts = [0] * len(docs)
        for i, doc in enumerate(docs):  # whole windows of long documents need no neighbour
            if not self.open:
                while len(doc[1]) - starts[i] >= self.window:
                    starts[i] = self.put(doc, starts[i])
        unused = np.asarray([len(d[1]) > s for d, s in zip(docs, starts, strict=True)], bool)
        index = _Index([d[1][s:] for d, s in zip(docs, starts, strict=True)], self.terms)
        first, cut = 0, None
        while True:
            if not self.open:
                while first < len(docs) and not unused[first]:
                    first += 1
                at = cut if cut is not None else first
                if at == len(docs):
                    return
            else:
                if not unused.any():
                    return
                scores = np.where(unused, index.scores(self.seed), -1.0)
                at = None
                for at in np.argsort(-scores, kind="stable")[: int(unused.sum())].tolist():
                    starts[at] = self.put(docs[at], starts[at])
                    unused[at] = starts[at] < len(docs[at][1])
                    if not self.open:
                        break
                cut = at if unused[at] else None
                continue
            while unused[at]:
                starts[at] = self.put(docs[at], starts[at])
                unused[at] = starts[at] < len(docs[at][1])
            cut = None

    def close(self) -> None:
        """What is left goes into windows of powers of two, which need no padding."""
        pieces, self.open = self.open, []
        while self.filled:
            room = 1 << (self.filled.bit_length() - 1)
            self.filled -= room
            window = []
            while room:
                key, ids, start, stop = pieces.pop(0)
                cut = min(stop, start + room)
                window.append((key, ids, start, cut))
                room -= cut - start
                if cut < stop:
                    pieces.insert(0, (key, ids, cut, stop))
            self.done.append(window)


def pack(
    docs: DataFrame,
    tokenizer: WordTokenizer,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    partition_tokens: int = PARTITION_TOKENS,
) -> DataFrame:
    """One row per piece: key, start, length, ids, doc_tokens, sequence_id, offset.

    A document is its ids and the closing id; every id lies in exactly one piece. ``ids`` are the
    piece's, packed as little-endian unsigned 32-bit integers. Pieces of a sequence follow each
    other from offset 0 without gaps. Sequences have ``window`` ids; the rest of each partition
    goes into sequences of powers of two, so none needs padding.

    A null or empty text has the closing id only. Null keys and repeated rows are documents of
    their own, an empty table gives no rows, and further columns are not looked at.
    """
    kind, vocabulary = id_kind(tokenizer), max(tokenizer.size(), tokenizer.end_id + 1)
    tokens = materialize(tokens_of(docs, tokenizer, key, text), "tokens")
    terms = term_statistics(tokens, kind, vocabulary)

    def run(batches):
        release_memory()
        packer, held, size, number = _Packer(terms, window), [], 0, TaskContext.get().partitionId() << 40
        key_type = None

        def rows(last: bool):
            nonlocal held, size, number
            packer.shard(held)
            held, size = [], 0
            if last:
                packer.close()
            columns: dict[str, list] = {n: [] for n in ("key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for pieces in packer.done:
                offset = 0
                for doc_key, ids, start, stop in pieces:
                    values = (doc_key, start, stop - start, ids[start:stop].astype("<u4").tobytes(), len(ids), number, offset)
                    for column, value in zip(columns.values(), values, strict=True):
                        column.append(value)
                    offset += stop - start
                number += 1
            packer.done = []
            types = {"key": key_type, "ids": pa.binary()}
            return pa.RecordBatch.from_arrays(
                [pa.array(v, types.get(n, pa.int64())) for n, v in columns.items()], names=list(columns)
            )

        for batch in batches:
            key_type = batch.column("key").type
            for doc_key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held.append((doc_key, np.frombuffer(ids, kind)))
                size += len(held[-1][1])
                if size >= shard_tokens:
                    yield rows(False)
        if key_type is not None:
            yield rows(True)

    partitions = max(1, math.ceil(terms.tokens / partition_tokens))
    dealt = tokens.repartitionByRange(partitions, "lead", "key", F.xxhash64("ids")).sortWithinPartitions("lead", "key", "ids")
    key_kind = docs.schema[key].dataType.simpleString()
    pieces = dealt.select("key", "ids").mapInArrow(
        run, f"key {key_kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return pieces.withColumnRenamed("key", key)
