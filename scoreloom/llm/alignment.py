"""Which tokens of one vocabulary stand for which of another, over a whole corpus.

A text is encoded by two tokenizers whose tokens spell the same bytes. Places where tokens of both end cut the
tokens into groups, and every token of the one side is linked with every token of the other in its group.

For each pair of ids an inverted list of documents is kept as bitmaps. Documents are numbered within chunks of
bounded size; a bitmap row says which documents of a chunk hold the pair, as sorted 16-bit numbers or as
bits, whichever is shorter. A pair may be linked several times in one document: plane ``k + 1`` marks
the documents whose number of further links has bit ``k``. Bitmaps of the batches of a chunk are OR-merged as it
closes; popcounts of the chunks add up to document and link counts of the pair.

Scores come from the same postings: each row meets the counts of its pair and goes to its chunk, where the marked
documents get their shares. A task holds the sums of one chunk at a time, never the list of a pair.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import materialize

#: A chunk closes at so many documents (their numbers have 16 bits) or postings.
CHUNK_DOCS, CHUNK_POSTINGS = 1 << 16, 1 << 20
#: Bytes of text whose tokens are held at a time; a longer text is held whole.
PART_BYTES = 1 << 19
#: Links of a group from which its ids are counted before they are paired.
WIDE_GROUP = 1 << 12
#: Characters from which a text is encoded by the tokenizer file itself and not by the faster library.
LONG_TEXT = 1 << 17
_SLOT_BITS = 16

_DOC_FIELDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_POSTING_FIELDS = "a int, b int, plane int, dense boolean, marked bigint, bits binary"


class ByteLevel:
    """A byte-level BPE file: ids of texts, and the bytes of each id.

    The merges run in a library that takes ranks where the file numbers its tokens in the order of its merges;
    otherwise, and for very long texts, the file's own library encodes.
    """

    def __init__(self, file: bytes, pattern: str):
        import tiktoken

        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in letters]
        byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(hidden)}
        content = json.loads(file)
        special = {t["content"] for t in content["added_tokens"]}
        vocabulary = content["model"]["vocab"]
        plain = {bytes(byte_of[c] for c in token): n for token, n in vocabulary.items() if token not in special}
        size = max([*vocabulary.values(), *(t["id"] for t in content["added_tokens"])]) + 1
        self.bytes_of = [b""] * size
        for token, n in plain.items():
            self.bytes_of[n] = token
        for token in content["added_tokens"]:
            self.bytes_of[token["id"]] = token["content"].encode()
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in content["model"]["merges"]]
        numbers = [vocabulary[m] for m in merges]
        in_order = numbers == sorted(numbers) and len(numbers) + 256 == len(plain) and min(numbers, default=256) == 256
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=plain, special_tokens={}) if in_order else None
        self.file = file

    @cached_property
    def own(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(self.file)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is None or len(text) > LONG_TEXT:
            return np.asarray(self.own.encode(text, add_special_tokens=False).ids, np.int64)
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class Pieces:
    """A piece model: ids of texts, and the bytes of each id."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        pieces = [(n, self.model.id_to_piece(n)) for n in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(n) else piece.replace("▁", " ").encode() for n, piece in pieces
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@dataclass(frozen=True)
class Tokenizers:
    """The files of the two tokenizers, and the pattern by which the first cuts texts before it merges."""

    byte_level: bytes
    pattern: str
    pieces: bytes

    @classmethod
    def read(cls, byte_level: str, pattern: str, pieces: str) -> Tokenizers:
        with open(byte_level, "rb") as a, open(pieces, "rb") as b:
            return cls(a.read(), pattern, b.read())


# bitmaps


def bitmap(slots: np.ndarray, docs: int) -> tuple[bool, bytes]:
    """Sorted numbers under ``docs`` as (dense, bytes)."""
    if len(slots) * 16 <= docs:
        return False, slots.astype("<u2").tobytes()
    marks = np.zeros(docs, np.uint8)
    marks[slots] = 1
    return True, np.packbits(marks).tobytes()


def numbers_in(dense: bool, bits: bytes) -> np.ndarray:
    """The numbers of a bitmap."""
    if not dense:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))


def _bitmap_rows(pairs: np.ndarray, slots: np.ndarray, docs: int, plane: int, width: int) -> list[pa.RecordBatch]:
    """Posting rows of one plane: ``pairs`` sorted, with the sorted slots of each. Sparse rows are cut from one buffer."""
    if not len(pairs):
        return []
    starts = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    counts = np.diff(np.append(starts, len(pairs)))
    ids = pairs[starts]
    sparse = counts * 16 <= docs
    in_sparse = np.repeat(sparse, counts)
    sizes = counts[sparse]
    offsets = np.concatenate(([0], np.cumsum(sizes * 2))).astype(np.int32)
    data = slots[in_sparse].astype("<u2").tobytes()
    rows = [(ids[sparse], sizes, pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), False)]
    packed = [bitmap(slots[starts[i] : starts[i] + counts[i]], docs)[1] for i in np.flatnonzero(~sparse)]
    rows.append((ids[~sparse], counts[~sparse], pa.array(packed, pa.binary()), True))
    return [
        pa.RecordBatch.from_arrays(
            [
                pa.array((found // width).astype(np.int32)),
                pa.array((found % width).astype(np.int32)),
                pa.array(np.full(len(found), plane, np.int32)),
                pa.array(np.full(len(found), dense)),
                pa.array(marked.astype(np.int64)),
                bits,
            ],
            names=["a", "b", "plane", "dense", "marked", "bits"],
        )
        for found, marked, bits, dense in rows
        if len(found)
    ]


# groups of a batch


@dataclass
class Aligned:
    """Tokens of the texts of a batch that both sides spell alike, on end, and their groups."""

    docs: np.ndarray
    a: np.ndarray
    b: np.ndarray
    group_doc: np.ndarray
    in_a: np.ndarray
    in_b: np.ndarray


def _spelled(ids: np.ndarray, table: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Ends of the tokens and all their bytes."""
    taken = table.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
    data = taken.buffers()[2]
    return offsets[1:], memoryview(data).cast("B")[: offsets[-1]] if data is not None else memoryview(b"")


def align(texts: list[str], first: ByteLevel, second: Pieces, table_a: pa.Array, table_b: pa.Array) -> Aligned:
    """``docs`` are the places of the texts that have tokens."""
    kept, a, b = [], [], []
    for place, (text, pieces) in enumerate(zip(texts, second.encode(texts), strict=True)):
        if not text:
            continue
        ids = first.encode(" " + text)
        spelled = (" " + text).encode()
        if all(_spelled(x, t)[1] == spelled for x, t in ((ids, table_a), (pieces, table_b))):
            kept.append(place)
            a.append(ids)
            b.append(pieces)
    if not kept:
        none = np.zeros(0, np.int64)
        return Aligned(none, none, none, none, none, none)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    ends_a, ends_b = _spelled(flat_a, table_a)[0], _spelled(flat_b, table_b)[0]
    ends = np.zeros(ends_a[-1] + 1, np.uint8)
    ends[ends_a] = 1
    ends[ends_b] += 1
    shared_a, shared_b = ends[ends_a] == 2, ends[ends_b] == 2
    # a group ends with a token that ends at a shared place
    last_a, last_b = np.flatnonzero(shared_a), np.flatnonzero(shared_b)
    in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    doc_ends = np.cumsum([len(x) for x in a])
    group_doc = np.searchsorted(doc_ends, last_a, side="right")
    return Aligned(np.asarray(kept), flat_a, flat_b, group_doc, in_a, in_b)


def _groups_text(found: Aligned, digits: list[pa.Array]) -> list[str]:
    """SHA-256 of the groups of each document, written ``a1,a2|b1;a3|b2``.

    Every id is taken from a list of its digits with the sign that follows it, so the text of a batch is one buffer.
    """
    sizes = found.in_a + found.in_b
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    inner_a = np.arange(len(found.a)) - np.repeat(np.cumsum(found.in_a) - found.in_a, found.in_a)
    inner_b = np.arange(len(found.b)) - np.repeat(np.cumsum(found.in_b) - found.in_b, found.in_b)
    at_a = np.repeat(starts, found.in_a) + inner_a
    at_b = np.repeat(starts + found.in_a, found.in_b) + inner_b
    ids, signs = np.zeros(total, np.int64), np.zeros(total, np.int64)
    ids[at_a], ids[at_b] = found.a, found.b
    signs[starts + found.in_a - 1] = 1
    signs[starts + sizes - 1] = 2
    group_ends = np.flatnonzero(np.diff(found.group_doc, append=-1))
    signs[(starts + sizes - 1)[group_ends]] = 3
    width = len(digits[0]) // 4
    taken = digits[0].take(pa.array(signs * width + ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: total + 1]
    text = memoryview(taken.buffers()[2])
    cuts = [0, *offsets[(starts + sizes)[group_ends]].tolist()]
    return [sha256(text[x:y]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _links(found: Aligned, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, document) as one number each, sorted, with the number of links."""
    first_a, first_b = np.cumsum(found.in_a) - found.in_a, np.cumsum(found.in_b) - found.in_b
    links = found.in_a * found.in_b
    narrow = links <= WIDE_GROUP
    size = np.where(narrow, links, 0)
    group = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    in_b = found.in_b[group]
    a = found.a[first_a[group] + inner // in_b]
    b = found.b[first_b[group] + inner % in_b]
    keys, times = np.unique(((a * width + b) << _SLOT_BITS) | found.group_doc[group], return_counts=True)
    for g in np.flatnonzero(~narrow).tolist():
        ids_a, times_a = np.unique(found.a[first_a[g] : first_a[g] + found.in_a[g]], return_counts=True)
        ids_b, times_b = np.unique(found.b[first_b[g] : first_b[g] + found.in_b[g]], return_counts=True)
        pairs = (ids_a[:, None] * width + ids_b[None, :]).ravel()
        keys = np.concatenate((keys, (pairs << _SLOT_BITS) | found.group_doc[g]))
        times = np.concatenate((times, np.outer(times_a, times_b).ravel()))
    return _summed(keys, times) + (links,)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys become one, with the sum of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(times, starts) if len(starts) else times


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of ``PART_BYTES`` of text."""
    before = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        if stop > start:
            yield batch.slice(start, stop - start)


def _read(docs: DataFrame, tokenizers: Tokenizers, key_field: str) -> DataFrame:
    """One pass over the texts: a row per document, and the bitmap rows of each chunk."""
    fields = f"{key_field}, chunk bigint, slot int, {_DOC_FIELDS}, {_POSTING_FIELDS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = loaded = None
        chunk, slots, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def told(batch: pa.RecordBatch) -> pa.RecordBatch:
            """The batch with nulls for the columns it lacks."""
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            return pa.RecordBatch.from_arrays(
                [have[f.name] if f.name in have else pa.nulls(batch.num_rows, f.type) for f in schema], schema=schema
            )

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            keys, times = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
            pairs, places, further = keys >> _SLOT_BITS, keys & ((1 << _SLOT_BITS) - 1), times - 1
            plane = 0
            while True:
                chosen = np.ones(len(keys), bool) if plane == 0 else (further >> (plane - 1)) & 1 == 1
                for rows in _bitmap_rows(pairs[chosen], places[chosen], slots, plane, len(loaded[1].bytes_of)):
                    yield told(rows.append_column("chunk", pa.array(np.full(rows.num_rows, chunk))))
                plane += 1
                if not len(further) or int(further.max()) >> (plane - 1) == 0:
                    break

        for batch in (part for whole in batches for part in _parts(whole)):
            if loaded is None:
                first, second = ByteLevel(tokenizers.byte_level, tokenizers.pattern), Pieces(tokenizers.pieces)
                tables = [pa.array(x.bytes_of, pa.large_binary()) for x in (first, second)]
                widest = max(len(first.bytes_of), len(second.bytes_of))
                digits = [pa.array([f"{n}{sign}".encode() for sign in (",", "|", ";", "") for n in range(widest)], pa.large_binary())]
                loaded = (first, second)
                schema = pa.schema(
                    [("key", batch.schema.field("key").type), ("chunk", pa.int64()), ("slot", pa.int32())]
                    + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                    + [("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32())]
                    + [("dense", pa.bool_()), ("marked", pa.int64()), ("bits", pa.binary())]
                )
            count = batch.num_rows
            if held and (slots + count > CHUNK_DOCS or size >= CHUNK_POSTINGS):
                yield from closed()
            if slots + count > CHUNK_DOCS or (size == 0 and slots):
                chunk, slots = chunk + 1, 0
            found = align(batch.column("text").to_pylist(), first, second, *tables)
            numbers = {n: np.zeros(count, np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")}
            hashes = np.full(count, "", object)
            if len(found.docs):
                keys, times, links = _links(found, len(second.bytes_of))
                owner = found.docs[found.group_doc]
                for name, weights in (("n_a", found.in_a), ("n_b", found.in_b), ("n_groups", np.ones_like(links)), ("n_links", links)):
                    np.add.at(numbers[name], owner, weights)
                hashes[found.docs] = _groups_text(found, digits)
                held.append(((keys >> _SLOT_BITS << _SLOT_BITS) | (found.docs[keys & ((1 << _SLOT_BITS) - 1)] + slots), times))
                size += len(keys)
            arrays = {n: pa.array(v) for n, v in numbers.items()}
            yield told(
                pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        pa.array(np.full(count, chunk)),
                        pa.array(np.arange(slots, slots + count, dtype=np.int32)),
                        *arrays.values(),
                        pa.array(hashes, pa.string()),
                    ],
                    names=["key", "chunk", "slot", *arrays, "groups_sha256"],
                )
            )
            slots += count
        if held:
            yield from closed()

    return docs.mapInArrow(run, fields)


def _scored(rows: DataFrame, key_field: str) -> DataFrame:
    """Documents with the sums of their postings; ``rows`` come sorted by chunk."""
    fields = f"{key_field}, {_DOC_FIELDS}, n_best bigint, count_sum bigint"
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, docs = None, []
        sums, best = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)

        def finished() -> Iterator[pa.RecordBatch]:
            for part in docs:
                slots = part.column("slot").to_numpy()
                columns = [*(part.column(n) for n in names), pa.array(best[slots]), pa.array(sums[slots])]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum"])

        def add(part: pa.RecordBatch) -> None:
            weight = np.left_shift(1, np.maximum(part.column("plane").to_numpy() - 1, 0).astype(np.int64))
            share, top = weight * part.column("documents").to_numpy(), weight * part.column("best").to_numpy(zero_copy_only=False)
            bits, marked = part.column("bits").to_pylist(), part.column("marked").to_numpy()
            dense = part.column("dense").to_numpy(zero_copy_only=False)
            slots = np.frombuffer(b"".join(x for x, d in zip(bits, dense, strict=True) if not d), "<u2")
            np.add.at(sums, slots, np.repeat(share[~dense], marked[~dense]))
            np.add.at(best, slots, np.repeat(top[~dense], marked[~dense]))
            for i in np.flatnonzero(dense).tolist():
                slots = numbers_in(True, bits[i])
                sums[slots] += share[i]
                best[slots] += top[i]

        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                if numbers[start] != chunk:
                    yield from finished()
                    chunk, docs = numbers[start], []
                    sums[:], best[:] = 0, 0
                part = batch.slice(start, stop - start)
                is_doc = pc.is_valid(part.column("slot"))
                docs.append(part.filter(is_doc))
                postings = part.filter(pc.invert(is_doc))
                if postings.num_rows:
                    add(postings)
        yield from finished()

    return rows.mapInArrow(run, fields)


def pair_counts(postings: DataFrame) -> DataFrame:
    """``(a, b, documents, links, best)``: documents that hold the pair linked and links of the corpus, from popcounts of the
    planes; ``best`` if no pair of that ``a`` has more documents."""
    links = F.when(F.col("plane") == 0, F.col("marked")).otherwise(F.expr("shiftleft(marked, plane - 1)"))
    counts = postings.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("marked")).otherwise(0)).alias("documents"), F.sum(links).alias("links")
    )
    counts = materialize(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select("a", "b", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, tokenizers: Tokenizers, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``.

    ``documents (key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum)`` has one row per row of ``docs``;
    ``n_best`` counts links whose pair has the most documents of all pairs with its first id, ties included, and ``count_sum``
    adds up the documents of the pair of every link. ``pairs`` is what ``pair_counts`` gives.

    Texts that are null or empty, or whose tokens do not spell a space and the text on both sides, have no tokens:
    zeros and an empty hash. Strings of special tokens are ordinary text. Rows that repeat a key, or have none,
    are documents of their own. An empty table gives no rows, and further columns are not looked at.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    stored = materialize(_read(rows, tokenizers, f"key {kind}"), "alignment")
    postings = stored.where("a is not null").select("chunk", "a", "b", "plane", "dense", "marked", "bits")
    pairs = pair_counts(postings)
    met = postings.join(pairs.select("a", "b", "documents", "best"), ["a", "b"]).drop("a", "b")
    listed = stored.where("a is null").select("chunk", "key", "slot", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    dealt = listed.unionByName(met, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk")
    found = _scored(dealt, f"key {kind}").withColumnRenamed("key", key)
    return found, pairs
