"""Byte-level BPE: encoding of texts of any length in overlapping chunks, and decoding.

A text of up to ``chunk`` characters is encoded in its row. A longer one is cut into chunks that
overlap; each chunk is pre-tokenised by itself, and two neighbours are stitched at the first
pre-token boundary that both find in their overlap. The pattern looks only ahead, so from a
common boundary on both find the same pre-tokens. The pieces between the stitches are encoded
apart and joined in order. A text with neighbours that share no boundary (one pre-token longer
than the overlap) is encoded whole.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import add_columns
from scoreloom.session import materialize

CHUNK = 1 << 16
OVERLAP = 1 << 10


@dataclass(frozen=True)
class Vocabulary:
    """Ranks in the tiktoken text format and the pre-token pattern; read on the driver, sent with tasks."""

    ranks: bytes
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def encoding(self):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in self.ranks.splitlines() if line)}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def _encode_column(vocabulary: Vocabulary):
    def make():
        encode = vocabulary.encoding().encode_ordinary

        def work(batch):
            return [pa.array([packed(encode(t)) for t in batch.column("text").to_pylist()], pa.binary())]

        return work

    return make


def _cut(chunk: int, overlap: int):
    """Rows (row, key, text) to chunks; each but the last reaches ``overlap`` into the next one."""

    def run(batches):
        for batch in batches:
            for row, key, text in zip(*(batch.column(c) for c in ("row", "key", "text")), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()] * len(starts), pa.int64()),
                        pa.array([key.as_py()] * len(starts), key.type),
                        pa.array(range(len(starts)), pa.int64()),
                        pa.array([s == starts[-1] for s in starts], pa.bool_()),
                        pa.array([text[s:] if s == starts[-1] else text[s : s + chunk + overlap] for s in starts], pa.string()),
                    ],
                    names=["row", "key", "part", "last", "text"],
                )

    return run


def _boundaries(pattern: str, chunk: int, overlap: int):
    """Pre-token ends in the first and the last ``overlap`` characters, counted from there.

    An end at the end of the chunk is left out: the next character may change it.
    """

    def make():
        import regex

        ends = regex.compile(pattern)

        def work(batch):
            heads, tails = [], []
            for text in batch.column("text").to_pylist():
                found = [m.end() for m in ends.finditer(text) if m.end() < len(text)]
                heads.append([e for e in found if e <= overlap])
                tails.append([e - chunk for e in found if chunk <= e])
            return [pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))]

        return work

    return make


def _encode_pieces(vocabulary: Vocabulary, chunk: int):
    def make():
        encode = vocabulary.encoding().encode_ordinary

        def work(batch):
            ids, texts = [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "last", "since", "until", "broken"))
            for text, last, since, until, broken in zip(*columns, strict=True):
                if broken:
                    ids.append(None)
                    texts.append(text if last else text[:chunk])
                else:
                    ids.append(packed(encode(text[since : len(text) if last else chunk + until])))
                    texts.append(None)
            return [pa.array(ids, pa.binary()), pa.array(texts, pa.string())]

        return work

    return make


def _encode_long(docs: DataFrame, vocabulary: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    key_type = docs.schema["key"].dataType.simpleString()
    schema = f"row bigint, key {key_type}, part bigint, last boolean, text string"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    chunks = rows.mapInArrow(_cut(chunk, overlap), schema).repartition("row", "part")
    chunks = materialize(
        add_columns(chunks, _boundaries(vocabulary.pattern, chunk, overlap), "head array<int>, tail array<int>"),
        "chunks",
    )
    right = chunks.where("part > 0").select("row", (F.col("part") - 1).alias("part"), "head")
    seams = (
        chunks.where("not last")
        .select("row", "part", "tail")
        .join(right, ["row", "part"], "left")
        .select("row", "part", F.array_min(F.array_intersect("tail", "head")).alias("seam"))
    )
    broken = seams.groupBy("row").agg(F.bool_or(F.col("seam").isNull()).alias("broken"))
    pieces = (
        chunks.drop("head", "tail")
        .join(seams.select("row", "part", F.col("seam").alias("until")), ["row", "part"], "left")
        .join(seams.select("row", (F.col("part") + 1).alias("part"), F.col("seam").alias("since")), ["row", "part"], "left")
        .join(broken, "row", "left")
        .withColumns({"since": F.coalesce("since", F.lit(0)), "broken": F.coalesce("broken", F.lit(False))})
    )
    encoded = add_columns(
        pieces, _encode_pieces(vocabulary, chunk), "ids binary, whole string", drop=("text", "last", "since", "until", "broken")
    )

    def join_pieces(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("part")
        if pieces["whole"].notna().any():
            ids = packed(vocabulary.encoding().encode_ordinary("".join(pieces["whole"])))
        else:
            ids = b"".join(pieces["ids"])
        return pd.DataFrame({"row": pieces["row"].iloc[:1], "ids": [ids]})

    joined = encoded.groupBy("row").applyInPandas(join_pieces, "row bigint, ids binary")
    keys = chunks.where("part = 0").select("row", "key")
    return keys.join(joined, "row").select("key", "ids")


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(key, ids)`` per row of ``docs``; ids as packed little-endian unsigned 32-bit integers.

    No special tokens: their strings are ordinary text. A null text is empty and gives no ids.
    Null and repeated keys are kept row by row, an empty table gives no rows, and further columns
    are not looked at. Texts above ``chunk`` characters are encoded in parts, with equal results.
    """
    if overlap > chunk:
        raise ValueError("the overlap must not exceed the chunk")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.where(F.length("text") <= chunk + overlap)
    short = add_columns(short, _encode_column(vocabulary), "ids binary", drop=("text",))
    long = _encode_long(rows.where(F.length("text") > chunk + overlap), vocabulary, chunk, overlap)
    return short.unionByName(long).withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``encoded`` plus ``decoded``: the bytes of its ids, one after the other; null for null ids."""

    def make():
        decoding = vocabulary.encoding()

        def work(batch):
            found = batch.column(ids).to_pylist()
            return [pa.array([None if x is None else decoding.decode_bytes(unpacked(x)) for x in found], pa.binary())]

        return work

    return add_columns(encoded, make, "decoded binary")
