"""Removal of repeated and nearly repeated lines with DataFrame functions only.

Equal lines of any length are found by a grouping of hashes. Then a segment-partition join finds pairs within an edit
distance: a line of length l is cut into threshold + 1 segments, of which an equal or longer line
within the threshold must hold one unchanged, near the same place. Every line is indexed by the hash
of each of its segments, together with l and the segment's number, and probes with the few substrings that may match
a segment of each length from its own down to the threshold less. Segments of short lines would be a letter or
two, so a line under ``SHORT`` characters meets others on the hash of what is left without any ``threshold`` of its characters
or fewer, which two lines within the distance share. Pairs that meet, and whose
letters differ by no more than the threshold allows, are verified on their texts with Spark's ``levenshtein`` with a threshold, which works on a band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import broadcast_if_small, ranked
from scoreloom.session import materialize, scratch

THRESHOLD = 2
#: Shorter lines are compared for equality only: within the threshold they might have less than half in common.
MIN_CHARS = 2 * THRESHOLD + 1
#: Lines from here on have segments of five characters at least.
SHORT = 5 * (THRESHOLD + 1)

#: Frequent letters. A line's counts of them, four bits each (modulo 16), are one number.
_LETTERS = "etaonirshldcumfp"


def _counts() -> str:
    """Each letter is looked for in what the earlier ones have left of the line, and is what that loses; the steps are common subexpressions."""
    rest, terms = "line", []
    for i, c in enumerate(_LETTERS):
        less = f"replace({rest}, '{c}')"
        terms.append(f"shiftleft(cast((octet_length({rest}) - octet_length({less})) & 15 as bigint), {4 * i})")
        rest = less
    return " | ".join(terms)


_COUNTS = _counts()


def _count_distance(a: str, b: str, letters: range) -> str:
    """At most the difference of the counts, summed over those of the letters."""
    terms = []
    for i in letters:
        apart = f"abs((shiftright({a}, {4 * i}) & 15) - (shiftright({b}, {4 * i}) & 15))"
        terms.append(f"least({apart}, 16 - {apart})")
    return " + ".join(terms)


_ADDRESS = ["key", "text_hash", "line_no"]


def _lines(docs: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """Lines with more than white space, by address, without those that ``skip`` (key, text_hash, lines) names."""
    rows = docs.select("key", "text", F.xxhash64("text").alias("text_hash"))
    if skip is not None:
        rows = rows.join(broadcast_if_small(skip, F.size("lines")), ["key", "text_hash"], "left")
    lines = rows.select("*", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    if skip is not None:
        lines = lines.where(~F.coalesce(F.array_contains("lines", F.col("line_no")), F.lit(False)))
    return lines.where(F.col("line").rlike(r"\S")).select(*_ADDRESS, "line")


def _identity() -> list[Column]:
    """128 bits of two hashes."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def exact_repeats(docs: DataFrame) -> DataFrame:
    """``(key, text_hash, lines)``: numbers of lines that equal an earlier one, per document that has any."""
    with scratch() as keep:
        hashed = _lines(docs).select(*_ADDRESS, *_identity())
        address = F.struct(*_ADDRESS)
        groups = hashed.groupBy("h1", "h2").agg(F.min(address).alias("first"), F.count(F.lit(1)).alias("n"))
        groups = materialize(groups.where("n > 1").select("h1", "h2", "first"), "line-groups")
        later = hashed.join(broadcast_if_small(groups), ["h1", "h2"]).where(address > F.col("first"))
        return keep(materialize(later.groupBy("key", "text_hash").agg(F.collect_set("line_no").alias("lines")), "line-repeats"))


def _segment(number: int, length: Column, threshold: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment of a line of ``length``; the last ones are one longer."""
    short = F.floor(length / (threshold + 1)).cast("int")
    longer_from = threshold + 1 - length % (threshold + 1)  # segments before this one are short
    start = short * number + F.greatest(F.lit(number) - longer_from, F.lit(0))
    return start.cast("int"), (short + (F.lit(number) >= longer_from).cast("int")).cast("int")


def _token(number: int, length: Column, start: Column, size: Column) -> Column:
    """Hash of a part of the line, of its bytes either way; characters are only counted where they are no bytes."""
    part = F.when(F.col("plain"), F.substring("bytes", start + 1, size)).otherwise(F.substring("line", start + 1, size).cast("binary"))
    return F.xxhash64(F.lit(number), length, part)


def _by_token(rows: DataFrame, tokens: Column, facts: list[str]) -> DataFrame:
    """A row per token; the array is a projection of its own, since a generator's child may be interpreted."""
    return rows.select(*facts, tokens.alias("tokens")).select(*facts, F.explode("tokens").alias("token"))


def _shortened(threshold: int) -> Column:
    """Hashes of the line without each choice of up to ``threshold`` characters."""
    texts = last = F.array("line")
    for _ in range(threshold):
        last = F.array_distinct(F.flatten(F.transform(last, lambda t: F.transform(
            F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1))
        ))))
        texts = F.concat(texts, last)
    return F.transform(F.array_distinct(texts), lambda t: F.xxhash64(F.lit(-1), t))


def _tokens(threshold: int) -> tuple[Column, Column]:
    """Hashes that a line of at least ``SHORT`` characters is indexed by, and those it probes with."""
    own = F.col("length")
    index, probe = [], []
    for number in range(threshold + 1):
        start, size = _segment(number, own, threshold)
        index.append(_token(number, own, start, size))
    for less in range(threshold + 1):
        length = own - less
        for number in range(threshold + 1):
            start, size = _segment(number, length, threshold)
            # an alignment with few enough edits before and after the segment shifts it by this much
            lowest = max(-number, less - (threshold - number))
            highest = min(number, less + (threshold - number))
            for shift in range(lowest, highest + 1):
                probe.append(_token(number, length, start + shift, size))
    return F.array(*index), F.array(*probe)


def _distinct_lines(docs: DataFrame, skip: DataFrame, min_chars: int) -> DataFrame:
    """Lines that take part in the join, stored once, with what the join needs to know of them.

    ``id`` is the place of the line among all in the order of addresses, so of two lines the earlier has the smaller one.
    """
    with scratch() as keep:
        lines = _lines(docs, skip).where(F.length("line") >= min_chars)
        numbered = ranked(lines.withColumn("all", F.lit(0)), "all", _ADDRESS).withColumnRenamed("rank", "id").drop("all")
        return keep(materialize(numbered.withColumns({"length": F.length("line"), "counts": F.expr(_COUNTS)}), "lines"))


#: Classes of earlier lines of which the first and the last are tried before all others.
_TRIED = 256


def _meetings(indexed: DataFrame, probing: DataFrame, threshold: int) -> DataFrame:
    """``(earlier, later)`` for every common hash of two lines whose letters differ by no more than the threshold allows."""
    met = indexed.alias("a").join(probing.alias("b"), "token")
    # an edit takes away one character at most and adds one at most, only one of the two if it changes the length
    most = f"{2 * threshold} - abs(a.length - b.length)"
    half = len(_LETTERS) // 2
    first, second = (_count_distance("a.counts", "b.counts", range(i, i + half)) for i in (0, half))
    met = met.where(f"{first} <= {most}").where(f"{first} + {second} <= {most}")
    # of two lines of one length each probes for the other; one of the two meetings is enough
    met = met.where("a.id <> b.id and (a.length < b.length or a.id < b.id)")
    return met.select(F.least("a.id", "b.id").alias("earlier"), F.greatest("a.id", "b.id").alias("later"))


def _close(pairs: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    """The ``later`` lines of those pairs that are within the threshold."""
    with scratch() as keep:
        pairs = materialize(pairs, "line-pairs")
        ids = materialize(pairs.select(F.col("earlier").alias("id")).unionByName(pairs.select(F.col("later").alias("id"))).distinct(), "line-ids")
        texts = materialize(lines.select("id", "line").join(broadcast_if_small(ids), "id", "left_semi"), "line-texts")
        met = pairs
        for side in ("earlier", "later"):
            met = met.join(texts.select(F.col("id").alias(side), F.col("line").alias(f"line_{side}")), side)
        # equal lines are left only where rows repeat key and text, and those are one document
        met = met.where("line_earlier <> line_later")
        met = met.where(F.levenshtein("line_earlier", "line_later", threshold) >= 0)
        return keep(materialize(met.select(F.col("later").alias("id")).distinct(), "near-lines"))


def near_repeats(docs: DataFrame, skip: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(key, text_hash, line_no)`` of lines within ``threshold`` edits of an earlier line.

    Lines that ``skip`` names take no part; they equal one that does.

    A line needs one earlier neighbour. So of the earlier lines it meets, the first and the last of a few classes are
    verified at first: a few pairs a line, however large its group of near copies. A line for which none of them is near, and which met
    others, then meets all earlier ones.
    """
    if not 2 * threshold < min_chars or SHORT <= 2 * threshold:
        raise ValueError("lines must be longer than twice the threshold")
    index, probe = _tokens(threshold)
    lines = _distinct_lines(docs, skip, min_chars)
    facts = ["id", "length", "counts"]
    # of two lines the shorter says how they meet
    short = lines.where(F.length("line") < SHORT + threshold).select(*facts, _shortened(threshold).alias("tokens"))
    short = materialize(short, "short-lines").select(*facts, F.explode("tokens").alias("token"))
    long = lines.where(F.length("line") >= SHORT)
    long = long.withColumns({"bytes": F.col("line").cast("binary"), "plain": F.octet_length("line") == F.col("length")})
    indexed = _by_token(long, index, facts).unionByName(short.where(F.col("length") < SHORT))
    probing = _by_token(long, probe, facts).unionByName(short)
    met = _meetings(indexed, probing, threshold).withColumn("class", F.pmod(F.xxhash64("earlier"), F.lit(_TRIED)))
    place = F.col("earlier").cast("decimal(18,0)")
    ends = met.groupBy("later", "class").agg(
        F.min("earlier").alias("first"), F.max("earlier").alias("last"), F.count(F.lit(1)).alias("n"),
        F.sum(place).cast("decimal(38,0)").alias("total"), F.sum(place * place).cast("decimal(38,0)").alias("squares"),
    )
    # the sum of (x - first) * (last - x), which is above 0 if and only if some x lies between the two
    between = "squares < (first + last) * total - n * cast(first as decimal(18,0)) * last"
    ends = materialize(ends.withColumn("more", F.expr(between)), "line-ends").select("later", "first", "last", "more")
    tried = ends.select("later", F.col("first").alias("earlier")).unionByName(ends.where("last > first").select("later", F.col("last").alias("earlier")))
    found = _close(tried, lines, threshold)
    more = ends.where("more").select(F.col("later").alias("id")).distinct()
    more = materialize(more.join(broadcast_if_small(found), "id", "left_anti"), "open-lines")
    if not more.isEmpty():
        only = broadcast_if_small(more)
        rest = _meetings(indexed.join(only, "id", "left_semi"), probing, threshold)
        rest = rest.unionByName(_meetings(indexed, probing.join(only, "id", "left_semi"), threshold))
        rest = rest.join(only.withColumnRenamed("id", "later"), "later", "left_semi").select("earlier", "later").distinct()
        found = found.unionByName(_close(rest, lines, threshold))
    return lines.select("id", *_ADDRESS).join(broadcast_if_small(materialize(found, "close-lines")), "id", "left_semi").select(*_ADDRESS)


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``(key, text_hash, lines)``: per document with such lines, the numbers of the lines to remove.

    Lines end at line feeds. A line is removed if an earlier line (by key, hash of the text, line number) equals it,
    or if both have at least ``min_chars`` characters and are within ``threshold`` edits. The earlier line
    counts even if it is removed itself. Blank lines part paragraphs and stay.

    Rows without key or text take no part. Rows that repeat key and text are one document; rows that
    share only the key are told apart by the hash of the text. An empty table gives no rows, and further columns
    are not looked at.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    with scratch() as keep:
        exact = exact_repeats(rows)
        near = near_repeats(rows, exact, threshold, min_chars)
        both = exact.select("key", "text_hash", F.explode("lines").alias("line_no")).unionByName(near)
        found = both.groupBy("key", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("lines"))
        return keep(materialize(found.withColumnRenamed("key", key), "repeated-lines"))


def without_lines(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed") -> DataFrame:
    """``docs`` with the lines that ``found`` names taken out of the text, and ``removed``, their number.

    A column of that name in ``docs`` gives way; ``removed`` can be given another name.
    """
    marks = found.select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash"), F.col("lines").alias("__lines"))
    joined = docs.join(broadcast_if_small(marks, F.size("__lines")), (F.col(key) == F.col("__key")) & (F.xxhash64(F.col(text)) == F.col("__hash")), "left")
    numbered = F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains("__lines", i))
    number = F.coalesce(F.size("__lines"), F.lit(0))
    kept = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(numbered, "\n"))
    columns = [kept.alias(c) if c == text else F.col(c) for c in docs.columns if c != removed]
    return joined.select(*columns, number.alias(removed))
