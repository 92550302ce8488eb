"""Near-duplicate documents: a grouped prefix join on word shingles, exact.

Documents become sets of hashed shingles; equal sets are one node. A global order puts common
shingles last. Two sets that are similar enough share a shingle among the first few of each (their
prefixes), so nodes are posted under those only. Nodes with the same prefix and size form a group,
and postings, counts and filters work on groups: of two groups the number of shared prefix shingles
bounds the overlap of any two members. What passes is expanded to members and verified on the
whole sets.

Shingles (and groups) with many nodes are not paired row by row. Their nodes go into blocks of
bounded size, and one task compares two blocks as matrices and gives back a spanning forest of links. First every block
meets one block of each bucket; then blocks are formed anew by component, and only blocks that may
still join two components meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoreloom.llm.components import components
from scoreloom.llm.common import broadcast_if_small, release_memory
from scoreloom.session import materialize, scratch

WORDS = 5
#: Least similarity, as a fraction.
SIMILAR = (3, 4)
#: The order needs to know common shingles only: seen this often, and at most this many of them.
COMMON_FROM, COMMON_MOST = 20, 1 << 18
#: Nodes under one shingle that are still paired row by row; shingles in the sets of a block.
PAIRED, BLOCK_TOKENS = 32, 1 << 20
#: Nodes up to which a pool of few shingles is one block, whatever the sizes of its sets.
BLOCK_NODES = 1 << 11
#: Cells of a matrix of two blocks that are held at a time.
CELLS = 1 << 21
#: Holders of a shingle that are met one by one.
FEW = 4
#: Nodes from which a component gets blocks of its own.
PURE = 16
#: Shingles counted at a time.
COUNTED = 1 << 21

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    """Hash of each word; forgets when it grows beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, known: dict, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles: runs of ``words`` words, or all words if fewer.

    A-Z is lower-cased; words end at blanks and at the characters 9 to 13.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    with np.errstate(over="ignore"):
        found = np.full(len(hashes) - size + 1, size, np.uint64)
        for k in range(size):
            found = found * _FACTOR + hashes[k : len(hashes) - size + 1 + k]
        found ^= found >> np.uint64(32)
        found *= _MIX
        found ^= found >> np.uint64(29)
    return np.unique(found)


def _number(data: bytes, seed: int = 0) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(data, seed)).astype(np.int64))


def _need(n: int | np.ndarray, similar: tuple[int, int]):
    """The least overlap of a set of size ``n`` with any similar set."""
    return -(-n * similar[0] // similar[1])


def _survey(docs: DataFrame, words: int) -> DataFrame:
    """In one pass over the texts: a row per document (key, n, node, text_hash), and partial counts (token, n)."""
    key_type = docs.schema["key"].dataType.simpleString()

    def run(batches):
        release_memory()
        known, held, size = _Words(), [], 0

        def counted():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            tokens, counts = tokens[often].astype(np.int64), counts[often].astype(np.int64)
            none = pa.nulls(len(tokens))
            return [none.cast(key_kind), pa.array(counts), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(tokens)]

        names = ["key", "n", "node", "text_hash", "token"]
        for batch in batches:
            key_kind = batch.column("key").type
            sets = [shingles(t, known, words) for t in batch.column("text").to_pylist()]
            nodes = [_number(s.tobytes()) if len(s) else None for s in sets]
            lengths = pa.array([len(s) for s in sets], pa.int64())
            rows = [batch.column("key"), lengths, pa.array(nodes, pa.int64()), batch.column("text_hash"), pa.nulls(len(sets), pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, names=names)
            held += sets
            size += sum(map(len, sets))
            if size >= COUNTED:
                yield pa.RecordBatch.from_arrays(counted(), names=names)
                held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays(counted(), names=names)

    return docs.mapInArrow(run, f"key {key_type}, n bigint, node bigint, text_hash bigint, token bigint")


@dataclass(frozen=True)
class _Order:
    """Common shingles and how often they were seen; all others come first, by hash."""

    tokens: np.ndarray
    counts: np.ndarray

    def prefix(self, found: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
        size = len(found) - _need(len(found), similar) + 1
        counts = np.zeros(len(found), np.int64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, found), len(self.tokens) - 1)
            counts = np.where(self.tokens[at] == found, self.counts[at], 0)
        return found[np.lexsort((found, counts))[:size]]


def _common(survey: DataFrame) -> _Order:
    counts = survey.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")).where(f"n >= {COMMON_FROM}")
    most = counts.orderBy(F.desc("n"), "token").limit(COMMON_MOST).toPandas()
    tokens = most["token"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(tokens)
    return _Order(tokens[order], most["n"].to_numpy(np.int64)[order])


def _postings(docs: DataFrame, order: _Order, words: int, similar: tuple[int, int]) -> DataFrame:
    """Rows (token, node, group, n): each node under its prefix, and under its group."""

    def run(batches):
        release_memory()
        known = _Words()
        for batch in batches:
            tokens, nodes, groups, sizes = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, known, words)
                if len(found):
                    prefix = order.prefix(found, similar)
                    group = _number(np.sort(prefix).tobytes(), len(found))
                    many = len(prefix) + 1
                    tokens += [prefix.astype(np.int64), [group]]
                    nodes.append(np.full(many, _number(found.tobytes()), np.int64))
                    groups.append(np.full(many, group, np.int64))
                    sizes.append(np.full(many, len(found), np.int64))
            if nodes:
                columns = [np.concatenate(c) for c in (tokens, nodes, groups, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["token", "node", "group", "n"])

    return docs.select("text").mapInArrow(run, "token bigint, node bigint, `group` bigint, n bigint")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``(node, tokens)``: the whole set, packed, once for each node. Rows with ``several`` may share a set, others share none."""

    def run(batches):
        release_memory()
        known = _Words()
        for batch in batches:
            found = [s.tobytes() for s in (shingles(t, known, words) for t in batch.column("text").to_pylist())]
            columns = [pa.array(map(_number, found), pa.int64()), pa.array(found, pa.binary()), batch.column("several")]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "tokens", "several"])

    found = materialize(docs.select("text", "several").mapInArrow(run, "node bigint, tokens binary, several boolean"), "sets")
    shared = materialize(found.where("several").select("node", "tokens").dropDuplicates(["node"]), "shared-sets")
    return found.where("not several").select("node", "tokens").unionByName(shared)


def _live(posted: DataFrame) -> DataFrame:
    """Postings of tokens that more than one node has; ``m`` is the number of groups under a token, and ``head`` marks one row of each of them."""
    within = Window.partitionBy("token").orderBy("group")
    placed = posted.withColumns({"place": F.dense_rank().over(within), "before": F.lag("group").over(within)})
    whole = Window.partitionBy("token")
    placed = placed.withColumns({"rows": F.count(F.lit(1)).over(whole), "m": F.max("place").over(whole)}).where("rows > 1")
    return placed.select("token", "node", "group", "n", "m", F.expr("before is null or before <> `group`").alias("head"))


def _candidates(live: DataFrame, similar: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes to verify, and the members ``(bucket, node)`` of buckets with too many to pair."""
    num, den = similar

    def bound(shared: str) -> str:
        # what two groups may have in common: shingles of both prefixes, and all that come after one of them
        after = ", ".join(f"ceil({num} * {n} / {den}) - 1" for n in ("gn", "hn"))
        return f"{shared} + greatest({after}) >= ceil({num} * (gn + hn) / {num + den})"

    with scratch() as keep:
        members = materialize(live.select("group", "node", "n").distinct(), "members")
        posted = live.where("head and m > 1 and token <> `group`")
        crowded = posted.where(f"m > {PAIRED}")
        paired = posted.where(f"m <= {PAIRED}").select("token", "group", "n")
        # shingles under which a group may meet another without being counted below
        unseen = crowded.groupBy("group").agg(F.count(F.lit(1)).alias("unseen"))
        a, b = paired.alias("a"), paired.alias("b")
        sizes = f"{den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)"
        met = a.join(b, "token").where(f"a.`group` < b.`group` and {sizes}")
        met = met.groupBy(F.col("a.group").alias("g"), F.col("b.group").alias("h"), F.col("a.n").alias("gn"), F.col("b.n").alias("hn")).count()
        for side in "gh":
            extra = unseen.select(F.col("group").alias(side), F.col("unseen").alias(f"unseen_{side}"))
            met = met.join(extra, side, "left").fillna(0, [f"unseen_{side}"])
        met = met.where(bound("count + least(unseen_g, unseen_h)")).select("g", "h")
        # of groups that meet under crowded shingles only, one with too few of them for a partner of its own size has few partners, of other sizes
        few = f"unseen + ceil({num} * n / {den}) - 1 < ceil({num} * 2 * n / {num + den})"
        crowded = crowded.select("token", "group", "n").join(unseen, "group").withColumn("few", F.expr(few))
        crowded = materialize(crowded, "crowded-groups")
        g, h = (crowded.select("token", *[F.col(c).alias(x) for c, x in names]) for names in (
            (("group", "g"), ("n", "gn"), ("unseen", "unseen_g")), (("group", "h"), ("n", "hn"), ("unseen", "unseen_h"), ("few", "few_h"))
        ))
        sizes = f"{den} * least(gn, hn) >= {num} * greatest(gn, hn)"
        lone = g.join(crowded.where("few").select("token", F.col("group").alias("g")), ["token", "g"], "left_semi")
        lone = lone.join(h, "token").where(f"g <> h and (g < h or not few_h) and {sizes} and {bound('least(unseen_g, unseen_h)')}")
        met = met.unionByName(lone.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).distinct())
        own = members.groupBy("group").agg(F.count(F.lit(1)).alias("k"))
        several = own.where("k > 1").select(F.col("group").alias("g"), F.col("group").alias("h"))
        met = met.unionByName(several)
        for side in "gh":
            met = met.join(own.select(F.col("group").alias(side), F.col("k").alias(f"k{side}")), side)
        met = materialize(met, "group-pairs")
        pairs = met.where(f"kg * kh <= {PAIRED * PAIRED}")
        many = met.where(f"kg * kh > {PAIRED * PAIRED}").withColumn("bucket", F.xxhash64("g", "h"))
        in_g, in_h = (members.select(F.col("group").alias(s), F.col("node").alias(t)) for s, t in (("g", "u"), ("h", "v")))
        pairs = pairs.join(in_g, "g").join(in_h, "h").where("g <> h or u < v").select("u", "v")
        buckets = crowded.where("not few").select(F.col("token").alias("bucket"), "group")
        for side in "gh":
            buckets = buckets.unionByName(many.select("bucket", F.col(side).alias("group")))
        buckets = buckets.join(members, "group").select("bucket", "node").distinct()
        return keep(materialize(pairs.distinct(), "node-pairs")), keep(materialize(buckets, "crowded"))


def _similar(a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return similar[1] * shared >= similar[0] * (len(a) + len(b) - shared)


def _verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs whose whole sets are similar."""
    left, right = (sets.select(F.col("node").alias(side), F.col("tokens").alias(f"set_{side}")) for side in "uv")
    # sets of the second side move once; those of the first move with their pairs only
    second = materialize(pairs.select("v").distinct(), "second")
    joined = left.join(broadcast_if_small(pairs), "u").join(right.join(broadcast_if_small(second), "v", "left_semi"), "v")

    def run(batches):
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("set_u", "set_v"))
            kept = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similar) for x, y in zip(*sides, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return joined.select("u", "v", "set_u", "set_v").mapInArrow(run, "u bigint, v bigint")


def _forest(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]], similar: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between two blocks of sets, as few as connect what the links connect.

    Their overlaps are counted for some sets of ``left`` at a time, and matrices have ``CELLS`` cells or a row.
    """
    sizes = np.asarray([len(s) for _, s in left + right])
    tokens = np.concatenate([s for _, s in left + right])
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    del order
    starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, int)
    counts = np.diff(np.append(starts, len(tokens)))
    del tokens
    cut, across = len(left), len(right)
    # holders of a shingle in few of the sets are met one by one, the others as slices of a matrix
    held = {size: rows[starts[counts == size][:, None] + np.arange(size)] for size in range(2, FEW + 1)}
    wide = np.repeat(counts > FEW, counts)
    rows, column = rows[wide], np.repeat(np.arange((counts > FEW).sum(), dtype=np.int32), counts[counts > FEW])
    del wide
    # a set that is in both blocks is one node
    place: dict[int, int] = {}
    label = np.asarray([place.setdefault(node, i) for i, (node, _) in enumerate(left + right)])
    links = []
    step, width = max(1, CELLS // max(across, 1)), max(1, CELLS // len(sizes))
    for first in range(0, cut, step):
        last = min(first + step, cut)
        overlap = np.zeros((last - first, across), np.float32)
        for size, nodes in held.items():
            for i in range(size):
                for j in range(size):
                    crossing = (nodes[:, i] >= first) & (nodes[:, i] < last) & (nodes[:, j] >= cut)
                    np.add.at(overlap, (nodes[crossing, i] - first, nodes[crossing, j] - cut), 1)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (start, start + width))
            here, at = rows[a:b], column[a:b] - start
            ours, theirs = (here >= first) & (here < last), here >= cut
            present = np.zeros((last - first, width), np.float32)
            present[here[ours] - first, at[ours]] = 1
            others = np.zeros((across, width), np.float32)
            others[here[theirs] - cut, at[theirs]] = 1
            overlap += present @ others.T
        overlap = np.rint(overlap).astype(np.int64)
        near = similar[1] * overlap >= similar[0] * (sizes[first:last, None] + sizes[None, cut:] - overlap)
        for i in range(first, last):
            met = np.flatnonzero(near[i - first]) + cut
            while len(met := met[label[met] != label[i]]):
                j = int(met[0])
                links.append((left[i][0], right[j - cut][0]))
                label[label == label[j]] = label[i]
    return links


def _size_class(similar: tuple[int, int]) -> str:
    """Sets can be similar only if their classes differ by one at most; classes are a little wider than they must be."""
    return f"cast(floor(ln(size) / ln(1.001 * {similar[1]} / {similar[0]})) as int)"


def _blocks(nodes: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``nodes (node, pool, pure)`` dealt to blocks of about ``BLOCK_TOKENS`` of one pool and class of sizes.

    A pool that fits in one block is one, of class -1.
    """
    with scratch() as keep:
        sized = nodes.join(sets.select("node", (F.octet_length("tokens") / 8).alias("size")), "node")
        sized = materialize(sized.withColumn("class", F.expr(_size_class(similar))), "sized")
        whole, pool = ["pool", "pure", "class"], Window.partitionBy("pool", "pure")
        pools = sized.groupBy(*whole).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        fits = (F.sum("size").over(pool) <= BLOCK_TOKENS) & (F.sum("n").over(pool) <= BLOCK_NODES)
        pools = pools.withColumn("fits", fits).select(*whole, "fits", F.ceil(F.col("size") / BLOCK_TOKENS).alias("parts"))
        dealt = sized.join(broadcast_if_small(materialize(pools, "pools")), whole)
        dealt = dealt.withColumns({"class": F.expr("if(fits, -1, class)"), "parts": F.expr("if(fits, 1, parts)")})
        dealt = dealt.select("node", *whole, F.xxhash64(*whole, F.expr("pmod(xxhash64(node), parts)")).alias("block"))
        return keep(materialize(dealt, "blocks"))


def _links_of_blocks(met: DataFrame, dealt: DataFrame, sets: DataFrame, similar: tuple[int, int], name: str) -> DataFrame:
    """Links between the blocks of each pair ``(p, q)``, stored under ``name``."""

    def run(batches):
        def unpacked(members):
            return [(m["node"], np.frombuffer(m["tokens"], np.uint64)) for m in members]

        release_memory()
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (unpacked(batch.column(c)[row].as_py()) for c in ("sets_p", "sets_q"))
                links = _forest(left, right, similar)
                columns = zip(*links, strict=True) if links else ([], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

    with scratch() as keep:
        blocks = materialize(met.select(F.explode(F.array("p", "q")).alias("block")).distinct(), "met-blocks")
        members = dealt.select("node", "block").join(broadcast_if_small(blocks), "block", "left_semi")
        members = broadcast_if_small(materialize(members, "block-members"))
        filled = sets.join(members, "node").groupBy("block").agg(F.collect_list(F.struct("node", "tokens")).alias("sets"))
        filled = materialize(filled, "filled-blocks")
        # a block that meets itself need not move
        alone = broadcast_if_small(materialize(met.where("p = q").select(F.col("p").alias("block")), "lone-blocks"))
        own = filled.join(alone, "block", "left_semi").select(F.col("sets").alias("sets_p"), F.col("sets").alias("sets_q"))
        two = materialize(met.where("p <> q"), "block-pairs")
        seconds = broadcast_if_small(materialize(two.select(F.col("q").alias("block")).distinct(), "second-blocks"))
        first = filled.select(F.col("block").alias("p"), F.col("sets").alias("sets_p")).join(broadcast_if_small(two), "p")
        second = filled.join(seconds, "block", "left_semi").select(F.col("block").alias("q"), F.col("sets").alias("sets_q"))
        both = own.unionByName(first.join(second, "q").select("sets_p", "sets_q"))
        return keep(materialize(both.mapInArrow(run, "u bigint, v bigint"), name))


def _crowded_links(buckets: DataFrame, sets: DataFrame, links: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links among nodes of crowded buckets, as few as connect what those links connect."""
    with scratch() as keep:
        sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))
        largest = F.max(F.struct("m", "bucket"))["bucket"]
        nodes = buckets.join(sizes, "bucket").groupBy("node").agg(largest.alias("pool"))
        nodes = materialize(nodes, "pooled")
        dealt = _blocks(nodes.withColumn("pure", F.lit(False)), sets, similar)
        placed = buckets.join(dealt, "node").select("bucket", "class", "block").distinct()
        hubs = placed.groupBy("bucket", "class").agg(F.min("block").alias("p"))
        met = materialize(placed.join(hubs, ["bucket", "class"]).select("p", F.col("block").alias("q")).distinct(), "hub-pairs")
        first = keep(_links_of_blocks(met, dealt, sets, similar, "hub-links"))
        before, done = dealt.select("node", F.col("block").alias("old")), met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        roots = materialize(components(links.unionByName(first)), "roots")
        labelled = nodes.join(roots, "node", "left").select("node", "pool", F.coalesce("root", "node").alias("root"))
        sizes = labelled.groupBy("root").agg((F.count(F.lit(1)) >= PURE).alias("pure"))
        labelled = labelled.join(sizes, "root").select("node", "pure", F.when(F.col("pure"), F.col("root")).otherwise(F.col("pool")).alias("pool"))
        dealt = _blocks(labelled, sets, similar)
        placed = materialize(buckets.join(dealt, "node").select("bucket", "block", "pure", "pool", "class").distinct(), "placed")
        p, q = placed.alias("p"), placed.alias("q")
        near = "(abs(p.class - q.class) <= 1 or least(p.class, q.class) < 0)"
        open_ = f"p.block <= q.block and {near} and not (p.pure and q.pure and p.pool = q.pool)"
        met = p.join(q, "bucket").where(open_).select(F.col("p.block").alias("p"), F.col("q.block").alias("q")).distinct()
        # blocks that are parts of two that have met need not meet again
        old = dealt.join(before, "node").groupBy("block").agg(F.min("old").alias("old"), F.max("old").alias("last"))
        old = materialize(old.where("old = last"), "old-blocks")
        for side in "pq":
            met = met.join(old.select(F.col("block").alias(side), F.col("old").alias(f"old_{side}")), side, "left")
        again = (F.least("old_p", "old_q") == F.col("a")) & (F.greatest("old_p", "old_q") == F.col("b"))
        known = F.col("old_p").isNotNull() & F.col("old_q").isNotNull()
        met = materialize(met.join(done, known & again, "left_anti").select("p", "q"), "late-pairs")
        if met.isEmpty():
            return first
        return first.unionByName(keep(_links_of_blocks(met, dealt, sets, similar, "late-links")))


def _links(alone: DataFrame, nodes: DataFrame, order: _Order, words: int, similar: tuple[int, int]) -> DataFrame:
    """Links that connect what similar sets connect; ``alone`` has one row of each set."""
    with scratch() as keep:
        with scratch() as keep_pairs:
            live = materialize(_live(_postings(alone, order, words, similar)), "postings")
            pairs, buckets = map(keep_pairs, _candidates(live, similar))
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).unionByName(buckets.select("node")).distinct()
        keys = nodes.join(wanted, "node").groupBy(F.col("first").alias("key")).agg(F.max(F.col("rows") > 1).alias("several"))
        sets = _sets(alone.join(broadcast_if_small(materialize(keys, "wanted")), "key"), words)
        links = materialize(_verified(pairs, sets, similar), "pair-links")
        if not buckets.isEmpty():
            links = links.unionByName(_crowded_links(buckets, sets, links, similar))
        return keep(materialize(links, "node-links"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """``(key, n_shingles, component_id)`` per row of ``docs``.

    A document's set holds its distinct shingles of ``words`` words, or the whole sequence as one if it
    has fewer; without words it is empty. Two documents link when the sizes of intersection and union are in
    the ratio ``similar`` or above. ``component_id`` is the smallest key reachable by links, its own included.

    Null and blank texts have an empty set and link with nothing. Rows without key take no part.
    Equal sets link, whatever their keys; rows that repeat a key are documents of their own. An empty table
    gives no rows, and further columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("key is not null")
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    with scratch() as keep:
        survey = keep(materialize(_survey(rows, words), "survey"))
        order = _common(survey)
        listed = survey.where("token is null").select("key", "n", "node", "text_hash")
        nodes = listed.where("node is not null").groupBy("node").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows"))
        nodes = keep(materialize(nodes, "nodes"))
        # one row of each set is enough from here on; the others are few and known by key and text
        twice = nodes.where("rows > 1").select("node", "first")
        copies = materialize(listed.join(broadcast_if_small(twice), "node").where("key > first").select("key", "text_hash").distinct(), "copies")
        alone = rows.join(broadcast_if_small(copies), ["key", "text_hash"], "left_anti")
        links = _links(alone, nodes, order, words, similar)
        roots = components(links).join(nodes, "node")
        least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
        classes = keep(materialize(roots.join(least, "root").select("node", "component_id"), "classes"))
    own = listed.join(nodes.where("rows > 1").select("node", "first"), "node", "left")
    found = own.join(classes, "node", "left")
    component = F.coalesce("component_id", "first", "key")
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
