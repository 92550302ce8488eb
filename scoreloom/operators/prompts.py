"""Prompts as DataFrame work: seeded exemplars, chat messages, rendering, length budgets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEX_DIGITS = 4  # 65,536 hash ranges per pool


@dataclass(frozen=True)
class ChatStyle:
    """Text around one message; ``{role}`` is replaced by the role."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    answer: str = "<|im_start|>assistant\n"


def seeded_hash(key: Column, seed: int) -> Column:
    """Hex hash of a key and a seed: the same on every partitioning and every retry."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def seeded_limit(df: DataFrame, key: str, seed: int, limit: float) -> DataFrame:
    """The sampling switch of the harnesses: a share below 1, otherwise a number of rows.

    A share is a filter on the hash and needs no shuffle; a number is the top of the
    hash order, counted off in ranges, as a limit would pass all its rows through one place.
    """
    hashed = seeded_hash(F.col(key), seed)
    if limit < 1:
        return df.where(_hash_number(hashed, 13) < F.lit(int(limit * 16**13)))
    return number_by_hash(df, key, seed).where(F.col("ordinal") < int(limit)).select(*df.columns)


def _hash_number(hashed: Column, digits: int) -> Column:
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def number_by_hash(df: DataFrame, key: str, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``ordinal`` (0-based, in hash order within ``by``) and ``pool_size``.

    A plain row_number would sort a whole pool in one task. Here a leading piece of the
    hash cuts each pool into ranges: rows are numbered inside their range, and the sizes
    of the ranges before it are added. Per pool only 65,536 sizes meet in one task.
    """
    by = list(by)
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn(
        "_range", F.substring("_hash", 1, HEX_DIGITS)
    )
    sizes = hashed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    pool = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    offsets = sizes.select(
        *by,
        "_range",
        F.coalesce(
            F.sum("_n").over(pool.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_n").over(pool).alias("pool_size"),
    )
    inside = W.partitionBy(*by, "_range").orderBy("_hash", key)
    return (
        hashed.withColumn("_row", F.row_number().over(inside))
        .transform(_join_null_safe, offsets, [*by, "_range"])
        .withColumn("ordinal", F.col("_before") + F.col("_row") - 1)
        .drop("_hash", "_range", "_before", "_row")
    )


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL meets a NULL; the columns of ``on`` come once."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    same = [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in on]
    return left.join(renamed, same).drop(*(f"_right_{name}" for name in on))


def choose_exemplars(
    items: DataFrame,
    pool: DataFrame,
    *,
    item_id: str,
    pool_id: str,
    shots: int,
    seed: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """``shots`` exemplars per item as rows ``(item_id, *by, rank, pool columns)``.

    The pool is put on a ring in hash order. Every item starts at its own hashed place
    and takes the following exemplars, never itself. That is an equi-join on ring
    places: work grows with items x shots, not with items x pool. ``item_id`` and
    ``pool_id`` share one id space, ids are unique.
    """
    by = list(by)
    ring = number_by_hash(pool, pool_id, seed, by)
    keys = items.select(item_id, *by)
    if by:
        placed = _join_null_safe(keys, ring.groupBy(*by).agg(F.max("pool_size").alias("_size")), by)
    else:
        placed = keys.withColumn("_size", ring.agg(F.max("pool_size")).scalar())
    start = F.pmod(_hash_number(seeded_hash(F.col(item_id), seed + 1), 13), F.col("_size"))
    # one place more than needed, in case an item meets itself
    steps = F.sequence(F.lit(0), F.least(F.lit(shots), F.col("_size") - 1).cast("int"))
    places = placed.where(F.col("_size") > 0).select(
        item_id, *by, start.alias("_start"), "_size", F.explode(steps).alias("_step")
    )
    wanted = places.select(
        F.col(item_id).alias("_item"),
        *by,
        "_step",
        F.pmod(F.col("_start") + F.col("_step"), F.col("_size")).alias("ordinal"),
    )
    met = _join_null_safe(wanted, ring.drop("pool_size"), [*by, "ordinal"]).where(
        F.col("_item") != F.col(pool_id)
    )
    # at most shots + 1 rows per item
    rank = F.row_number().over(W.partitionBy("_item").orderBy("_step"))
    return (
        met.withColumn("rank", rank)
        .where(F.col("rank") <= shots)
        .drop("_step", "ordinal")
        .withColumnRenamed("_item", f"for_{item_id}")
    )


def fewshot_messages(
    items: DataFrame,
    exemplars: DataFrame,
    *,
    item_id: str,
    question: str,
    answer: str,
    system: str | None = None,
) -> DataFrame:
    """``(item_id, messages)``: exemplars as user/assistant turns, the question last.

    ``exemplars`` is the output of ``choose_exemplars``; a list holds at most as many
    entries as there are shots.
    """
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    shots = (
        exemplars.groupBy(F.col(f"for_{item_id}").alias(item_id))
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", F.col(question).alias("q"), F.col(answer).alias("a")))
            ).alias("_shots")
        )
    )
    pairs = F.flatten(
        F.transform("_shots", lambda s: F.array(turn("user", s["q"]), turn("assistant", s["a"])))
    )
    empty = F.array().cast("array<struct<role:string,content:string>>")
    opening = F.array(turn("system", F.lit(system))) if system is not None else empty
    return items.select(item_id, question).join(shots, item_id, "left").select(
        item_id,
        F.concat(opening, F.coalesce(pairs, empty), F.array(turn("user", F.col(question)))).alias("messages"),
    )


def render_chat(messages: Column, style: ChatStyle = ChatStyle(), *, ask: bool = True) -> Column:
    """One prompt string from ``array<struct<role, content>>``."""
    body = F.array_join(F.transform(messages, lambda m: _fragment(m["role"], m["content"], style)), "")
    return F.concat(body, F.lit(style.answer)) if ask else body


def _fragment(role: Column, content: Column, style: ChatStyle) -> Column:
    return F.concat(F.replace(F.lit(style.before), F.lit("{role}"), role), content, F.lit(style.after))


def chat_fragments(
    turns: DataFrame,
    *,
    conversation: str,
    turn: str,
    role: str,
    text: str,
    style: ChatStyle = ChatStyle(),
) -> DataFrame:
    """Rendered turns as rows; in turn order they concatenate to the prompt.

    A conversation of any length stays spread out: turns are rendered where they are,
    and only the last turn number is aggregated for the closing answer header.
    """
    rendered = turns.select(
        conversation, turn, _fragment(F.col(role), F.col(text), style).alias("fragment")
    )
    closing = turns.groupBy(conversation).agg((F.max(turn) + 1).alias(turn)).select(
        conversation, turn, F.lit(style.answer).alias("fragment")
    )
    return rendered.unionByName(closing)


def context_budget(
    df: DataFrame, *, length: str, max_length: int | str, max_gen_toks: int | str
) -> DataFrame:
    """Adds ``room`` for the prompt and ``decision``: keep, truncate, or drop without room."""
    as_column = lambda v: F.col(v) if isinstance(v, str) else F.lit(v)
    room = as_column(max_length) - as_column(max_gen_toks)
    return df.withColumn("room", room).withColumn(
        "decision",
        F.when(F.col("room") <= 0, "drop").when(F.col(length) <= F.col("room"), "keep").otherwise("truncate"),
    )
