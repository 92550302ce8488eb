"""Scores from model outputs.

Only the names of these scores come with the evaluation tasks; the definitions are the
published ones or, where none exists, our own, and are stated with each function.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions import stats
from scoreloom.functions import variants as V

INVALID = "[invalid]"


def strip_reasoning(text: Column, opening: str = "<think>", closing: str = "</think>") -> Column:
    """Text without the spans between the tags, tags included."""
    return F.regexp_replace(text, rf"(?s)\Q{opening}\E.*?\Q{closing}\E", "")


def after_reasoning(text: Column, end_token: str = "</think>") -> Column:
    """Text after the last end token; all of it if there is none."""
    return F.substring_index(text, end_token, -1)


def extract_answer(text: Column, pattern: str, group: int = 1, *, last: bool = False) -> Column:
    """First (or last) match of the pattern, ``[invalid]`` without one."""
    if last:
        found = F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))
    else:
        found = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
    return F.coalesce(found, F.lit(INVALID))


def normalise(
    text: Column, *, trim: bool = True, lower: bool = True, punctuation: bool = False
) -> Column:
    """Text as compared: lower case, without punctuation, single inner blanks."""
    if lower:
        text = F.lower(text)
    if punctuation:
        text = F.regexp_replace(text, r"\p{Punct}", "")
    return F.trim(F.regexp_replace(text, r"\s+", " ")) if trim else text


def mean_score(df: DataFrame, score: Column, by: Sequence[str], name: str) -> DataFrame:
    """Mean of a per-sample score with the standard error of the mean."""
    return (
        df.select(*by, score.cast("double").alias("_score"))
        .groupBy(*by)
        .agg(
            F.count("_score").alias("n"),
            F.avg("_score").alias(name),
            stats.standard_error("_score").alias(f"{name}_stderr"),
        )
    )


def exact_match(df: DataFrame, answer: Column, target: Column, by: Sequence[str]) -> DataFrame:
    """Share of answers equal to the target; a missing answer is wrong."""
    return mean_score(df, F.coalesce(answer == target, F.lit(False)), by, "exact_match")


# Checks on one response, in the manner of verifiable instructions (arXiv 2311.07911).


def words_at_least(text: Column, n: int) -> Column:
    return _word_count(text) >= n


def words_at_most(text: Column, n: int) -> Column:
    return _word_count(text) <= n


def _word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def keyword_at_least(text: Column, keyword: str, n: int = 1) -> Column:
    return F.regexp_count(text, F.lit(rf"(?i)\b\Q{keyword}\E\b")) >= n


def forbidden_word(text: Column, keyword: str) -> Column:
    return ~text.rlike(rf"(?i)\b\Q{keyword}\E\b")


def all_lower(text: Column) -> Column:
    return text == F.lower(text)


def all_upper(text: Column) -> Column:
    return text == F.upper(text)


def no_comma(text: Column) -> Column:
    return ~text.contains(",")


def bullets_exactly(text: Column, n: int) -> Column:
    return F.regexp_count(text, F.lit(r"(?m)^\s*[*-]\s+\S")) == n


def is_json(text: Column) -> Column:
    """One JSON value and nothing else, a code fence around it aside."""
    body = F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")
    return V.envelope_is_strict(V.strict_envelope(body), body)


def instruction_accuracy(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """Mean over instructions and, beside it, over prompts that met all of theirs.

    A check that gives NULL does not apply to that prompt. Sums per row are enough, so
    nothing is exploded before the aggregation.
    """
    names = [f"_check{i}" for i in range(len(checks))]
    marks = df.select(*by, *(check.alias(name) for name, check in zip(names, checks.values())))
    rows = marks.select(
        *by,
        sum(F.col(name).isNotNull().cast("int") for name in names).alias("_asked"),
        sum(F.coalesce(F.col(name), F.lit(False)).cast("int") for name in names).alias("_met"),
    )
    return rows.groupBy(*by).agg(
        F.sum("_asked").alias("n_instructions"),
        F.count(F.when(F.col("_asked") > 0, 1)).alias("n_prompts"),
        F.try_divide(F.sum("_met"), F.sum("_asked")).alias("inst_level_strict_acc"),
        F.avg(F.when(F.col("_asked") > 0, (F.col("_met") == F.col("_asked")).cast("double"))).alias(
            "prompt_level_strict_acc"
        ),
    )


def instruction_breakdown(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """Accuracy of every instruction on its own."""
    pairs = F.array(
        *(F.struct(F.lit(name).alias("instruction"), check.alias("ok")) for name, check in checks.items())
    )
    return (
        df.select(*by, F.inline(pairs))
        .groupBy(*by, "instruction")
        .agg(F.count("ok").alias("n"), F.avg(F.col("ok").cast("double")).alias("accuracy"))
    )


def pass_at_k(samples: DataFrame, problem: Sequence[str], correct: Column, ks: Sequence[int]) -> DataFrame:
    """pass@k per problem (arXiv 2107.03374) from one row per sample."""
    counts = (
        samples.select(*problem, correct.alias("_ok"))
        .groupBy(*problem)
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_ok"), 1)).alias("c"))
    )
    return counts.select(
        *problem, "n", "c", *(stats.pass_at_k(F.col("n"), F.col("c"), k).alias(f"pass_at_{k}") for k in ks)
    )


def code_pass_at_k(
    verdicts: DataFrame, problem: Sequence[str], sample: str, passed: Column, ks: Sequence[int]
) -> DataFrame:
    """pass@k from one row per test: a sample is correct if all its tests passed."""
    samples = (
        verdicts.select(*problem, sample, passed.alias("_passed"))
        .groupBy(*problem, sample)
        .agg(F.bool_and(F.coalesce("_passed", F.lit(False))).alias("_ok"))
    )
    return pass_at_k(samples, problem, F.col("_ok"), ks)


def length_bucket(length: Column, bounds: Sequence[int]) -> Column:
    """Number of the bucket: 0 up to the first bound, then ``(lower, upper]``, and one beyond the last bound.

    NULL for an unknown length.
    """
    return F.when(length.isNotNull(), sum((length > bound).cast("int") for bound in bounds))


def bucket_scores(
    df: DataFrame, length: str, score: str, bounds: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Mean score per length bucket. Every row is in one: the first bucket has no lower bound, the last no
    upper bound, and rows of unknown length have a bucket without either."""
    number = F.col("_bucket")
    edges = F.array(F.lit(None).cast("bigint"), *map(F.lit, bounds), F.lit(None).cast("bigint"))
    found = (
        df.select(*by, length_bucket(F.col(length), bounds).alias("_bucket"), F.col(score).cast("double").alias("_score"))
        .groupBy(*by, "_bucket")
        .agg(F.count("_score").alias("n"), F.avg("_score").alias("score"))
        .withColumns({"lower": F.get(edges, number), "upper": F.get(edges, number + 1)})
    )
    lower, upper = F.col("lower"), F.col("upper")
    name = (
        F.when(lower.isNotNull() & upper.isNotNull(), F.format_string("score_gt_%s_le_%s", _short(lower), _short(upper)))
        .when(lower.isNotNull(), F.format_string("score_gt_%s", _short(lower)))
        .when(upper.isNotNull(), F.format_string("score_le_%s", _short(upper)))
        .otherwise("score_length_unknown")
    )
    return found.drop("_bucket").withColumn("metric", name)


def _short(bound: Column) -> Column:
    """16384 as 16k, other numbers as they are."""
    whole = (bound % 1024 == 0) & (bound > 0)
    return F.when(whole, F.concat((bound / 1024).cast("int").cast("string"), F.lit("k"))).otherwise(
        bound.cast("string")
    )


def length_auc(buckets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under score over log2(bucket upper bound), divided by the span.

    Our own definition. The open bucket stands at twice its lower bound; the bucket without lower bound and unknown lengths
    have no place. A group has as many rows here as there are buckets.
    """
    by = list(by)
    end = F.coalesce("upper", F.col("lower") * 2)
    placed = buckets.where(F.col("score").isNotNull() & F.col("lower").isNotNull()).withColumn("_end", end)
    x = F.log2("_end")
    order = W.partitionBy(*(by or [F.lit(0)])).orderBy("_end")
    steps = placed.select(
        *by,
        x.alias("x"),
        "score",
        F.lag(x).over(order).alias("x0"),
        F.lag("score").over(order).alias("score0"),
    )
    width = F.col("x") - F.col("x0")
    return steps.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_buckets"),
        F.try_divide(F.sum(width * (F.col("score") + F.col("score0")) / 2), F.sum(width)).alias("length_auc"),
    )
