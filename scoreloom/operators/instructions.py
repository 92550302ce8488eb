"""Instruction following where every prompt brings its own list of instructions.

A list is a table of rows ``(prompt, ord, kind, arguments)``; ``kind`` names one of ``KINDS`` and ``arguments`` is a
``map<string,string>``. Kinds are Spark predicates over the response and the arguments, in the manner of verifiable
instructions (arXiv 2311.07911), with definitions of our own.

Lists join the responses as one array per prompt, so a text is shuffled once however many
instructions it has; what leaves the task afterwards are marks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import variants as V

Check = Callable[[Column, Column], Column]

#: A sign of a word.
_SIGN = r"[\p{L}\p{N}_]"


def _argument(arguments: Column, name: str) -> Column:
    return F.try_element_at(arguments, F.lit(name))


def _number(arguments: Column, name: str = "n") -> Column:
    return _argument(arguments, name).try_cast("bigint")


def _related(count: Column, arguments: Column) -> Column:
    """``count`` against ``n`` by ``relation``: at least, less than, or exactly; at least if it is not given."""
    n, relation = _number(arguments), F.coalesce(_argument(arguments, "relation"), F.lit("at least"))
    return F.when(relation == "at least", count >= n).when(relation == "less than", count < n).when(relation == "exactly", count == n)


def _listed(arguments: Column, name: str) -> Column:
    """The members of an argument, parted by ``|``."""
    return F.split(_argument(arguments, name), r"\|")


def _literally(text: Column) -> Column:
    """A pattern for the text itself."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _whole_word(word: Column) -> Column:
    """A pattern for ``word`` as a whole word, upper and lower case alike. It looks for the word before it looks around it."""
    word = _literally(word)
    return F.concat(F.lit("(?iu)(?="), word, F.lit(rf")(?<!{_SIGN})"), word, F.lit(rf"(?!{_SIGN})"))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def _json(text: Column, arguments: Column) -> Column:
    body = F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")
    return V.let(body, lambda b: V.let(V.strict_envelope(b), lambda e: V.envelope_is_strict(e, b)))


#: What a response is asked for. Arguments: ``n`` with ``relation`` (at least, less than, exactly), ``word`` or
#: ``words`` (parted by ``|``), ``letter``, ``text``, ``choices`` (parted by ``|``), ``separator``.
KINDS: dict[str, Check] = {
    "word_count": lambda t, a: _related(_words(t), a),
    # the end of a sentence: its last sign and a mark. A pattern for whole sentences takes the square of a text without marks
    "sentence_count": lambda t, a: _related(F.regexp_count(t, F.lit(r"[^.!?\s]\s*+[.!?]")), a),
    "line_count": lambda t, a: _related(F.regexp_count(t, F.lit(r"(?m)^.*\S.*$")), a),
    "paragraph_count": lambda t, a: _related(
        F.size(F.filter(F.split(t, r"\n[ \t]*\n"), lambda p: p.rlike(r"\S"))), a
    ),
    "bullet_count": lambda t, a: _related(F.regexp_count(t, F.lit(r"(?m)^[ \t]*[*-][ \t]+\S")), a),
    "placeholder_count": lambda t, a: _related(F.regexp_count(t, F.lit(r"\[[^\[\]]+\]")), a),
    "highlight_count": lambda t, a: _related(F.regexp_count(t, F.lit(r"\*[^*\n]+\*")), a),
    "capital_word_count": lambda t, a: _related(F.regexp_count(t, F.lit(rf"(?=\p{{Lu}}{{2}})(?<!{_SIGN})\p{{Lu}}{{2,}}+(?!{_SIGN})")), a),
    "letter_count": lambda t, a: _related(
        F.length(t) - F.length(F.replace(F.lower(t), F.lower(_argument(a, "letter")), F.lit(""))), a
    ),
    "word_frequency": lambda t, a: _related(F.regexp_count(t, _whole_word(_argument(a, "word"))), a),
    "words_present": lambda t, a: F.forall(_listed(a, "words"), lambda w: F.regexp_like(t, _whole_word(w))),
    "words_absent": lambda t, a: F.forall(_listed(a, "words"), lambda w: ~F.regexp_like(t, _whole_word(w))),
    "all_lower": lambda t, a: t == F.lower(t),
    "all_upper": lambda t, a: t == F.upper(t),
    "no_comma": lambda t, a: ~t.contains(","),
    "json": _json,
    "title": lambda t, a: t.rlike(r"<<[^<>\n]*[^<>\s][^<>\n]*>>"),
    "quoted": lambda t, a: (F.length(F.trim(t)) > 1) & F.startswith(F.trim(t), F.lit('"')) & F.endswith(F.trim(t), F.lit('"')),
    "starts_with": lambda t, a: F.startswith(F.lower(F.ltrim(t)), F.lower(_argument(a, "text"))),
    "ends_with": lambda t, a: F.endswith(F.lower(F.rtrim(t)), F.lower(_argument(a, "text"))),
    "one_of": lambda t, a: F.array_contains(_listed(a, "choices"), F.trim(t)),
    "parts": lambda t, a: _related(
        F.size(F.filter(F.split(t, _literally(_argument(a, "separator"))), lambda p: p.rlike(r"\S"))), a
    ),
}


def follows(text: Column, kind: Column, arguments: Column, kinds: dict[str, Check] = KINDS) -> Column:
    """Whether ``text`` does what the instruction asks; NULL for a kind that is not known or lacks an argument.

    Only the branch of the row's own kind is evaluated.
    """
    chosen = None
    for name, check in kinds.items():
        asked, met = kind == name, check(text, arguments)
        chosen = F.when(asked, met) if chosen is None else chosen.when(asked, met)
    return chosen


def loosened(text: Column) -> Column:
    """The text and its seven loose forms: without the first line, the last line or both, and each without asterisks."""
    lines = F.split(text, "\n")
    join = lambda part: F.trim(F.array_join(part, "\n"))
    size = F.size(lines)
    cut = [
        text,
        join(F.slice(lines, F.lit(2), F.greatest(size - 1, F.lit(0)))),
        join(F.slice(lines, F.lit(1), F.greatest(size - 1, F.lit(0)))),
        join(F.slice(lines, F.lit(2), F.greatest(size - 2, F.lit(0)))),
    ]
    return F.array(*cut, *(F.replace(c, F.lit("*"), F.lit("")) for c in cut))


def judged(
    responses: DataFrame,
    instructions: DataFrame,
    *,
    prompt: str,
    response: str,
    keep: Sequence[str] = (),
    loose: bool = False,
    kinds: dict[str, Check] = KINDS,
) -> DataFrame:
    """``(prompt, *keep, ord, kind, strict[, loose])``: a row per response and instruction of its prompt.

    ``instructions`` has the columns ``prompt``, ``ord``, ``kind`` and ``arguments``; ``keep`` names further columns of the
    responses, among them what tells responses to one prompt apart. An empty or missing response follows nothing.
    Prompts without instructions, and instructions of prompts without a response, give no rows. A kind that is not
    known, or an argument that is missing, gives NULL marks.
    """
    lists = instructions.groupBy(prompt).agg(F.collect_list(F.struct("ord", "kind", "arguments")).alias("_list"))
    texts = responses.select(prompt, *keep, F.coalesce(F.col(response), F.lit("")).alias("_text"))
    rows = texts.join(lists, prompt).select(prompt, *keep, "_text", F.inline("_list"))

    def mark(text: Column) -> Column:
        asked = follows(text, F.col("kind"), F.col("arguments"), kinds)
        # one of the two is evaluated
        return F.when(text.rlike(r"\S"), asked).otherwise(F.when(asked.isNotNull(), False))

    judged_rows = rows.withColumn("strict", mark(F.col("_text")))
    marks = ["strict"]
    if loose:
        # the loose forms are made where the strict one fails
        others = F.array_except(loosened(F.col("_text")), F.array("_text"))
        tried = F.coalesce(F.exists(others, mark), F.lit(False))
        marks.append(F.when(F.col("strict").isNotNull(), F.col("strict") | tried).alias("loose"))
    return judged_rows.select(prompt, *keep, "ord", "kind", *marks)


def accuracy(marks: DataFrame, by: Sequence[str], reply: Sequence[str]) -> DataFrame:
    """Means over instructions, and over responses that follow all of theirs, for each kind of mark.

    ``reply`` names the columns that identify a response. NULL marks do not count. Sums per response come first and
    combine on the map side, where its rows lie together.
    """
    kinds = [c for c in ("strict", "loose") if c in marks.columns]
    replies = marks.groupBy(*dict.fromkeys((*by, *reply))).agg(
        F.count(kinds[0]).alias("asked"), *(F.count_if(F.col(c)).alias(c) for c in kinds)
    )
    levels = []
    for c in kinds:
        levels.append(F.try_divide(F.sum(c), F.sum("asked")).alias(f"inst_level_{c}_acc"))
        levels.append(F.avg(F.when(F.col("asked") > 0, (F.col(c) == F.col("asked")).cast("double"))).alias(f"prompt_level_{c}_acc"))
    return replies.groupBy(*by).agg(
        F.sum("asked").alias("n_instructions"), F.count(F.when(F.col("asked") > 0, 1)).alias("n_prompts"), *levels
    )


def by_kind(marks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of each kind of instruction."""
    kinds = [c for c in ("strict", "loose") if c in marks.columns]
    return marks.groupBy(*by, "kind").agg(
        F.count(kinds[0]).alias("n"), *(F.avg(F.col(c).cast("double")).alias(f"{c}_accuracy") for c in kinds)
    )
