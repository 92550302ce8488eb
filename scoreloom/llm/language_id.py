"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence add up as log probabilities: the text under a byte-trigram model of each
language, the language that the markup declares, the one that the address suggests, and a prior of
the host. Host priors are counts of the text's own verdicts, smoothed towards the parent domain, the
top domain and all rows in turn. A further class, ``und``, holds what is no text in any of the
languages: every trigram is equally likely there.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import add_columns
from scoreloom.session import materialize

UNKNOWN = "und"
BUCKETS = 1 << 16
#: Labelled rows that the text model is fitted on, about; all if there are fewer.
TRAIN_ROWS = 50_000
#: Share of a language's trigrams that is spread over all buckets. So an unseen trigram costs the same however long the
#: training text was, and a key or a number in a text does not outweigh its words.
UNSEEN = 0.1
#: Trigrams overlap, so each counts for a third of an observation.
TRIGRAM_WEIGHT = 1 / 3
#: How often a declared language and an address tell the truth.
DECLARED_TRUST, ADDRESS_TRUST = 0.9, 0.8
#: Rows of the parent that a host's own count is mixed with.
SMOOTHING = 20.0
MIN_CONFIDENCE = 0.5
#: Top domains that suggest a language. Fixed values.
COUNTRY = {"de": "de", "at": "de", "es": "es", "mx": "es", "ar": "es", "fr": "fr", "uk": "en", "us": "en", "au": "en", "ie": "en"}


def _codes(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-cased text, with a blank on either side."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    return (((data[:-2] << 16) | (data[1:-1] << 8) | data[2:]) * np.uint32(2654435761)) >> np.uint32(16)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: log probability of each bucket, one column per language and the last for ``und``
    table: np.ndarray = field(repr=False)

    def likelihoods(self, text: str) -> np.ndarray:
        return self.table[_codes(text)].sum(0, dtype=np.float64) * TRIGRAM_WEIGHT


def fit(
    labelled: DataFrame,
    languages: Sequence[str],
    text: str = "text",
    label: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> TextModel:
    """A trigram model from rows whose label is one of ``languages``.

    Where there are more than ``train_rows`` such rows, a share of them is drawn by a hash of the
    text. The counts that reach the driver are bounded by buckets times languages. Languages without
    a row, or an empty table, leave uniform columns.
    """
    languages = tuple(languages)
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.where(F.col("label").isin(*languages) & F.col("text").isNotNull())
    found = rows.count()
    if found > train_rows:
        rows = rows.where(F.expr(f"pmod(xxhash64(text, 17), 1000000) < {round(1e6 * train_rows / found)}"))

    def count(batches):
        seen = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for t, one in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[languages.index(one)] += np.bincount(_codes(t), minlength=BUCKETS)
        at, code = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(code, pa.int64()), pa.array(seen[at, code], pa.int64())],
            names=["language", "code", "n"],
        )

    counts = rows.mapInArrow(count, "language bigint, code bigint, n bigint")
    counts = counts.groupBy("language", "code").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS, len(languages) + 1))
    seen[counts["code"], counts["language"]] += counts["n"]
    total = seen.sum(0)
    share = np.where(total > 0, (1 - UNSEEN) * seen / np.maximum(total, 1) + UNSEEN / BUCKETS, 1 / BUCKETS)
    return TextModel(languages, np.log(share).astype(np.float32))


def suggested(address: Column, languages: Sequence[str], country: Mapping[str, str] = COUNTRY) -> Column:
    """The language that an address suggests: a path that starts with its code, else its top domain."""
    host = F.regexp_extract(address, "://([^/?#:]*)", 1)
    path = F.lower(F.regexp_extract(address, "://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    top = F.lower(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1))
    by_top = F.lit(None).cast("string")
    for code, language in country.items():
        by_top = F.when(top == code, language).otherwise(by_top)
    return F.when(path.isin(*languages), path).otherwise(by_top)


def declared_in(html: Column) -> Column:
    """The language code in the ``lang`` attribute of the root element."""
    return F.lower(F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1), F.lit("")))


#: Where something opens that is no prose of the page itself, and what closes it.
_OPENS = re.compile(r"<!--|<(script|style|nav|footer|template|noscript)\b", re.I)
_CLOSES = {None: re.compile("-->")} | {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "nav", "footer", "template", "noscript")}
_TAG = re.compile(r"<[/!?]?[a-z][^>]*>", re.I)


def _without_hidden(page: str) -> str:
    """The page without comments, scripts and the like; what is not closed stays.

    Positions only move on: the next closing of each kind is looked up once and kept until it is passed.
    """
    kept, at, start = [], 0, 0
    closing: dict[str | None, tuple[int, int] | None] = {}
    while opened := _OPENS.search(page, at):
        kind = opened.group(1) and opened.group(1).lower()
        at = opened.end()
        if kind not in closing or (closing[kind] is not None and closing[kind][0] < at):
            found = _CLOSES[kind].search(page, at)
            closing[kind] = found and found.span()
        if closing[kind] is not None:
            kept.append(page[start : opened.start()])
            at = start = closing[kind][1]
    return " ".join([*kept, page[start:]])


def page_text(page: str) -> str:
    """The text of a page without markup, scripts, menus and footers, in time that grows with its length."""
    page = _without_hidden(page)
    last = page.rfind(">") + 1  # no tag ends behind it, so none is looked for
    return " ".join(markup.unescape(_TAG.sub(" ", page[:last]) + page[last:]).split())


def with_page_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the text of each page; null without a page."""

    def make():
        return lambda batch: [pa.array([None if p is None else page_text(p) for p in batch.column(html).to_pylist()], pa.string())]

    return add_columns(pages, make, f"{text} string")


def _evidence(found: Column, languages: Sequence[str], trust: float) -> list[Column]:
    """Log probability of what was found under each language; even where it names none of them."""
    other = math.log((1 - trust) / max(1, len(languages) - 1))
    even = math.log(1 / len(languages))
    known = F.coalesce(found.isin(*languages), F.lit(False))
    return [F.when(~known, even).when(found == x, math.log(trust)).otherwise(other) for x in languages] + [F.lit(even)]


def host_priors(verdicts: DataFrame, classes: Sequence[str], smoothing: float = SMOOTHING) -> DataFrame:
    """``(host, prior_0 ...)`` from rows ``(host, verdict)``; counted on the map side.

    The chain is host, last two labels, last label, all rows, even.
    """
    counts = verdicts.groupBy("host").agg(
        *[F.count(F.when(F.col("verdict") == c, 1)).alias(f"n{i}") for i, c in enumerate(classes)]
    )
    parts = F.split("host", r"\.")
    counts = counts.withColumns({"parent": F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2)), "top": F.element_at(parts, -1)})
    ns = [f"n{i}" for i in range(len(classes))]

    def summed(level: str, prefix: str) -> DataFrame:
        return counts.groupBy(level).agg(*[F.sum(n).alias(f"{prefix}{n}") for n in ns])

    total = verdicts.groupBy("verdict").count().collect()  # a row per class at most
    total = {row["verdict"]: row["count"] for row in total}
    joined = counts.join(summed("parent", "parent_"), "parent").join(summed("top", "top_"), "top")
    joined = joined.withColumns({f"all_n{i}": F.lit(total.get(c, 0)) for i, c in enumerate(classes)})
    probability = [F.lit(1 / len(classes))] * len(classes)
    for prefix in ("all_", "top_", "parent_", ""):
        total = sum(F.col(prefix + n) for n in ns)
        probability = [(F.col(prefix + n) + smoothing * p) / (total + smoothing) for n, p in zip(ns, probability, strict=True)]
    return joined.select("host", *[F.log(p).alias(f"prior_{i}") for i, p in enumerate(probability)])


def identify(
    rows: DataFrame,
    model: TextModel,
    key: str = "doc_id",
    text: str = "text",
    declared: Column | None = None,
    address: Column | None = None,
    host: Column | None = None,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``(key, language, confidence, kept, text_hash)`` per row of ``rows``.

    ``declared`` is a language code, ``address`` a url, ``host`` the group that shares a prior;
    each may be left out or null and then says nothing. ``confidence`` is the posterior probability. A row is
    kept if its language is not ``und`` and the confidence reaches ``min_confidence``. ``text_hash``
    tells rows with the same key apart.

    Null, empty and blank texts are ``und`` with confidence 1 and not kept. Ties go to the language
    that comes first in the model. Null keys and repeated rows are judged one by one, an empty table gives no rows, and
    further columns are not looked at.
    """
    classes = [*model.languages, UNKNOWN]
    none = F.lit(None).cast("string")
    base = rows.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        (none if declared is None else F.lower(F.regexp_extract(declared.cast("string"), "^[A-Za-z]+", 0))).alias("declared"),
        (none if address is None else suggested(address, model.languages)).alias("suggested"),
        (F.lit("") if host is None else F.coalesce(host.cast("string"), F.lit(""))).alias("host"),
    )

    def make():
        def work(batch):
            found = [(model.likelihoods(t) if t.strip() else None) for t in batch.column("text").to_pylist()]
            return [
                pa.array([None if f is None else f[i] for f in found], pa.float64()) for i in range(len(classes))
            ]

        return work

    likelihoods = ", ".join(f"text_{i} double" for i in range(len(classes)))
    judged = materialize(add_columns(base, make, likelihoods, drop=("text",)), "text-likelihoods")
    evidence = zip(
        [F.col(f"text_{i}") for i in range(len(classes))],
        _evidence(F.col("declared"), model.languages, DECLARED_TRUST),
        _evidence(F.col("suggested"), model.languages, ADDRESS_TRUST),
        strict=True,
    )
    scored = judged.select("key", "text_hash", "host", *[(t + d + a).alias(f"own_{i}") for i, (t, d, a) in enumerate(evidence)])

    def best(scores: list[Column]) -> Column:
        """The first class with the greatest score."""
        top = F.greatest(*scores)
        return F.coalesce(*[F.when(s == top, F.lit(c)) for s, c in zip(scores, classes, strict=True)], F.lit(UNKNOWN))

    own = [F.col(f"own_{i}") for i in range(len(classes))]
    priors = host_priors(scored.select("host", best(own).alias("verdict")), classes)
    joined = scored.join(priors, "host", "left")
    joined = joined.select("key", "text_hash", *[(o + F.col(f"prior_{i}")).alias(f"sum_{i}") for i, o in enumerate(own)])
    sums = [F.col(f"sum_{i}") for i in range(len(classes))]
    top = F.greatest(*sums)
    confidence = F.coalesce(1 / sum(F.exp(s - top) for s in sums), F.lit(1.0))
    verdict = joined.select("key", best(sums).alias("language"), confidence.alias("confidence"), "text_hash")
    kept = (F.col("language") != UNKNOWN) & (F.col("confidence") >= min_confidence)
    return verdict.select(F.col("key").alias(key), "language", "confidence", kept.alias("kept"), "text_hash")
