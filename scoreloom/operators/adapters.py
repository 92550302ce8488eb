"""Declarative descriptions of result-document formats.

An adapter names where things are in a document. ``extract`` turns a list of
adapters into one projection, so mixed inputs need a single scan and no union.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.functions import variants as V


# Fixed value: how the harnesses mark a standard error.
STDERR_MARK = "_stderr"


@dataclass(frozen=True)
class ParamField:
    """One inference parameter: output name, key in the document, default if the key is absent."""

    name: str
    key: str
    if_absent: float | None = None


@dataclass(frozen=True)
class Adapter:
    """Layout of one document format.

    ``required``      keys whose presence identifies the format
    ``header``        path of the object that holds the three fields below
    ``started``       start time, epoch seconds
    ``duration``      duration in seconds, number or text
    ``model``         model name
    ``params``        path of the object with the inference parameters
    ``infer_sampling``  derive do_sample from temperature > 0 instead of reading it
    ``skip_tasks``    result keys that are roll-ups, not tasks
    ``skip_metrics``  keys of a task that are never metrics
    ``stderr_inside`` look for ``<a>_stderr,<b>`` before ``<a>,<b>_stderr``
    """

    name: str
    required: tuple[str, ...]
    started: str
    duration: str
    model: str
    params: tuple[str, ...]
    fields: tuple[ParamField, ...]
    header: tuple[str, ...] = ()
    infer_sampling: bool = False
    skip_tasks: tuple[str, ...] = ()
    skip_metrics: tuple[str, ...] = ()
    stderr_inside: bool = False

    def members(self) -> set[str]:
        """Members of the document itself that the other methods look at."""
        header = self.header[:1] or (self.started, self.duration, self.model)
        return {"results", *self.required, *header, *self.params[:1]}

    def matches(self, doc: V.Document) -> Column:
        """Key presence decides; a JSON null counts as present."""
        found = F.lit(True)
        for key in self.required:
            found = found & doc.has(key)
        return found

    def header_field(self, doc: V.Document, key: str) -> Column:
        return doc.field(*self.header, key)

    def broken_path(self, doc: V.Document, params: Column) -> Column:
        """Some object on the way to header or parameters is present but not an object.

        ``params`` is what was found at the end of the parameter path; if it is there,
        that path is whole.
        """
        to_params = [self.params[: i + 1] for i in range(len(self.params))]
        to_header = [self.header[: i + 1] for i in range(len(self.header))]
        broken = params.isNull() & _any_not_object(doc, to_params)
        others = [path for path in to_header if path not in to_params]
        return broken | _any_not_object(doc, others) if others else broken

    def stderr_keys(self, metric: str) -> list[str]:
        """Names under which the standard error of ``metric`` may be stored, best first.

        The mark closes a leading run of the comma-separated parts: each shorter one in turn where
        the harness does so, and at last the whole name.
        """
        parts = metric.split(",")
        cuts = [*range(1, len(parts)), len(parts)] if self.stderr_inside else [len(parts)]
        return [",".join([",".join(parts[:cut]) + STDERR_MARK, *parts[cut:]]) for cut in cuts]

    def stderr_key_array(self, metric: Column) -> Column:
        """``stderr_keys`` for metric names that are only known at run time."""
        whole = F.array(F.concat(metric, F.lit(STDERR_MARK)))
        if not self.stderr_inside:
            return whole
        parts = F.split(metric, ",")
        marked = lambda cut: F.concat(
            F.array_join(F.slice(parts, F.lit(1), cut), ","),
            F.lit(STDERR_MARK + ","),
            F.array_join(F.slice(parts, cut + 1, F.size(parts)), ","),
        )
        inside = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), marked)
        return F.when(metric.contains(","), F.concat(inside, whole)).otherwise(whole)


def _any_not_object(doc: V.Document, paths: list[tuple[str, ...]]) -> Column:
    broken = F.lit(False)
    for path in paths:
        broken = broken | V.not_object(doc.field(*path))
    return broken


LIGHTEVAL = Adapter(
    name="lighteval",
    required=("config_general",),
    header=("config_general",),
    started="start_time",
    duration="total_evaluation_time_secondes",  # spelt like this in the files
    model="model_name",
    params=("config_general", "model_config", "generation_parameters"),
    fields=(
        ParamField("temperature", "temperature", if_absent=0.0),
        ParamField("top_p", "top_p"),
        ParamField("top_k", "top_k"),
        ParamField("max_gen_toks", "max_new_tokens"),
        ParamField("seed", "seed"),
    ),
    infer_sampling=True,
    skip_tasks=("all",),
)

LM_EVAL = Adapter(
    name="lm_eval",
    required=("results", "configs", "config"),
    started="date",
    duration="total_evaluation_time_seconds",
    model="model_name",
    params=("config", "gen_kwargs"),
    fields=(
        ParamField("do_sample", "do_sample"),
        ParamField("temperature", "temperature"),
        ParamField("top_p", "top_p"),
        ParamField("top_k", "top_k"),
        ParamField("max_gen_toks", "max_gen_toks"),
        ParamField("seed", "seed"),
    ),
    skip_metrics=("name", "alias", "sample_len"),
    stderr_inside=True,
)

# The first matching adapter wins.
DEFAULT_ADAPTERS: tuple[Adapter, ...] = (LIGHTEVAL, LM_EVAL)
