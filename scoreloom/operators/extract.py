"""Documents to normalised task results.

Everything here is narrow: one document row in, one outcome row out. A document is
accepted or refused as a whole, decided on its own row before any explode, so no
shuffle is needed to keep files atomic.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import scalars as S
from scoreloom.functions import variants as V
from scoreloom.operators.adapters import DEFAULT_ADAPTERS, Adapter
from scoreloom.operators.registry import Registry, as_mapping, metrics_by_task, registry_frame, stored_registry
from scoreloom.session import materialize

PARAMS_TYPES = {
    "do_sample": "boolean",
    "temperature": "double",
    "top_p": "double",
    "top_k": "bigint",
    "max_gen_toks": "bigint",
    "seed": "bigint",
}


def extract(
    docs: DataFrame,
    *,
    registry: Registry | None = None,
    adapters: Sequence[Adapter] = DEFAULT_ADAPTERS,
    metrics: str = "registry",
) -> DataFrame:
    """One outcome row per document of ``(path, source_filename, content)``.

    ``code`` is NULL for accepted documents, ``rows`` holds their task results. With
    ``metrics="auto"`` unregistered tasks are kept too, with every numeric metric.
    """
    if metrics not in ("registry", "auto"):
        raise ValueError("metrics must be 'registry' or 'auto'")
    if isinstance(registry, DataFrame):
        registry = stored_registry(registry)
    known = as_mapping(registry)
    if known is None:
        return _joined(docs, registry_frame(docs.sparkSession, registry), tuple(adapters), metrics == "auto")
    reported = tuple((task, tuple(keys)) for task, keys in known.items())
    for columns in _stages(tuple(adapters), reported, metrics == "auto", _gateway()):
        docs = docs.select(*columns)
    return docs


def _joined(docs: DataFrame, registry: DataFrame, adapters: tuple[Adapter, ...], auto: bool) -> DataFrame:
    """The same outcomes with a registry of any size: tasks meet it in a join and come together again by document.

    A document is known by its path, name and 128 bits of its text, all as they were read. So what becomes of
    it does not hang on the order of rows, should a lost stage run again; documents equal in all of these are counted and
    come out as often as they went in. Texts are dropped before the first shuffle; what travels is a task at a time. A
    document of one task or none is whole after the join and is not grouped; the rows are stored, so that the two kinds
    part without a second parse.
    """
    before, task, after = _joined_stages(adapters, auto, _gateway())
    for columns in before:
        docs = docs.select(*columns)
    docs = docs.withColumn("_several", F.coalesce(F.size("_tasks") > 1, F.lit(False)))
    rows = docs.select("*", F.posexplode_outer("_tasks").alias("_ord", "_task")).drop("_tasks")
    # documents without tasks are spread over the partitions, as no task has this name
    name = F.coalesce(F.col("_task.task_name"), F.concat(F.lit("\0"), F.hex("_text_hash")))
    met = rows.withColumn("_name", name).join(metrics_by_task(registry), "_name", "left")
    header = [c for c in rows.columns if c not in (*_IDENTITY, "_several", "_ord", "_task", "_quoted")]
    met = met.select(
        *_IDENTITY,
        "_several",
        F.struct(*header).alias("_header"),
        F.col("_ord"),
        F.when(F.col("_task").isNotNull(), task).alias("_task"),
    )
    met = materialize(met, "task-rows")
    found = F.struct("_ord", "_task")
    whole = met.where("_several").groupBy(*_IDENTITY).agg(
        F.any_value("_header").alias("_header"),
        F.array_sort(F.collect_set(F.when(F.col("_task").isNotNull(), found))).alias("_found"),
        F.count_if(F.coalesce(F.col("_ord"), F.lit(0)) == 0).cast("int").alias("_copies"),
    )
    tasks = F.when(F.col("_header._has_tasks"), F.transform("_found", lambda f: f["_task"]))
    one = whole.select("path", "source_filename", "_header.*", tasks.alias("_tasks"), F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")).drop("_copy")
    tasks = F.when(F.col("_header._has_tasks"), F.filter(F.array("_task"), lambda t: t.isNotNull()))
    one = one.unionByName(met.where("not _several").select("path", "source_filename", "_header.*", tasks.alias("_tasks")))
    for columns in after:
        one = one.select(*columns)
    return one


#: What tells documents apart while their tasks are on the way.
_IDENTITY = ("path", "source_filename", "_text_hash", "_text_hash2")


@lru_cache(maxsize=8)
def _joined_stages(adapters: tuple[Adapter, ...], auto: bool, gateway: int) -> tuple:
    """The projections up to the join, the task of a row that has met its metrics, and the projections after."""
    hashes = ["_text_hash", "_text_hash2"]
    before = [
        ["path", "source_filename", "content", F.xxhash64("content").alias(hashes[0]), F.xxhash64(F.lit(1), "content").alias(hashes[1])],
        *_parse(hashes),
        *_locate(adapters, _raw_tasks, hashes, "map<string,variant>"),
        ["_quoted", *hashes, *_typed(adapters), F.col("_tasks").isNotNull().alias("_has_tasks")],
    ]
    task = _by_adapter(
        adapters,
        lambda a: V.let(
            V.as_map(F.col("_task.value")),
            lambda members: F.when(
                F.lit(True) if auto else F.col("reported").isNotNull(),
                F.struct(
                    F.col("_task.task_name").alias("task_name"),
                    members.isNotNull().alias("is_object"),
                    _metrics(a, None, members, None, auto, F.col("_quoted")).alias("metrics"),
                ),
            ),
        ),
    )
    return before, task, [["*", _code().alias("code")], _finish(), _sealed()]


def _raw_tasks(adapter: Adapter, tasks: Column) -> Column:
    """``array<struct<task_name, value>>`` of all tasks in document order; NULL as for ``_task_rows``."""
    wanted = lambda names: F.filter(names, lambda n: _is_task(adapter, n))
    return V.let(
        tasks,
        lambda tasks: V.let(
            wanted(F.map_keys(tasks)),
            lambda names: F.transform(
                F.when(F.size(names) > 1, _document_order(names, wanted)).otherwise(names),
                lambda name: F.struct(name.alias("task_name"), F.try_element_at(tasks, name).alias("value")),
            ),
        ),
    )


def _gateway() -> int:
    """Columns are JVM objects: those of another JVM are of no use."""
    return id(SparkContext._gateway)


@lru_cache(maxsize=32)
def _stages(
    adapters: tuple[Adapter, ...], reported: tuple[tuple[str, tuple[str, ...]], ...], auto: bool, gateway: int
) -> list[list[Column | str]]:
    """The projections of an extraction with a registry that is a literal, in order.

    They do not depend on the input, and composing some thousand expressions from
    Python takes a second or two, so they are kept for the next call.
    """
    return [
        *_parse([]),
        # where every task is wanted, the members of each are taken out with the tasks
        *_locate(adapters, lambda a, tasks: _task_rows(a, tasks, dict(reported), auto), [], f"map<string,{'map<string,variant>' if auto else 'variant'}>"),
        _typed(adapters),
        ["*", _code().alias("code")],
        _finish(),
        _sealed(),
    ]


def _finish() -> list[Column]:
    kept = ("path", "source_filename", "framework", "code", "model_name")
    return [
        *(F.col(name).alias(name) for name in kept),
        _detail().alias("detail"),
        F.when(F.col("_started_ok"), F.col("_started")).alias("evaluation_datetime"),
        S.epoch_iso(F.col("_started")).alias("evaluation_datetime_iso"),
        F.col("evaluation_duration_seconds"),
        F.col("inference_parameters"),
        F.coalesce(F.when(F.col("code").isNull(), _rows()), F.array()).alias("rows"),
    ]


OUTCOME_COLUMNS = [
    "path",
    "source_filename",
    "framework",
    "code",
    "detail",
    "model_name",
    "evaluation_datetime",
    "evaluation_datetime_iso",
    "evaluation_duration_seconds",
    "inference_parameters",
    "rows",
]


def _sealed() -> list[Column]:
    """The same columns, closed to filters.

    A filter on a projected column is rewritten in terms of what is below, and here
    that means copies of the whole parse. Spark does not do that for columns it takes
    for nondeterministic, as anything with the partition number. Columns nobody asks for
    are still left out of the plan.
    """
    return [F.when(F.spark_partition_id() >= 0, F.col(name)).alias(name) for name in OUTCOME_COLUMNS]


def _parse(kept: list[str]) -> list[list[Column | str]]:
    """Strict parse; a failed text gets a second try with bare non-finite numbers quoted."""
    text = F.col("content")
    return [
        [
            "path",
            "source_filename",
            *kept,
            F.when(F.is_valid_utf8(text), text).alias("content"),
            F.when(F.octet_length(text) == 0, "EMPTY_FILE")
            .when(~F.is_valid_utf8(text), "INVALID_UTF8")
            .alias("_unreadable"),
        ],
        ["*", V.strict_envelope(text).alias("_first")],
        ["*", V.envelope_is_strict(F.col("_first"), text).alias("_strict")],
        ["*", F.when(~F.col("_strict"), V.quote_nonfinite(text)).alias("_fixed")],
        ["*", V.strict_envelope(F.col("_fixed")).alias("_second")],
        [
            "path",
            "source_filename",
            *kept,
            "_unreadable",
            F.when(F.octet_length(text) > V.MAX_DOCUMENT, "TOO_LARGE")
            .when(~F.col("_strict") & V.has_long_string(text), "STRING_TOO_LONG")
            .otherwise("MALFORMED_JSON")
            .alias("_refused"),
            F.coalesce("_fixed", "content").alias("_text"),
            F.col("_fixed").isNotNull().alias("_quoted"),
            F.when(F.col("_strict"), F.col("_first"))
            .when(V.envelope_is_strict(F.col("_second"), F.col("_fixed")), F.col("_second"))
            .alias("_doc"),
        ],
    ]


def _by_adapter(adapters: Sequence[Adapter], build) -> Column:
    """``build(adapter)`` of the adapter whose name is in column ``framework``."""
    chosen = None
    for adapter in adapters:
        matches = F.col("framework") == adapter.name
        value = build(adapter)
        chosen = F.when(matches, value) if chosen is None else chosen.when(matches, value)
    return chosen


def _locate(adapters: tuple[Adapter, ...], tasks, kept: list[str], results: str) -> list[list[Column | str]]:
    """Classify the documents and pick the raw fields and ``tasks(adapter, results)``, with the results as a map of that type.

    The document is dropped here.
    """
    kinds = _kinds(adapters, results)
    doc = V.Document(F.col("_doc"), F.col("_members"), kinds)
    framework = None
    for adapter in adapters:
        hit, name = adapter.matches(doc), F.lit(adapter.name)
        framework = F.when(hit, name) if framework is None else framework.when(hit, name)
    header = lambda key: _by_adapter(adapters, lambda a: a.header_field(doc, getattr(a, key)))
    return [
        ["*", V.Document.members_of(F.col("_doc"), kinds).alias("_members")],
        ["*", framework.alias("framework")],
        [
            "*",
            doc.has("results").alias("_has_results"),
            _by_adapter(adapters, lambda a: doc.field_map(*a.params)).alias("_params"),
            header("started").alias("_started_raw"),
            header("duration").alias("_duration_raw"),
            header("model").alias("_model_raw"),
        ],
        [
            "path", "source_filename", *kept, "framework", "_unreadable", "_refused", "_quoted",
            F.col("_doc").isNotNull().alias("_parsed"), "_has_results", "_params",
            "_started_raw", "_duration_raw", "_model_raw",
            _by_adapter(adapters, lambda a: a.broken_path(doc, F.col("_params"))).alias("_broken_path"),
            _by_adapter(adapters, lambda a: tasks(a, doc.field_map("results"))).alias("_tasks"),
        ],
    ]


def _kinds(adapters: tuple[Adapter, ...], results: str) -> dict[str, str]:
    """Type of each member to be taken out. Spark cannot tell fields of a struct apart by case, so such members are left to their paths."""
    names = sorted({name for a in adapters for name in a.members()})
    folded = [name.lower() for name in names]
    kinds = {name: "variant" for name in names if folded.count(name.lower()) == 1}
    if "results" in kinds:
        kinds["results"] = results
    return kinds


def _typed(adapters: tuple[Adapter, ...]) -> list[Column | str]:
    """Raw fields to their types, with a flag where the type is wrong."""
    quoted = F.col("_quoted")
    started, duration, model = F.col("_started_raw"), F.col("_duration_raw"), F.col("_model_raw")
    return [
        "path", "source_filename", "framework", "_unreadable", "_refused", "_parsed", "_has_results",
        "_broken_path", "_tasks",
        V.number(started, quoted).alias("_started"),
        _started_usable(started, quoted).alias("_started_ok"),
        F.coalesce(V.number(duration, quoted), S.float_text(V.text_of(duration))).alias(
            "evaluation_duration_seconds"
        ),
        F.coalesce(V.type_tag(duration).isin("OBJ", "ARR"), F.lit(False)).alias("_bad_duration"),
        V.text_of(model).alias("model_name"),
        (V.is_present(model) & V.text_of(model).isNull()).alias("_bad_model"),
        _by_adapter(adapters, lambda a: _temperature_unusable(a, quoted)).alias("_bad_temp"),
        _by_adapter(adapters, lambda a: _params(a, quoted)).alias("inference_parameters"),
    ]


def _is_task(adapter: Adapter, name: Column) -> Column:
    if not adapter.skip_tasks:
        return F.lit(True)
    return ~F.array_contains(F.array(*map(F.lit, adapter.skip_tasks)), name)


def _is_wanted(adapter: Adapter, name: Column, reported: dict[str, tuple[str, ...]], auto: bool) -> Column:
    keep = _is_task(adapter, name)
    if auto:
        return keep
    if not reported:
        return F.lit(False)
    return keep & F.array_contains(F.array(*map(F.lit, sorted(reported))), name)


def _started_usable(value: Column, quoted: Column) -> Column:
    """Absent, empty or a number on the calendar; any other value is an error."""
    seconds = V.number(value, quoted)
    return (
        F.when(value.isNull() | F.is_variant_null(value), True)
        .when(seconds.isNotNull(), (seconds == 0) | S.epoch_in_range(seconds))
        .otherwise(F.try_variant_get(value, "$", "string").isin("", "[]", "{}"))
    )


def _temperature_unusable(adapter: Adapter, quoted: Column) -> Column:
    """Sampling can only be inferred from a number."""
    if not adapter.infer_sampling:
        return F.lit(False)
    value = F.try_element_at("_params", F.lit(_temperature(adapter).key))
    return F.coalesce(V.is_present(value) & V.number(value, quoted).isNull(), F.lit(False))


def _temperature(adapter: Adapter):
    return next(f for f in adapter.fields if f.name == "temperature")


def _params(adapter: Adapter, quoted: Column) -> Column:
    by_name = {f.name: f for f in adapter.fields}
    values = []
    for name, kind in PARAMS_TYPES.items():
        if name == "do_sample" and adapter.infer_sampling:
            temp = _param_value(adapter, _temperature(adapter), "double", quoted)
            values.append((F.coalesce((temp > 0) & ~F.isnan(temp), F.lit(False))).alias(name))
        elif name in by_name:
            values.append(_param_value(adapter, by_name[name], kind, quoted).alias(name))
        else:
            values.append(F.lit(None).cast(kind).alias(name))
    return F.struct(*values)


def _param_value(adapter: Adapter, spec: ParamField, kind: str, quoted: Column) -> Column:
    value = F.try_element_at("_params", F.lit(spec.key))
    if kind == "double":
        typed = V.number(value, quoted)
        if not adapter.infer_sampling:
            typed = F.coalesce(typed, S.float_text(V.text_of(value)))
    else:
        typed = F.try_variant_get(value, "$", kind)
    if spec.if_absent is not None:
        typed = F.when(value.isNull(), F.lit(spec.if_absent)).otherwise(typed)
    return typed


def _task_rows(adapter: Adapter, tasks: Column, reported: dict[str, tuple[str, ...]], auto: bool) -> Column:
    """``array<struct<task_name, is_object, metrics>>`` of the wanted tasks in document order.

    NULL if there are no results or they are not an object.
    """
    quoted = F.col("_quoted")
    wanted = lambda names: F.filter(names, lambda n: _is_wanted(adapter, n, reported, auto))

    def task(name: Column, members: Column) -> Column:
        return F.struct(
            name.alias("task_name"),
            members.isNotNull().alias("is_object"),
            _metrics(adapter, name, members, reported, auto, quoted).alias("metrics"),
        )

    members_of = V.let if auto else lambda value, body: V.let(V.as_map(value), body)
    return V.let(
        tasks,
        lambda tasks: V.let(
            wanted(F.map_keys(tasks)),
            lambda names: F.transform(
                F.when(F.size(names) > 1, _document_order(names, wanted)).otherwise(names),
                lambda name: members_of(F.try_element_at(tasks, name), lambda members: task(name, members)),
            ),
        ),
    )


def _document_order(names: Column, wanted) -> Column:
    """A VARIANT object is sorted by key; the order of its keys is taken from the text again."""
    in_text = F.json_object_keys(F.get_json_object(F.col("_text"), "$.results"))
    return V.let(
        wanted(F.array_distinct(in_text)),
        lambda ordered: F.when(F.size(ordered) == F.size(names), ordered).otherwise(names),
    )


def _metrics(adapter, task_name, members, reported, auto, quoted) -> Column:
    """Measured metrics of one task."""
    registered = F.filter(
        F.transform(
            _specs(adapter, task_name, reported),
            lambda spec: _measure(
                spec["metric"], F.try_element_at(members, spec["metric"]), spec["stderr_keys"], members, quoted
            ),
        ),
        lambda m: m["present"],
    ) if reported is None or reported else None
    if not auto:
        return registered
    # one comparison each: inside lambdas a search in a constant array is far slower
    def may_be(name: Column) -> Column:
        wanted = ~name.contains("_stderr")
        for skipped in adapter.skip_metrics:
            wanted = wanted & (name != skipped)
        return wanted

    every = F.filter(
        F.transform(
            F.filter(F.map_keys(members), may_be),
            lambda name: _measure(name, F.try_element_at(members, name), adapter.stderr_key_array(name), members, quoted),
        ),
        lambda m: m["value"].isNotNull(),
    )
    return every if registered is None else F.coalesce(registered, every)


def _specs(adapter: Adapter, task_name: Column, reported: dict[str, tuple[str, ...]] | None) -> Column:
    """``array<struct<metric, stderr_keys>>`` of a task, NULL if it is not registered.

    Without a literal registry, column ``reported`` has the metrics of the row's own task.
    """
    if reported is not None:
        return F.try_element_at(_known(adapter, reported), task_name)
    return F.transform(
        F.col("reported"),
        lambda key: F.struct(key.alias("metric"), adapter.stderr_key_array(key).alias("stderr_keys")),
    )


def _known(adapter: Adapter, reported: dict[str, tuple[str, ...]]) -> Column:
    """Constant ``map<task, array<struct<metric, stderr_keys>>>``."""
    pairs = []
    for name, keys in reported.items():
        specs = [
            F.struct(
                F.lit(key).alias("metric"),
                F.array(*map(F.lit, adapter.stderr_keys(key))).alias("stderr_keys"),
            )
            for key in keys
        ]
        pairs += [F.lit(name), F.array(*specs)]
    return F.create_map(*pairs)


def _measure(metric: Column, value: Column, stderr_keys: Column, members: Column, quoted: Column) -> Column:
    """Value and standard error of one metric; the first non-null candidate decides."""
    candidates = F.filter(
        F.transform(stderr_keys, lambda key: F.try_element_at(members, key)), V.is_present
    )

    def measured(stderr: Column) -> Column:
        return F.struct(
            metric.alias("metric"),
            V.number(value, quoted).alias("value"),
            V.number(stderr, quoted).alias("stderr"),
            F.coalesce(V.is_present(value), F.lit(False)).alias("present"),
            (
                stderr.isNotNull()
                & V.number(stderr, quoted).isNull()
                & ~F.coalesce(V.text_of(stderr) == "N/A", F.lit(False))
            ).alias("bad_stderr"),
        )

    return V.let(F.get(candidates, F.lit(0)), measured)


def _code() -> Column:
    """Why a document is refused, NULL if it is not."""
    tasks = F.col("_tasks")
    return (
        F.when(F.col("_unreadable").isNotNull(), F.col("_unreadable"))
        .when(~F.col("_parsed"), F.col("_refused"))
        .when(F.col("framework").isNull(), "UNKNOWN_FORMAT")
        .when(F.col("_has_results") & tasks.isNull(), "BAD_RESULTS")
        # from here on only documents with something to report can fail
        .when(tasks.isNull() | (F.size(tasks) == 0), F.lit(None).cast("string"))
        .when(F.exists(tasks, lambda t: ~t["is_object"]), "BAD_TASK")
        .when(F.col("_broken_path"), "BAD_PARAMS")
        .when(F.col("_bad_temp"), "BAD_TEMPERATURE")
        .when(~F.col("_started_ok"), "BAD_TIMESTAMP")
        .when(F.col("_bad_model"), "BAD_MODEL_NAME")
        .when(F.col("_bad_duration"), "BAD_DURATION")
        .when(
            F.exists(
                tasks,
                lambda t: F.exists(t["metrics"], lambda m: m["value"].isNull() | m["bad_stderr"]),
            ),
            "NON_NUMERIC_METRIC",
        )
    )


def _detail() -> Column:
    """The task, or task and metric, for which a document is refused; NULL where the code says it all."""
    bad = lambda m: m["value"].isNull() | m["bad_stderr"]
    metrics = F.flatten(
        F.transform(
            "_tasks",
            lambda t: F.transform(F.filter(t["metrics"], bad), lambda m: F.concat(t["task_name"], F.lit(": "), m["metric"])),
        )
    )
    return F.when(
        F.col("code") == "BAD_TASK", F.get(F.filter("_tasks", lambda t: ~t["is_object"]), F.lit(0))["task_name"]
    ).when(F.col("code") == "NON_NUMERIC_METRIC", F.get(metrics, F.lit(0)))


#: At which step a document is refused, by code; all other codes are given while fields are extracted.
STAGES = {
    "EMPTY_FILE": "read",
    "INVALID_UTF8": "read",
    "MALFORMED_JSON": "parse",
    "TOO_LARGE": "parse",
    "STRING_TOO_LONG": "parse",
    "UNKNOWN_FORMAT": "classify",
}


def _rows() -> Column:
    """Task rows without the flags."""
    return F.transform(
        "_tasks",
        lambda t: F.struct(
            t["task_name"].alias("task_name"),
            F.transform(
                t["metrics"],
                lambda m: F.struct(
                    m["metric"].alias("metric"), m["value"].alias("value"), m["stderr"].alias("stderr")
                ),
            ).alias("metrics"),
        ),
    )


def results(outcomes: DataFrame) -> DataFrame:
    """One row per (document, reported task)."""
    exploded = outcomes.select(
        "path",
        "source_filename",
        "framework",
        "model_name",
        "evaluation_datetime",
        "evaluation_datetime_iso",
        "evaluation_duration_seconds",
        "inference_parameters",
        F.posexplode("rows").alias("task_ord", "_row"),
    )
    return exploded.select(
        "path",
        "source_filename",
        "task_ord",
        "framework",
        F.col("_row.task_name").alias("task_name"),
        "model_name",
        "evaluation_datetime",
        "evaluation_datetime_iso",
        "evaluation_duration_seconds",
        F.map_from_entries(
            F.transform(
                "_row.metrics",
                lambda m: F.struct(m["metric"], F.struct(m["value"].alias("value"), m["stderr"].alias("stderr"))),
            )
        ).alias("metrics"),
        "inference_parameters",
    )


def rejects(outcomes: DataFrame) -> DataFrame:
    """Refused documents with the step that refused them, the reason, and the task and metric where one is at fault."""
    stages = F.create_map(*(F.lit(x) for pair in STAGES.items() for x in pair))
    stage = F.coalesce(F.try_element_at(stages, "code"), F.lit("extract"))
    return outcomes.where(F.col("code").isNotNull()).select(
        "path", "source_filename", "framework", stage.alias("stage"), "code", "detail"
    )


def fail_on_rejects(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` unchanged, but the job fails at the first refused document."""
    message = F.concat(F.lit("refused document "), F.col("path"), F.lit(": "), F.col("code"))
    # a filter, unlike a column, is never left out because nobody asks for it
    return outcomes.where(F.when(F.col("code").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))
