"""Queries over prompts, generation and scores."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scoreloom.operators import instructions as I
from scoreloom.operators import prompts as P
from scoreloom.operators import scoring as S
from scoreloom.operators.generate import generate, generate_with_ledger, ledger_of
from scoreloom.plans.catalog import query, table, work_table
from scoreloom.plans.parsing import SCALE, r6, scored_events
from scoreloom.session import materialize, shared_dir, ship_with_tasks
from scoreloom.sources.harness import write_details

ship_with_tasks(__name__)

SHOTS, SEED = 5, 1234


@query(f"""with pool as (
    select item_id, text, row_number() over (order by md5(item_id || ':{SEED}'), item_id) - 1 as ordinal,
           count(*) over () as size from benchmark),
wanted as (
    select b.item_id, s.step, (('0x' || substr(md5(b.item_id || ':{SEED + 1}'), 1, 13))::bigint % b.size + s.step) % b.size as ordinal
    from pool b, unnest(range(0, least({SHOTS} + 1, b.size))) s(step)),
chosen as (
    select w.item_id, p.text, row_number() over (partition by w.item_id order by step) as rank
    from wanted w join pool p using (ordinal) where w.item_id <> p.item_id),
shots as (
    select item_id, count(*) as n, string_agg('<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
        || '<|im_start|>assistant' || chr(10) || length(text) || '<|im_end|>' || chr(10), '' order by rank) as body
    from chosen where rank <= {SHOTS} group by item_id)
select b.item_id, 2 * coalesce(n, 0) + 1 as n_messages,
    coalesce(body, '') || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
        || '<|im_start|>assistant' || chr(10) as prompt
from benchmark b left join shots using (item_id)""")
def fewshot_prompts(spark, sf_dir):
    """Five seeded exemplars per item as chat turns, rendered."""
    items = table(spark, sf_dir, "benchmark").withColumn("answer", F.length("text").cast("string"))
    chosen = P.choose_exemplars(
        items.select("item_id"),
        items.withColumnRenamed("item_id", "exemplar_id"),
        item_id="item_id",
        pool_id="exemplar_id",
        shots=SHOTS,
        seed=SEED,
    )
    messages = P.fewshot_messages(items, chosen, item_id="item_id", question="text", answer="answer")
    return messages.select(
        "item_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        P.render_chat(F.col("messages")).alias("prompt"),
    )


@query("""with pool as (
    select lang, doc_id, row_number() over (partition by lang order by md5(doc_id || ':7'), doc_id) - 1 as ordinal,
           count(*) over (partition by lang) as size
    from documents join labels using (doc_id) where quality = 1),
sizes as (select distinct lang, size from pool),
wanted as (
    select d.doc_id, lang, s.step, (('0x' || substr(md5(d.doc_id || ':8'), 1, 13))::bigint % size + s.step) % size as ordinal
    from documents d join sizes using (lang), unnest(range(0, least(4, size))) s(step)),
chosen as (
    select w.doc_id, p.doc_id as exemplar_id, row_number() over (partition by w.doc_id order by step) as rank
    from wanted w join pool p using (lang, ordinal) where w.doc_id <> p.doc_id)
select doc_id, exemplar_id, rank::int as rank from chosen where rank <= 3""")
def exemplars_by_language(spark, sf_dir):
    """Exemplars only from good documents of the same language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    good = docs.join(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"), "doc_id")
    chosen = P.choose_exemplars(
        docs,
        good.withColumnRenamed("doc_id", "exemplar_id"),
        item_id="doc_id",
        pool_id="exemplar_id",
        shots=3,
        seed=7,
        by=["lang"],
    )
    return chosen.select(F.col("for_doc_id").alias("doc_id"), "exemplar_id", "rank")


@query("""select conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as fragment from conversations
union all select conv_id, max(turn) + 1, '<|im_start|>assistant' || chr(10) from conversations group by conv_id""")
def chat_render(spark, sf_dir):
    return P.chat_fragments(
        table(spark, sf_dir, "conversations"), conversation="conv_id", turn="turn", role="role", text="text"
    )


@query("""select doc_id from documents
where ('0x' || substr(md5(doc_id || ':99'), 1, 13))::bigint < (0.1 * 4503599627370496)::bigint""")
def seeded_sample(spark, sf_dir):
    """The sampling switch with a share of one tenth."""
    return P.seeded_limit(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 99, 0.1)


@query("""select conv_id, n_chars, 1024 - 256 * (conv_id % 5) as room,
    case when 1024 - 256 * (conv_id % 5) <= 0 then 'drop' when n_chars <= 1024 - 256 * (conv_id % 5) then 'keep'
         else 'truncate' end as decision
from (select conv_id, sum(length(text))::bigint as n_chars from conversations group by conv_id)""")
def context_budget(spark, sf_dir):
    lengths = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(F.sum(F.length("text")).alias("n_chars"))
        .withColumn("gen", F.pmod(F.col("conv_id"), F.lit(5)) * 256)
    )
    return P.context_budget(lengths, length="n_chars", max_length=1024, max_gen_toks="gen").drop("gen")


@query("""select conv_id, turn, text as stripped, text as after_end,
    case when role = 'assistant' then length(text) * 2 + 18 else length(text) end as n_raw from conversations""")
def strip_reasoning(spark, sf_dir):
    """Assistant turns with a span of reasoning put in front; both ways of removal."""
    text = F.col("text")
    thought = F.concat(F.lit("<think>"), text, F.lit("\n\n\n</think>"), text)
    raw = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", thought).otherwise(text).alias("raw")
    )
    return raw.select(
        "conv_id",
        "turn",
        S.strip_reasoning(F.col("raw")).alias("stripped"),
        S.after_reasoning(F.col("raw")).alias("after_end"),
        F.length("raw").cast("bigint").alias("n_raw"),
    )


@query("""select event_type, count(*) as n, round(avg(ok), 6) as exact_match,
    round(stddev_samp(ok) / sqrt(count(*)), 6) as exact_match_stderr
from (select event_type, (regexp_extract(props, '"k": *(-?[0-9]+)', 1) = (event_id % 100)::varchar)::int as ok from events)
group by event_type""")
def extract_exact_match(spark, sf_dir):
    answer = S.normalise(S.extract_answer(F.col("props"), r'"k": *(-?[0-9]+)'))
    target = F.pmod(F.col("event_id"), F.lit(100)).cast("string")
    scores = S.exact_match(table(spark, sf_dir, "events"), answer, target, ["event_type"])
    return scores.select("event_type", "n", r6("exact_match"), r6("exact_match_stderr"))


def _checks():
    text = F.col("text")
    return {
        "words_at_least_50": S.words_at_least(text, 50),
        "no_comma": S.no_comma(text),
        "two_bullets": S.bullets_exactly(text, 2),
        # asked of long documents only
        "words_at_most_500": F.when(F.col("n_chars") > 1000, S.words_at_most(text, 500)),
    }


CHECKS_SQL = """with checks as (
    select lang, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) >= 50 as words_at_least_50,
        not contains(text, ',') as no_comma,
        len(regexp_extract_all(text, '(?m)^\\s*[*-]\\s+\\S')) = 2 as two_bullets,
        case when n_chars > 1000 then len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) <= 500 end
            as words_at_most_500
    from documents)
"""


@query(
    CHECKS_SQL
    + """select lang, (count(words_at_least_50) + count(no_comma) + count(two_bullets) + count(words_at_most_500))::bigint
        as n_instructions, count(*) as n_prompts,
    round((count_if(words_at_least_50) + count_if(no_comma) + count_if(two_bullets) + count_if(words_at_most_500))
        / (count(words_at_least_50) + count(no_comma) + count(two_bullets) + count(words_at_most_500)), 6)
        as inst_level_strict_acc,
    round(avg((words_at_least_50 and no_comma and two_bullets and coalesce(words_at_most_500, true))::int), 6)
        as prompt_level_strict_acc
from checks group by lang"""
)
def inst_level_strict(spark, sf_dir):
    scores = S.instruction_accuracy(work_table(spark, sf_dir, "documents"), _checks(), ["lang"])
    return scores.select(
        "lang", "n_instructions", "n_prompts", r6("inst_level_strict_acc"), r6("prompt_level_strict_acc")
    )


@query(
    CHECKS_SQL
    + """select lang, instruction, count(ok) as n, round(avg(ok::int), 6) as accuracy
from (unpivot checks on words_at_least_50, no_comma, two_bullets, words_at_most_500 into name instruction value ok)
group by all"""
)
def instruction_breakdown(spark, sf_dir):
    scores = S.instruction_breakdown(work_table(spark, sf_dir, "documents"), _checks(), ["lang"])
    return scores.select("lang", "instruction", "n", r6("accuracy"))


#: (kind, arguments by the number of the prompt), and the same checks in SQL
ASKED = (
    ("word_count", {"n": "20 + doc_id % 200", "relation": "if(doc_id % 2 = 0, 'at least', 'less than')"},
     "case when doc_id % 2 = 0 then n_words >= 20 + doc_id % 200 else n_words < 20 + doc_id % 200 end"),
    ("sentence_count", {"n": "1 + doc_id % 20"}, r"len(regexp_extract_all(t, '[^.!?\s][^.!?]*[.!?]+')) >= 1 + doc_id % 20"),
    ("line_count", {"n": "2 + doc_id % 10", "relation": "'less than'"}, r"len(regexp_extract_all(t, '(?m)^.*\S.*$')) < 2 + doc_id % 10"),
    ("paragraph_count", {"n": "1 + doc_id % 4"},
     r"len(list_filter(regexp_split_to_array(t, '\n[ \t]*\n'), lambda p: regexp_matches(p, '\S'))) >= 1 + doc_id % 4"),
    ("bullet_count", {"n": "doc_id % 3", "relation": "'exactly'"}, r"len(regexp_extract_all(t, '(?m)^[ \t]*[*-][ \t]+\S')) = doc_id % 3"),
    ("letter_count", {"n": "doc_id % 300", "letter": "substr('etaonirs', int(1 + doc_id % 8), 1)"},
     "length(t) - length(replace(lower(t), substr('etaonirs', 1 + doc_id % 8, 1), '')) >= doc_id % 300"),
    ("word_frequency", {"n": "1 + doc_id % 7", "word": "element_at(array('the', 'DER', 'la', 'Le', 'de'), int(1 + doc_id % 5))"},
     "len(list_filter(words, lambda w: w = list_value('the', 'der', 'la', 'le', 'de')[1 + doc_id % 5])) >= 1 + doc_id % 7"),
    ("words_present", {"words": "if(doc_id % 2 = 0, 'de|la', 'Der|und')"},
     "list_has_all(words, case when doc_id % 2 = 0 then ['de', 'la'] else ['der', 'und'] end)"),
    ("words_absent", {"words": "if(doc_id % 2 = 0, 'le|de', 'and|THE')"},
     "not list_has_any(words, case when doc_id % 2 = 0 then ['le', 'de'] else ['and', 'the'] end)"),
    ("all_lower", {}, "t = lower(t)"),
    ("no_comma", {}, "not contains(t, ',')"),
    ("json", {}, "json_valid(t)"),
    ("starts_with", {"text": "element_at(array('The', 'de', '{', 'l'), int(1 + doc_id % 4))"},
     "starts_with(lower(ltrim(t)), list_value('the', 'de', '{', 'l')[1 + doc_id % 4])"),
    ("ends_with", {"text": "if(doc_id % 3 = 0, '}', '.')"}, "ends_with(lower(rtrim(t)), case when doc_id % 3 = 0 then '}' else '.' end)"),
    ("capital_word_count", {"n": "1 + doc_id % 3", "relation": "'less than'"},
     r"len(list_filter(regexp_split_to_array(t, '[^\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '\p{Lu}{2,}'))) < 1 + doc_id % 3"),
    ("placeholder_count", {"n": "0", "relation": "'exactly'"}, r"len(regexp_extract_all(t, '\[[^\[\]]+\]')) = 0"),
)


def _prompts(spark, sf_dir):
    """Lists of one to four instructions for every document, and a response to each: a fifth of them JSON."""
    documents = work_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    asked = documents.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int"))).alias("ord"))
    arguments, kinds = None, F.array(*(F.lit(name) for name, *_ in ASKED))
    asked = asked.withColumn("kind", F.get(kinds, F.expr(f"int((doc_id * 3 + ord * 5) % {len(ASKED)})")))
    for name, given, _ in ASKED:
        pairs = [F.struct(F.lit(k), F.expr(f"cast({v} as string)")) for k, v in given.items()]
        own = F.map_from_entries(F.array(*pairs)) if pairs else F.create_map().cast("map<string,string>")
        arguments = F.when(F.col("kind") == name, own) if arguments is None else arguments.when(F.col("kind") == name, own)
    made = F.when(F.col("doc_id") % 5 == 0, F.to_json(F.struct("doc_id", "lang"))).otherwise(F.col("text"))
    return documents.select("doc_id", "lang", made.alias("response")), asked.withColumn("arguments", arguments)


_CASES = "\n        ".join(f"when '{name}' then {sql}" for name, _, sql in ASKED)
MARKS_SQL = rf"""with responses as (
    select doc_id, lang, case when doc_id % 5 = 0 then '{{"doc_id":' || doc_id || ',"lang":"' || lang || '"}}' else text end as response
    from documents),
cut as (
    select *, string_split(response, chr(10)) as lines from responses),
forms as (
    select doc_id, lang, list_concat(c, list_transform(c, lambda x: replace(x, '*', ''))) as forms
    from (select doc_id, lang, [response, trim(array_to_string(lines[2:], chr(10))), trim(array_to_string(lines[:-2], chr(10))),
                 trim(array_to_string(lines[2:-2], chr(10)))] as c from cut)),
tried as (
    select doc_id, lang, f.form, f.t, len(regexp_extract_all(f.t, '\S+')) as n_words,
           regexp_split_to_array(lower(f.t), '[^\p{{L}}\p{{N}}_]+') as words
    from (select doc_id, lang, unnest(range(1, 9)) as form, unnest(forms) as t from forms) f),
asked as (
    select doc_id, ord, list_value({", ".join(f"'{name}'" for name, *_ in ASKED)})[1 + (doc_id * 3 + ord * 5) % {len(ASKED)}] as kind
    from documents, unnest(range(0, 1 + doc_id % 4)) o(ord)),
judged as (
    select doc_id, lang, ord, kind, form, regexp_matches(t, '\S') and case kind
        {_CASES} end as met
    from tried join asked using (doc_id)),
marks as (
    select doc_id, lang, ord, kind, bool_or(met and form = 1) as strict, bool_or(met) as loose from judged group by all)
"""


@query(
    MARKS_SQL
    + """select lang, sum(asked)::bigint as n_instructions, count(*) as n_prompts,
    round(sum(strict) / sum(asked), 6) as inst_level_strict_acc, round(avg((strict = asked)::int), 6) as prompt_level_strict_acc,
    round(sum(loose) / sum(asked), 6) as inst_level_loose_acc, round(avg((loose = asked)::int), 6) as prompt_level_loose_acc
from (select doc_id, lang, count(*) as asked, count_if(strict) as strict, count_if(loose) as loose from marks group by all)
group by lang"""
)
def instruction_lists(spark, sf_dir):
    """Every prompt with instructions of its own, strict and loose."""
    responses, asked = _prompts(spark, sf_dir)
    marks = I.judged(responses, asked, prompt="doc_id", response="response", keep=["lang"], loose=True)
    found = I.accuracy(marks, ["lang"], ["doc_id"])
    return found.select("lang", "n_instructions", "n_prompts", *[r6(f"{level}_level_{mark}_acc") for level in ("inst", "prompt") for mark in ("strict", "loose")])


@query(
    MARKS_SQL
    + """select kind, count(*) as n, round(avg(strict::int), 6) as strict_accuracy, round(avg(loose::int), 6) as loose_accuracy
from marks group by kind"""
)
def instruction_kinds(spark, sf_dir):
    responses, asked = _prompts(spark, sf_dir)
    found = I.by_kind(I.judged(responses, asked, prompt="doc_id", response="response", loose=True))
    return found.select("kind", "n", r6("strict_accuracy"), r6("loose_accuracy"))


PASS_SQL = """case when c = 0 then 0.0 when n - c < {k} then 1.0
    else 1 - list_reduce(list_transform(range(n - c + 1, n + 1), lambda i: 1 - {k}::double / i), lambda a, x: a * x) end"""


@query(f"""select event_type, user_id, n, c, round({PASS_SQL.format(k=1)}, 6) as pass_at_1,
    round({PASS_SQL.format(k=3)}, 6) as pass_at_3
from (select event_type, user_id, count(*) as n, count_if(value > 50)::bigint as c from events group by all)""")
def pass_at_k(spark, sf_dir):
    scores = S.pass_at_k(table(spark, sf_dir, "events"), ["event_type", "user_id"], F.col("value") > 50, [1, 3])
    return scores.select("event_type", "user_id", "n", "c", r6("pass_at_1"), r6("pass_at_3"))


@query(f"""with samples as (
    select l_orderkey // 40 as problem, l_orderkey, bool_and(l_quantity > 5) as ok from lineitem group by all),
counts as (select problem, count(*) as n, count_if(ok)::bigint as c from samples group by problem)
select problem, n, c, round({PASS_SQL.format(k=1)}, 6) as pass_at_1, round({PASS_SQL.format(k=5)}, 6) as pass_at_5
from counts""")
def codegen_pass_at_k(spark, sf_dir):
    """An order is a sample, its lines are the tests."""
    verdicts = table(spark, sf_dir, "lineitem").withColumn("problem", F.floor(F.col("l_orderkey") / 40))
    scores = S.code_pass_at_k(verdicts, ["problem"], "l_orderkey", F.col("l_quantity") > 5, [1, 5])
    return scores.select("problem", "n", "c", r6("pass_at_1"), r6("pass_at_5"))


BOUNDS = [0, 1024, 4096, 8192, 16384, 32768]
BUCKETS_SQL = """with scored as (
    select lang, quality, case when n_chars <= 0 then null when n_chars <= 1024 then 1024 when n_chars <= 4096 then 4096
        when n_chars <= 8192 then 8192 when n_chars <= 16384 then 16384 when n_chars <= 32768 then 32768
        else 65536 end as upper
    from documents left join labels using (doc_id)),
buckets as (select lang, upper, count(quality) as n, avg(quality) as score from scored group by all)
"""


def _scored_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@query(
    BUCKETS_SQL
    + """select lang, case when upper <= 32768 then upper end as upper, n, round(score, 6) as score,
    case upper when 1024 then 'score_gt_0_le_1k' when 4096 then 'score_gt_1k_le_4k' when 8192 then 'score_gt_4k_le_8k'
    when 16384 then 'score_gt_8k_le_16k' when 32768 then 'score_gt_16k_le_32k' when 65536 then 'score_gt_32k'
    else 'score_le_0' end as metric from buckets"""
)
def length_buckets(spark, sf_dir):
    buckets = S.bucket_scores(_scored_documents(spark, sf_dir), "n_chars", "quality", BOUNDS, ["lang"])
    return buckets.select("lang", "upper", "n", r6("score"), "metric")


@query(
    BUCKETS_SQL
    + """, steps as (select lang, log2(upper) as x, score, lag(log2(upper)) over w as x0, lag(score) over w as s0
    from buckets where score is not null and upper is not null window w as (partition by lang order by upper))
select lang, count(*) as n_buckets,
    round(sum((x - x0) * (score + s0) / 2) / sum(x - x0), 6) as length_auc from steps group by lang"""
)
def length_auc(spark, sf_dir):
    buckets = S.bucket_scores(_scored_documents(spark, sf_dir), "n_chars", "quality", BOUNDS, ["lang"])
    return S.length_auc(buckets, ["lang"]).select("lang", "n_buckets", r6("length_auc"))


def _count_characters(text: str) -> str:
    if len(text) > 300:
        raise ValueError("too long")
    return str(len(text))


@query("""select conv_id, turn, case when length(text) <= 300 then length(text)::varchar end as output,
    case when length(text) > 300 then 'ValueError: too long' end as error,
    case when length(text) > 300 then 3 else 1 end as attempts
from conversations""")
def batch_generate(spark, sf_dir):
    """A caller's function over every turn; refusals stay in the result as errors."""
    turns = table(spark, sf_dir, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    answered = generate(turns, _count_characters, key="key", prompt="text", threads=4, retries=2)
    return answered.select("conv_id", "turn", "output", "error", "attempts")


def _breaks_off(text: str) -> str:
    if len(text) % 2:
        raise ConnectionError("gone")
    return str(len(text))


@query("""select conv_id, turn, length(text)::varchar as output, 1::bigint as n_answers,
    case when length(text) % 2 = 0 then 'first' else 'second' end as answered_in
from conversations""")
def resumed_generation(spark, sf_dir):
    """Two passes over all turns with a ledger: the first breaks off at every second text, the other answers the rest."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    turns = turns.withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    ledger = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    options = {"key": "key", "prompt": "text", "tasks": spark.sparkContext.defaultParallelism, "threads": 4, "batch": 512}
    generate_with_ledger(turns, _breaks_off, ledger, retries=0, **options)
    first = materialize(ledger_of(spark, ledger).where("error is null").select("key", F.lit("first").alias("answered_in")), "first-pass")
    answered = generate_with_ledger(turns, lambda text: str(len(text)), ledger, retries=0, **options)
    counts = spark.read.parquet(ledger).where("error is null").groupBy("key").agg(F.count(F.lit(1)).alias("n_answers"))
    return answered.join(counts, "key").join(first, "key", "left").select(
        "conv_id", "turn", "output", "n_answers", F.coalesce("answered_in", F.lit("second")).alias("answered_in")
    )


@query(f"""select event_type as task_name, 'm' || (user_id % 5) as model_name, (event_id % 3 + 1)::int as rep,
    count(*) as n, round(avg(value / {SCALE}), 6) as score
from events group by all""")
def details_sink(spark, sf_dir):
    """Per-sample details stored per run, scored from the stored table. A third of the runs is stored twice."""
    samples = scored_events(spark, sf_dir).select(
        F.col("event_type").alias("task_name"),
        F.concat(F.lit("m"), F.pmod(F.col("user_id"), F.lit(5)).cast("string")).alias("model_name"),
        (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int").alias("rep"),
        "event_id",
        "value",
    )
    target = f"{shared_dir(spark)}/details-{uuid.uuid4().hex}"
    write_details(samples, target)
    write_details(samples.where("rep = 2"), target)
    stored = spark.read.parquet(target)
    return stored.groupBy("task_name", "model_name", "rep").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("score")
    )
