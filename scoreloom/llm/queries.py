"""The named queries of this package with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import alignment, ann, byte_bpe, embedding_dedup, jaccard, language_id, line_dedup, merkle, packing, token_counts, topk, url_filters, warc
from scoreloom.llm.common import prepare
from scoreloom.plans.catalog import Entry, table

CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(fn):
        CATALOG[fn.__name__] = Entry(lambda spark, sf_dir: fn(prepare(spark), sf_dir), sql)
        return fn

    return register


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return byte_bpe.decode(encoded, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: (verdict, host, path)
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def repeated_addresses(pages: DataFrame) -> DataFrame:
    """Canonical addresses that more than one page carries: the list of the query below."""
    address = url_filters.canonical(url_filters.host_of(F.col("url")), url_filters.path_of(F.col("url")))
    counts = pages.select(address.alias("address")).groupBy("address").count()
    return counts.where("count > 1 and address is not null").select("address")


@query(
    """
    with parts as (
        select page_id,
               case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
        from pages),
    split as (
        select page_id,
               translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from (select page_id, coalesce(rest, '') as rest from parts)),
    rules(kind, h, p) as (
        values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
               ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    addressed as (
        select *, case when host <> '' then host || regexp_replace(path, '/+$', '') end as address,
               (select max_by(h || p || '|' || kind, length(h || p)) from rules
                where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)) as ruled
        from split),
    counted as (select *, count(*) over (partition by address) as n from addressed)
    select page_id, host, path, split_part(ruled, '|', 1) as rule,
           coalesce(split_part(ruled, '|', 2), case when address is not null and n > 1 then 'block' else 'allow' end) as verdict,
           address is not null and n > 1 as listed
    from counted
    """
)
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(pages, repeated_addresses(pages), URL_RULES)


@query(
    """
    with p as (
        select page_id, coalesce(html, '') as html from pages),
    d as (select page_id, strlen(html) as payload_bytes, sha1(html) as payload_digest from p),
    g as (
        select *, max(page_id) over (partition by payload_digest) as holder from d)
    select page_id, payload_bytes, payload_digest,
           case when payload_bytes >= 1000 and page_id < holder then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 1000 and page_id < holder then holder end as refers_to
    from g
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    store = warc.store_records(warc.read_warc(spark, folder))
    payloads = store.payloads.select(
        "digest",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    return store.headers.join(payloads, "digest", "left").select(
        warc.key_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.key_of(F.col("refers_to")).alias("refers_to"),
    )


def packing_tokenizer() -> packing.WordTokenizer:
    return packing.WordTokenizer.read(public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


LANGUAGES = ("de", "en", "es", "fr")


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, LANGUAGES)
    # the label that the model is fitted on is no evidence here
    found = language_id.identify(docs, model, host=F.col("source"))
    return found.select("doc_id", "language", "confidence", "kept")


@query()
def op10_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(table(spark, sf_dir, "documents"), LANGUAGES)
    pages = language_id.with_page_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    host = url_filters.host_of(F.col("url"))
    found = language_id.identify(
        pages, model, "page_id", declared=language_id.declared_in(F.col("html")), address=F.col("url"), host=host
    )
    return found.select("page_id", "language", "confidence", "kept")


@query(
    """
    with f as (
        select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
        from embeddings where embedding is not null),
    s as (
        select q.vec_id as query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
        from f q join f c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
    select query_id, rank, vec_id, score from r where rank <= 10
    """
)
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


@query()
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_lines(docs, line_dedup.repeated_lines(docs))


@query()
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def tidying_edits(text) -> Column:
    """Edits of one document: its first line goes, the first mail address and the first IPv4 address are
    hidden, and a closing line is added."""

    def hidden(pattern: str, new: str) -> Column:
        found = F.regexp_substr(text, F.lit(pattern))
        start = F.length(F.call_function("substring_index", text, found, F.lit(1)))
        return F.struct(start.alias("start"), (start + F.length(found)).alias("end"), F.lit(new).alias("new"))

    first_line = F.length(F.substring_index(text, "\n", 1)) + 1
    size = F.length(text)
    return F.array(
        F.struct(F.lit(0).alias("start"), F.least(first_line, size).alias("end"), F.lit("").alias("new")),
        hidden(r"[\w.]+@[\w.]+", "<mail>"),
        hidden(r"\d{1,3}(\.\d{1,3}){3}", "<address>"),
        F.struct(size.alias("start"), size.alias("end"), F.lit("\nEnd of document.").alias("new")),
    )


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary)
    total = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)
    before = counted.select("*", total.alias("n_tokens"), tidying_edits(F.col("text")).alias("edits"))
    after = token_counts.apply_edits(before, vocabulary)
    return after.select("doc_id", "n_tokens", total.alias("n_tokens_edited"), "encoded_chars", F.length("text").alias("n_chars_edited"))


@query()
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query(
    """
    with recursive docs as (
        select doc_id, source, text, row_number() over () as id,
               concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head,
               replace(text, chr(10), '') as joined,
               list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                               lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) & 1 as odd
        from documents),
    hashed as (
        select id, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
               case when odd = 1 then sha256(head || coalesce(strlen(joined) || ':' || joined, '-')) end as tampered
        from docs),
    leaves as (
        select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank,
               count(*) over (partition by source) as n
        from hashed),
    nodes(source, height, pos, n, digest) as (
        select source, 0, rank, n, leaf from leaves
        union all
        select source, height + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
        from nodes where n > 1 group by source, height, pos // 3, n),
    subroots as (
        select source, digest as subroot, row_number() over (order by source nulls first) - 1 as tree, count(*) over () as trees
        from nodes where n = 1),
    tops(height, pos, n, digest) as (
        select 0, tree, trees, subroot from subroots
        union all
        select height + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
        from tops where n > 1 group by height, pos // 3, n),
    turns as (
        select l.id, h.height as level, h.height, l.source, null::bigint as tree, l.rank // cast(pow(3, h.height) as bigint) as pos
        from leaves l join (select distinct source, height from nodes where n > 1) h on l.source is not distinct from h.source
        union all
        select l.id, 1000 + h.height, h.height, null, s.tree, s.tree // cast(pow(3, h.height) as bigint)
        from leaves l join subroots s on l.source is not distinct from s.source
        cross join (select distinct height from tops where n > 1) h),
    met as (
        select t.id, t.level, t.pos, x.pos as other, x.digest
        from turns t join nodes x on t.tree is null and x.source is not distinct from t.source and x.height = t.height and x.pos // 3 = t.pos // 3
        union all
        select t.id, t.level, t.pos, x.pos, x.digest
        from turns t join tops x on t.tree is not null and x.height = t.height and x.pos // 3 = t.pos // 3),
    segments as (
        select id, level, coalesce(string_agg(digest, '' order by other) filter (other < pos), '') as before,
               coalesce(string_agg(digest, '' order by other) filter (other > pos), '') as after
        from met group by id, level),
    paths as (
        select id, string_agg(before || after, '' order by level) as proof,
               list({'b': before, 'd': '', 'a': after} order by level) as path
        from segments group by id),
    whole as (select digest as root from tops where n = 1),
    folded as (
        select l.doc_id, l.leaf, s.subroot, w.root, sha256(coalesce(p.proof, '')) as proof_sha256,
               list_reduce(list_prepend({'b': '', 'd': coalesce(l.tampered, l.leaf), 'a': ''}, coalesce(p.path, [])),
                           lambda x, y: {'b': '', 'd': sha256(y.b || x.d || y.a), 'a': ''}).d as folded_root
        from leaves l join subroots s on l.source is not distinct from s.source cross join whole w left join paths p on p.id = l.id)
    select *, folded_root = root as verified from folded
    """
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the manifest is of the documents as they are; of half of them a text without line feeds is shown later
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    joined = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, joined).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", merkle.leaf_digest(*head, F.col("text")).alias("leaf"), merkle.leaf_digest(*head, shown).alias("shown")
    )
    proven = merkle.proofs(merkle.build(rows, "source", "doc_id", "leaf"))
    found = proven.select(
        "row.doc_id",
        *[merkle.text_of(F.col(c)).alias(c.split(".")[-1]) for c in ("row.leaf", "subroot", "root")],
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        merkle.folded(F.col("row.shown"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@query(
    """
    with recursive sound as (
        select vec_id, label, len(embedding) as length, list_transform(embedding, lambda x: x::double) as v from embeddings
        where vec_id is not null and label is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    scaled as (select *, list_max(list_transform(v, lambda x: abs(x))) as widest from sound),
    measured as (
        select *, list_transform(v, lambda x: x / widest) as w, sqrt(list_sum(list_transform(v, lambda x: (x / widest) * (x / widest)))) as size
        from scaled),
    links as (
        select a.vec_id as u, b.vec_id as v from measured a join measured b on a.label = b.label and a.length = b.length and a.vec_id <> b.vec_id
        where list_dot_product(a.w, b.w) / (a.size * b.size) >= 0.98),
    reached as (select u, v from links union select r.u, l.v from reached r join links l on r.v = l.u),
    counted as (select u, count(*) as n from links group by u),
    least as (select u, min(v) as v from reached group by u)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, v) as component_id, coalesce(least(vec_id, v) = vec_id, false) as kept
    from embeddings left join counted on counted.u = vec_id left join least on least.u = vec_id
    """
)
def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


def alignment_tokenizers() -> alignment.Tokenizers:
    path = public_tokenizers.path
    return alignment.Tokenizers.read(path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = alignment.align_tokens(table(spark, sf_dir, "documents"), alignment_tokenizers())
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
