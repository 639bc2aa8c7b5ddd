"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, fim, langid, lm, merkle, pieces, secrets, simhash, suffix_dedup, topk, toxicity, url_filter
from tidemark.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


SECRETS_SQL = r"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
cut as (
  select doc_id, 0 as place, 'assign' as kind, 6 as least,
         regexp_extract_all(text, '{assign}', 0) as hits, regexp_extract_all(text, '{assign}', 2) as tails,
         regexp_split_to_array(text, '{assign}') as gaps from texts
  union all
  select doc_id, 1, 'access', 20, regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0),
         regexp_split_to_array(text, 'AKIA[A-Z0-9]+') from texts
  union all
  select doc_id, 2, 'hex', 24, regexp_extract_all(text, '[0-9a-f]+', 0), regexp_extract_all(text, '[0-9a-f]+', 0),
         regexp_split_to_array(text, '[0-9a-f]+') from texts
  union all
  select doc_id, 3, 'pem', 0, regexp_extract_all(text, '{pem}', 0), regexp_extract_all(text, '{pem}', 0),
         regexp_split_to_array(text, '{pem}') from texts),
each_hit as (
  select doc_id, place, kind, least, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit, unnest(tails) as tail, unnest(gaps[1:len(hits)]) as gap
  from cut where len(hits) > 0),
placed as (
  select *, sum(length(gap) + length(hit)) over (partition by doc_id, place order by i) as stop from each_hit),
spans as (
  select doc_id, place, kind, cast(stop - length(hit) as bigint) as start, kind || ':' || cast(stop - length(hit) as bigint) || ':' || cast(stop as bigint) as span
  from placed where length(tail) >= least),
gathered as (
  select doc_id, count(*) filter (where place = 0) as n_assign, count(*) filter (where place = 1) as n_access,
         count(*) filter (where place = 2) as n_hex,
         coalesce(string_agg(span, ',' order by start, place) filter (where place < 3), '') as base,
         string_agg(span, ',' order by start, place) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join gathered using (doc_id)
""".format(assign=secrets.ASSIGN.replace("'", "''"), pem=secrets.RULES[-1].pattern)


@query("op4_secrets", SECRETS_SQL)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger.create(spark)
    ledger.ingest(docs)
    found = secrets.report(docs, ledger)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op6_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score_documents(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op9_decontamination")
def benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_suffix_dedup")
def suffix_dedup_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), length=400)
    size = F.octet_length("text").cast("long")
    removed = size - F.octet_length("kept")
    return found.select("doc_id", size.alias("n_bytes"), removed.alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


TOP_K_SQL = """
with q as (
  select vec_id, [floor(256 * cast(x as double)) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         cast(list_dot_product(a.v, b.v) as bigint) as score
  from q a join q b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
select query_id, cast(place as int) as rank, vec_id, score from ranked where place <= 5
"""


@query("op5_top_k", TOP_K_SQL)
def top_k_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


URL_SQL = r"""
with parsed as (
  select page_id, date '2024-01-01' + cast(page_id * 7919 % 730 as int) as day,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.+$', ''), '') as host,
         regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/+', '/', 'g'), '^/|/$', '', 'g') as path
  from pages),
hosts as (select distinct host from parsed where host is not null),
seeds as (
  select host, cast('0x' || substr(md5(host), 1, 4) as int) as a, cast('0x' || substr(md5(host), 5, 4) as int) as b from hosts
  union all
  select distinct host || '/' || split_part(path, '/', 1), cast('0x' || substr(md5(host || '/' || split_part(path, '/', 1)), 1, 4) as int),
         cast('0x' || substr(md5(host || '/' || split_part(path, '/', 1)), 5, 4) as int) from parsed where host is not null and path <> ''),
spans as (
  select host as value, ['spam', 'adult', 'malware'][1 + a % 3] as list, b % 4 = 0 as allow,
         date '2024-01-01' + a % 600 as valid_from,
         case when b % 3 = 0 then date '9999-12-31' else date '2024-01-01' + a % 600 + 1 + b % 200 end as valid_to
  from seeds where a % 2 = 0 or host like '%/%'),
labels as (select page_id, day, host, path, string_split(host, '.') as l, string_split(path, '/') as p from parsed),
wanted as (
  select page_id, day, array_to_string(l[unnest(range(1, len(l) + 1)):], '.') as value from labels where host is not null
  union
  select page_id, day, host || '/' || array_to_string(p[1:unnest(range(1, len(p) + 1))], '/') from labels where host is not null and path <> ''),
hits as (
  select page_id, w.value, list, allow, length(w.value) as size,
         max(case when allow then length(w.value) end) over (partition by page_id) as allowed
  from wanted w join spans s on w.value = s.value and day >= valid_from and day < valid_to),
kept as (select * from hits where not allow and size > coalesce(allowed, -1)),
judged as (
  select page_id, string_agg(distinct list, ',' order by list) as lists, first(value order by size desc, value) as value from kept group by page_id)
select page_id, value is not null as blocked, coalesce(lists, '') as lists, value from pages left join judged using (page_id)
"""


@query("op3_url_filter", URL_SQL)
def url_filter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day that follows from the id. The list holds
    every other host and every first path part under a host, added and mostly removed
    again on days that follow from its hash; a quarter of it allows."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    start = F.to_date(F.lit("2024-01-01"))
    captures = pages.withColumn("fetched", F.date_add(start, (F.col("page_id") * 7919 % 730).cast("int")))
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    part = F.when(F.length(path) > 0, F.concat_ws("/", host, F.substring_index(path, "/", 1)))
    seeds = pages.select(F.explode(F.array(host, part)).alias("value")).where("value is not null").distinct()
    number = lambda at: F.conv(F.substring(F.md5("value"), at, 4), 16, 10).cast("int")
    seeds = seeds.select("value", number(1).alias("a"), number(5).alias("b")).where("a % 2 = 0 or contains(value, '/')")
    events = F.array(
        F.struct(F.lit(0).alias("after"), F.lit(True).alias("added")), F.struct((1 + F.col("b") % 200).alias("after"), F.lit(False).alias("added"))
    )
    some = F.when(F.col("b") % 3 == 0, F.slice(events, 1, 1)).otherwise(events)
    entries = seeds.select(
        "value",
        F.element_at(F.array(F.lit("spam"), F.lit("adult"), F.lit("malware")), 1 + F.col("a") % 3).alias("list"),
        (F.col("b") % 4 == 0).alias("allow"),
        F.col("a"),
        F.explode(some).alias("event"),
    ).select("value", "list", "allow", F.date_add(start, F.col("a") % 600 + F.col("event.after")).alias("day"), "event.added")
    return url_filter.judge(captures, entries)


LM_SQL = """
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
split as (select doc_id, [w for w in regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+') if w <> ''] as w from texts),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as c from split),
grams as (
  select doc_id, i, c, lag(c, 1) over (partition by doc_id order by i) as b, lag(c, 2) over (partition by doc_id order by i) as a from words),
one as (select c, count(*) as n from grams group by c),
two as (select b, c, count(*) as n from grams where b is not null group by b, c),
three as (select a, b, c, count(*) as n from grams where a is not null group by a, b, c),
scored as (
  select g.doc_id, case
      when g.a is not null and three.n >= 2 then ln(three.n / ab.n)
      when g.b is not null and two.n >= 2 then case when g.a is null then 0 else ln(0.4) end + ln(two.n / b1.n)
      else case when g.a is not null then 2 * ln(0.4) when g.b is not null then ln(0.4) else 0 end + ln(one.n / (select count(*) from grams))
    end as s
  from grams g join one on g.c = one.c
  left join two on g.b = two.b and g.c = two.c left join three on g.a = three.a and g.b = three.b and g.c = three.c
  left join two ab on g.a = ab.b and g.b = ab.c left join one b1 on g.b = b1.c),
summed as (select doc_id, count(*) as n_words, avg(s) as score from scored group by doc_id)
select doc_id, coalesce(n_words, 0) as n_words, round(score, 6) as score from documents left join summed using (doc_id)
"""


@query("op10_lm_score", LM_SQL)
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.scores(table(spark, sf_dir, "documents"), order=3, alpha=0.4, least=2)
    return found.withColumn("score", F.round("score", 6))


FIM_SQL = r"""
with texts as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
units as (
  select doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from texts),
cut as (
  select doc_id, text, u, cast(len(u) as bigint) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form from units),
parts as (
  select doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') as p, coalesce(array_to_string(u[a + 1:b], ''), '') as m,
         coalesce(array_to_string(u[b + 1:], ''), '') as s from cut)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


@query("op11_fill_in_middle", FIM_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, suffix_first=80)
    restored = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    )


@query("op12_sentence_pieces")
def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path, packed="packed")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


# CRC-32 of the decimal doc_id, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(list_concat([cast(4294967295 as bigint)],
  list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ascii(d) as bigint))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

MERKLE_SQL = """
with recursive leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as size,
         row_number() over () as id
  from (
    select doc_id, lang,
           sha256({doc_id} || {source} || {lang} || {n_chars} || {text}) as leaf,
           sha256({doc_id} || {source} || {lang} || {claimed} || {text}) as claim
    from documents)),
nodes as (
  select lang, 0 as level, pos, leaf as digest, size from leaves
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(size) + 1) // 2 from nodes where size > 1 group by lang, level, pos // 2),
subroots as (
  select lang, digest, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as size from nodes where size = 1),
upper as (
  select 0 as level, pos, digest, size from subroots
  union all
  select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(size) + 1) // 2 from upper where size > 1 group by level, pos // 2),
steps as (
  select l.id, l.pos >> n.level as at, n.level as step, s.digest as other
  from leaves l join (select distinct lang, level from nodes where size > 1) n on l.lang is not distinct from n.lang
  left join nodes s on s.lang is not distinct from l.lang and s.level = n.level and s.pos = xor(l.pos >> n.level, 1)
  union all
  select l.id, r.pos >> n.level, 1000 + n.level, s.digest
  from leaves l join subroots r on l.lang is not distinct from r.lang cross join (select distinct level from upper where size > 1) n
  left join upper s on s.level = n.level and s.pos = xor(r.pos >> n.level, 1)),
numbered as (select *, row_number() over (partition by id order by step) as k from steps),
proofs as (select id, coalesce(string_agg(other, '' order by k), '') as proof from numbered group by id),
folded as (
  select id, 0 as k, claim as digest from leaves
  union all
  select f.id, f.k + 1, sha256(case when n.other is null then f.digest when n.at % 2 = 1 then n.other || f.digest else f.digest || n.other end)
  from folded f join numbered n on n.id = f.id and n.k = f.k + 1),
ends as (select id, arg_max(digest, k) as folded_root from folded group by id),
top as (select digest as root from upper where size = 1)
select l.doc_id, l.leaf, r.digest as subroot, top.root, sha256(coalesce(p.proof, '')) as proof_sha256, e.folded_root, e.folded_root = top.root as verified
from leaves l join subroots r on l.lang is not distinct from r.lang cross join top join ends e on e.id = l.id left join proofs p on p.id = l.id
""".format(
    **{
        name: f"coalesce(octet_length(encode(cast({value} as varchar))) || ':' || cast({value} as varchar), '-')"
        for name, value in {
            **{c: c for c in ("doc_id", "source", "lang", "n_chars", "text")},
            "claimed": f"(n_chars + case when {CRC32_SQL} % 7 = 0 then 1 else 0 end)",
        }.items()
    }
)


@query("op13_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    claimed = {"n_chars": F.col("n_chars") + F.when(tampered, 1).otherwise(0)}
    made = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], group="lang", key="doc_id", claimed=claimed)
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")
