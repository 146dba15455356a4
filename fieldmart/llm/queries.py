"""The queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.llm import bpe, embedding_dedup, exact_dedup, jaccard_join, mixing, pii, prefix_trie, quality, spelling, suffix_dedup, token_count, toxicity, warc
from fieldmart.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_pii")
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest_columns(pii.pii_spans(table(spark, folder, "documents")))


@query("op2_exact_dedup", """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
           from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256, octet_length(encode(body)) as n_bytes
from t window same as (partition by body)""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, folder, "documents"), bpe.default_vocabulary()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_token_count")
def op8_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"), bpe.default_vocabulary())


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.grade_documents(docs, quality.train(docs, table(spark, folder, "labels")))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op4_warc", """
with p as (select page_id, coalesce(html, '') as payload from pages),
q as (select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as digest,
             max(page_id) over (partition by payload) as newest from p)
select page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || digest[5 * i + 1 : 5 * i + 5])::int >> (15 - 5 * j)) & 31)::int + 1]),
           'string_agg', '')), 'string_agg', '') as payload_digest,
       case when page_id = newest then 'response' else 'revisit' end as record_type,
       case when page_id <> newest then newest end as refers_to
from q""")
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, folder, "pages"), archive)
    return warc.read_records(index, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"), words=3, percent=90)


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, folder, "labels")))


@query("op13_spelling", r"""
with recursive crc_table as materialized (
  select list(v order by i) as crcs
  from (select i, list_reduce(list_concat([i], range(8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
        from range(256) r(i))),
runs as (
  select coalesce(cast(doc_id as varchar), '') as id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
  from documents),
doc_runs as (select id, w, count(*) as n, hex(encode(id || ':' || w)) as x from runs where length(w) >= 7 group by id, w),
hashed as materialized (
  select w, n, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint))),
           lambda a, b: xor(crcs[(xor(a, b) & 255) + 1], a >> 8))) as h
  from doc_runs, crc_table),
words as materialized (
  select word, sum(n)::bigint as n
  from (select n, case when h % 31 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word from hashed)
  where length(word) >= 7 group by word having sum(n) >= 2),
gaps as materialized (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as gap
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as materialized (
  select a.word as word, b.word as near from gaps a join gaps b on a.gap = b.gap and a.i = b.i and a.word <> b.word
  union select g.word, w.word from gaps g join words w on g.gap = w.word
  union select w.word, g.word from gaps g join words w on g.gap = w.word),
best as (
  select e.word, count(*) as n_near, arg_max(e.near, (v.n, -rank)) as form, max(v.n) as form_n
  from near e join (select *, row_number() over (order by word) as rank from words) v on v.word = e.near group by e.word),
formed as materialized (
  select w.word, case when form_n >= 10 * w.n then form end as form, w.n, coalesce(n_near, 0) as n_near,
         case when form_n >= 10 * w.n then form_n end as form_n
  from words w left join best b on b.word = w.word),
chain as (
  select word, word as tip, 0 as step from formed
  union all select c.word, f.form, step + 1 from chain c join formed f on f.word = c.tip where f.form is not null)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n
from formed f join (select word, arg_max(tip, step) as root from chain group by word) c on c.word = f.word""")
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(table(spark, folder, "documents"))


@query("op11_prefix_trie", """
with crc_table as (
  select list(v order by i) as crcs
  from (select i, list_reduce(list_concat([i], range(8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
        from range(256) r(i))),
turns as (
  select conv_id, {'r': coalesce(role, ''), 'x': coalesce(text, '')} as m,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null),
whole as (select conv_id, list(m order by p) as own from turns group by conv_id),
hashed as (
  select conv_id, own, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
           lambda a, b: xor(crcs[(xor(a, b) & 255) + 1], a >> 8))) % 9 as h
  from whole, crc_table),
rebuilt as (
  select c.conv_id, list_concat(coalesce(f.own, [])[1:c.h], c.own[c.h + 1:]) as seq
  from hashed c left join whole f on f.conv_id = c.conv_id - c.conv_id % 5),
starts as (select conv_id, d, seq[1:d] as k, len(seq) = d as over from (select conv_id, seq, unnest(range(0, len(seq) + 1)) as d from rebuilt)),
nodes as (
  select d, k, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (over), '')) as ends_sha256,
         case when d = 0 then 0 else (count(*) - 1) * octet_length(encode(k[d].x)) end as saved
  from starts group by d, k),
children as (select d - 1 as d, k[1:d - 1] as k, count(*) as n from nodes where d > 0 group by 1, 2),
grown as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.d = n.d and c.k = n.k),
sums as (
  select a as d, k[1:a] as k, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
  from (select k, n_children, saved, unnest(range(0, d + 1)) as a from grown) group by 1, 2)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from grown n join sums s on s.d = n.d and s.k = n.k left join nodes p on p.d = n.d - 1 and p.k = n.k[1:n.d - 1]""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(table(spark, folder, "conversations")))
