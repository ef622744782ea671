"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import (bpe, decontaminate, exact_dedup, html_extract, importance, prefix_trie, quality, sharding, simhash, substring_dedup,
                          token_counts, url_filters, warc)
from lakeward.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ENCODER = public_tokenizers.path("byte_bpe_50k.json")
COUNTER = public_tokenizers.path("word_bpe_49k.json")


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


@register("op1_bpe")
def op1(spark, sf):
    return bpe.with_digests(bpe.encode_documents(table(spark, sf, "documents"), ENCODER))


@register("op2_token_counts")
def op2(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), COUNTER)


@register("op5_decontamination")
def op5(spark, sf):
    return decontaminate.benchmark_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op6_quality")
def op6(spark, sf):
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op7_exact_dedup", r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
g as (
  select text_sha256, arg_min(doc_id, (-chars, doc_id)) as keep_id, count(*) as group_size
  from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from t join g using (text_sha256)""")
def op7(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


@register("op10_simhash")
def op10(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@register("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


# ---------------------------------------------------------------- archives and lists

OP4_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
w as (select html, max(page_id) as winner from p group by html),
-- DuckDB has no base 32: five bits at a time over the 40 hex digits of the digest.
d as (select page_id, octet_length(encode(html)) as payload_bytes, winner,
             list_aggregate(list_transform(string_split_regex(sha1(html), ''), lambda x: lpad(bin(('0x' || x)::int), 4, '0')), 'string_agg', '') as bits
      from p join w using (html))
select page_id, payload_bytes::bigint as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (('0b' || substr(bits, (5 * i + 1)::int, 5))::int) + 1, 1)), 'string_agg', '') as payload_digest,
       case when page_id = winner then 'response' else 'revisit' end as record_type,
       case when page_id = winner then null else winner end as refers_to
from d"""


@register("op4_warc", OP4_SQL)
def op4(spark, sf):
    return warc.archived(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def captures_of(pages: DataFrame) -> DataFrame:
    """(id, url, at): pages with a fetch day in 2024 that follows from their id."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")
    return pages.select(F.col("page_id").alias("id"), "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """(list, kind, pattern, at, action): three dated lists over the domains of the
    pages; which domain stands on which list, and when, follows from its MD5."""
    host = url_filters.host_of(F.col("url"))
    tail = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domains = pages.select(F.when(tail == "", host).otherwise(tail).alias("domain")).where("domain != ''").distinct()
    drawn = domains.select("domain", F.explode(F.array(*map(F.lit, range(3)))).alias("i")).withColumn(
        "h", F.md5(F.concat_ws(":", "domain", "i"))).where("substr(h, 5, 1) < '8'")
    added = F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % 400
    gone = added + 20 + F.conv(F.substring("h", 6, 2), 16, 10).cast("int") % 180
    start = F.lit("2023-10-01").cast("date")
    changes = F.array(F.struct(F.date_add(start, added).alias("at"), F.lit("add").alias("action")),
                      F.when(F.substring("h", 8, 1) < "c", F.struct(F.date_add(start, gone).alias("at"), F.lit("remove").alias("action"))))
    return drawn.select(
        F.concat(F.lit("list"), "i").alias("list"), F.when(F.col("i") < 2, "domain").otherwise("prefix").alias("kind"),
        F.when(F.col("i") < 2, F.col("domain")).otherwise(F.concat("domain", F.lit("/en"))).alias("pattern"),
        F.inline(F.filter(changes, lambda x: x.isNotNull())))


OP8_SQL = r"""
with c as (
  select page_id, url, date '2024-01-01' + ((page_id * 7919) % 365)::int as day,
         lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')) as host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') as parts
  from pages),
dom as (
  select distinct case when regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) = '' then host
                       else regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) end as domain
  from c where host <> ''),
drawn as (
  select domain, i, md5(domain || ':' || i) as h from dom, range(3) t(i)),
span as (
  select 'list' || i as list, case when i < 2 then 'domain' else 'prefix' end as kind,
         case when i < 2 then domain else domain || '/en' end as pattern,
         date '2023-10-01' + (('0x' || substr(h, 1, 4))::int % 400) as since,
         case when substr(h, 8, 1) < 'c' then
           date '2023-10-01' + (('0x' || substr(h, 1, 4))::int % 400) + 20 + (('0x' || substr(h, 6, 2))::int % 180) end as until
  from drawn where substr(h, 5, 1) < '8'),
asked as (
  select page_id, url, day, unnest(list_distinct(list_transform(range(1, len(string_split(host, '.')) + 1),
           lambda i: 'domain ' || array_to_string(string_split(host, '.')[i:], '.'))
         || list_transform(range(0, len(parts) + 1),
           lambda i: 'prefix ' || lower(host || '/' || array_to_string(parts[1:i], '/'))))) as ask
  from c where host <> ''),
hit as (
  select a.page_id, count(*) as n_entries, string_agg(distinct s.list, ',' order by s.list) as lists
  from asked a join span s on a.ask = s.kind || ' ' || s.pattern and s.since <= a.day and (s.until is null or a.day < s.until)
  group by a.page_id)
select c.page_id, c.url, c.day as fetched_on, h.page_id is not null as blocked,
       coalesce(h.n_entries, 0)::bigint as n_entries, coalesce(h.lists, '') as lists
from c left join hit h using (page_id)"""


@register("op8_url_filters", OP8_SQL)
def op8(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    rows = url_filters.url_filter(captures_of(pages), entries_of(pages))
    return rows.select(F.col("id").alias("page_id"), "url", F.col("at").alias("fetched_on"), "blocked", "n_entries", "lists")


@register("op9_substring_dedup")
def op9(spark, sf):
    return substring_dedup.repeated_spans(table(spark, sf, "documents"))


@register("op3_html_extraction")
def op3(spark, sf):
    texts = html_extract.main_texts(table(spark, sf, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


# ---------------------------------------------------------------- sampling, conversations, shards

#: CRC-32 byte by byte: the table of a byte's contributions, and the walk over a text's hex digits.
CRC_TABLE = """
crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i)))"""


def crc_sql(hex_text: str) -> str:
    """CRC-32 of the bytes written in hex, with crc_table in scope."""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length({hex_text}), 2),
             lambda i: ('0x' || substr({hex_text}, i, 2))::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


OP11_SQL = f"""
with {CRC_TABLE},
texts as (
  select 0 as side, row_number() over () as row, doc_id, text from documents
  union all select 1, row_number() over (), null, text from benchmark),
words as (
  select side, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
feats as (
  select side, row, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as f
  from words, range(1, 4) r(n)),
hexed as (select f, hex(encode(f)) as h from (select distinct f from feats)),
hashed as (select f, {crc_sql('h')} % 10000 as bucket from hexed, crc_table),
counted as (
  select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from feats join hashed using (f) group by bucket),
total as (select sum(s)::double as s, sum(t)::double as t from counted),
gains as (
  select bucket, floor(1000.0::double * ln((c.t + 1)::double * (total.s + 10000) / ((c.s + 1)::double * (total.t + 10000))))::bigint as gain
  from counted c, total),
weights as (
  select row, count(*) as n_features, sum(gain) as weight from feats join hashed using (f) join gains using (bucket) where side = 0 group by row),
scored as (
  select x.doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight, len(w.w) as n_words,
         coalesce(weight, 0)::bigint + floor(-1000.0::double * ln(-ln((('0x' || substr(sha256('42:' || x.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score
  from texts x join words w using (side, row) left join weights using (row) where side = 0),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place, count(*) over (partition by n_words >= 20) as n from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= n * 5 // 100 then place end as rank from ranked"""


@register("op11_importance", OP11_SQL)
def op11(spark, sf):
    return importance.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = f"""
with {CRC_TABLE},
own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
ids as (select conv_id, hex(encode(conv_id::varchar)) as hx from (select distinct conv_id from own)),
kept as (select conv_id, {crc_sql('hx')} % 9 as h from ids, crc_table),
raw as (
  select k.conv_id, 0 as part, o.pos, o.role, o.text from kept k join own o on o.conv_id = k.conv_id - k.conv_id % 5 and o.pos <= k.h
  union all
  select k.conv_id, 1, o.pos, o.role, o.text from kept k join own o on o.conv_id = k.conv_id and o.pos > k.h),
turns as (
  select conv_id, row_number() over w as depth, octet_length(encode(text)) as n_bytes,
         string_agg(sha256(octet_length(encode(role)) || ':' || role || text), '') over w as path
  from raw window w as (partition by conv_id order by part, pos rows between unbounded preceding and current row)),
members as (
  select conv_id, depth, n_bytes, path from turns union all select conv_id, 0, 0, '' from kept),
lens as (select conv_id, max(depth) as len from members group by conv_id),
nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, max(n_bytes) as n_bytes,
         sha256(coalesce(string_agg(case when depth = len then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256
  from members join lens using (conv_id) group by path, depth),
child as (
  select p.path, count(c.path) as n_children from nodes p left join nodes c on c.depth = p.depth + 1 and substr(c.path, 1, 64 * p.depth) = p.path group by p.path),
up as (
  select substr(n.path, 1, 64 * d) as path, (n_convs - 1) * n_bytes as saved, (n_children = 0)::int as leaf
  from nodes n join child using (path), lateral (select unnest(range(0, n.depth + 1)) as d)),
sums as (select path, sum(saved) as saved_tokens, sum(leaf) as n_leaves from up group by path)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n_children, n_leaves::bigint as n_leaves,
       saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join child using (path) join sums using (path)
left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.path = substr(n.path, 1, 64 * (n.depth - 1))"""


@register("op12_prefix_trie", OP12_SQL)
def op12(spark, sf):
    return prefix_trie.trie(table(spark, sf, "conversations"))


#: 24 shards: two regions of three racks of four.
CLUSTER = sharding.Tree.regular(2, 3, 4)

OP13_SQL = f"""
with {CRC_TABLE},
rows as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 8 as size, hex(encode(coalesce(text, ''))) as h from documents),
crcs as (select doc_id, size::bigint as size, case when h = '' then 0 else {crc_sql('h')} end as text_crc32 from rows, crc_table),
-- One more shard is a region of its own.
shards as (select i as shard, case when i < 24 then i // 4 else 6 end as rack, case when i < 24 then i // 12 else 2 end as region from range(25) r(i)),
trees as (select 0 as grown, * from shards where shard < 24 union all select 1, * from shards),
draws as (
  select doc_id, grown, shard, rack, region,
    ln((('0x' || substr(sha256('region' || region || ':' || doc_id), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
      / count(*) over (partition by doc_id, grown, region) as region_draw,
    ln((('0x' || substr(sha256('rack' || rack || ':' || doc_id), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
      / count(*) over (partition by doc_id, grown, rack) as rack_draw,
    ln((('0x' || substr(sha256('shard' || shard || ':' || doc_id), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double) as shard_draw
  from (select distinct doc_id from rows), trees),
won as (
  select doc_id, grown, arg_max(shard, (region_draw, region, rack_draw, rack, shard_draw, shard)) as shard from draws group by doc_id, grown)
select c.doc_id, c.size, c.text_crc32, 'key' as law, a.shard::int as shard,
       row_number() over (partition by a.shard order by c.doc_id, c.text_crc32, c.size) - 1 as slot, b.shard::int as grown_shard
from crcs c join won a on a.doc_id = c.doc_id and a.grown = 0 join won b on b.doc_id = c.doc_id and b.grown = 1"""


@register("op13_sharding", OP13_SQL)
def op13(spark, sf):
    return sharding.sharded(table(spark, sf, "documents"), CLUSTER).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
