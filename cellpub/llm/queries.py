"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.sources.shared import shared_folder
from cellpub.llm.exact_dedup import exact_groups
from cellpub.llm.hard_negatives import hard_negatives
from cellpub.llm.html_text import extracted
from cellpub.llm.language_id import languages
from cellpub.llm.mixing import mixed_documents
from cellpub.llm.near_dedup import near_groups
from cellpub.llm.packing import packed
from cellpub.llm.prefix_trie import rebuilt, trie
from cellpub.llm.quality_classifier import quality
from cellpub.llm.quality_rules import quality_verdicts
from cellpub.llm.token_store import read_digests, write_store
from cellpub.llm.toxicity import toxicity
from cellpub.llm.warc import crawl_of, header_lines, resolved


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_docs(spark, sf_dir), shingle=4).drop("content_key", "class_id", "one")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_docs(spark, sf_dir)).drop("content_key")


def _remainder(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def _with_verdict(scores: DataFrame, held_out: Column, least: float) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_docs(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_docs(spark, sf_dir))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _with_verdict(quality(_docs(spark, sf_dir), labels, _remainder(5) != 0), _remainder(5) == 0, 0.3)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    write_store(_docs(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_digests(spark, path)


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolved(crawl_of(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return found.withColumn("headers", header_lines(F.col("headers")))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(_docs(spark, sf_dir)).drop("content_key", "source")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _with_verdict(toxicity(_docs(spark, sf_dir), labels, _remainder(3) != 1), _remainder(3) == 1, 0.7)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    borrowed = (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int")
    return trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"), conv - conv % 100, borrowed))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages(_docs(spark, sf_dir), _remainder(3) != 1)
    return found.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", label, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_near_dedup": op3_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_store": op6_token_store,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_html_text": op8_html_text,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_language_id": op12_language_id,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op2_quality_rules": r"""
with w as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         row_number() over () as row
  from documents),
grams as (
  select row, i, array_to_string(words[i : i + 7], ' ') as gram
  from (select row, words, unnest(range(1, len(words) - 6)) as i from w)),
repeated as (select row, i from grams qualify count(*) over (partition by row, gram) > 1),
covered as (select row, count(distinct i + k) as n from repeated, range(8) t(k) group by row),
lines as (
  select row, count(*) - count(distinct line) as n
  from (select row, unnest(string_split(text, chr(10))) as line from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by row),
m as (
  select doc_id, source, len(words) as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(lines.n, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words
  from w left join covered using (row) left join lines using (row)),
f as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         100 * n_symbols > 10 * word_chars as symbols_failed, 100 * n_dup_lines > 5 * n_words as lines_failed
  from m),
g as (select *, cast(base_failed as int) + cast(symbols_failed as int) + cast(lines_failed as int) as n_failed from f),
h as (select source, count(*) as n, count(*) filter (n_failed > 0) as x from g group by source),
s as (
  select sum(n) as docs, sum(x) as failing, avg(x / n) as mean, coalesce(var_samp(x / n), 0) as var, avg(1 / n) as inverse from h),
p as (
  select *, case when mean > 0 and mean < 1 then mean else (failing + 0.5) / (docs + 1.0) end as m0 from s),
q as (
  select *, m0 * (1 - m0) as spread, case when inverse < 1 then (var - m0 * (1 - m0) * inverse) / (1 - inverse) else 0 end as true_var from p),
r as (
  select *, greatest(case when true_var > spread / (docs + 1.0) then spread / true_var - 1 else docs end, 1e-3) as strength from q),
v as (select source, (x + m0 * strength) / (n + strength) as rate from h, r)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and rate < 0.5 and n_failed < (case when rate >= 0.02 then 1 else 2 end) as kept,
       symbols_failed, lines_failed, rate >= 0.5 as host_rejected
from g join v on g.source is not distinct from v.source""",
    "op3_near_dedup": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
    else [array_to_string(words[i : i + 3], ' ') for i in range(1, len(words) - 2)] end) as shingle
  from w where words is not null),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (shingle) where a.doc_id <> b.doc_id group by all),
links as (
  select x, y from common join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
reach(x, y) as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
least as (select x, min(y) as y from reach group by x)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(d.doc_id, coalesce(least.y, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(least.y, d.doc_id)) as kept
from documents d left join n using (doc_id) left join least on d.doc_id = least.x""",
    "op4_exact_dedup": r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
g as (
  select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
         row_number() over w = 1 as kept, sha256(norm) as text_sha256
  from t window w as (partition by norm order by n desc, doc_id))
select doc_id, keep_id, cast(group_size as bigint) as group_size, kept, text_sha256 from g""",
    "op7_warc_revisits": r"""
with p as (
  select page_id, coalesce(html, '') as html,
         regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://', '') as bare
  from pages),
k as (
  select page_id, '"' || md5(html) || '"' as tag, sha256(html) as digest, 'day ' || (page_id // 1440) as modified,
         regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www[0-9]*\.', '')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as place,
         list_sort([x for x in string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&')
           if x <> '' and not regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid)(=|$)')]) as parts
  from p),
u as (select *, place || case when len(parts) > 0 then '?' || array_to_string(parts, '&') else '' end as url_key from k),
a as (select url_key, page_id * 3 as id, page_id * 60 as date, tag, modified, digest from u),
r as (
  select url_key, page_id * 3 + 1 as record_id, page_id * 60 + 604800 as date,
         case when page_id % 11 = 0 or page_id % 7 = 0 then null else tag end as tag,
         case when page_id % 11 <> 0 and page_id % 7 = 0 then modified end as modified, 1 as k from u
  union all
  select url_key, page_id * 3 + 2, page_id * 60 + 1209600, case when page_id % 5 = 0 then '"other"' else tag end, null, 2 from u),
j as (
  select r.*, x.id, x.date as response_date, x.tag as its_tag, x.modified as its_modified, x.digest
  from r left join lateral (select * from a where a.url_key = r.url_key and a.date < r.date order by a.date desc, a.id desc limit 1) x on true),
v as (
  select *, case when id is null then 'no response' when coalesce(tag = its_tag, modified = its_modified) is null then 'unchecked'
                 when coalesce(tag = its_tag, modified = its_modified) then 'resolved' else 'changed' end as verdict
  from j),
h as (
  select *, verdict = 'resolved' as ok, k = 1 and tag is not null as tagged from v)
select cast(record_id as bigint) as record_id, url_key, cast(date as bigint) as date, verdict, cast(id as bigint) as response_id,
       cast(response_date as bigint) as response_date, case when ok then 200 else 304 end as status, case when ok then digest end as payload_digest,
       array_to_string([x for x in [
         case when tagged then 'cache-control: max-age=120' when ok then 'cache-control: max-age=60' end,
         case when tagged and not ok then 'content-length: 0' end,
         case when ok then 'content-type: text/html' end,
         case when k = 2 then 'date: second' when tag is null then 'date: first' end,
         case when tagged then 'etag: W/' || tag when k = 2 then 'etag: ' || tag when ok then 'etag: ' || its_tag end,
         case when modified is not null then 'last-modified: ' || modified when ok then 'last-modified: ' || its_modified end]
         if x is not null], chr(10)) as headers
from h""",
    "op11_prefix_trie": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
o as (
  select conv_id, md5(length(role) || ':' || role || text) as id, length(text) as chars,
         row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as i
  from t),
c as (
  select conv_id, conv_id - conv_id % 100 as head,
         xor(list_reduce(list_concat([4294967295::ubigint], [ascii(x)::ubigint for x in string_split(cast(conv_id as varchar), '')]),
           lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
             lambda x, k: case when (x & 1) = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)), 4294967295::ubigint) % 6 as h
  from (select distinct conv_id from o)),
r as (
  select c.conv_id, 0 as own, i, id, chars from c join o on o.conv_id = c.head where i < h
  union all select c.conv_id, 1, i, id, chars from c join o on o.conv_id = c.conv_id where i >= h),
s as (
  select c.conv_id, coalesce(list(id order by own, i) filter (id is not null), []) as seq, coalesce(list(chars order by own, i) filter (id is not null), []) as lens
  from c left join r using (conv_id) group by c.conv_id),
p as (select conv_id, seq, lens, unnest(range(0, len(seq) + 1)) as depth from s),
n as (
  select array_to_string(seq[1:depth], '') as k, any_value(case when depth > 0 then array_to_string(seq[1:depth - 1], '') end) as up, depth, any_value(seq[1:depth]) as seq,
         min(conv_id) as conv_id, count(*) as n_convs, any_value(case when depth > 0 then lens[depth] else 0 end) as chars,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(p.seq) = depth), '')) as ends_sha256
  from p group by k, depth),
ch as (select up as k, count(*) as n_children from n where up is not null group by up),
m as (select n.*, coalesce(n_children, 0) as n_children from n left join ch using (k)),
b as (
  select k, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * chars) as saved
  from (select array_to_string(seq[1:d], '') as k, n_convs, chars, n_children from (select *, unnest(range(0, depth + 1)) as d from m)) group by k)
select m.conv_id, m.depth, u.conv_id as parent_conv_id, m.n_convs, m.n_children, b.n_leaves, cast(b.saved as bigint) as saved_tokens, m.ends_sha256
from m join b using (k) left join n u on u.k = m.up""",
    "op13_hard_negatives": r"""
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * cast(x as double)) for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, cast(row_number() over w as int) as rank, n.b as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.a = p.a and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
window w as (partition by p.a, p.b order by n.score desc, n.b) qualify row_number() over w <= 5""",
}
