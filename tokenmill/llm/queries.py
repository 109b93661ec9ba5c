"""Queries over the operators, each over its whole table, and their DuckDB SQL
where SQL can express them (the others have brute-force tests)."""

from __future__ import annotations

from tokenmill.llm import (
    exact_dedup, html_extract, jaccard_join, knn_join, language_id, line_dedup, mixing, sentencepiece, sharding, spelling, token_files, toxicity,
    whitening)
from tokenmill.llm.tables import read


#: A SentencePiece model with byte pieces; another file may be given to the operator.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A file of the tokenizers library; any other of its files may be given.
WORD_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def op1_exact_dedup(spark, sf):
    return exact_dedup.dedup_report(read(spark, sf, "documents"))


def op2_sharding(spark, sf):
    return sharding.shard(read(spark, sf, "documents"), n_shards=24)[0]


def op3_sentencepiece(spark, sf):
    return sentencepiece.round_trip(read(spark, sf, "documents"), PIECE_MODEL)


def op4_line_dedup(spark, sf):
    return line_dedup.dedup_lines(read(spark, sf, "pages"))


def op5_mixing(spark, sf):
    return mixing.mix_report(read(spark, sf, "documents"))


def op6_html_extraction(spark, sf):
    return html_extract.extract(read(spark, sf, "pages"))


def op7_jaccard_join(spark, sf):
    return jaccard_join.near_duplicates(read(spark, sf, "documents"))


def op8_toxicity(spark, sf):
    return toxicity.score(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op9_knn_join(spark, sf):
    return knn_join.top_k(read(spark, sf, "embeddings"))


def op10_language_id(spark, sf):
    return language_id.predict(read(spark, sf, "documents"))


def op11_spelling_variants(spark, sf):
    return spelling.variants(read(spark, sf, "documents"))


def op12_token_files(spark, sf):
    return token_files.write_and_read(read(spark, sf, "documents"), WORD_TOKENIZER)


def op13_embedding_whitening(spark, sf):
    return whitening.whiten(read(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_sharding, op3_sentencepiece, op4_line_dedup, op5_mixing, op6_html_extraction, op7_jaccard_join, op8_toxicity, op9_knn_join,
    op10_language_id, op11_spelling_variants, op12_token_files, op13_embedding_whitening)}

ORACLE = {
    "op4_line_dedup": rf"""
with p as (
  select row_number() over () as r, page_id, lower(regexp_extract(coalesce(url, ''), '{line_dedup.HOST}', 1)) as host,
    list_filter(list_transform(string_split(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{line_dedup.HIDDEN}', ' ', 'g'),
        '{line_dedup.BLANK}', ' ', 'g'), '{line_dedup.BREAK}', chr(10), 'g'), '{line_dedup.TAG}', '', 'g'), chr(10)),
      lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: x <> '') as lines
  from pages),
n as (select host, count(*) as pages from p group by host),
l as (select r, host, unnest(list_distinct(lines)) as line from p),
c as (
  select l.host, l.line from l join n on l.host = n.host group by l.host, l.line, n.pages
  having count(*) >= {line_dedup.MIN_PAGES} and count(*) / n.pages > {line_dedup.MAX_SHARE}),
d as (select host, list(line) as gone from c group by host),
k as (
  select p.*, case when gone is null then lines else list_filter(lines, lambda x: not list_contains(gone, x)) end as kept
  from p left join d on p.host = d.host)
select page_id, host, coalesce(array_to_string(kept, chr(10)), '') as text, len(lines)::bigint as n_lines, (len(lines) - len(kept))::bigint as n_dropped
from k
""",
    "op9_knn_join": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
""",
    "op1_exact_dedup": """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
""",
    "op5_mixing": r"""
with d as (
  select doc_id, source as src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         ('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), 'null:' || md5(coalesce(text, '')))), 1, 12))::bigint as h
  from documents),
s as (
  select src, sum(size)::bigint as size,
         ((row_number() over (order by src collate "C" nulls last) - 1) % 3 + 1)::double as w
  from d group by src),
r as (
  select *, 3.0::double * size as cap,
         (sum(size) over ()
          - coalesce(sum(3.0::double * size) over (order by 3.0::double * size / w, src nulls last
                     rows between unbounded preceding and 1 preceding), 0))
         / (sum(w) over () - coalesce(sum(w) over (order by 3.0::double * size / w, src nulls last
                     rows between unbounded preceding and 1 preceding), 0)) as level
  from s),
l as (select arg_min(level, cap / w) as level from r where cap >= level * w),
t as (
  select src, size, least(cap, l.level * w) as target from r, l),
u as (
  select src, size, target, case when size > 0 then floor(target / size)::bigint else 0 end as copies from t),
v as (select *, target - copies * size as extra from u),
c as (
  select src, h, sum(size) as words, sum(sum(size)) over (partition by src order by h) as through from d group by src, h),
b as (
  select c.src, min(c.h) as h, arg_min(c.through, c.h) as through, arg_min(c.words, c.h) as words, any_value(v.extra) as extra
  from c join v on c.src is not distinct from v.src where v.extra > 0 and c.through > v.extra group by c.src),
k as (
  select src, h + case when through - extra < extra - (through - words) then 1 else 0 end as threshold from b)
select d.doc_id, d.size::bigint as size, v.size as source_size, v.target,
       (d.size * (v.copies + case when d.h < coalesce(k.threshold, 0) then 1 else 0 end))::bigint as taken
from d join v on d.src is not distinct from v.src left join k on d.src is not distinct from k.src
""",
}
