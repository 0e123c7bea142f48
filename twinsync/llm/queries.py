"""The operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from twinsync.llm import (
    chat_format, decontamination, exact_dedup, language, line_dedup, lm_scoring, ngram_join, packing, quality,
    ranked_search, sharding, spelling, warc,
)
from twinsync.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
CRAWL_TIME = datetime(2024, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("matches")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_conversations(table(spark, sf_dir, "conversations"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.mark_groups(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.package_and_read(table(spark, sf_dir, "pages"), CRAWL_TIME)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


_ALL = (
    op1_language_id, op2_lm_scoring, op3_exact_dedup, op4_quality, op5_sharding, op6_packing, op7_decontamination,
    op8_line_dedup, op9_chat_format, op10_ngram_join, op11_ranked_search, op12_warc, op13_spelling,
)

OP3_SQL = """
with d as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(text) as text_sha256
from d window w as (partition by text)
"""

OP8_SQL = r"""
with l as (
  select doc_id, line, row_number() over (partition by doc_id order by spot) - 1 as p, spot
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as spot from documents)
  where trim(line) <> ''
), w as (
  select doc_id, p, case n when 1 then [line] when 2 then [line, lead(line) over d] else [line, lead(line) over d, lead(line, 2) over d] end as run,
         case n when 1 then p when 2 then lead(p) over d else lead(p, 2) over d end as last, n
  from l, (values (1), (2), (3)) t(n) window d as (partition by doc_id, n order by p)
), f as (
  select doc_id, p, n, first_value(doc_id) over g as d0, first_value(p) over g as p0
  from w where last is not null
    and (n = 3 or len(regexp_extract_all(list_aggregate(run, 'string_agg', ' '), '[^ \t]+')) >= 50)
  window g as (partition by run order by doc_id, p)
), r as (
  select distinct doc_id, p + i as p from f, (values (0), (1), (2)) t(i) where i < n and (doc_id <> d0 or p >= p0 + n)
), gone as (select l.doc_id, l.spot from l join r using (doc_id, p)),
whole as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as spot from documents
)
select whole.doc_id, count(*) filter (trim(line) <> '') as n_lines, count(gone.spot) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by whole.spot) filter (gone.spot is null), '')) as text_sha256
from whole left join gone on whole.doc_id = gone.doc_id and whole.spot = gone.spot group by whole.doc_id
"""

OP11_SQL = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as term from documents
), tf as (select doc_id, term, count(*) as tf from t group by all),
n as (select doc_id, sum(tf) as n from tf group by doc_id),
size as (select count(*)::bigint as docs, sum(n)::bigint as terms from n),
df as (select term, count(*) as df from tf group by term),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as term from benchmark
), s as (
  select item_id, doc_id, sum(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint
           * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::bigint as score
  from q join df using (term) join tf using (term) join n using (doc_id), size group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank, doc_id, score
from s where score > 0 qualify rank <= 10
"""

OP12_SQL = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
g as (select page_id, html, strlen(html) as bytes, max(page_id) over (partition by html) as first_id from p)
select page_id, bytes as payload_bytes, sha1(html) as payload_digest,
       case when bytes >= 1000 and page_id <> first_id then 'revisit' else 'response' end as record_type,
       case when bytes >= 1000 and page_id <> first_id then first_id end as refers_to from g
"""

OP13_SQL = r"""
with recursive tab as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crc
  from range(256) r(i)
), runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) as run
  from documents
), counted as (select id, run, count(*) as n from runs group by all),
bytes as (
  select id, run, n, flatten(list_transform(list_transform(string_split(id || ':' || run, ''), lambda s: unicode(s)),
    lambda u: case when u < 128 then [u] else [195, u - 64] end)) as b from counted
), keyed as (
  select run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) as h
  from bytes, tab
), words as (
  select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, sum(n)::bigint as n
  from keyed group by 1 having sum(n) >= 5 and length(word) >= 6
), cut as (
  select word, n, -1 as spot, word as part from words union all
  select word, n, i, word[:i] || word[i + 2:] from (select word, n, unnest(range(length(word))) as i from words)
), near as (
  select distinct a.word, b.word as near, b.n as near_n from cut a join cut b on a.part = b.part and a.word <> b.word
  where a.spot = b.spot or a.spot = -1 or b.spot = -1
), best as (
  select word, count(*) as n_near, max(near_n) as near_n, first(near order by near_n desc, near) as near from near group by word
), forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form,
         case when near_n >= 5 * w.n then near_n end as form_n from words w left join best using (word)
), walk as (
  select word, coalesce(form, word) as root from forms union
  select walk.word, forms.form from walk join forms on walk.root = forms.word where forms.form is not null
)
select f.word, f.n, f.n_near, f.form, f.form_n, w.root
from forms f join walk w on f.word = w.word join forms e on e.word = w.root and e.form is null
"""


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def all_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": OP3_SQL, "op8_line_dedup": OP8_SQL, "op11_ranked_search": OP11_SQL, "op12_warc": OP12_SQL,
        "op13_spelling": OP13_SQL,
    }
