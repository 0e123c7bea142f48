"""Input views over the given tables (see FIXTURES.md).

The reference data holds no contact records, so these views derive them.  Every view covers its whole
tables.  Each is SQL that Spark and DuckDB both read; ``@name`` stands for a given table.
"""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsync.functions.times import format_iso
from twinsync.rules import SYSTEM_A, SYSTEM_B, System

AS_OF_1 = datetime(1998, 7, 1)
AS_OF_2 = datetime(2001, 9, 1)
FIRST_CUT = datetime(1998, 7, 1)
LOAD_TS = datetime(2024, 2, 1, 3, 4, 5)
SINCE = datetime(2024, 1, 10)
DEFAULT_START = datetime(2000, 1, 1)
OPTION_SETS = {"firstname": "segment"}
LOOKUPS = {"company": "accounts"}
PAGED_A = replace(SYSTEM_A, json_names={"a_id": "recordId", "a_modified": "lastChanged", "phone": "phone_number"})
PAGED_B = replace(SYSTEM_B, json_names={"b_id": "accountid", "b_modified": "changedon"})

VIEWS = {
    # Change rows of system A, several per id: null, invalid, shared and padded upper-case emails, emails
    # that B does not know, equal times within an id.
    "src_a": """
        select 'A' || cast(o_custkey as string) as a_id,
            o_orderdate as a_modified,
            o_orderkey as a_version,
            case when o_custkey % 13 = 0 then cast(null as string)
                 when o_custkey % 17 = 0 then 'not-an-address'
                 when o_custkey % 29 = 0 then 'shared' || cast(o_custkey % 3 as string) || '@example.org'
                 when o_custkey % 5 = 0 then lower(c_name) || '@only-a.example.org'
                 when o_custkey % 3 = 0 then '  ' || upper(c_name) || '@EXAMPLE.ORG '
                 else lower(c_name) || '@example.org' end as email,
            case when o_orderstatus = 'O' then cast(null as string) else c_mktsegment end as firstname,
            c_name as lastname,
            case when o_orderpriority = '3-MEDIUM' then cast(null as string) else o_orderpriority end as phone,
            case when o_orderkey % 4 = 0 then '' else cast(o_orderkey as string) end as mobilephone,
            c_mktsegment as jobtitle,
            case when o_custkey % 4 = 0 then cast(null as string)
                 when o_custkey % 3 = 1 then '00000000-0000-0000-0000-' || lpad(cast(c_nationkey as string), 12, '0')
                 else 'Co' || cast(c_nationkey as string) end as company,
            o_orderstatus as lifecyclestage
        from @orders join @customer on o_custkey = c_custkey
    """,
    # Change rows of system B: null emails, emails that A does not know, times behind A's for odd orders.
    "src_b": """
        select 'B' || cast(o_custkey as string) as b_id,
            case when o_orderkey % 2 = 1 then o_orderdate - interval '400' day else o_orderdate end as b_modified,
            o_orderkey as b_version,
            case when o_custkey % 19 = 0 then cast(null as string)
                 when o_custkey % 7 = 0 then lower(c_name) || '@only-b.example.org'
                 else lower(c_name) || '@example.org' end as emailaddress1,
            case when o_orderstatus = 'F' then cast(null as string) else c_mktsegment end as firstname,
            c_name as lastname,
            case when o_orderpriority = '1-URGENT' then cast(null as string) else o_orderpriority end as telephone1,
            case when o_orderkey % 6 = 0 then cast(null as string) else cast(o_orderkey as string) end as mobilephone,
            lower(c_mktsegment) as jobtitle,
            case when o_custkey % 6 <> 3 then cast(null as string)
                 else 'Co' || cast(c_nationkey as string) end as company
        from @orders join @customer on o_custkey = c_custkey
    """,
    # Landed JSON of either system: unreadable text and times, two documents in a text, time zones that lead out of
    # the years there are, absent attributes.
    "raw_a": """
        select case when event_id % 97 = 0 then '{"id":"' || cast(event_id as string)
               when event_id % 83 = 0 then '{"id":"' || cast(event_id as string) || '"} {"id":"' || cast(event_id as string) || '"}'
               when event_id % 79 = 0 then '{"id":"' || cast(event_id as string) || '"},{"id":"' || cast(event_id as string) || '"}'
               when event_id % 89 = 0 then '{"id":"' || cast(event_id as string) || '","properties":{"email":"u0@example.org"}}'
               else '{"id":"' || cast(event_id as string) || '","properties":{"email":"u' || cast(user_id as string)
                || '@example.org","jobtitle":"' || event_type || '","modified":"'
                || case when event_id % 10 = 0 then 'not-a-time'
                        when event_id % 20 = 3 then '9999-12-31T23:00:00-05:00'
                        when event_id % 20 = 5 then '0001-01-01T00:00:00+05:00'
                        when event_id % 10 = 1 then cast(cast(ts as date) as string) || 'T05:30:00+05:30'
                        else cast(cast(ts as date) as string) || 'T' || lpad(cast(extract(hour from ts) as string), 2, '0') || ':'
                            || lpad(cast(extract(minute from ts) as string), 2, '0') || ':05Z' end
                || '"}}' end as raw
        from @events
    """,
    "raw_b": """
        select '{"id":"' || cast(event_id as string) || '","emailaddress1":"u' || cast(user_id as string)
                || '@example.org","company":"' || event_type || '","modified":"'
                || cast(cast(ts as date) as string) || 'T12:34:56.789Z"}' as raw
        from @events
    """,
    # Pages of two records and a link, some of them empty, cut off, or without a list.
    "pages_a": """
        select case when event_id % 50 = 0 then '{"results":[]}' when event_id % 53 = 0 then '{"results":[{"recordId":"'
               when event_id % 47 = 0 then '{"total":0}'
               else '{"results":[{"recordId":"' || cast(event_id as string) || '","properties":{"email":"u' || cast(user_id as string)
                || '@example.org","phone_number":"' || event_type || '","lastChanged":"' || cast(cast(ts as date) as string)
                || 'T01:02:03Z"}},{"recordId":"x' || cast(event_id as string)
                || '","properties":{"lastChanged":"never"}}],"paging":{"next":{"after":"' || cast(event_id as string) || '"}}}' end as raw
        from @events
    """,
    "pages_b": """
        select '{"value":[{"accountid":"' || cast(event_id as string) || '","emailaddress1":"u' || cast(user_id as string)
                || '@example.org","company":"' || event_type || '","changedon":"' || cast(cast(ts as date) as string)
                || 'T01:02:03+01:00"}],"nextLink":"page' || cast(event_id as string) || '"}' as raw
        from @events
    """,
    # Times as others write them: zones, fractions, a blank for the T, days alone, times out of range, and no times.
    "time_texts": """
        select event_id, case event_id % 9 when 0 then cast(cast(ts as date) as string) || 'T05:30:00+05:30'
            when 1 then cast(cast(ts as date) as string) || 'T23:59:59.5Z'
            when 2 then cast(cast(ts as date) as string) || ' 01:02:03'
            when 3 then cast(cast(ts as date) as string)
            when 4 then '9999-12-31T23:00:00-05:00' when 5 then '0001-01-01T00:00:00+05:00' when 6 then event_type
            when 7 then cast(cast(ts as date) as string) || 'T00:00:00.123456-11:30'
            else cast(cast(ts as date) as string) || 'T10:11:12Z' end as text
        from @events
    """,
    # Positions as they are appended.
    "watermark_rows": """
        select event_type as entity, 's' || cast(user_id % 3 as string) as source,
            date_trunc('day', ts) as watermark_ts, ts as updated_at
        from @events
    """,
    # What a sender reports, for half of the ids: success, retryable and final codes.
    "push_results_a": """
        select 'A' || cast(c_custkey * 2 as string) as a_id,
            cast(case when c_custkey % 10 = 1 then 429 when c_custkey % 10 = 2 then 400
                      when c_custkey % 10 = 3 then 503 else 200 end as int) as http_code,
            'code for ' || c_name as message
        from @customer
    """,
    "push_results_b": """
        select 'B' || cast(c_custkey * 2 as string) as b_id,
            cast(case when c_custkey % 10 = 1 then 429 when c_custkey % 10 = 2 then 400
                      when c_custkey % 10 = 3 then 503 else 204 end as int) as http_code,
            'code for ' || c_name as message
        from @customer
    """,
    # What a sender reports for batches.
    "batch_results_a": """
        select cast(c_custkey - 1 as bigint) as batch,
            cast(case c_custkey % 4 when 0 then 503 when 1 then 400 else 200 end as int) as http_code,
            'batch for ' || c_name as message
        from @customer
    """,
    # Labels and codes, one label spelled otherwise than in the records.
    "option_dim": """
        select distinct 'segment' as option_set,
            case when c_mktsegment = 'MACHINERY' then 'MACHINES' else c_mktsegment end as label,
            cast(100000000 + length(c_mktsegment) as bigint) as code
        from @customer
    """,
    # Option-set documents: a label given twice, an option without labels.
    "option_sets_raw": """
        select '{"Name":"set' || cast(p_partkey as string) || '","Options":['
            || '{"Value":1,"Label":{"LocalizedLabels":[{"Label":"' || p_brand || '"},{"Label":"other"}]}},'
            || '{"Value":2,"Label":{"LocalizedLabels":[{"Label":"' || p_type || '"}]}},'
            || '{"Value":' || cast(p_size + 10 as string) || ',"Label":{"LocalizedLabels":[{"Label":"'
            || case when p_partkey % 3 = 0 then p_brand else p_name end || '"}]}},'
            || '{"Value":4,"Label":{"LocalizedLabels":[]}}]}' as raw
        from @part
    """,
    # Whole documents, with card numbers and spelled digits put behind most of them.
    "text_rows": """
        select doc_id, text || case doc_id % 8
            when 0 then ' pay 4' || substr('000000000000000', 1, 15) || ' now'
            when 1 then ' pay 1234 5678 9012 3456, and SEVEN Eight nine oNe'
            when 2 then ' one two three four five six seven eight nine zero one two three'
            when 3 then ' id 41111111111111111 (17) and 41111111111111111111 (20)'
            when 4 then ' 123456789012345678901234'
            when 5 then ' 1234 5678 9012 3456 7890 1234'
            when 6 then ' someone at 12-34, 1234-567890123456-78901234 or 5500000000000004'
            else '' end as text
        from @documents
    """,
    # A customer table, and a batch of which half of the keys are new to it.
    "upsert_target": "select c_custkey, c_name, c_acctbal from @customer",
    "upsert_source": "select c_custkey * 2 as c_custkey, c_name, c_acctbal + 1 as c_acctbal from @customer",
}


def landed_text(changes: DataFrame, system: System) -> DataFrame:
    """Change rows as the JSON text that the system would land; attributes without a value are absent."""
    body = [format_iso(F.col(system.modified)).alias("modified"), *system.attributes]
    if system.nested:
        record = F.struct(F.col(system.id).alias("id"), F.struct(*body).alias(system.nested))
    else:
        record = F.struct(F.col(system.id).alias("id"), *body)
    return changes.select(F.to_json(record).alias("raw"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input view over the Parquet tables of a folder."""
    return spark.sql(re.sub(r"@(\w+)\b(?=\s|$)", lambda m: _named(spark, sf_dir, m.group(1)), VIEWS[name]))


def _named(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The name of a given table in this session; its files are listed and its schema read once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = f"given_{name}_{crc32(path.encode()):08x}"
    if not spark.catalog.tableExists(known):
        spark.read.parquet(path).createOrReplaceTempView(known)
    return known


def view_sql(name: str) -> str:
    """The same view for an engine that knows the tables by name."""
    return re.sub(r"@(\w+)\b(?=\s|$)", r"\1", VIEWS[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.table(_named(spark, sf_dir, name))
