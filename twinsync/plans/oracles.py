"""SQL that gives the expected rows of each query, for an independent engine (DuckDB).

Written in joins and windows of plain SQL, by another route than the Spark side where there is one.
"""

from __future__ import annotations

import re

from twinsync.plans.inputs import VIEWS, view_sql

_COLS_A = "a_id, a_modified, email, firstname, lastname, phone, mobilephone, jobtitle, company"
_COLS_B = "b_id, b_modified, emailaddress1, firstname, lastname, telephone1, mobilephone, jobtitle, company"
_FIELDS = ("email", "firstname", "lastname", "phone", "mobilephone", "jobtitle", "company")
_CHECKSUM = "sha256(concat_ws('|', {}))".format(", ".join(f"coalesce({c}, '')" for c in _FIELDS))
_HISTORY = f"unified_contact_id, {', '.join(_FIELDS)}, valid_from, valid_to, is_current, checksum"
_T1, _T2 = "timestamp '1998-07-01 00:00:00'", "timestamp '2001-09-01 00:00:00'"
_NO_TIME = "cast(null as timestamp)"
_STRIP = "lower(regexp_replace({}, '^\\s+|\\s+$', '', 'g'))"


def _email(column: str) -> str:
    text = _STRIP.format(column)
    return f"case when contains({text}, '@') then {text} end"


def _snapshot(system: str, columns: str, ties: str, where: str) -> str:
    rank = f"""row_number() over (partition by {system}_id
        order by {system}_modified desc nulls last, {ties.replace(",", " desc nulls last,")} desc nulls last)"""
    return f"select {columns} from (select *, {rank} as rn from src_{system} where {where}) where rn = 1"


def _keys(snap: str, email: str, id_: str, modified: str) -> str:
    return f"""
        select * from (
            select *, row_number() over (partition by match_email order by {modified} desc nulls last, {id_}) as rn
            from (select *, {_email(email)} as match_email from {snap}) where match_email is not null
        ) where rn = 1"""


def _crosswalk(keys_a: str, keys_b: str) -> str:
    return f"""
        select sha256(coalesce(a.match_email, b.match_email)) as unified_contact_id,
            coalesce(a.match_email, b.match_email) as email, a_id, b_id
        from {keys_a} a full join {keys_b} b on a.match_email = b.match_email"""


def _unified(crosswalk: str, snap_a: str, snap_b: str) -> str:
    return f"""
        select x.unified_contact_id, coalesce(a.email, b.emailaddress1) as email,
            coalesce(a.firstname, b.firstname) as firstname, coalesce(a.lastname, b.lastname) as lastname,
            coalesce(a.phone, b.telephone1) as phone, coalesce(a.mobilephone, b.mobilephone) as mobilephone,
            coalesce(a.jobtitle, b.jobtitle) as jobtitle, coalesce(a.company, b.company) as company
        from {crosswalk} x left join {snap_a} a on x.a_id = a.a_id left join {snap_b} b on x.b_id = b.b_id"""


def _deltas(target: str, rules: list[tuple[str, str, str]], prefix: str = "", newest: bool = False, empty: bool = False) -> str:
    source = "b" if target == "a" else "a"
    branches = []
    for position, (have, offer, strategy) in enumerate(rules):
        t, s = f"{target}.{have}", f"{source}.{offer}"
        null = "nullif({}, '')" if empty else "{}"
        test = f"{null.format(t)} is null and {null.format(s)} is not null" if strategy == "fill" else f"{t} <> {s}"
        if newest and strategy == "overwrite" and have != "jobtitle":
            newer = ">=" if source == "a" else ">"
            test += f" and ({target}.{target}_modified is null or {source}.{source}_modified {newer} {target}.{target}_modified)"
        branches.append(f"""
            select x.unified_contact_id, x.{target}_id, {position} as pos, '{have}' as field, {s} as value
            from {prefix}crosswalk x left join {prefix}snap_a a on x.a_id = a.a_id left join {prefix}snap_b b on x.b_id = b.b_id
            where {test}""")
    return " union all ".join(branches)


def _outbox(target: str, prefix: str = "") -> str:
    return f"""
        select unified_contact_id, {target}_id,
            '{{' || string_agg(to_json(field)::varchar || ':' || to_json(value)::varchar, ',' order by pos) || '}}' as payload,
            'PENDING' as status, 0 as attempt, {_NO_TIME} as last_attempt_ts
        from {prefix}deltas_{target} group by all"""


def _time(text: str) -> str:
    """A time of the years 0001 to 9999, or null."""
    micros = f"epoch_us(try_cast({text} as timestamptz))"
    return f"case when {micros} between -62135596800000000 and 253402300799999999 then make_timestamp({micros}) end"


def _parsed(raw: str, system: str, texts: dict[str, str], modified: str, nested: bool, id_: str = "id") -> str:
    """``texts`` maps every bronze text column to its JSON key, or to nothing when no record has it."""
    body = "$.properties." if nested else "$."
    doc = "case when json_valid(raw) then raw end"
    columns = ", ".join(
        f"json_extract_string({doc}, '{body}{key}') as {c}" if key else f"cast(null as varchar) as {c}"
        for c, key in texts.items()
    )
    text = f"json_extract_string({doc}, '{body}{modified}')"
    return f"""
        select timestamp '2024-02-01 03:04:05' as load_ts, json_extract_string({doc}, '$.{id_}') as {system}_id,
            {_time(text)} as {system}_modified, {columns}, raw, {text} as modified_text,
            case when not json_valid(raw) then case when regexp_matches(raw, '\\}}[, ]\\{{')
                then 'Text after the document' else 'No document' end end as fault
        from {raw}"""


_TEXTS_A = dict.fromkeys(("firstname", "lastname", "phone", "mobilephone", "company", "lifecyclestage"), "")
_TEXTS_A = {"email": "email", "jobtitle": "jobtitle", **_TEXTS_A}
_TEXTS_B = dict.fromkeys(("firstname", "lastname", "telephone1", "mobilephone", "jobtitle"), "")
_TEXTS_B = {"emailaddress1": "emailaddress1", "company": "company", **_TEXTS_B}


def _reason(system: str) -> str:
    return (
        f"case when fault is not null then fault when {system}_id is null then 'Missing record id'"
        f" when modified_text is not null and {system}_modified is null then 'Unreadable modified time' end"
    )


def _accepted(system: str, texts: dict[str, str], parsed: str = "parsed_") -> str:
    columns = ", ".join(texts)
    return f"""
        select load_ts, {system}_id, {system}_modified, {columns}, raw from {parsed}{system}
        where {_reason(system)} is null"""


# The words read as digits.
_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def _digits(text: str) -> str:
    for digit, word in enumerate(_WORDS):
        spellings = "|".join((word, word.upper(), word.capitalize()))
        text = f"regexp_replace({text}, '\\b(?:{spellings})\\b', '{digit}', 'g')"
    return text


# All card formats in the order they are tried.
_CARD_FORMATS = (
    r"\b(?:\d[ -]*?){13,16}\b",
    r"\b4\d{12,18}\b",
    r"\b(?:5[1-5]\d{14}|2[2-7][0-9]{14})\b",
    r"\b3[47]\d{13}\b",
    r"\b(?:6011|65|64[4-9])\d{12}\b",
    r"\b35\d{14}\b",
    r"\b(?:\d{4}[- ]?){3}\d{4}[- ]?\d{4}[- ]?\d{4}\b",
)


def _cards(text: str) -> str:
    return f"regexp_replace({text}, '{'|'.join(_CARD_FORMATS)}', '[REDACTED]', 'g')"


def _status(code: str) -> str:
    return f"""case when {code} between 200 and 299 then 'SUCCESS'
        when {code} in (429, 500, 502, 503, 504) then 'PENDING' else 'FAILED' end"""


_VALUE = "case when code is not null then code::varchar else to_json(value)::varchar end"
_BINDS = "field = 'company' and length(value) >= 32"
_BOUND_KEY = f"case when {_BINDS} then field || '@odata.bind' else field end"
_BOUND_VALUE = f"case when {_BINDS} then '/accounts(' || value || ')' else value end"

def _matching(prefix: str, ties_a: str, ties_b: str, until: str | None = None) -> dict[str, str]:
    """Snapshots up to unified records, of all changes or of those up to a day."""
    where = "cast({}_modified as date) <= date '" + until + "'" if until else "true"
    return {
        f"{prefix}snap_a": _snapshot("a", _COLS_A, ties_a, where.format("a")),
        f"{prefix}snap_b": _snapshot("b", _COLS_B, ties_b, where.format("b")),
        f"{prefix}keys_a": _keys(f"{prefix}snap_a", "email", "a_id", "a_modified"),
        f"{prefix}keys_b": _keys(f"{prefix}snap_b", "emailaddress1", "b_id", "b_modified"),
        f"{prefix}crosswalk": _crosswalk(f"{prefix}keys_a", f"{prefix}keys_b"),
        f"{prefix}unified": _unified(f"{prefix}crosswalk", f"{prefix}snap_a", f"{prefix}snap_b"),
    }


def _two_dates(prefix: str) -> dict[str, str]:
    """History of the unified records of the first date, and what the second changes in it."""
    return {
        f"{prefix}history": f"""
            select *, {_T1} as valid_from, {_NO_TIME} as valid_to, true as is_current, {_CHECKSUM} as checksum
            from {prefix}old_unified""",
        f"{prefix}current": f"select *, {_CHECKSUM} as checksum from {prefix}unified",
        f"{prefix}changes": f"""
            select c.*, {_T2} as valid_from, {_NO_TIME} as valid_to, true as is_current
            from {prefix}current c left join {prefix}history h on c.unified_contact_id = h.unified_contact_id
            where h.checksum is null or h.checksum <> c.checksum""",
        f"{prefix}closed": f"""
            select * replace ({_T2} as valid_to, false as is_current) from {prefix}history
            where unified_contact_id in (select unified_contact_id from {prefix}changes)""",
        f"{prefix}untouched": f"""
            select * from {prefix}history
            where unified_contact_id not in (select unified_contact_id from {prefix}changes)""",
    }


def _whole_history(prefix: str) -> str:
    parts = (f"select {_HISTORY} from {prefix}{part}" for part in ("changes", "closed", "untouched"))
    return " union all ".join(parts)


_TIES_A = _COLS_A.removeprefix("a_id, a_modified, ")
_TIES_B = _COLS_B.removeprefix("b_id, b_modified, ")

_RULES_A = [
    ("email", "emailaddress1", "overwrite"), ("firstname", "firstname", "fill"),
    ("lastname", "lastname", "fill"), ("phone", "telephone1", "overwrite"),
    ("mobilephone", "mobilephone", "fill"), ("jobtitle", "jobtitle", "overwrite"),
]
_RULES_B = [
    ("emailaddress1", "email", "overwrite"), ("firstname", "firstname", "fill"),
    ("lastname", "lastname", "fill"), ("telephone1", "phone", "overwrite"),
    ("mobilephone", "mobilephone", "fill"), ("company", "company", "fill"),
]


def _applied(target: str, prefix: str = "") -> str:
    return f"""
        select o.unified_contact_id, o.{target}_id, o.payload,
            case when r.{target}_id is not null then {_status('r.http_code')}
                 when o.{target}_id is null then 'FAILED' else o.status end as status,
            cast(case when r.{target}_id is not null then 1 else 0 end as int) as attempt,
            case when r.{target}_id is not null then {_T2} end as last_attempt_ts
        from {prefix}outbox_{target} o left join push_results_{target} r on o.{target}_id = r.{target}_id"""


def _records(pages: str, at: str) -> str:
    return f"""
        select unnest(cast(json_extract(raw, '$.{at}') as json[]))::varchar as raw from {pages}
        where json_valid(raw) and json_extract(raw, '$.{at}') is not null"""


# Intermediate results; a query pulls in those it names.
STEPS = {
    **_matching("", "a_version", "b_version"),
    **_matching("old_", "a_version", "b_version", until="1998-06-30"),
    **_two_dates(""),
    **_matching("run_", _TIES_A, _TIES_B),
    **_matching("run_old_", _TIES_A, _TIES_B, until="1998-06-30"),
    **_two_dates("run_"),
    "deltas_a": _deltas("a", _RULES_A),
    "deltas_b": _deltas("b", _RULES_B),
    "run_deltas_a": _deltas("a", _RULES_A, "run_"),
    "run_deltas_b": _deltas("b", _RULES_B, "run_"),
    "run_outbox_a": _outbox("a", "run_"),
    "run_outbox_b": _outbox("b", "run_"),
    "newest_deltas_a": _deltas("a", _RULES_A, newest=True),
    "empty_deltas_b": _deltas("b", _RULES_B, empty=True),
    "applied_a": _applied("a"),
    "run_applied_a": _applied("a", "run_"),
    "run_applied_b": _applied("b", "run_"),
    "records_a": _records("pages_a", "results"),
    "records_b": _records("pages_b", "value"),
    "paged_a": _parsed("records_a", "a", {**_TEXTS_A, "jobtitle": "", "phone": "phone_number"}, "lastChanged", nested=True, id_="recordId"),
    "paged_b": _parsed("records_b", "b", _TEXTS_B, "changedon", nested=False, id_="accountid"),
    "whole_past": f"""
        select *, {_T1} as valid_from, {_NO_TIME} as valid_to, true as is_current, {_CHECKSUM} as checksum from unified""",
    "whole_now": f"select *, {_CHECKSUM} as checksum from old_unified",
    "batches_a": """
        select (row_number() over (order by unified_contact_id) - 1) // 90 as batch from outbox_a where a_id is not null""",
    "outbox_a": _outbox("a"),
    "outbox_b": _outbox("b"),
    "parsed_a": _parsed("raw_a", "a", _TEXTS_A, "modified", nested=True),
    "parsed_b": _parsed("raw_b", "b", _TEXTS_B, "modified", nested=False),
    "bronze_a": _accepted("a", _TEXTS_A),
    "bronze_b": _accepted("b", _TEXTS_B),
    "coded": """
        select d.*, o.code from deltas_b d left join option_dim o
            on d.field = 'firstname' and o.option_set = 'segment' and o.label = d.value""",
    "pushed_b": """
        select unified_contact_id, b_id, payload, http_code, message
        from outbox_b join push_results_b using (b_id)""",
    "options": """
        select json_extract_string(raw, '$.Name') as option_set, generate_subscripts(o, 1) as pos, unnest(o) as opt
        from (select raw, cast(json_extract(raw, '$.Options') as json[]) as o from option_sets_raw)""",
}

_LINEITEM_RANK = """row_number() over (partition by l_partkey, l_suppkey
    order by l_shipdate desc nulls last, l_orderkey desc, l_linenumber desc)"""
_COUNTS = """select '{0}' as system, (select count(*) from raw_{0}) as landed,
    (select count(*) from bronze_{0}) as accepted,
    (select count(*) from parsed_{0} where {1} is not null) as rejected,
    (select max({0}_modified) from bronze_{0}) as high_water"""
_REASON_SINCE = f"coalesce({_reason('a')}, case when modified_text is null then 'Missing modified time' end)"
_HALF_KEY = "select c_custkey from upsert_target"

QUERIES = {
    "bronze_nested_json": "select * from bronze_a",
    "bronze_flat_json": "select * from bronze_b",
    "ingest_a": "select * from bronze_a where a_modified >= timestamp '2024-01-10 00:00:00'",
    "ingest_b": "select * from bronze_b where b_modified >= timestamp '2024-01-10 00:00:00'",
    "ingest_dead_letter": f"""
        select timestamp '2024-02-01 03:04:05' as ts, 'a' as system, 'contacts' as entity, a_id as key,
            {_REASON_SINCE} as reason, raw as payload
        from parsed_a where {_REASON_SINCE} is not null""",
    "ingest_counts": _COUNTS.format("a", _reason("a")) + " union all " + _COUNTS.format("b", _reason("b")),
    "incremental_filter": "select * from events where ts >= timestamp '2024-01-10 00:00:00'",
    "ordered_changes": """
        select event_id, ts, user_id, event_type,
            cast(row_number() over (partition by cast(ts as date) order by ts, event_id) as int) as place
        from events""",
    "batch_high_water": "select count(*) as records, max(ts) as high_water from events",
    "option_set_dim": """
        select option_set, label, code from (
            select option_set, json_extract_string(opt, '$.Label.LocalizedLabels[0].Label') as label,
                cast(json_extract_string(opt, '$.Value') as bigint) as code,
                row_number() over (partition by option_set, label order by pos desc) as rn
            from options
        ) where rn = 1 and label is not null""",
    "upsert_by_key": """
        select coalesce(s.c_custkey, t.c_custkey) as c_custkey,
            case when s.c_custkey is not null then s.c_name else t.c_name end as c_name,
            case when s.c_custkey is not null then s.c_acctbal else t.c_acctbal end as c_acctbal
        from upsert_target t full join upsert_source s on t.c_custkey = s.c_custkey""",
    "partitioned_write_read": """
        select event_id, ts, user_id, event_type, value, props, cast(ts as date) as load_date
        from events where cast(ts as date) >= date '2024-01-10'""",
    "latest_snapshot_a": "select * from snap_a",
    "latest_snapshot_b": "select * from snap_b",
    "latest_by_composite_key": f"""
        select l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber
        from (select *, {_LINEITEM_RANK} as rn from lineitem) where rn = 1""",
    "email_dedup": "select match_email, a_id, a_modified from keys_a",
    "normalize_email": f"select a_id, a_version, {_email('email')} as email from src_a",
    "crosswalk": "select * from crosswalk",
    "crosswalk_keep_unkeyed": f"""
        select * from crosswalk union all
        select sha256('a|' || a_id), null, a_id, null from snap_a where ({_email('email')}) is null union all
        select sha256('b|' || b_id), null, null, b_id from snap_b where ({_email('emailaddress1')}) is null""",
    "unified": "select * from unified",
    "unified_from_crosswalk": "select * from unified",
    "row_checksum": f"select unified_contact_id, {_CHECKSUM} as checksum from unified",
    "scd2_changes": f"select {_HISTORY} from changes",
    "scd2_close": f"select {_HISTORY} from closed",
    "scd2_untouched": f"select {_HISTORY} from untouched",
    "scd2_apply": _whole_history(""),
    "sync_two_runs": _whole_history("run_"),
    "field_deltas_long_a": "select unified_contact_id, a_id, field, value from deltas_a",
    "field_deltas_long_b": "select unified_contact_id, b_id, field, value from deltas_b",
    "outbox_a": "select * from outbox_a",
    "outbox_b": "select * from outbox_b",
    "payload_explode": "select unified_contact_id, a_id, field, value from deltas_a",
    "pending_outbox": """
        select unified_contact_id, a_id, payload, attempt, coalesce(a_id, '') <> '' as deliverable
        from applied_a where status = 'PENDING' order by attempt, last_attempt_ts nulls first, unified_contact_id limit 90""",
    "outbox_dead_letter": f"""
        select {_T2} as ts, 'a' as system, 'contacts' as entity, unified_contact_id as key,
            'Missing a_id' as reason, payload
        from outbox_a where a_id is null""",
    "outbox_apply_results": "select * from applied_a",
    "push_batches": """
        select (row_number() over (order by attempt, last_attempt_ts nulls first, unified_contact_id) - 1) // 90 as batch,
            unified_contact_id, a_id, payload, attempt
        from applied_a where status = 'PENDING' and a_id is not null""",
    "payload_dead_letter": f"""
        select {_T2} as ts, 'a' as system, 'contacts' as entity, unified_contact_id as key,
            case when a_id is null then 'Missing a_id' else 'Unreadable payload' end as reason,
            case when length(payload) % 5 = 0 then payload[:-2] else payload end as payload
        from outbox_a where a_id is null or length(payload) % 5 = 0""",
    "bronze_pages_a": _accepted("a", _TEXTS_A, "paged_"),
    "bronze_pages_b": _accepted("b", _TEXTS_B, "paged_"),
    "time_texts": f"""
        select event_id, text, {_time("case when length(text) = 10 then text || ' 00:00:00Z' when length(text) = 19 then text || 'Z' when text like '____-%' then text end")} as parsed
        from time_texts""",
    "row_checksum_prefixed": "select unified_contact_id, sha256(concat_ws('|', {})) as checksum from unified".format(
        ", ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in _FIELDS)
    ),
    "field_deltas_newest": "select unified_contact_id, a_id, field, value from newest_deltas_a",
    "field_deltas_empty_is_null": "select unified_contact_id, b_id, field, value from empty_deltas_b",
    "scd2_close_missing": f"""
        select {_HISTORY} from (
            select p.* replace (case when n.checksum is null or n.checksum <> p.checksum then {_T2} end as valid_to,
                n.checksum is not null and n.checksum = p.checksum as is_current)
            from whole_past p left join whole_now n on p.unified_contact_id = n.unified_contact_id)
        union all
        select {_HISTORY} from (
            select n.*, {_T2} as valid_from, {_NO_TIME} as valid_to, true as is_current
            from whole_now n left join whole_past p on p.unified_contact_id = n.unified_contact_id
            where p.checksum is null or n.checksum <> p.checksum)""",
    "sync_outboxes": """
        select * rename (a_id as target_id), 'a' as system from run_applied_a union all
        select * rename (b_id as target_id), 'b' as system from run_applied_b""",
    "sync_letters": " union all ".join(f"""
        select {_T2} as ts, '{s}' as system, 'contacts' as entity, unified_contact_id as key,
            case when {s}_id is null then 'Missing {s}_id' else message end as reason, payload
        from run_applied_{s} left join push_results_{s} using ({s}_id) where status = 'FAILED'""" for s in "ab"),
    "sync_audit": " union all ".join(f"""
        select ts, system, operation, status, http_code, n, message, (select max({s}_modified) from src_{s}) as watermark_ts from (
            select {t} as ts, '{s}' as system, 'ingest' as operation, 'SUCCESS' as status, 200 as http_code, 1::bigint as n,
                'Ingested ' || (select count(*) from src_{s} where {w}) || ' records' as message
        )""" for s in "ab" for t, w in ((_T1, f"{s}_modified < {_T1}"), (_T2, "{0}_modified >= (select max({0}_modified) from src_{0} where {0}_modified < {1})".format(s, _T1)))) + " union all " + " union all ".join(f"""
        select {_T2}, '{s}', 'push', case when http_code between 200 and 299 then 'SUCCESS' else 'FAILED' end, http_code,
            count(*), cast(null as varchar), (select max({s}_modified) from src_{s})
        from run_outbox_{s} join push_results_{s} using ({s}_id) group by http_code""" for s in "ab"),
    "audit_rows": f"""
        select {_T2} as ts, 'b' as system, 'contacts' as entity, 'push' as operation,
            'push-' || cast(cast(floor(epoch({_T2})) as bigint) as varchar) as request_id,
            case when http_code between 200 and 299 then 'SUCCESS' else 'FAILED' end as status, http_code,
            case when http_code between 200 and 299 then 'Patched ' || b_id else message end as message,
            case when http_code between 200 and 299 then null else payload end as payload
        from pushed_b
        union all
        select {_T2}, 'a', 'contacts', 'push', 'push-999302400', case when http_code = 200 then 'SUCCESS' else 'FAILED' end,
            http_code, case when http_code = 200 then 'Pushed ' || n || ' records' else message end, null
        from (select batch, count(*) as n from batches_a group by batch) join batch_results_a using (batch)
        union all
        select timestamp '2024-02-01 03:04:05', 'a', 'contacts', 'ingest', 'load-1706756645', 'SUCCESS', 200,
            'Ingested ' || cast(count(*) as varchar) || ' records',
            '{{"since":"2000-01-01T00:00:00Z","max":"' || strftime(max(a_modified), '%Y-%m-%dT%H:%M:%SZ') || '"}}'
        from bronze_a""",
    "push_dead_letter": f"""
        select {_T2} as ts, 'b' as system, 'contacts' as entity, unified_contact_id as key, message as reason, payload
        from pushed_b where {_status('http_code')} = 'FAILED'""",
    "watermark_current": """
        select entity, source, arg_max(watermark_ts, updated_at) as watermark_ts
        from watermark_rows group by entity, source""",
    "iso_timestamps": """
        select event_id, case when ts = date_trunc('second', ts) then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
            else strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') end as iso, ts as parsed,
            cast(null as timestamp) as unreadable
        from events""",
    "translate_options": f"""
        select unified_contact_id, b_id,
            '{{' || string_agg(to_json(field)::varchar || ':' || {_VALUE}, ',' order by pos) || '}}' as payload
        from coded group by all""",
    "bind_lookups": f"""
        select unified_contact_id, b_id, '{{' || string_agg(to_json({_BOUND_KEY})::varchar || ':'
            || to_json({_BOUND_VALUE})::varchar, ',' order by pos) || '}}' as payload
        from deltas_b group by all""",
    "translate_payload": f"""
        select unified_contact_id, b_id, '{{' || string_agg(to_json({_BOUND_KEY})::varchar || ':'
            || case when code is not null then code::varchar else to_json({_BOUND_VALUE})::varchar end,
            ',' order by pos) || '}}' as payload, 'PENDING' as status, 0 as attempt, {_NO_TIME} as last_attempt_ts
        from coded group by unified_contact_id, b_id""",
    "digit_words": f"select doc_id, {_digits('text')} as text from text_rows",
    "redact_cards": f"select doc_id, {_cards('text')} as text from text_rows",
    "redact_text": f"select doc_id, {_cards(_digits('text'))} as text from text_rows",
    "redact_documents": f"select doc_id, {_cards(_digits('text'))} as text from documents",
    "sync_flagship": f"""
        select u.*, x.a_id, x.b_id, a.payload as a_payload, b.payload as b_payload
        from current u join crosswalk x on u.unified_contact_id = x.unified_contact_id
        left join outbox_a a on u.unified_contact_id = a.unified_contact_id
        left join outbox_b b on u.unified_contact_id = b.unified_contact_id""",
    "stream_ingest": "select * from bronze_a",
    "stream_snapshot": "select * from run_snap_a",
}


def sql(body: str) -> str:
    """The query with the views and steps it needs before it."""
    known = {**{name: None for name in VIEWS}, **STEPS}
    needed: dict[str, str] = {}

    def require(text: str) -> None:
        for name in re.findall(r"\b[a-z]\w*\b", re.sub(r"'[^']*'", "''", text)):
            if name in known and name not in needed:
                inner = view_sql(name) if name in VIEWS else STEPS[name]
                needed[name] = ""
                require(inner)
                del needed[name]
                needed[name] = inner

    require(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in needed.items()) + "\n" + body


def all_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in QUERIES.items()}
