"""DuckDB SQL oracles for the registered queries (same names, same columns).

Written independently of the Spark code: plain SQL over the parquet views,
with DuckDB's own functions (``strip_accents``, ``try_strptime``,
``date_sub``, list indexing, ``row_number``).  Integer aggregates are cast to
BIGINT and percentages computed in DOUBLE, as on the Spark side.
"""

from __future__ import annotations

from tidyframe.registry import (
    EVENTS_WITH_GAPS_SQL,
    EVENTS_WITH_NULLS_SQL,
    ORDER_RULES,
    RANGE_RULES,
)

# Unicode White_Space, spelled for RE2: what Java's (?U)\s matches.
WS = r"[\t\n\x0B\f\r\x{85}\pZ]+"


def _norm(expr: str) -> str:
    return f"lower(trim(regexp_replace({expr}, '{WS}', ' ', 'g')))"


def _squish(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}', ' ', 'g'))"


def _title(expr: str) -> str:
    """Capitalise each space-separated word.  The first letter takes its full
    Unicode title-case mapping, which for the sharp s is 'Ss' (DuckDB's upper()
    would give the capital sharp s instead)."""
    return (f"array_to_string(list_transform(string_split({_squish(expr)}, ' '), "
            f"lambda w: case when w[1] = chr(223) then 'Ss' else upper(w[1]) end "
            f"|| lower(w[2:])), ' ')")


def _pct(part: str, whole: str) -> str:
    return (f"case when {whole} > 0 then 100.0::double * cast({part} as double) "
            f"/ cast({whole} as double) else 0.0::double end")


def completeness_sql(src: str, cols: list[tuple[str, bool]], warn: float = 10.0) -> str:
    """``cols``: (name, is_float) -> one row per column."""
    parts = []
    for name, is_float in cols:
        miss = f"({name} is null or isnan({name}))" if is_float else f"{name} is null"
        n, t = f"count_if({miss})", "count(*)"
        parts.append(
            f"select '{name}' as \"column\", cast({t} as bigint) as total, "
            f"cast({n} as bigint) as n_null, cast({t} - {n} as bigint) as n_filled, "
            f"{_pct(n, t)} as pct_null, {_pct(f'{t} - {n}', t)} as pct_filled, "
            f"case when {n} = 0 then 'ok' when {_pct(n, t)} < {warn} then 'warn' "
            f"else 'fail' end as status from {src}"
        )
    return "\nunion all\n".join(parts)


def describe_sql(src: str, cols: list[str], decimals: int | None = 4) -> str:
    def r(x):
        return f"round(cast({x} as double), {decimals})" if decimals is not None else f"cast({x} as double)"

    return "\nunion all\n".join(
        f"select '{c}' as \"column\", cast(count({c}) as bigint) as count, "
        f"{r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as stddev, "
        f"cast(min({c}) as double) as min, cast(max({c}) as double) as max from {src}"
        for c in cols
    )


def range_sql(src: str, rules: list[dict]) -> str:
    parts = []
    for r in rules:
        c, lo, hi = r["column"], float(r["min"]), float(r["max"])
        bad = f"count_if({c} < {lo!r} or {c} > {hi!r})"
        nul = f"count_if({c} is null)"
        valid = f"(count(*) - {bad} - {nul})"
        parts.append(
            f"select '{c}' as \"column\", {lo!r}::double as min, {hi!r}::double as max, "
            f"cast(count(*) as bigint) as total, cast({valid} as bigint) as n_valid, "
            f"cast({bad} as bigint) as n_invalid, cast({nul} as bigint) as n_null, "
            f"{_pct(bad, 'count(*)')} as pct_invalid, {_pct(valid, 'count(*)')} as pct_valid "
            f"from {src}"
        )
    return "\nunion all\n".join(parts)


def duplicates_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (
        f"select '{','.join(keys)}' as key, cast(sum(n) as bigint) as total, "
        f"cast(count(*) as bigint) as n_unique, cast(sum(n) - count(*) as bigint) as n_duplicate, "
        f"{_pct('sum(n) - count(*)', 'sum(n)')} as pct_duplicate "
        f"from (select {k}, count(*) as n from {src} group by {k})"
    )


def long_sql(inner: str, check: str, subject: str, metrics: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{check}' as \"check\", cast({subject} as varchar) as subject, "
        f"'{m}' as metric, round(cast({m} as double), 4) as value from ({inner})"
        for m in metrics
    )


def report_sql(src: str, cols: list[tuple[str, bool]], numeric: list[str],
               rules: list[dict], keys: list[str]) -> str:
    parts = [
        long_sql(completeness_sql(src, cols), "completeness", '"column"',
                 ["total", "n_null", "n_filled", "pct_null", "pct_filled"]),
        long_sql(describe_sql(src, numeric, None), "describe", '"column"',
                 ["count", "mean", "stddev", "min", "max"]),
        long_sql(range_sql(src, rules), "range", '"column"',
                 ["total", "n_valid", "n_invalid", "n_null", "pct_invalid", "pct_valid"]),
    ]
    if keys:
        parts.append(long_sql(duplicates_sql(src, keys), "duplicates", "key",
                              ["total", "n_unique", "n_duplicate", "pct_duplicate"]))
    return "\nunion all\n".join(parts)


def _with(ctes: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes.items()) + "\n" + body


EVENT_COLS = [("event_id", False), ("ts", False), ("user_id", False),
              ("event_type", False), ("value", True), ("props", False)]
EVENT_RULES = RANGE_RULES  # the rules the Spark query checks

LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]

_DEDUPE_LATEST = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from (select *, row_number() over (partition by o_custkey order by o_orderdate desc,
        o_orderkey desc, o_orderstatus desc, o_totalprice desc, o_orderpriority desc) as rn
      from orders) where rn = 1"""

_FLAGSHIP_CTES = {
    "p": f"""select o_orderkey, o_custkey,
        {_norm("' ' || o_orderpriority || '  '")} as priority,
        try_cast(case when o_orderkey % 9 = 0 then 'n/a'
                      else cast(o_totalprice as varchar) end as double) as total,
        o_orderdate from orders""",
    "l": """select o_orderkey, o_custkey, priority, total, o_orderdate from (
        select *, row_number() over (partition by o_custkey order by o_orderdate desc,
            o_orderkey desc, priority desc, total desc) as rn from p) where rn = 1""",
}

_JOB_CTES = {
    "src": """select cast(o_orderkey as varchar) as order_id,
        cast(o_custkey as varchar) as customer_id,
        o_orderstatus || '/' || o_orderpriority as status_priority,
        '  ' || upper(o_orderpriority) || ' ' || chr(9) || ' ' as priority_note,
        strftime(o_orderdate, '%d/%m/%Y') as order_date,
        case when o_orderkey % 9 = 0 then 'n/a' else cast(o_totalprice as varchar) end as total
        from orders""",
    "c": f"""select try_cast(order_id as bigint) as order_id,
        try_cast(customer_id as bigint) as customer_id,
        {_norm("priority_note")} as priority_note,
        strftime(try_strptime(order_date, '%d/%m/%Y'), '%Y-%m-%d') as order_date,
        try_cast(total as double) as total,
        string_split(status_priority, '/')[1] as status,
        string_split(status_priority, '/')[2] as priority from src""",
    "e": """select *, cast(date_sub('year', cast(order_date as date), date '2026-12-01')
        as integer) as order_age from c""",
    "d": """select order_id, customer_id, priority_note, order_date, total, status, priority,
        order_age, date '2026-12-01' as processing_date,
        timestamp '2026-12-01 06:30:00' as processing_ts
        from (select *, row_number() over (partition by customer_id order by order_date desc,
            order_id desc, priority_note desc, total desc, status desc, priority desc,
            order_age desc) as rn from e) where rn = 1""",
}
_JOB_COLS = [("order_id", False), ("customer_id", False), ("priority_note", False),
             ("order_date", False), ("total", True), ("status", False), ("priority", False),
             ("order_age", False), ("processing_date", False), ("processing_ts", False)]


#: the orders with the number of the drop that brings them
_DROPS = """select *, case when o_orderdate < timestamp '1996-01-01' then 0
    when o_orderdate < timestamp '1998-04-25' then 1 else 2 end as part from orders"""


def _ingest_report() -> str:
    """One report per drop: of each customer's latest order, duplicates before that."""
    cols = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", False),
            ("o_totalprice", True), ("o_orderdate", False), ("o_orderpriority", False)]
    ctes, parts = {}, []
    for batch, when in enumerate(("<", ">=")):
        ctes[f"b{batch}"] = f"select * from orders where o_orderdate {when} timestamp '1998-04-25'"
        ctes[f"d{batch}"] = f"""select * from (select *, row_number() over (partition by o_custkey
            order by o_orderdate desc, o_orderkey desc) as rn from b{batch}) where rn = 1"""
        report = report_sql(f"d{batch}", cols, ["o_orderkey", "o_custkey", "o_totalprice"],
                            ORDER_RULES, [])
        dups = long_sql(duplicates_sql(f"b{batch}", ["o_custkey"]), "duplicates", "key",
                        ["total", "n_unique", "n_duplicate", "pct_duplicate"])
        parts.append(f"select *, cast({batch} as bigint) as batch_id from ({report} union all {dups})")
    return _with(ctes, "\nunion all\n".join(parts))


def _report_history() -> str:
    """The report of each of three drops, once, with its batch and the run's date."""
    cols = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", False),
            ("o_totalprice", True), ("o_orderdate", False), ("o_orderpriority", False)]
    ctes, parts = {}, []
    for batch in range(3):
        ctes[f"b{batch}"] = f"select * exclude (part) from ({_DROPS}) where part = {batch}"
        ctes[f"d{batch}"] = f"""select * from (select *, row_number() over (partition by o_custkey
            order by o_orderdate desc, o_orderkey desc) as rn from b{batch}) where rn = 1"""
        report = report_sql(f"d{batch}", cols, ["o_orderkey", "o_custkey", "o_totalprice"],
                            ORDER_RULES, [])
        dups = long_sql(duplicates_sql(f"b{batch}", ["o_custkey"]), "duplicates", "key",
                        ["total", "n_unique", "n_duplicate", "pct_duplicate"])
        parts.append(f"select *, cast({batch} as bigint) as batch_id, date '2026-12-01' as run_date "
                     f"from ({report} union all {dups})")
    return _with(ctes, "\nunion all\n".join(parts))


def oracles() -> dict[str, str]:
    part_all = "select * from part"
    sql = {
        "scan_parquet": "select l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
                        "l_shipdate from lineitem",
        "roundtrip_csv": part_all,
        "roundtrip_json": part_all,
        "roundtrip_xml": part_all,
        "roundtrip_parquet": part_all,
        "roundtrip_csv_text": "select * from documents",
        "roundtrip_json_text": "select * from documents",
        "roundtrip_xml_text": "select * from documents",
        "scan_glob": "select *, '20240101' as batch from part union all "
                     "select *, '20240102' as batch from part",
        "glob_dedupe": part_all,
        "scan_glob_headers": "select * replace (case when p_partkey % 3 = 2 then null else p_size end "
                             "as p_size) from part",
        "cast_safe": """select o_orderkey,
            try_cast(case when o_orderkey % 7 = 0 then 'abc'
                          else cast(o_totalprice as varchar) end as double) as price,
            try_cast(case when o_orderkey % 11 = 0 then '12x'
                          else cast(o_custkey as varchar) end as bigint) as custkey,
            try_cast(case when o_orderkey % 5 = 0 then ''
                          else cast(o_totalprice as varchar) end as double) as price2
            from orders""",
        "text_normalize": f"select doc_id, {_norm('text')} as text_norm from documents",
        "text_normalize_messy": "select p_partkey, " + _norm(
            "'  ' || p_name || chr(9) || chr(10) || '  ' || p_type || chr(160) || ' ' || upper(p_brand) "
            "|| ' '"
        ) + " as text_norm from part",
        "text_title": "select p_partkey, array_to_string(list_transform(string_split("
                      + _squish("' ' || upper(p_name) || '  ' || p_type")
                      + ", ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name_title "
                      "from part",
        "text_title_documents": f"select doc_id, {_title('text')} as text_title from documents",
        "text_title_plain": f"select doc_id, strip_accents({_title('text')}) as text_title "
                            "from documents",
        "text_unaccent": "select doc_id, strip_accents(text) as text_plain from documents",
        "date_reformat": """select o_orderkey, strftime(try_strptime(
            case when o_orderkey % 11 = 0 then '31/02/2000'
                 when o_orderkey % 17 = 0 then '2020-01-05'
                 else strftime(o_orderdate, '%d/%m/%Y') end, '%d/%m/%Y'), '%Y-%m-%d')
            as order_date from orders""",
        "split_columns": """with x as (select p_partkey,
              case when p_partkey % 5 = 0 then cast(p_size as varchar)
                   when p_partkey % 7 = 0 then cast(p_size as varchar) || '/'
                   else cast(p_size as varchar) || '/' || p_brand end as code from part)
            select p_partkey, string_split(code, '/')[1] as size_part,
                   string_split(code, '/')[2] as brand_part from x""",
        "age_years": "select o_orderkey, cast(date_sub('year', cast(o_orderdate as date), "
                     "date '2026-12-01') as integer) as age_years from orders",
        "age_days365": "select o_orderkey, cast(trunc(date_diff('day', cast(o_orderdate as date),"
                       " date '2026-12-01') / 365) as integer) as age_years from orders",
        "age_years_messy": """with x as (select o_orderkey, o_orderdate,
                case when o_orderkey % 17 = 0 then 'none' when o_orderkey % 11 = 0 then 'abc'
                     when o_orderkey % 13 = 0 then 'no day' when o_orderkey % 7 = 0 then 'leap'
                     else 'given' end as kind from orders),
            b as (select o_orderkey,
                case kind when 'none' then null when 'abc' then 'abc' when 'no day' then '31/02/2000'
                    when 'leap' then '29/02/1996' else strftime(o_orderdate, '%d/%m/%Y') end as day_first,
                case kind when 'none' then null when 'abc' then 'abc' when 'no day' then '2000-02-31'
                    when 'leap' then '1996-02-29' else strftime(o_orderdate, '%Y-%m-%d') end as iso
                from x)
            select o_orderkey,
                cast(date_sub('year', cast(try_strptime(day_first, '%d/%m/%Y') as date),
                    date '2026-12-01') as integer) as age_pattern,
                cast(date_sub('year', try_cast(iso as date), date '2026-12-01') as integer) as age_iso
            from b""",
        "run_stamp": "select *, "
                     "date '2026-12-01' as processing_date, "
                     "timestamp '2026-12-01 06:30:00' as processing_ts from orders",
        "dedupe_latest": _DEDUPE_LATEST,
        "dedupe_latest_counted": """select * exclude (rn) from (
            select *, count(*) over (partition by o_custkey) as n_orders,
                row_number() over (partition by o_custkey
                    order by o_orderdate desc, o_orderkey desc) as rn from orders)
            where rn = 1""",
        "dedupe_mixed_text_order": """select * exclude (rn) from (
            select *, count(*) over (partition by o_custkey) as n_orders,
                row_number() over (partition by o_custkey order by year desc,
                    priority asc nulls last, o_orderstatus, o_orderkey desc) as rn
            from (select o_orderkey, o_custkey, cast(date_trunc('year', o_orderdate) as date) as year,
                    o_orderstatus, case when o_orderkey % 7 = 0 then null
                        else substr(o_orderpriority, 1, cast(1 + o_orderkey % 9 as bigint)) end as priority
                  from orders)) where rn = 1""",
        "dedupe_documents": f"""select doc_id, text_norm, lang, source from (
            select *, row_number() over (partition by text_norm
                order by doc_id, lang, source) as rn
            from (select doc_id, {_norm('text')} as text_norm, lang, source from documents))
            where rn = 1""",
        "dedupe_report": f"""select cast(sum(n) as bigint) as rows_before,
            cast(count(*) as bigint) as rows_after,
            cast(sum(n) - count(*) as bigint) as rows_removed,
            {_pct('sum(n) - count(*)', 'sum(n)')} as pct_removed
            from (select l_orderkey, l_linenumber, count(*) as n from lineitem
                  group by l_orderkey, l_linenumber)""",
        "completeness": _with({"g": EVENTS_WITH_GAPS_SQL}, completeness_sql("g", EVENT_COLS)),
        "duplicate_metrics": _with(
            {"x": "select case when o_orderkey % 50 = 0 then null else o_custkey end "
                  "as o_custkey from orders"},
            duplicates_sql("x", ["o_custkey"]),
        ),
        "describe_numeric": describe_sql("lineitem", LINEITEM_NUMERIC),
        "range_check": _with({"g": EVENTS_WITH_GAPS_SQL}, range_sql("g", EVENT_RULES)),
        "quality_report": _with(
            {"g": EVENTS_WITH_NULLS_SQL},
            report_sql("g", EVENT_COLS, ["event_id", "user_id", "value"], EVENT_RULES,
                       ["user_id"]),
        ),
        "clean_dedupe_profile": _with(
            _FLAGSHIP_CTES,
            completeness_sql("l", [("o_orderkey", False), ("o_custkey", False),
                                   ("priority", False), ("total", True),
                                   ("o_orderdate", False)]),
        ),
        "write_partitioned": "select * from orders",
        "write_layout": "select 'single' as layout, cast(1 as bigint) as n_files, "
                        "cast(count(*) as bigint) as n_rows from information_schema.columns "
                        "where table_name = 'part' union all "
                        "select 'four', cast(4 as bigint), cast(count(*) as bigint) from part",
        "write_modes": "select *, date '2024-01-01' as load_date from part union all "
                       "select *, date '2024-01-02' from part union all "
                       "select *, date '2024-01-03' from part",
        "write_overwrite_static": "select * from orders where o_orderstatus <> 'F'",
        "write_target_size": """select case when o_orderkey % 2 = 0 then 'hot' else o_orderstatus end as status,
            greatest(1, cast(ceil(sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority))
                / 40000.0) as bigint)) as n_files,
            count(*) as n_rows, cast(0 as bigint) as n_overlaps from orders group by 1""",
        "append_rerun_safe": "select * from orders",
        "ingest_archived": f"select * replace (cast(part as integer) as part) from ({_DROPS})",
        "ingest_skips_identical_files": "select * from orders",
        "ingest_incremental": "select * from events",
        "ingest_job_report": _ingest_report(),
        "ingest_report_history": _report_history(),
        "ingest_unique_across_runs": f"""select * exclude (part, rn) from (
            select *, row_number() over (partition by o_custkey
                order by part, o_orderdate desc, o_orderkey desc) as rn from ({_DROPS})) where rn = 1""",
        "metrics_merged": _with(
            {"g": EVENTS_WITH_NULLS_SQL},
            report_sql("g", EVENT_COLS, ["event_id", "user_id", "value"], EVENT_RULES,
                       ["user_id"]),
        ),
        "ingest_watermark_report": _with(
            {"g": "select *, cast(null as varchar) as note from events",
             "twice": "select * from g union all select * from g"},
            report_sql("g", [*EVENT_COLS, ("note", False)], ["event_id", "user_id", "value"], EVENT_RULES, [])
            + "\nunion all\n"
            + long_sql(duplicates_sql("twice", ["event_id"]), "duplicates", "key",
                       ["total", "n_unique", "n_duplicate", "pct_duplicate"]),
        ),
        "ingest_csv_text": "select * replace ('  ' || text || ' ' as text) from documents",
        "ingest_xml": part_all,
        "ingest_job_latest": """select * exclude (late, rn) from (
            select *, row_number() over (partition by late, o_custkey
                order by o_orderdate desc, o_orderkey desc) as rn
            from (select *, o_orderdate >= timestamp '1998-04-25' as late from orders))
            where rn = 1""",
        "prep_job": _with(_JOB_CTES, "select * from d"),
        "chain_steps": _with(_JOB_CTES, "select * from d"),
        "prep_job_conversions": """with m as (select cast(o_orderkey as varchar) as order_id,
                case when o_orderkey % 5 = 0 then '12/x' when o_orderkey % 7 = 0 then 'y'
                     else o_custkey || '/' || (o_orderkey % 100) end as pair,
                o_orderstatus || '/' || case when o_orderkey % 9 = 0 then 'none'
                     else cast(o_totalprice as varchar) end as tagged,
                case when o_orderkey % 11 = 0 then 'abc' when o_orderkey % 13 = 0 then '31/02/2000'
                     when o_orderkey % 17 = 0 then null
                     else strftime(o_orderdate, '%d/%m/%Y') end as born from orders),
            p as (select *, string_split(pair, '/')[1] as l, string_split(pair, '/')[2] as r,
                string_split(tagged, '/')[2] as t from m),
            n as (
                select 'order_id' as subject, count_if(try_cast(order_id as bigint) is null) as n from p
                union all select 'total', count_if(try_cast(t as double) is null) from p
                union all select 'left', count_if(l is not null and try_cast(l as integer) is null) from p
                union all select 'right', count_if(r is not null and try_cast(r as integer) is null) from p
                union all select 'age', count_if(born is not null
                    and try_strptime(born, '%d/%m/%Y') is null) from p)
            select 'conversion' as "check", subject, 'n_nulled' as metric,
                cast(n as double) as value from n""",
        "prep_job_quarantine": """with m as (select o_orderkey as k, o_custkey as c,
                case when o_orderkey % 11 = 0 then '31/02/2000'
                     else strftime(o_orderdate, '%d/%m/%Y') end as born,
                case when o_orderkey % 9 = 0 then 'n/a' else cast(o_totalprice as varchar) end as total,
                o_orderkey % 10 = 3 as malformed from orders),
            j as (select *, strftime(try_strptime(born, '%d/%m/%Y'), '%Y-%m-%d') as order_date,
                try_cast(total as double) as price from m),
            r as (select *, case when malformed then 'malformed record' else concat_ws('; ',
                    case when order_date is null then 'conversion of order_date' end,
                    case when price is null then 'conversion of total' end) end as reasons,
                case when malformed then k || ',' || c || ',' || born || ',' || total || ',more'
                    else '{"order_id":"' || k || '","customer_id":"' || c || '","order_date":"' || born
                        || '","total":"' || total || '"}' end as record from j),
            a as (select * from r where reasons = ''),
            n as (select 'n_read' as record, 'rows' as reasons, count(*) as n from r
                union all select 'n_accepted', 'rows', count(*) from a
                union all select 'n_rejected', 'rows', count_if(reasons <> '') from r
                union all select 'n_rejected', x, count_if(contains(reasons, x)) from r,
                    (select unnest(['malformed record', 'conversion of order_id', 'conversion of customer_id',
                        'conversion of order_date', 'conversion of total']) as x) group by x)
            select 'accepted' as side, k as order_id, c as customer_id, order_date, price as total,
                cast(null as varchar) as record, cast(null as varchar) as reasons
            from (select *, row_number() over (partition by c order by order_date desc, k desc) as rn from a)
            where rn = 1
            union all select 'rejected', null, null, null, null, record, reasons from r where reasons <> ''
            union all select 'counted', null, null, null, cast(n as double), record, reasons from n""",
        "prep_job_report": _with(
            {**_JOB_CTES,
             "b": "select * from e"},
            report_sql("d", _JOB_COLS, ["order_id", "customer_id", "total", "order_age"],
                       [{"column": "total", "min": 1000.0, "max": 500000.0}], [])
            + "\nunion all\n"
            + long_sql(
                "select 'customer_id' as key, cast(count(*) as bigint) as total, "
                "cast((select count(*) from d) as bigint) as n_unique, "
                "cast(count(*) - (select count(*) from d) as bigint) as n_duplicate, "
                + _pct("count(*) - (select count(*) from d)", "count(*)")
                + " as pct_duplicate from b",
                "duplicates", "key", ["total", "n_unique", "n_duplicate", "pct_duplicate"],
            )
            # the raw job input has no NULLs, so every NULL left in a converted
            # column was produced by the conversion
            + "\nunion all\n"
            + long_sql(
                "\nunion all\n".join(
                    f"select '{c}' as subject, count_if({c} is null) as n_nulled from d"
                    for c in ("order_date", "order_id", "customer_id", "total")
                )
                + "\nunion all\nselect 'order_age' as subject, "
                "count_if(order_age is null and order_date is not null) as n_nulled from d",
                "conversion", "subject", ["n_nulled"],
            ),
        ),
    }
    # the long (wide-table) layout must give exactly the same results
    sql["quality_report_long"] = sql["quality_report"]
    sql["describe_numeric_long"] = sql["describe_numeric"]
    return sql
