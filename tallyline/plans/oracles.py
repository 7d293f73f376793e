"""The same questions as SQL, one statement per query of the catalog."""

from __future__ import annotations

from tallyline.operators.generate import ADDRESS_LENGTH, CONTINENTS, MAX_ID, NAME_LENGTH
from tallyline.plans.feeds import CUSTOMERS_SQL, LINEITEMS_SQL, LINES_SQL, MESSAGES_SQL, ORDERS_SQL

_POWERS = [pow(10, k, 2**32) for k in range(32)]


def parsed(source: str, keep: str = "raw") -> str:
    """``source`` (a query with a column raw) with its four fields."""
    return f"""
    select {keep},
           case when len(f) >= 2 then (case when u >= 2147483648 then u - 4294967296 else u end)::int else 0 end as id,
           case when len(f) >= 3 then f[2] else '' end as name,
           case when len(f) >= 4 then f[3] else '' end as address,
           case when len(f) = 4 then f[4] else '' end as continent
    from (
      select *, coalesce(list_sum(list_transform(range(0, least(32, length(h) // 2)), lambda k:
               (((('0x' || substr(h, length(h) - 2 * k - 1, 2))::int::bigint - 48 + 256) % 256)
                * ({_POWERS}::bigint[])[k + 1]) % 4294967296)), 0)::hugeint % 4294967296 as u
      from (select *, string_split(raw, ',') as f, hex(encode(string_split(raw, ',')[1])) as h from ({source}) as s) as t
    ) as p"""


def numbered(source: str, *order: str) -> str:
    """line_no and raw of ``source`` sorted by the given columns, then raw."""
    return f"select row_number() over (order by {', '.join([*order, 'raw'])}) as line_no, * from ({parsed(source)}) as q"


def sorted_lines(source: str, *order: str) -> str:
    return f"select line_no, raw from ({numbered(source, *order)}) as n"


def fanout(source: str, label: str) -> str:
    return " union all ".join(
        f"select '{key}' as {label}, line_no, raw from ({numbered(source, key)}) as n_{key}"
        for key in ("id", "name", "continent")
    )


def _section(rows: str, name: str, low: str, high: str) -> str:
    return f"""
    select output, '{name}' as section, (line_no - greatest({low}, 1) + 1)::int as seq, line_no, line
    from ({rows}) as r_{name} where line_no between {low} and {high}"""


def samples(source: str) -> str:
    rows = f"""
    select output, line_no, raw as line, max(line_no) over (partition by output) as total
    from ({fanout(source, 'output')}) as f"""
    middle = "total // 2"
    return " union all ".join(
        [
            _section(rows, "head", "1", "3"),
            _section(rows, "mid", middle, f"{middle} + 2"),
            _section(rows, "tail", "total - 2", "total"),
            f"select distinct output, 'total' as section, 1::int as seq, total as line_no, null::varchar as line from ({rows}) as t",
        ]
    )


def one_section(source: str, key: str, low: str, high: str) -> str:
    return f"""
    select line_no, raw from (
      select line_no, raw, max(line_no) over () as total from ({numbered(source, key)}) as n
    ) as t where line_no between {low} and {high}"""


def violations(source: str, order: str, checks: dict[str, str]) -> str:
    """What the order check finds in ``source`` sorted by ``order``, for each named key."""
    return " union all ".join(
        f"""
    select '{name}' as output, count(*) as lines, count(*) filter (where k < before) as violations,
           min(line_no) filter (where k < before) as first_violation
    from (select line_no, {key} as k, lag({key}) over (order by line_no) as before
          from ({numbered(source, order or key)}) as n_{name}) as c_{name}"""
        for name, key in checks.items()
    )


def report_text(source: str) -> str:
    """The report with the outputs' names for paths."""
    texts = f"""
    select o, s, seq, case when section = 'total' then 'total lines path=' || output || ' total_lines=' || line_no
                           else '[' || section || '] path=' || output || ' line=' || line end as text
    from (select *, list_position(['id', 'name', 'continent'], output) as o,
                 list_position(['head', 'total', 'mid', 'tail'], section) as s from ({samples(source)}) as m) as x"""
    titles = " union all ".join(
        f"select {o}, {s}, 0, '{text}'"
        for o, name in enumerate(("id", "name", "continent"), start=1)
        for s, text in (
            (0, f"start sampling path={name}"),
            (1, f"=== head section === path={name}"),
            (3, f"=== mid section === path={name}"),
            (4, f"=== tail section === path={name}"),
        )
    )
    return f"select row_number() over (order by o, s, seq) as line_no, text from ({texts} union all {titles}) as a"


def _hex_number(digest: str, start: int, digits: int) -> str:
    return f"('0x' || substr({digest}, {start}, {digits}))::bigint"


def generated(source: str, row: str, seed: int) -> str:
    """The record the generator makes for every row of ``source``."""
    continents = "[" + ", ".join(f"'{c}'" for c in CONTINENTS) + "]"
    (n_low, n_high), (a_low, a_high) = NAME_LENGTH, ADDRESS_LENGTH
    return f"""
    select {row}, concat_ws(',',
             cast({_hex_number('b', 43, 8)} % {MAX_ID + 1} as varchar),
             rpad(translate(to_base64(unhex(a)), '0123456789+/=', ''),
                  ({_hex_number('b', 57, 4)} % {n_high - n_low + 1} + {n_low})::int, 'a'),
             rpad(translate(to_base64(unhex(substr(b, 1, 42))), '+/=', ' '),
                  ({_hex_number('b', 61, 4)} % {a_high - a_low + 1} + {a_low})::int, 'a'),
             {continents}[{_hex_number('b', 51, 6)} % {len(CONTINENTS)} + 1]) as raw
    from (select {row}, sha256('{seed}:' || {row} || ':first') as a, sha256('{seed}:' || {row} || ':second') as b
          from {source}) as d"""


_KNOWN = "('id', 'name', 'continent')"


def oracles() -> dict[str, str]:
    both_sorted = " union all ".join(
        f"select '{key}' as output, line_no, raw from ({numbered(f'(select raw from ({CUSTOMERS_SQL}) as c union all select raw from ({ORDERS_SQL}) as o)', key)}) as n"
        for key in ("id", "name", "continent")
    )
    return {
        "sort_by_name": sorted_lines(CUSTOMERS_SQL, "name"),
        "sort_by_id": sorted_lines(LINEITEMS_SQL, "id"),
        "sort_by_continent": sorted_lines(ORDERS_SQL, "continent"),
        "sort_hot_key": sorted_lines(LINEITEMS_SQL, "name"),
        "sort_in_two_steps": sorted_lines(LINEITEMS_SQL, "name"),
        "sort_hot_record": """
            select row_number() over (order by raw) as line_no, raw
            from (select concat_ws(',', '0', l_returnflag, '', l_linestatus) as raw from lineitem) as h""",
        "sort_malformed": sorted_lines(LINES_SQL, "id"),
        "sort_custom_key": sorted_lines(CUSTOMERS_SQL, "address desc", "id"),
        "sort_fanout": fanout(ORDERS_SQL, "sort_key"),
        "merge_runs": sorted_lines(f"select value as raw from ({MESSAGES_SQL}) as m", "id"),
        "line_numbers": sorted_lines(ORDERS_SQL, "name"),
        "line_numbers_by_counting": sorted_lines(ORDERS_SQL, "name"),
        "parse_records": parsed(CUSTOMERS_SQL),
        "parse_malformed": parsed(LINES_SQL, "doc_id, raw"),
        "parse_lenient_id": f"select doc_id, id from ({parsed('select doc_id, text as raw from documents', 'doc_id')}) as p",
        "encode_record": LINEITEMS_SQL.replace("l_linenumber, ", "", 1),
        "payload_bytes": "select doc_id, strlen(text)::bigint as payload_bytes from documents",
        "normalise_lines": LINES_SQL,
        "key_from_path": """
            select doc_id, lang || '_' || source as path, source as key from documents union all
            select doc_id, source as path, source as key from documents union all
            select doc_id, lang || '_' as path, lang || '_' as key from documents""",
        "filter_topic": f"select \"offset\", value from ({MESSAGES_SQL}) as m where topic = 'source'",
        "stream_source": f"select value as raw from ({MESSAGES_SQL}) as m where topic = 'source'",
        "size_cut_batches": ORDERS_SQL,
        "drain_until_count": ORDERS_SQL,
        "drain_until_idle": f"{ORDERS_SQL} union all {CUSTOMERS_SQL}",
        "flush_by_size_and_clock": f"select raw, 'size,clock' as flushes from ({ORDERS_SQL} union all {CUSTOMERS_SQL}) as r",
        "run_progress": f"""
            select 'ingest' as step, count(*) as records, sum(strlen(raw))::bigint as payload_bytes, 0::bigint as dropped, true as ended
            from ({ORDERS_SQL}) as o
            union all select 'sort', 3 * count(*), 3 * sum(strlen(raw))::bigint, 0, true from ({ORDERS_SQL}) as o""",
        "multi_topic_source": f"select topic, \"offset\", value from ({MESSAGES_SQL}) as m where topic in {_KNOWN}",
        "scan_lines": f"select raw from ({LINEITEMS_SQL}) as l",
        "topic_sink": f"select raw as value from ({ORDERS_SQL}) as o",
        "ordered_topic_sink": sorted_lines(ORDERS_SQL, "continent"),
        "sorted_files_roundtrip": fanout(CUSTOMERS_SQL, "output"),
        "route_by_topic": f"select topic, value from ({MESSAGES_SQL}) as m where topic in {_KNOWN}",
        "routed_counts": f"""
            select count(*) filter (where topic in {_KNOWN}) as routed,
                   count(*) filter (where topic not in {_KNOWN}) as rejected
            from ({MESSAGES_SQL}) as m""",
        "stream_fanout": f"select topic, \"offset\", value from ({MESSAGES_SQL}) as m where topic in {_KNOWN}",
        "resume_with_late_data": "select value as raw from (" + MESSAGES_SQL + ") as m",
        "run_counters": f"""
            select count(*) filter (where topic = 'source') as records,
                   sum(strlen(value)) filter (where topic = 'source')::bigint as payload_bytes,
                   count(*) filter (where topic <> 'source') as rejected
            from ({MESSAGES_SQL}) as m""",
        "carry_on_roundtrip": both_sorted,
        "kafka_rows_roundtrip": both_sorted,
        "ingested_batches": f"""
            select 1 as batches_ok, count(*) as records, sum(strlen(raw))::bigint as payload_bytes from ({LINEITEMS_SQL}) as l""",
        "batch_stats": f"""
            select l_linenumber::bigint as batch_id, count(*) as records, sum(strlen(raw))::bigint as payload_bytes
            from ({LINEITEMS_SQL}) as l group by l_linenumber""",
        "emitted_counts": " union all ".join(
            f"select '{key}' as sort_key, count(*) as emitted from orders" for key in ("id", "name", "continent")
        ),
        "sample_head": one_section(LINEITEMS_SQL, "continent", "1", "3"),
        "sample_mid": one_section(LINEITEMS_SQL, "continent", "total // 2", "total // 2 + 2"),
        "sample_tail": one_section(LINEITEMS_SQL, "continent", "total - 2", "total"),
        "key_extremes": f"""
            select output, min(raw) filter (where line_no = 1) as first_raw, min(raw) filter (where line_no = total) as last_raw
            from (select *, max(line_no) over (partition by output) as total from ({fanout(LINEITEMS_SQL, 'output')}) as f) as t
            group by output""",
        "sample_report": samples(ORDERS_SQL),
        "sample_tables": samples(LINEITEMS_SQL),
        "report_text": report_text(ORDERS_SQL),
        "report_sink": report_text(ORDERS_SQL),
        "count_per_output": " union all ".join(
            f"select '{key}' as output, count(*) as lines from orders" for key in ("id", "name", "continent")
        ),
        "count_check": " union all ".join(
            f"""select '{key}' as output, (select count(*) from lineitem) as expected, count(*) as actual,
                       count(*) = (select count(*) from lineitem) as ok from orders"""
            for key in ("id", "name", "continent")
        ),
        "order_check": violations(LINEITEMS_SQL, "", {"id": "id", "name": "name", "continent": "continent"}),
        "order_check_unsorted": violations(
            ORDERS_SQL, "name", {"by_id": "id", "by_name": "name", "by_address": "address", "by_continent": "continent"}
        ),
        "generate_records": "select raw from ("
        + generated("(select l_orderkey * 8 + l_linenumber as n from lineitem) as l", "n", 3)
        + ") as g",
        "generate_for_rows": generated("orders", "o_orderkey", 7),
    }
