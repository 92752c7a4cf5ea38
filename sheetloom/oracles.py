"""The same results in SQL, written from what the text was made of rather than by parsing it again."""

from datetime import date, timedelta

from .fixtures import MONTHS, SIZES, TYPES

# --- shared parts

LINE = """fx_line as (
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_quantity,
           (l_shipdate + interval 28 year)::date as ship_date
    from lineitem)"""

WEEK = """fx_span as (select min(date_trunc('week', ship_date)) as a, max(date_trunc('week', ship_date)) as b from fx_line),
fx_week as (
    select row_number() over (order by monday) as col_idx, monday,
           'F' || strftime(monday, '%y') || '-' || strftime(monday, '%m%d') as period
    from (select unnest(generate_series(a::timestamp, b::timestamp, interval 7 day))::date as monday from fx_span))"""

PLAN_CELL = """fx_part_week as (
    select l_partkey, date_trunc('week', ship_date)::date as monday, cast(sum(l_quantity) as bigint) as n
    from fx_line group by all),
fx_plan_cell as (
    select p.p_partkey, p.p_type, w.col_idx, w.monday, coalesce(q.n, 0) as n, (p.p_partkey + w.col_idx) % 7 as kind,
           case when w.col_idx % 50 = 0 then 'Unknown' else w.period end as period
    from part p cross join fx_week w
    left join fx_part_week q on q.l_partkey = p.p_partkey and q.monday = w.monday)"""

CELL_TEXT = """case kind when 0 then '-' when 1 then null when 2 then '$' || n
    when 3 then format('{:,}', n * 1000) when 4 then '-' || n else n::varchar end"""

DATE_TEXT = """case %(kind)s when 0 then strftime(%(d)s, '%%-m/%%-d/%%Y') when 1 then strftime(%(d)s, '%%-m/%%-d/%%y')
    else (%(d)s - date '1899-12-30')::varchar end"""

SIGNED = "case kind when 0 then null when 1 then null when 3 then n * 1000 when 4 then -n else n end::double"

FORECAST_CELL = """fx_size_week as (
    select p_size, date_trunc('week', ship_date)::date as monday, cast(sum(l_quantity) as bigint) as n
    from fx_line join part on p_partkey = l_partkey group by all),
fx_forecast_cell as (
    select s.p_size, w.col_idx as week, w.monday, w.period, coalesce(q.n, 0) as n, (s.p_size + day(w.monday)) % 6 as kind,
           case when w.monday in (select ship_date from fx_line) then w.monday end as dated
    from (select distinct p_size from part) s cross join fx_week w
    left join fx_size_week q on q.p_size = s.p_size and q.monday = w.monday)"""

FORECAST_TEXT = """case kind when 0 then '(' || n || ')' when 1 then 'n/a' when 2 then '-' || n
    when 3 then null when 4 then n || '.5' else n::varchar end"""

UNSIGNED = "case kind when 1 then 0 when 3 then 0 when 4 then n + 1 else n end::double"
SKU = "case when p_size % 5 = 0 then 'SK-' || p_size else p_size::varchar end"


def item_of(prefix: str) -> str:
    filled = f"'{prefix}' || {SKU}" if prefix else "null"
    return f"case when p_size % 3 = 0 then {filled} else (9000 + p_size)::varchar end"


PLAN_LINE = LINE + """, fx_plan as (
    select l_orderkey, l_linenumber, l_returnflag, 'F' || strftime(ship_date, '%y-%m') as "Period",
           case when l_linenumber <> 7 then ship_date end as "Date", l_partkey::varchar as "Item", l_quantity, l_partkey,
           case when l_returnflag = 'A' then 'Alexandria' end as "City", case when l_returnflag = 'A' then 'Virginia' end as "State",
           case l_returnflag when 'A' then 'ALEX' when 'N' then 'SAN' else 'STER' end as "Location" from fx_line),
keyed as (select *, "Period" || coalesce('-' || "Date"::varchar, '') || '-' || "Item" || '-' || "Location" as "PDIL" from fx_plan)"""

PLAN_COLUMNS = '"PDIL", "Period", "Date", "Item", "Planning_Value", "Location", "City", "State"'


def plans(name: str, lines: str, missing: str, more: str = "") -> str:
    return f"""{name} as (select "PDIL", "Period", "Date", "Item", "Location", "City", "State",
        case when l_linenumber not in ({missing}) then l_quantity{more} end as "Planning_Value" from keyed where {lines})"""


ALL = plans("rows", "true", "6")
EARLIER = plans("earlier", "l_linenumber <= 4", "4")
LATER = plans("later", "l_linenumber >= 3", "3, 6", " + case when l_partkey % 5 = 0 then 1 else 0 end")


def unique(name: str, source: str) -> str:
    return f"""{name} as (select {PLAN_COLUMNS} from (select *, row_number() over (
        partition by "PDIL" order by "Planning_Value" desc nulls last) as rn from {source}) where rn = 1)"""


UNIQUE = f"with {PLAN_LINE}, {ALL}, {unique('u', 'rows')}"
MERGE = f"""with {PLAN_LINE}, {EARLIER}, {LATER}, {unique('s', 'later')}, {unique('e', 'earlier')},
t as (select row_number() over (order by "PDIL") as "PrimaryKey", * from e)"""
STATE = """state as (
    select t."PrimaryKey", t."PDIL", t."Period", t."Date", case when c then s."Item" else t."Item" end as "Item",
           case when c then s."Planning_Value" else t."Planning_Value" end as "Planning_Value", t."Location", t."City", t."State"
    from (select t.*, coalesce(s."Planning_Value" is not null and s."Planning_Value" is distinct from t."Planning_Value", false) as c
          from t left join s using ("PDIL")) t left join s using ("PDIL")),
fresh as (select row_number() over (order by "PDIL") + (select max("PrimaryKey") from t) as "PrimaryKey", *
          from s where "PDIL" not in (select "PDIL" from t))"""
PLAN_FACT = f'"PrimaryKey", {PLAN_COLUMNS}'

FORECAST_LINE = LINE + """, shaped as (
    select l_linenumber, l_returnflag, 'F' || strftime(ship_date, '%y-%m') as "Period", case when l_linenumber <> 7 then ship_date end as "Date",
           case when l_linenumber <> 5 then 'SK-' || l_suppkey end as "SKU", case when l_linenumber <> 5 then l_partkey::varchar end as "Item",
           l_quantity as "Forecast_Value", case l_returnflag when 'R' then 'STER' else 'SAN' end as "Location" from fx_line),
fkeyed as (select *, "Period" || coalesce('-' || "Date"::varchar, '') || '-' || coalesce("Item", 'NA') || '-' || "Location" as "PDIL" from shaped)"""
FORECAST_COLUMNS = '"PDIL", "Period", "Date", "SKU", "Item", "Forecast_Value", "Location"'
BY_FORECAST = '"PDIL", "SKU" nulls first, "Item" nulls first, "Forecast_Value"'
REPLACE = f"""with {FORECAST_LINE},
t as (select row_number() over (order by {BY_FORECAST}) as "IndexKey", {FORECAST_COLUMNS} from fkeyed where l_linenumber <= 5),
s as (select {FORECAST_COLUMNS} from fkeyed where l_linenumber >= 3)"""
REPLACED = f"""{REPLACE}
select "IndexKey", {FORECAST_COLUMNS} from t where "PDIL" not in (select "PDIL" from s)
union all select row_number() over (order by {BY_FORECAST}) + (select max("IndexKey") from t), {FORECAST_COLUMNS} from s"""

TEXT_LINE = LINE + """, tx as (
    select *, l_quantity::bigint as n, l_linenumber as kind, l_partkey::varchar as key,
        case when l_quantity = 13 then '13/45/2026' when l_linenumber = 1 then strftime(ship_date, '%-m/%-d/%Y')
             when l_linenumber = 2 then strftime(ship_date, '%m/%d/%y') when l_linenumber = 3 then ' ' || (ship_date - date '1899-12-30')
             when l_linenumber = 4 then (ship_date - date '1899-12-30') || '.75' when l_linenumber = 5 then ship_date::varchar
             when l_linenumber = 6 then ship_date || ' 00:00:00' else strftime(ship_date, '%-m/%-d/%Y') || ' 0:00' end as date_text,
        case when n = 13 then '5-3' when kind = 1 then '$ ' || n when kind = 2 then format('{:,}', n * 1000) when kind = 3 then '-' || n
             when kind = 4 then '(' || n || ')' when kind = 5 then '-' when kind = 6 then null else n || '.5' end as quantity_text,
        case kind when 1 then key when 2 then key || '.0' when 3 then ' ' || key || '.0 ' when 4 then 'AB-' || key
             when 5 then 'AB-' || key || '.0' when 6 then ' ' end as code_text,
        'F' || strftime(ship_date, '%y-%m') as period
    from fx_line)"""


def cleaned(source: str, output: str) -> str:
    return f'with {TEXT_LINE} select {source} as "input", {output} as "output" from tx'


WEEKS = 357  # Mondays in the seven years of line items


def monday_periods() -> list[str]:
    first = date(2023, 1, 2)
    return [(first + timedelta(days=7 * i)).strftime("F%y-%m%d") for i in range(WEEKS)]


LISTED = """seen as (select 'res_' || user_id as resource, user_id, max(ts) filter (event_type in ('click', 'view')) as m from events group by all),
listing as (select resource, user_id, m, case user_id % 4 when 0 then strftime(m, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(m, '%Y-%m-%dT%H:%M:%S.%f')
    when 2 then strftime(m, '%Y%m%dT%H%M%S') else 'garbage' end as modified from seen),
entries as (select 'res_' || user_id as resource, case event_id % 6 when 2 then ts when 4 then ts when 5 then null else date_trunc('second', ts) end as t,
    case event_id % 6 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts + interval 330 minute, '%Y-%m-%dT%H:%M:%S+05:30')
        when 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') when 3 then strftime(ts, '%Y%m%dT%H%M%S') when 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' else 'garbage' end as ingestion_date,
    'landing/res_' || user_id || '/res_' || user_id || '.xlsx' as file_path from events where event_type = 'purchase' and user_id % 10 <> 0),
latest as (select resource, t, ingestion_date as last_ingested from (select *, row_number() over (partition by resource order by t desc nulls last, ingestion_date desc) as rn from entries) where rn = 1),
decided as (select l.resource, l.modified, e.last_ingested,
    case when e.t is null or l.user_id % 4 = 3 or l.m is null then true when l.user_id % 4 = 1 then e.t < l.m
         else e.t < date_trunc('second', l.m) end as is_due from listing l left join latest e using (resource))"""

BRAND_ROW = " + ".join(f"case when p_type = '{t}' then {i + 1} else 0 end" for i, t in enumerate(TYPES))
MONTH_SUMS = ", ".join(f"sum(case when month(ship_date) = {m} then l_quantity end)::bigint as m{m}" for m in range(1, 13))
MONTH_BLANK = ["'-'", "' - '", "''", "'–'", "'- 0'", "null"]
MONTH_TEXT = [f"coalesce(m{m}::varchar, {MONTH_BLANK[m % 6]})" for m in range(1, 13)]
MONTH_TOTAL = "(" + " + ".join(f"coalesce(m{m}, 0)" for m in range(1, 13)) + ")::varchar"
MONTH_NAMES = ["Category", "SubCategory", "Customer", *[f"FY_26_{m}_26" for m in MONTHS], "All_Total", "All_Total_1"]
MONTH_HEADS = [
    [None, None, None, *["FY 26"] * 12, "All", "All"],
    ["Brand", "Type", "Size", *[f"{m}-26" for m in MONTHS], "Total", "Total"],
]


def text(value: str | None) -> str:
    return "null::varchar" if value is None else f"'{value}'"


def months(names: list[str], wrap=lambda name, c: c, first: int = 0) -> str:
    """The month sheet without its empty row, each column through ``wrap``."""
    body = ["p_brand", "p_type", "p_size::varchar", *MONTH_TEXT, MONTH_TOTAL, MONTH_TOTAL]
    inner = ", ".join(f"{c} as c{i}" for i, c in enumerate(body))
    heads = " ".join(
        f"union all select {r + 1}, " + ", ".join(text(v) for v in head) for r, head in enumerate(MONTH_HEADS)
    )
    outer = ", ".join(f'{wrap(names[i - first], f"c{i}")} as "{names[i - first]}"' for i in range(first, 17))
    return f"""with {LINE}, sums as (select p_brand, p_type, p_size, {MONTH_SUMS} from fx_line join part on p_partkey = l_partkey group by all),
        whole as (select (regexp_extract(p_brand, '([0-9]+)$', 1)::bigint * 6 + {BRAND_ROW}) * {SIZES} + p_size + 3 as row_idx, {inner} from sums {heads})
        select row_idx, {outer} from whole"""


def plain_names() -> list[str]:
    return ["unnamed", *[f"FY_26_{m}_26" for m in MONTHS], "All_Total", "All_Total_1"]


ZERO = "case when {c} in ('-', '–', '—', '', ' ', '- 0', '0.0') then '0' else {c} end"


def is_period_name(name: str) -> bool:
    return any(p in name.lower() for p in ["fy", "total", *[m.lower() for m in MONTHS]])


PLAN_WIDE = ", ".join(f"max(case when col_idx = {i} then t end) as _c{i}" for i in range(1, WEEKS + 1))
HEAD_WIDE = {
    "period": ", ".join(f"max(case when col_idx = {i} then p end)" for i in range(1, WEEKS + 1)),
    "day": ", ".join("'Mon'" for _ in range(WEEKS)),
    "date": ", ".join(f"max(case when col_idx = {i} then d end)" for i in range(1, WEEKS + 1)),
}
ITEM_TEXT = "p_partkey || case when p_partkey % 2 = 0 then '.0' else '' end"
PLAN = f"with {LINE}, {WEEK}, {PLAN_CELL}"
FORECAST = f"with {LINE}, {WEEK}, {FORECAST_CELL}"
LONG_PLAN = f"""{PLAN} select p_partkey::varchar as "Item", period as "Period", monday as "Date", {SIGNED} as "Planning_Value",
    'San Antonio' as "City", 'Texas' as "State" from fx_plan_cell where p_partkey <> 0"""


PERIOD_CELL = "case when col_idx % 50 = 0 then null when col_idx % 10 = 3 then chr(160) || period || chr(10) else ' ' || period end"


def filled(period: str, sku: str, kind3: str) -> str:
    """The earliest melts: header texts as they stand, only dates with a four-digit year; the week row, which carries another name here, is an item like any other."""
    value = f"case kind when 0 then 0 when 1 then null when 2 then null when 3 then {kind3} when 4 then -n else n end::double"
    return f"""{PLAN}, named as (select col_idx, {period} as p, case when col_idx % 3 = 0 and col_idx % 5 <> 2 then monday end as d
            from (select col_idx, monday, {PERIOD_CELL} as raw from fx_week))
        select {sku} as "SKU", p as "Period", d as "Date", {value} as "Value", 'San Antonio' as "City", 'Texas' as "State" from fx_plan_cell join named using (col_idx)
        union all select 'DofW', p, d, null, 'San Antonio', 'Texas' from named"""


def long_forecast(prefix: str, extra: str = '"Date"') -> str:
    return f"""{FORECAST} select period as "Period", dated as "Date", {SKU} as "SKU", {item_of(prefix)} as "Item",
        {UNSIGNED} as "Forecast_Value" from fx_forecast_cell"""


DAYS = f"with {LINE}, days as (select distinct ship_date as d, 'F' || strftime(date_trunc('week', ship_date), '%y-%m%d') as period from fx_line)"


def forecast_rows() -> str:
    """The forecast sheet from its first period row down, all cells."""
    cells = ", ".join(f"max(case when p_size = {s} then t end) as _c{s}" for s in range(1, SIZES + 1))
    tail = ", ".join("'1'" for _ in range(SIZES)) + ", null"
    return f"""{FORECAST}, t as (select week, period, p_size, {FORECAST_TEXT} as t from fx_forecast_cell)
        select week + 6 as row_idx, period || ' ' as _c0, {cells}, '7' as _c{SIZES + 1} from t group by week, period
        union all select max(col_idx) + 7, 'Total Cases', {tail} from fx_week
        union all select max(col_idx) + 8, '2024.5', {tail} from fx_week
        union all select max(col_idx) + 9, null, {tail} from fx_week"""


def transposed() -> str:
    half_even = "case kind when 5 then n when 2 then -n when 4 then (case when n % 2 = 0 then n else n + 1 end) else 0 end"
    weeks = ", ".join(f"max(case when period = '{p}' then v end) as \"{p}\"" for p in monday_periods())
    blank = ", ".join("7::bigint" for _ in range(WEEKS))
    return f"""{FORECAST}, t as (select p_size, period, ({half_even})::bigint as v from fx_forecast_cell)
        select {SKU} as "Sku", '_c' || p_size as "Period", 1::bigint as "Total Cases", 1::bigint as "2024.5", {weeks} from t group by p_size
        union all select null, '_c{SIZES + 1}', 0, 0, {blank}"""


REFRESH_SITES = {"STANDARD": ("SAN", 0), "SMALL": ("STER", 1), "MEDIUM": ("SAN", 2), "ECONOMY": ("STER", 3), "PROMO": ("STER", 3), "LARGE": ("ALEX", 4)}
REFRESH_TABLES = [
    "Vert_SAN_Plan_FY2025", "Vert_STER_Plan_FY2025", "Vert_SAN_Plan_FY2026", "Vert_STER_Plan_FY2026", "Vert_ALEX_Plan_FY2026",
    "Forecast_SAN_FY2025", "Forecast_STER_FY2025", "Forecast_SAN_FY2026", "Forecast_STER_FY2026",
]
REFRESH_CITIES = ["San Antonio", "Sterling", "San Antonio", "Sterling", "Alexandria", "San Antonio", "Sterling", "San Antonio", "Sterling"]
PLAN_SHEET = "case p_type " + " ".join(f"when '{t}' then {i}" for t, (_, i) in REFRESH_SITES.items()) + " end"
LINE_SHEET = "case when l_returnflag = 'R' then case when l_linestatus = 'F' then 6 else 8 end when l_returnflag = 'N' and l_linestatus = 'F' then 5 else 7 end"
REFRESH = f"""{PLAN}, fx_sheet_week as (
    select {LINE_SHEET} as sheet, p_size, date_trunc('week', ship_date)::date as monday, cast(sum(l_quantity) as bigint) as n
    from fx_line join part on p_partkey = l_partkey group by all),
plan_cells as (select {PLAN_SHEET} as sheet, p_partkey::varchar as item, period, monday, {SIGNED} as v from fx_plan_cell where p_partkey <> 0),
sheet_cells as (
    select h.sheet, s.p_size, w.monday, w.period, coalesce(q.n, 0) as n, (s.p_size + day(w.monday)) % 6 as kind,
           case when w.monday in (select ship_date from fx_line) then w.monday end as dated
    from (select unnest([5, 6, 7, 8]) as sheet) h cross join (select distinct p_size from part) s cross join fx_week w
    left join fx_sheet_week q on q.sheet = h.sheet and q.p_size = s.p_size and q.monday = w.monday),
forecast_cells as (
    select sheet, period, dated, {SKU} as sku, case when sheet in (5, 7) then {item_of('600')} else {item_of('200')} end as item, {UNSIGNED} as v from sheet_cells)"""


def refresh_summary(again: bool = False) -> str:
    """After a first refresh, or after one more in which all forecasts were replaced."""
    after = " + (select count(*) from f)" if again else ""
    taken = ", 0::bigint as n_taken" if again else ""
    return f"""{REFRESH}, times as (select user_id % 9 as sheet, max(ts) filter (event_type in ('click', 'view')) as m, max(ts) filter (event_type = 'purchase') as t
        from events group by 1), due as (select sheet from times where m is not null and (t is null or t < m)),
    p as (select case when sheet in (0, 2) then 'SAN' when sheet in (1, 3) then 'STER' else 'ALEX' end as loc, *,
        period || '-' || monday || '-' || item || '-' || loc as k from plan_cells where sheet in (select sheet from due)),
    pn as (select loc, v, row_number() over (order by k) as i from p),
    f as (select case when sheet in (5, 7) then 'SAN' else 'STER' end as loc, *, period || coalesce('-' || dated, '') || '-' || item || '-' || loc as k
        from forecast_cells where sheet in (select sheet from due)),
    fn as (select loc, v, row_number() over (order by k, sku, item, v){after} as i from f)
    select 'plan_fact' as fact, loc as "Location", count(*) as n_rows, min(i) as first_key, max(i) as last_key, sum(i * v)::bigint as weighted, sum(v)::bigint as total{taken} from pn group by loc
    union all select 'forecast_fact', loc, count(*), min(i), max(i), sum(i * v)::bigint, sum(v)::bigint{taken} from fn group by loc"""


def source_summary() -> str:
    names = "[" + ", ".join(f"'{t}'" for t in REFRESH_TABLES) + "]"
    cities = "[" + ", ".join(f"'{c}'" for c in REFRESH_CITIES) + "]"
    return f"""{REFRESH}, both_kinds as (select sheet, monday, v from plan_cells union all select sheet, dated, v from forecast_cells)
    select {names}[sheet + 1] as source_table, {cities}[sheet + 1] as city, count(*) as n_rows, count(monday) as n_dated, sum(v)::bigint as total from both_kinds group by sheet"""


LOOKUP = """select case p_partkey % 4 when 0 then p_partkey when 1 then p_partkey when 2 then p_partkey * 10 end::bigint as item,
    p_name as name, p_brand as brand, p_type as type, p_size::varchar as size from part"""
PLAN_UNION = f"""with {PLAN_LINE}, {ALL} select "Period", "Date", "Item", "Planning_Value", "City", "State", "Location" from rows"""
FORECAST_KEYED = f"with {FORECAST_LINE} select {FORECAST_COLUMNS} from fkeyed"

ORACLES: dict[str, str] = {
    # scans, sources, sinks
    "scan_range": f"""{PLAN}, t as (select p_partkey, col_idx, {CELL_TEXT} as t from fx_plan_cell),
        v as (select *, {DATE_TEXT % {'kind': 'col_idx % 3', 'd': 'monday'}} as t from fx_week),
        w as (select col_idx, {PERIOD_CELL} as p, case when col_idx % 5 = 2 then chr(160) || t || chr(9) else t end as d from v)
        select p_partkey + 6 as row_idx, {ITEM_TEXT} as _c0, {PLAN_WIDE} from t group by p_partkey
        union all select 2, ' Period ', {HEAD_WIDE['period']} from w union all select 3, 'DofW', {HEAD_WIDE['day']}
        union all select 4, 'DATE', {HEAD_WIDE['date']} from w""",
    "scan_lookup": LOOKUP,
    "lookup_table": LOOKUP,
    "scan_calendar": f"""{DAYS} select d - (select min(date_trunc('week', d))::date from days) + 2557 as row_idx,
        {DATE_TEXT % {'kind': 'day(d) % 3', 'd': 'd'}} as raw_date, period as "Period" from days""",
    "scan_table": f"with {LINE} select * from fx_line",
    "scan_inferred": """select p_partkey + 1 as row_idx, p_partkey as part, case when p_partkey % 10 <> 0 then p_size end::bigint as size,
        p_retailprice as price, p_partkey % 2 = 0 as is_even, date '2024-01-01' + p_size as day, p_name as name from part""",
    "source_specs": source_summary(),
    "skip_missing_sources": PLAN_UNION,
    "sink_create_or_overwrite": f"with {PLAN_LINE}, {ALL} select {PLAN_COLUMNS} from rows",
    "sink_create_or_replace": FORECAST_KEYED,
    "sink_publish_version": f"with {PLAN_LINE}, {ALL} select layout, {PLAN_COLUMNS} from rows cross join (values ('plain'), ('partitioned'), ('bucketed')) v(layout)",
    "sink_append": f"with {PLAN_LINE}, {EARLIER}, {LATER} select {PLAN_COLUMNS} from earlier union all select {PLAN_COLUMNS} from later",
    "temp_view": f"""with {PLAN_LINE} select "Location", count(*) as n_rows, count(distinct "PDIL") as n_keys from keyed group by 1""",
    # grids
    "find_label_row": f"""{PLAN} select 2::bigint as row_idx, ' Period ' as label, ' ' || period as first_cell from fx_week where col_idx = 1
        union all select 3, 'DofW', 'Mon'""",
    "column_map": f"""{PLAN} select col_idx::int as col_idx, case when col_idx % 50 = 0 then 'Unknown' else period end as period,
        {DATE_TEXT % {'kind': 'col_idx % 3', 'd': 'monday'}} as date_text, monday as date from fx_week""",
    "data_rows": f"""{PLAN}, t as (select p_partkey, col_idx, {CELL_TEXT} as t from fx_plan_cell)
        select p_partkey + 6 as row_idx, {ITEM_TEXT} as _c0, {PLAN_WIDE} from t group by p_partkey""",
    "melt_plan": LONG_PLAN,
    "plan_sheet_to_long": LONG_PLAN,
    "attach_site": "select p_partkey, p_name, 'Sterling' as \"City\", 'Virginia' as \"State\" from part",
    "find_sku_header": """select 'sku' as header, 4::bigint as row_idx, min(p_size) || '.0' as _c1, 'SK-' || (min(p_size) + 4) as _c5 from part
        union all select 'item', 2, ' ' || (9000 + min(p_size)) || '.0', ' ' || (9004 + min(p_size)) || '.0' from part""",
    "find_data_start": f"""{FORECAST}, t as (select *, {FORECAST_TEXT} as t from fx_forecast_cell where week = 1)
        select 7::bigint as row_idx, period || ' ' as _c0, max(case when p_size = 1 then t end) as _c1, max(case when p_size = 2 then t end) as _c2 from t group by period""",
    "header_pairs": """select distinct p_size as col_idx, case when p_size % 3 <> 0 then (9000 + p_size) || '.0' end as item,
        case when p_size % 5 = 0 then 'SK-' || p_size else p_size || '.0' end as sku from part""",
    "rows_from": forecast_rows(),
    "melt_forecast": long_forecast("200"),
    "forecast_sheet_to_long": long_forecast("600"),
    "calendar_left_join": long_forecast(""),
    "melt_stack": filled("coalesce(replace(raw, '-', '_'), 'UNKNOWN_' || (col_idx - 1))", ITEM_TEXT, "case when n = 0 then 0 end"),
    "melt_crossjoin": filled("raw", "p_partkey::varchar", "n * 1000"),
    "melt_plan_v4": f"""{PLAN} select p_partkey::varchar as sku, replace(period, '-', '_') as period, monday as date, {SIGNED} as value, 'San Antonio' as city, 'Texas' as state from fx_plan_cell
        union all select 'DofW', case when col_idx % 50 = 0 then 'Unknown' else replace(period, '-', '_') end, monday, null, 'San Antonio', 'Texas' from fx_week""",
    "label_cross_join": f"""{PLAN} select p_partkey::varchar as item, col_idx::int as col_idx, {CELL_TEXT} as cell, period, monday as date from fx_plan_cell""",
    "transpose_wide": transposed(),
    "transpose_tiles": f"""{FORECAST} select {SKU} as "Sku", '_c' || p_size as "Column", period as "Period",
        (case kind when 5 then n when 2 then -n when 4 then n + n % 2 else 0 end)::bigint as cell from fx_forecast_cell""",
    "pivot_first": f"""with {LINE}, f as (select l_orderkey, l_linenumber, l_quantity, row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, ship_date, l_quantity) as rn from fx_line)
        select l_orderkey, {", ".join(f"max(case when l_linenumber = {i} then l_quantity end) as line_{i}" for i in range(1, 8))} from f where rn = 1 group by 1""",
    "two_row_header": months(MONTH_NAMES),
    "two_row_header_plain": months(plain_names(), first=2),
    "drop_empty_rows": months([f"_c{i}" for i in range(17)]),
    "normalize_placeholders": months(MONTH_NAMES, lambda name, c: ZERO.format(c=c)),
    "placeholders_to_null": months(MONTH_NAMES, lambda name, c: f"case when trim({c}) not in ('-', '') then {c} end"),
    "cast_period_columns": months(MONTH_NAMES, lambda name, c: f"try_cast({c} as double)" if is_period_name(name) else c),
    "clean_columns": "select p_partkey as part_key, p_name as name_of_part, p_brand as brand_no, p_type as kind from part",
    "unique_columns": 'select p_partkey as a, p_name as a_1, p_brand as a_1_1, p_type as b, p_size as b_1 from part',
    "positional_columns": "select p_partkey as c0, p_name as c1, p_brand as c2, p_type as c3, p_size as c4, p_retailprice as c5 from part",
    "swap_columns": "select p_size as first, p_name as second, p_partkey as third from part",
    "drop_if_present": "select p_partkey, p_name, p_brand, p_type, p_size from part",
    "row_index": f"""with r as (select p_partkey + 6 as row_idx, {ITEM_TEXT} as _c0 from part union all values (2, ' Period '), (3, 'DofW'), (4, 'DATE'))
        select row_number() over (order by row_idx) - 1 as row_index, row_idx, _c0 from r""",
    "preview_rows": f"""{PLAN}, t as (select p_partkey + 6 as row_idx, {ITEM_TEXT} as _c0, {CELL_TEXT} as _c1 from fx_plan_cell where col_idx = 1
        union all select 2, ' Period ', ' ' || period from fx_week where col_idx = 1 union all select 3, 'DofW', 'Mon'
        union all select 4, 'DATE', {DATE_TEXT % {'kind': 'col_idx % 3', 'd': 'monday'}} from fx_week where col_idx = 1)
        select * from t order by row_idx limit 25""",
    # cleaning rules
    "parse_mixed_date": cleaned("date_text", "case when n <> 13 then ship_date end"),
    "excel_serial_date": cleaned("date_text", "case when n <> 13 and kind in (3, 4) then ship_date end"),
    "calendar_date": cleaned("date_text", "case when n <> 13 and kind not in (5, 6) then ship_date end"),
    "clean_item": cleaned("code_text", "case kind when 1 then key when 2 then key when 3 then key when 4 then 'AB-' || key when 5 then 'AB-' || key || '.0' when 6 then '' end"),
    "clean_code": cleaned("code_text", "case when kind = 2 then key else code_text end"),
    "trim_code": cleaned("code_text", "case kind when 1 then key when 2 then key when 3 then key when 4 then 'AB-' || key when 5 then 'AB-' || key when 6 then '' end"),
    "clean_quantity_signed": cleaned("quantity_text", "case when n = 13 or kind in (5, 6) then null when kind = 2 then n * 1000 when kind = 3 then -n when kind = 7 then n + 0.5 else n end::double"),
    "clean_quantity_unsigned": cleaned("quantity_text", "case when n = 13 then 53 when kind in (5, 6) then 0 when kind = 2 then n * 1000 when kind = 7 then n + 1 else n end::double"),
    "clean_quantity_zero": cleaned("quantity_text", "case when n = 13 then null when kind = 5 then 0 when kind = 2 then n * 1000 when kind = 3 then -n when kind = 7 then n + 0.5 end::double"),
    "round_int_even": cleaned("quantity_text", "case when n = 13 then 0 when kind = 3 then -n when kind = 7 then n + n % 2 else 0 end::bigint"),
    "two_digit_year": f"""with {LINE} select case when l_linenumber <= 3 then year(ship_date) - 2000 else year(ship_date) end::int as year_in,
        strftime(ship_date, '%m-%d') as day_in, ship_date as output from fx_line""",
    "fill_item_prefix": f"""with {TEXT_LINE} select code_text as input, l_suppkey::varchar as sku,
        case when kind >= 6 then '600' || l_suppkey else code_text end as san_antonio,
        case when kind >= 6 then '200' || l_suppkey else code_text end as sterling, code_text as alexandria from tx""",
    "drop_zero_items": f"""with {TEXT_LINE} select l_orderkey, case kind when 4 then 'AB-' || key when 5 then 'AB-' || key || '.0' when 6 then '' else key end as item
        from tx where kind <> 7 and not (kind <= 3 and l_partkey = 0)""",
    "drop_junk_periods": f"""with {TEXT_LINE} select l_orderkey, case kind when 1 then period else n || 'x' end as period_text from tx where kind in (1, 6)""",
    "natural_key": f"""with {PLAN_LINE}, {FORECAST_LINE.removeprefix(LINE + ', ')} select "Period", "Date", "Item", "Location", "PDIL", 'plan' as kind from keyed
        union all select "Period", "Date", "Item", "Location", "PDIL", 'forecast' from fkeyed""",
    "location_from_name": f"""with {LINE} select l_orderkey, case l_returnflag when 'A' then 'Vert_ALEX_Plan_FY2024' when 'N' then 'Forecast_SAN_FY2024' else 'Other_STER_FY2024' end as source_table,
        case when l_returnflag = 'A' then 'ALEX' else 'Unknown' end as plan_location, case when l_returnflag = 'N' then 'SAN' else 'Unknown' end as forecast_location from fx_line""",
    "optional_columns": f"""with {PLAN_LINE}, {ALL} select "Period", "Date", "Item", "Planning_Value", "City", "State" from rows""",
    "union_sources": PLAN_UNION,
    "parse_timestamp_tolerant": """with e as (select event_id, ts, event_id % 6 as kind from events) select event_id,
        case kind when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') when 2 then strftime(ts, '%Y%m%dT%H%M%S')
            when 3 then strftime(ts, '%Y%m%d-late') when 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S+05:30') else strftime(ts, 'on %Y-%m-%d') end as input,
        strftime(case kind when 0 then date_trunc('second', ts) when 1 then ts when 2 then date_trunc('second', ts) when 3 then date_trunc('day', ts)
            when 4 then date_trunc('second', ts) - interval 330 minute end, '%Y-%m-%d %H:%M:%S.%f') as output from e""",
    "checksum": "select doc_id, sha256(text) as checksum_sha256 from documents",
    # joins, windows, counts
    "monday_calendar": f"""{DAYS} select period as "Period", d as "Date" from days where dayofweek(d) = 1""",
    "distinct_calendar": f"""{DAYS} select distinct period as "Period" from days""",
    "anti_new_rows": f"""{MERGE} select {PLAN_COLUMNS} from later where "PDIL" not in (select "PDIL" from t)""",
    "semi_delete": f"""{REPLACE} select "IndexKey", {FORECAST_COLUMNS} from t where "PDIL" in (select "PDIL" from s)""",
    "merge_match": f"""{MERGE} select t."PDIL", t."PrimaryKey", t."Planning_Value", s."Planning_Value" as "new_Planning_Value", s."Item" as "new_Item" from t join s using ("PDIL")""",
    "merge_classes": f"""{MERGE} select "PDIL", case when t."PrimaryKey" is null then 'new' when s."PDIL" is null then 'untouched'
        when s."Planning_Value" <> t."Planning_Value" or (s."Planning_Value" is not null and t."Planning_Value" is null) then 'changed' else 'same' end as merge_class,
        t."PrimaryKey", t."Planning_Value" as old_value, s."Planning_Value" as new_value from t full join s using ("PDIL")""",
    "max_key": f"""with {PLAN_LINE}, {EARLIER} select count(distinct "PDIL") as max_key from earlier""",
    "row_counts": f"""with {PLAN_LINE} select 'union' as stage, count(*) as n_rows from keyed union all select 'unique', count(distinct "PDIL") from keyed""",
    "dedup_by_key": f"{UNIQUE} select * from u",
    "dedup_source_cte": f"{UNIQUE} select * from u",
    "surrogate_key": f"""{UNIQUE} select row_number() over (order by "PDIL") + 1000 as "PrimaryKey", "PDIL", "Planning_Value" from u""",
    # upserts and facts
    "upsert_changed": f"{MERGE}, {STATE} select {PLAN_FACT} from state",
    "insert_new": f"{MERGE}, {STATE} select {PLAN_FACT} from fresh",
    "fact_planning": f"{MERGE}, {STATE} select {PLAN_FACT} from state union all select {PLAN_FACT} from fresh",
    "fact_planning_by_file": f"{MERGE}, {STATE} select {PLAN_FACT} from state union all select {PLAN_FACT} from fresh",
    "initial_load": f"""{UNIQUE} select row_number() over (order by "PDIL") as "PrimaryKey", * from u""",
    "replace_by_key": REPLACED,
    "fact_forecast": REPLACED,
    "fact_forecast_by_file": REPLACED,
    # ingestion
    "files_to_ingest": f"with {LISTED} select * from decided",
    "last_ingested": f"with {LISTED} select resource, last_ingested from latest",
    "ledger_append": f"""with {LISTED}, grown as (select distinct resource, ingestion_date, t, file_path from entries
        union all select resource, '2024-02-01T00:00:00.000000', timestamp '2024-02-01', 'landing/' || resource || '/' || resource || '.xlsx' from decided where is_due)
        select resource, ingestion_date, file_path, row_number() over (partition by resource order by t desc nulls last, ingestion_date desc, file_path desc) = 1 as is_current from grown""",
    "ledger_history": f"""with {LISTED}, once as (select distinct resource, ingestion_date, t, file_path from entries),
        placed as (select *, row_number() over (partition by resource order by t desc nulls last, ingestion_date desc, file_path desc) as rn, count(*) over (partition by resource) as n from once)
        select resource, max(case when rn = 1 then ingestion_date end) as ingestion_date, max(case when rn = 1 then file_path end) as file_path, max(n) as n_entries,
            max(case when rn = n then ingestion_date end) as first_entry from placed group by resource""",
    "file_manifest": """select 'documents' as source_system, 'doc_' || doc_id || '.txt' as file_name, doc_id::varchar as file_id,
        '2024-01-31T08:00:00Z' as last_modified_datetime, sha256(text) as checksum_sha256, n_chars as download_duration_ms, '2024-02-01T00:00:00' as generated_at_utc from documents""",
    "due_by_content": """select doc_id::varchar as path, case when doc_id % 7 = 3 then 'new' when doc_id % 11 = 4 then 'removed' when doc_id % 5 = 0 then 'changed' else 'same' end as fate,
        doc_id % 11 <> 4 and (doc_id % 7 = 3 or doc_id % 5 = 0) as is_due from documents where doc_id % 7 <> 3 or doc_id % 11 <> 4""",
    "file_history": """with d as (select doc_id::varchar as path, n_chars as length, sha256(text) as one, sha256(text || '!') as two,
            doc_id % 7 <> 3 as early, doc_id % 11 <> 4 as late, doc_id % 5 = 0 as edited from documents)
        select path, length, one as checksum, '2024-01-01' as valid_from, case when not late or edited then '2024-01-02' end as valid_to from d where early
        union all select path, length, case when edited then two else one end, '2024-01-02', case when not early or edited then '2024-01-03' end from d where late and (not early or edited)
        union all select path, length, one, '2024-01-03', null from d where early and (not late or edited)""",
    "file_manifest_stream": """select 'documents' as source_system, doc_id % 16 as part, sha256(string_agg(text || chr(10), '' order by doc_id)) as checksum_sha256,
        '2024-02-01T00:00:00' as generated_at_utc from documents group by doc_id % 16""",
    "any_changed": f"with {LISTED} select bool_or(is_due) as any_changed from decided",
    "resource_name": """select o_orderkey, 'Plan ' || o_custkey as resource, 'landing/Plan ' || o_custkey || '/Plan ' || o_custkey || '.xlsx' as object_key from orders""",
    # checks
    "reconcile_cells": f"""{FORECAST}, c as (select {SKU} as "Sku", period as "Period", ({UNSIGNED})::bigint as original,
        case kind when 5 then n when 2 then -n when 4 then n + n % 2 else 0 end::bigint as reshaped from fx_forecast_cell)
        select * from c where original <> reshaped""",
    "reconcile_digests": f"""{FORECAST}, c as (select {SKU} as "Sku", period as "Period", ({UNSIGNED})::bigint as original,
        case kind when 5 then n when 2 then -n when 4 then n + n % 2 else 0 end::bigint as reshaped from fx_forecast_cell)
        select * from c where original <> reshaped""",
    "reconcile_round_trip": f"""{FORECAST} select 0::bigint as n_differ, count(*) as n_cells from fx_forecast_cell""",
    "reconcile_counts": f"""{UNIQUE}, c as (select (select count(*) from rows) as rows_before, (select count(*) from u) as rows_after)
        select *, rows_before = rows_after as all_kept, case when rows_before = rows_after then 'all rows kept' else 'rows changed from ' || rows_before || ' to ' || rows_after end as message from c""",
    "merge_conflicts": f"""with {PLAN_LINE} select "PDIL", count(*) as n from keyed group by 1 having count(*) > 1""",
    "refresh_all": refresh_summary(),
    "refresh_again": refresh_summary(again=True),
    "refresh_store": refresh_summary(again=True),
}
