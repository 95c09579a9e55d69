"""The registered queries once more, as SQL over the same tables.

Written independently of the operators (joins, rules, de-duplication, money,
generated domains), so that a mistake has to be made twice to go unnoticed.
Shared are the definition of the retail view's columns and the constants of the
generator's mix.
"""

from __future__ import annotations

from ledgerloom.queries import GENERATOR_SEED
from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources import generator
from ledgerloom.sources.retail_view import COLUMN_EXPRESSIONS

_COLUMNS = RAW_SCHEMA.fieldNames()
# The quality rules and the spellings of gender.
_BAD = "(quantity <= 0 or customer_age < 15 or customer_age > 100 or unit_price <= 0)"
_GENDER = (
    "case when upper(trim(gender)) in ('MALE', 'M') then 'M'"
    " when upper(trim(gender)) in ('FEMALE', 'F') then 'F' else 'Unknown' end"
)


def _select(**replaced: str) -> str:
    return ", ".join(
        f"{replaced[name]} as {name}" if name in replaced else name for name in _COLUMNS
    )


_VIEW = (
    "raw as (select "
    + ", ".join(f"{expression} as {name}" for name, expression in COLUMN_EXPRESSIONS.items())
    + " from lineitem"
    " join orders on l_orderkey = o_orderkey"
    " join part on l_partkey = p_partkey"
    " join customer on o_custkey = c_custkey"
    " join nation on c_nationkey = n_nationkey"
    " join region on n_regionkey = r_regionkey)"
)


def _dedup(table: str) -> str:
    order = ", ".join(f"{name} nulls first" for name in _COLUMNS if name != "transaction_id")
    return (
        f"select {', '.join(_COLUMNS)} from (select *, row_number() over"
        f" (partition by transaction_id order by {order}) as position from {table})"
        " where position = 1"
    )


_SILVER = (
    f"{_VIEW}, valid as (select {_select(gender=_GENDER)} from raw where not {_BAD}),"
    f" silver as ({_dedup('valid')})"
)
_PRODUCT_VALUE = "quantity * unit_price * (1 - discount_pct / 100)"
# round() of the two engines differs on doubles; the decimal of the printed value does not.
_AMOUNT = (
    f"cast(round(cast(cast({_PRODUCT_VALUE} as varchar) as decimal(38, 17)), 2) as double)"
)
_CENTS = (
    f"{_SILVER}, sales as (select *, cast(round({_AMOUNT} * 100) as hugeint) as cents from silver)"
)
_REVENUE = "cast(sum(cents) as double) / 100"
_MEAN = "cast((2 * sum(cents) + count(cents)) // (2 * nullif(count(cents), 0)) as double) / 100"

_DAILY = (
    f"with {_CENTS} select order_date, {_REVENUE} as total_revenue,"
    f" count(transaction_id) as total_orders, {_MEAN} as avg_order_value"
    " from sales group by order_date"
)
_PRODUCT = (
    f"with {_CENTS} select product_category, {_REVENUE} as category_revenue,"
    " cast(sum(quantity) as bigint) as total_units_sold, count(transaction_id) as order_count"
    " from sales group by product_category"
)
_CITY = (
    f"with {_CENTS} select city, state, {_REVENUE} as city_revenue,"
    f" count(transaction_id) as order_count, {_MEAN} as avg_order_value"
    " from sales group by city, state"
)
_MEASURES = (
    "cast(sum(cents) as bigint) as cents, cast(null as double) as inexact, count(cents) as amounts,"
    " cast(sum(quantity) as bigint) as units, count(transaction_id) as orders"
)
_ROLLUP = (
    f"with {_CENTS} select order_date, null as product_category, null as city, null as state,"
    f" 'daily_sales_metrics' as mart, {_MEASURES} from sales group by order_date"
    f" union all select null, product_category, null, null, 'product_performance', {_MEASURES}"
    " from sales group by product_category"
    f" union all select null, null, city, state, 'city_revenue', {_MEASURES}"
    " from sales group by city, state"
)
_COUNTS = (
    f"count(*) as raw_rows, count(*) filter (not {_BAD}) as valid_rows,"
    f" count(*) filter ({_BAD}) as quarantine_rows,"
    f" count(*) filter ({_BAD} is null) as indeterminate_rows,"
    " count(*) filter (quantity <= 0) as quantity_not_positive,"
    " count(*) filter (customer_age < 15) as age_below_min,"
    " count(*) filter (customer_age > 100) as age_above_max,"
    " count(*) filter (unit_price <= 0) as price_not_positive"
)
_MULTI_RUN = (
    f"with {_VIEW} select "
    + _select(payment_type="case when order_status = 'Returned' then null else payment_type end")
    + " from raw"
)


def _extremes() -> str:
    """City revenue with amounts that are NaN or beyond a bigint of cents planted in silver."""
    planted = (
        f"{_SILVER}, extreme as (select *, case when transaction_id % 500 = 3 then state end as place from silver),"
        f" amounts as (select *, case place when 'AFRICA' then 'nan'::double when 'ASIA' then 6e16::double else {_AMOUNT} end as amount from extreme),"
        " sales as (select *, case when not isnan(amount) then cast(round(amount * 100) as hugeint) end as cents from amounts)"
    )
    return (
        f"with {planted} select city, state, case when bool_or(isnan(amount)) then 'nan'::double else {_REVENUE} end as city_revenue,"
        f" count(transaction_id) as order_count, case when bool_or(isnan(amount)) then 'nan'::double else {_MEAN} end as avg_order_value"
        " from sales group by city, state"
    )


def _generated() -> str:
    """The generator's mix and, spelt out, the domains that it draws from."""
    modulus, multipliers = generator.MODULUS, generator.MULTIPLIERS
    offsets = ", ".join(f"('{name}', {generator.draw_offset(GENERATOR_SEED, name)}::bigint)" for name in generator.DRAWS)
    steps = [
        "lines as (select row_number() over () as line, l_orderkey * 10 + l_linenumber as record from lineitem)",
        f"z0 as (select line, name, (record % {modulus} * {multipliers[0]} + record // {modulus} * {generator.DRAW_STEP} + o) % {modulus} as z"
        f" from lines, (values {offsets}) d(name, o))",
    ]
    for k, (shift, multiplier) in enumerate(zip(generator.SHIFTS, multipliers[1:], strict=True)):
        steps.append(f"z{k + 1} as (select line, name, xor(z, z >> {shift}) * {multiplier}::bigint % {modulus} as z from z{k})")
    wide = ", ".join(f"max(z) filter (name = '{name}') as {name}" for name in generator.DRAWS)

    def pick(name: str, start: int, stop: int | str) -> str:
        return f"({start} + {name} % (({stop}) - ({start})))::bigint"

    def listed(name: str, values: str, size: int) -> str:
        return f"([{values}])[1 + {pick(name, 0, size)}]"

    def damaged(value: str, by_kind: dict[int, str]) -> str:
        cases = " ".join(f"when {hit} and {pick('defect_kind', 0, 6)} = {kind} then {bad}" for kind, bad in by_kind.items())
        return f"case {cases} else {value} end"

    # The domains, in the order of the draws.
    hit = f"{pick('defect', 0, 1000000)} < 50000"
    quantity, age = pick("quantity", 1, 10), pick("customer_age", 10, 100)
    low, span = listed("product_category", "2000, 100, 5000, 1000", 4), listed("product_category", "48001, 4901, 145001, 79001", 4)
    cents = f"({pick('unit_price', 0, span)} + {low})"
    day = f"(date '2023-01-01' + {pick('order_date', 0, 1096)}::int)"
    columns = {
        "transaction_id": pick("transaction_id", 1, 100000000),
        "order_date": f"strftime({day}, '%Y-%m-%d')",
        "ship_date": f"strftime({day} + {pick('ship_delay', -3, 10)}::int, '%Y-%m-%d')",
        "customer_id": f"'CUST' || {pick('customer_id', 1, 200000)}",
        "customer_age": damaged(age, {2: f"{age} + 101", 3: "null"}),
        "gender": listed("gender", "'M', 'F', 'Male', 'Female', null", 5),
        "product_id": f"'PROD' || {pick('product_id', 1, 50000)}",
        "product_category": listed("product_category", "'Fashion', 'Grocery', 'Furniture', 'Sports'", 4),
        "quantity": damaged(quantity, {0: f"-({quantity})", 1: "null"}),
        "unit_price": damaged(f"{cents}::double / 100", {4: "0::double", 5: "null"}),
        "discount_pct": f"{pick('discount_pct', 0, 5001)}::double / 100",
        "city": listed("city", "'New York', 'Los Angeles', 'Chicago', 'Houston', 'Phoenix'", 5),
        "state": listed("city", "'NY', 'CA', 'IL', 'TX', 'AZ'", 5),
        "payment_type": listed("payment_type", "'Card', 'UPI', 'COD', 'Crypto', null", 5),
        "order_status": listed("order_status", "'Delivered', 'Cancelled', 'Returned'", 3),
        "ingestion_date": "'2026-01-01'",
    }
    return (
        f"with {', '.join(steps)}, wide as (select line, {wide} from z{len(generator.SHIFTS)} group by line) select "
        + ", ".join(f"{columns[name]} as {name}" for name in _COLUMNS)
        + " from wide"
    )


def _upserts() -> str:
    """Rows of silver after each batch; 16 buckets, all of which a large batch touches and one id touches one of."""
    large = "order_status <> 'Returned'"
    one = "order_status = 'Returned' and transaction_id = (select min(transaction_id) from valid where order_status = 'Returned')"
    steps = [(0, "large", 16, 0, large), (1, "one id", 1, 15, f"{large} or {one}"), (2, "large", 0, 16, f"{large} or {one}")]
    return f"with {_SILVER} " + " union all ".join(
        f"select cast({step} as int) as step, '{batch}' as batch, cast({rewritten} as int) as rewritten, cast({kept} as int) as kept,"
        f" (select count(distinct transaction_id) from valid where {held}) as silver_rows"
        for step, batch, rewritten, kept, held in steps
    )


def _versions() -> str:
    """Rows and ids (of the mart, orders) that each version holds, from the rows that went into it."""

    def version(state: str, held: str) -> list[str]:
        ids = "count(distinct transaction_id)"
        return [
            f"select '{state}' as state, 'silver' as \"table\", {ids} as rows, {ids} as ids from valid where {held}",
            f"select '{state}', 'quarantine', count(*), {ids} from raw where {_BAD} and {held}",
            f"select '{state}', 'city_revenue', count(distinct city || state), {ids} from valid where {held}",
        ]

    first = "order_status = 'Delivered'"
    return f"with {_SILVER} " + " union all ".join([*version("first", first), *version("broken off", first), *version("second", "true")])


def _asof(key: str) -> str:
    """The greatest (price, discount) of the last day; NULL is the least."""
    return (
        f"with {_VIEW}, days as (select {key} as k, cast(ship_date as date) as day,"
        " row_number() over (partition by product_key, ship_date order by unit_price desc nulls last, discount_pct desc nulls last) as place,"
        f" unit_price as valid_price, discount_pct as valid_discount from (select *, {key} as product_key from raw)),"
        f" asked as (select transaction_id, customer_id, {key}, cast(order_date as date) as order_day from raw)"
        f" select a.*, valid_price, valid_discount from asked a asof left join (select * from days where place = 1) d on a.{key} = d.k and a.order_day >= d.day"
    )


def _profiles() -> str:
    """Counts of every run and column; the sketches' values must be within their bounds."""
    columns = {"transaction_id": True, "quantity": True, "unit_price": True, "customer_id": False, "payment_type": False}
    return f"with {_VIEW}, runs as (select order_status as run, * from raw union all select 'all', * from raw) " + " union all ".join(
        f"select run, '{name}' as \"column\", count(*) as rows, count({name}) as known, true as distinct_fits, true as quantiles_fit, {str(number).lower()} as has_quantiles from runs group by run"
        for name, number in columns.items()
    )


def _drift() -> str:
    def change(name: str, fits: str) -> str:
        share = f"1 - count({name})::double / count(*)"
        return f"select order_status as run, '{name}' as \"column\", round({share} - (select {share} from raw), 9) as null_share_change, {fits} as distance_fits from raw group by order_status"

    return f"with {_VIEW} {change('quantity', 'true')} union all {change('payment_type', 'null::boolean')}"


# Runs of ten days, then events of all days. A run drops what lies in windows that ended two days before the latest time of the
# runs before it.
_EVENTS = (
    "with events_in as (select event_id, event_type, value, case when event_id % 500 <> 57 then ts end as moment,"
    " case when event_id % 50 = 7 then 3 else least(2, (day(ts) - 1) // 10) end as run from events),"
    " seen as (select b.run, (select max(moment) - interval 2 day from events_in e where e.run < b.run) as closed from (select distinct run from events_in) b),"
    " judged as (select e.*, moment is null as untimed, coalesce(date_trunc('day', moment) + interval 1 day <= closed, false) as late from events_in e join seen using (run))"
)


_PROFILED = [
    "transaction_id",
    "order_date",
    "ship_date",
    "customer_id",
    "customer_age",
    "gender",
    "product_id",
    "unit_price",
    "quantity",
    "discount_pct",
    "place",
    "payment_type",
    "order_status",
]

_RAW = f"with {_VIEW} select {_select()} from raw"
_QUARANTINE = f"{_RAW} where {_BAD}"
_SILVER_ROWS = f"with {_SILVER} select {_select()} from silver"

ORACLE_SQL: dict[str, str] = {
    "raw_scan": _RAW,
    "explicit_schema_scan": (
        'select l_orderkey as "L_ORDERKEY", cast(l_linenumber as bigint) as l_linenumber,'
        " l_returnflag, cast(null as varchar) as l_channel from lineitem"
    ),
    "bronze_count": f"with {_VIEW} select count(*) as row_count from raw",
    "bronze_multi_run": _MULTI_RUN,
    "bronze_incremental": _MULTI_RUN,
    "landing_chunks": (
        f"with {_VIEW} select count(*) as row_count, cast(0 as bigint) as oversized_files from raw"
    ),
    "triaged_bronze": _MULTI_RUN,
    "triage_report": (
        f"with {_VIEW}, counted as (select 'run_' || lower(order_status) as run, count(*) as rows from raw group by all)"
        " select run, case run when 'run_cancelled' then 'widening' else 'compatible' end as kind, cast(null as varchar) as reason, rows from counted"
        " union all select 'run_prices', 'rejected', 'unit_price is string, not double', 0"
        " union all select 'run_notes', 'rejected', 'not a Parquet file', 0"
    ),
    "asof_product": _asof("product_id"),
    "asof_category": _asof("product_category"),
    "quality_predicate": (
        f"with {_VIEW} select transaction_id, quantity <= 0 as quantity_not_positive,"
        " customer_age < 15 as age_below_min, customer_age > 100 as age_above_max,"
        f" unit_price <= 0 as price_not_positive, {_BAD} as is_bad from raw"
    ),
    "quality_valid": f"{_RAW} where not {_BAD}",
    "quality_quarantine": _QUARANTINE,
    "dq_report": f"with {_VIEW} select {_COUNTS} from raw",
    "quarantine_csv_roundtrip": _QUARANTINE,
    "gender_standardized": f"with {_VIEW} select {_select(gender=_GENDER)} from raw",
    "dedup_transactions": f"with {_VIEW} {_dedup('raw')}",
    "silver_clean": _SILVER_ROWS,
    "order_amount": (
        f"with {_SILVER} select {_select()}, {_AMOUNT} as total_amount from silver"
    ),
    "daily_sales_metrics": _DAILY,
    "product_performance": _PRODUCT,
    "city_revenue": _CITY,
    "mart_rollup": _ROLLUP,
    "city_revenue_extremes": _extremes(),
    "silver_job": _SILVER_ROWS,
    "quarantine_job": _QUARANTINE,
    "pipeline_counts": (
        f"with {_SILVER} select (select count(*) from raw) as bronze_rows, c.*,"
        " (select count(*) from raw) as landed_rows, (select count(*) from silver) as silver_rows"
        f" from (select {_COUNTS} from raw) c"
    ),
    "pipeline_daily_sales_metrics": _DAILY,
    "pipeline_product_performance": _PRODUCT,
    "pipeline_city_revenue": _CITY,
    "incremental_silver": _SILVER_ROWS,
    "incremental_quarantine": _QUARANTINE,
    "incremental_rollup": _ROLLUP,
    "upsert_buckets": _upserts(),
    "versioned_layers": _versions(),
    "bucketed_silver": (
        f"with {_SILVER}, counts as (select transaction_id as id, count(*) as raw_rows from raw group by transaction_id)"
        " select transaction_id, order_date, city, raw_rows, cast(0 as int) as exchanges from silver join counts on transaction_id = id"
    ),
    "clustered_files": (
        f"with {_VIEW} select layout, (select count(*) from raw) as rows,"
        " (select count(*) from raw where order_date >= '1996-01-01' and order_date < '1996-07-01' and city = 'NATION_7') as matching_rows,"
        " layout = 'clustered' as third_of_files_at_most from (values ('clustered'), ('as it comes')) l(layout)"
    ),
    "profile_report": _profiles(),
    "profile_drift": _drift(),
    "event_windows": (
        f"{_EVENTS} select strftime(moment, '%Y-%m-%d') as day, event_type, count(*) as rows, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents"
        " from judged where not untimed and not late group by all"
    ),
    "event_report": (
        f"{_EVENTS} select count(*) as input_rows, count(*) filter (not untimed and not late) as window_rows,"
        " count(*) filter (late) as late_rows, count(*) filter (untimed) as untimed_rows from judged"
    ),
    "generated_transactions": _generated(),
    "generated_profile": (
        "select count(*) as row_count, "
        + ", ".join(
            # The blanked records break every rule but those that allow a missing value.
            "cast(0 as bigint) as bad_" + name
            if name in ("gender", "payment_type")
            else f"count(*) filter ((l_orderkey * 10 + l_linenumber) % 997 = 0) as bad_{name}"
            for name in _PROFILED
        )
        + " from lineitem"
    ),
}
