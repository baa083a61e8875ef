"""SQL for DuckDB that gives the expected result of each query in the catalog.

The input feeds are the same column expressions the queries use; everything after that
is written separately, from the rules of the data model.
"""

from scdflow.sources import testdata as td

OPEN_END = "timestamp '9999-12-31 00:00:00'"


def _feed(columns: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f'{e} as "{n}"' for n, e in columns.items()) + f" from {source}"


_LINES_PART = "lineitem join part on l_partkey = p_partkey"
CUSTOMER_CHANGES = _feed(td.CUSTOMER_CHANGES, "orders")
CUSTOMER_SNAPSHOT = _feed(td.CUSTOMER_SNAPSHOT, "customer")
PRODUCT_CHANGES = _feed(
    td.PRODUCT_CHANGES | {"orderkey": "l_orderkey"} | {c: c for c in td.PRODUCT_ORDER},
    _LINES_PART,
)
ORDERS = _feed(td.ORDER_ROWS, "orders")
ITEMS = _feed(td.ITEM_ROWS, "lineitem")
CUSTOMER_RECORDS = _feed(td.CUSTOMER_RECORDS, "orders")
PRODUCT_RECORDS = _feed(td.PRODUCT_RECORDS, _LINES_PART)
ORDER_RECORDS = _feed(td.ORDER_RECORDS, "orders")
ITEM_RECORDS = _feed(td.ITEM_RECORDS, "lineitem")
RECORDS = " union all ".join([CUSTOMER_RECORDS, PRODUCT_RECORDS, ORDER_RECORDS, ITEM_RECORDS])
ATTEMPTS = _feed(td.FAILED_ATTEMPTS, "events") + " where event_type = 'error'"

_TRACKED = {"customer": ["phone", "address", "city", "country"], "product": ["price", "cost"]}
_TYPE1 = {
    "customer": ["first_name", "last_name", "email"],
    "product": ["product_name", "category", "brand", "description"],
}


def fold(entity: str, changes: str, order: str, opened: str) -> str:
    """CTEs that end in the dimension `dim_<entity>`, with all its versions.

    Versions are counted within lives, a life being the stretch up to a delete.
    """
    key = f"{entity}_id"
    tracked, type1 = _TRACKED[entity], _TYPE1[entity]
    attributes = ", ".join(f"{c} := {c}" for c in tracked + type1)
    differs = " or ".join(
        f"{c} is distinct from lag({c}) over (partition by {key}, life order by rn)"
        for c in tracked
    )
    p = entity
    return f"""
    {p}_numbered as (
        select *, row_number() over (partition by {key} order by {order}) as rn
        from ({changes})
    ),
    {p}_before as (
        select *, lag(op) over (partition by {key} order by rn) as prev_op from {p}_numbered
    ),
    {p}_effective as (
        select * from {p}_before
        where not (op is distinct from 'c' and op is distinct from 'u' and op is distinct from 'd'
                   and rn > 1 and prev_op is distinct from 'd')
    ),
    {p}_lives as (
        select *, coalesce(sum(case when op = 'd' then 1 else 0 end) over (
            partition by {key} order by rn rows between unbounded preceding and 1 preceding), 0)
            as life
        from {p}_effective
    ),
    {p}_flagged as (
        select *, case when op = 'd' then 0
            when lag(rn) over (partition by {key}, life order by rn) is null or {differs}
            then 1 else 0 end as opens,
            op = 'd' and coalesce(lag(op) over (partition by {key} order by rn), 'd') = 'd'
                as is_stray
        from {p}_lives
    ),
    {p}_versioned as (
        select *, cast(sum(opens) over (partition by {key}, life order by rn
            rows unbounded preceding) as integer) as version,
            max(case when opens = 1 or (op = 'd' and not is_stray) then ts end)
                over (partition by {key} order by rn rows unbounded preceding) as clock
        from {p}_flagged
    ),
    {p}_grouped as (
        select {key}, life, version,
            arg_min(clock, rn) filter (where op is distinct from 'd') as valid_from,
            arg_min({opened}, rn) filter (where op is distinct from 'd') as opened,
            min(rn) filter (where op is distinct from 'd') as open_rn,
            arg_max(struct_pack({attributes}), rn) filter (where op is distinct from 'd') as a,
            max(clock) filter (where op = 'd') as deleted_at
        from {p}_versioned group by {key}, life, version
        having count(*) filter (where op is distinct from 'd') > 0
    ),
    dim_{p} as (
        select {key}, version, valid_from,
            coalesce(lead(valid_from) over (partition by {key}, life order by version),
                     deleted_at, {OPEN_END}) as valid_to,
            lead(valid_from) over (partition by {key}, life order by version) is null
                and deleted_at is null as is_current,
            a.*, opened, open_rn
        from {p}_grouped
    )"""


CUSTOMER = fold("customer", CUSTOMER_CHANGES, '"offset"', '"offset"')
PRODUCT = fold("product", PRODUCT_CHANGES, ", ".join(td.PRODUCT_ORDER), "orderkey")

_CUSTOMER_COLUMNS = (
    "customer_id, version, valid_from, cast(valid_to as varchar) as valid_to, is_current, "
    "first_name, last_name, email, phone, address, city, country"
)
_MARGIN = (
    "cast(case when price > 0 then (cast(price as double) - cast(cost as double))"
    " / cast(price as double) * 100 else 0 end as decimal(5,2))"
)
_PRODUCT_COLUMNS = (
    "product_id, version, valid_from, cast(valid_to as varchar) as valid_to, is_current, "
    "product_name, category, brand, description, cast(price as double) as price, "
    f"cast(cost as double) as cost, cast({_MARGIN} as double) as margin_percentage"
)


def customers_as(select: str, changes: str = CUSTOMER_CHANGES, extra: str = "") -> str:
    return f"with {fold('customer', changes, _OFFSET, _OFFSET)}{extra} {select}"


_OFFSET = '"offset"'


# Envelopes


def _normalized(records: str) -> str:
    return f"""
    parsed as (
        select *, case when value is not null and json_valid(value) then value end as doc
        from ({records})
    ),
    typed as (
        select *, json_type(doc) as doc_type, json_type(doc, '$.payload') as payload_type,
            case when json_type(doc, '$.payload') is null then '$' else '$.payload' end as root,
            topic = 'ecommerce.public.order_items' as is_item
        from parsed
    ),
    kinds as (
        select *, case when value is null then 'tombstone' when doc is null then 'malformed'
            when doc_type = 'NULL' then 'tombstone' when doc_type = 'OBJECT' then 'object'
            when doc_type in ('ARRAY', 'VARCHAR') then 'sequence' else 'scalar' end as kind,
            coalesce(json_type(doc, root || '.before'), 'NULL') as before_type,
            coalesce(json_type(doc, root || '.after'), 'NULL') as after_type
        from typed
    ),
    opped as (
        select *, case
            when payload_type is not null then
                case when json_type(doc, '$.payload.op') is null then 'c'
                     else json_extract_string(doc, '$.payload.op') end
            when after_type = 'NULL' then 'd' when before_type = 'NULL' then 'c' else 'u' end
            as doc_op
        from kinds
    ),
    imaged as (
        select *, json_extract(doc, root || case when doc_op = 'd' and not is_item
            then '.before' else '.after' end) as row_image
        from opped
    ),
    judged as (
        select *, (is_item and doc_op is distinct from 'c')
            or row_image is null
            or cast(row_image as varchar) in ('null', '{{}}', '[]', '""', '0', 'false') as idle
        from imaged
    ),
    errors as (
        select *, case when kind = 'malformed' then 'JSONDecodeError'
            when kind = 'scalar' then 'TypeError' when kind = 'sequence' then 'AttributeError'
            when payload_type is not null and payload_type <> 'OBJECT' then 'AttributeError'
            when kind = 'object' and not idle and json_type(row_image) <> 'OBJECT'
            then 'AttributeError' end as error_type
        from judged
    ),
    normalized as (
        select topic, "partition", "offset", "timestamp", value,
            kind, payload_type is not null as wrapped, error_type,
            case when kind <> 'tombstone' and error_type is null then doc_op end as op,
            case when kind = 'tombstone' then 'tombstone' when error_type is not null
                then 'failed' when idle then 'skipped' else 'change' end as outcome,
            row_image
        from errors
    ),
    changes as (
        select topic, "partition", "offset", "timestamp" as ts, value, op, row_image as image
        from normalized where outcome = 'change'
    )"""


def _text(name: str) -> str:
    return f"json_extract_string(image, '$.{name}')"


def _is_null(name: str) -> str:
    return f"coalesce(json_type(image, '$.{name}') = 'NULL', false)"


_CUSTOMER_LIMITS = {
    "first_name": 100,
    "last_name": 100,
    "email": 255,
    "phone": 20,
    "address": 500,
    "city": 100,
    "country": 100,
}
_CUSTOMER_TYPED = f"""
    customer_changes as (
        select "partition", "offset", ts, value, op, image,
            cast({_text('customer_id')} as bigint) as customer_id,
            {', '.join(f'{_text(c)} as {c}' for c in _CUSTOMER_LIMITS)}
        from changes
    ),
    customer_errors as (
        select *, list_filter([
            case when {_is_null('email')} then 'AttributeError' end,
            case when json_type(image, '$.email') not in ('VARCHAR', 'NULL')
                then 'AttributeError' end,
            case when upper(email) like '%ERROR%' and json_type(image, '$.email') = 'VARCHAR'
                then 'ValueError' end,
            case when customer_id is null and op is distinct from 'd' then 'IntegrityError' end,
            {', '.join(f"case when length({c}) > {n} and op is distinct from 'd' then 'DataError' end"
                       for c, n in _CUSTOMER_LIMITS.items())}
        ], lambda e: e is not null) as errors,
            (customer_id is null and op is distinct from 'd') or
            {' or '.join(f"(coalesce(length({c}), 0) > {n} and op is distinct from 'd')"
                         for c, n in _CUSTOMER_LIMITS.items())} as is_bad_still
        from customer_changes
    )"""


def _number_errors(name: str) -> str:
    return (
        f"case when {_is_null(name)} and op is distinct from 'd' then 'TypeError' end, "
        f"case when json_type(image, '$.{name}') is not null and not {_is_null(name)} and "
        f"try_cast({_text(name)} as double) is null and op is distinct from 'd' "
        "then 'ValueError' end"
    )


def _amount(name: str) -> str:
    return (
        f"case when json_type(image, '$.{name}') is null then 0.0::double "
        f"else try_cast({_text(name)} as double) end"
    )


_PRODUCT_TYPED = f"""
    product_changes as (
        select "partition", "offset", op, image,
            cast({_text('product_id')} as bigint) as product_id,
            {_amount('price')} as price, {_amount('cost')} as cost
        from changes
    ),
    product_errors as (
        select *, list_filter([
            {_number_errors('price')}, {_number_errors('cost')},
            case when product_id is null and op is distinct from 'd' then 'IntegrityError' end,
            case when length({_text('product_name')}) > 255 and op is distinct from 'd'
                then 'DataError' end,
            case when length({_text('category')}) > 100 and op is distinct from 'd'
                then 'DataError' end,
            case when length({_text('brand')}) > 100 and op is distinct from 'd'
                then 'DataError' end,
            case when abs(price) >= 99999999.995 and op is distinct from 'd' then 'DataError' end,
            case when abs(cost) >= 99999999.995 and op is distinct from 'd' then 'DataError' end,
            case when price > 0 and abs((price - cost) / price * 100) >= 999.995
                and op is distinct from 'd' then 'DataError' end
        ], lambda e: e is not null) as errors
        from product_changes
    )"""

_LATEST_ORDERS = f"""{_normalized(ORDER_RECORDS)},
    placed as (
        select cast({_text('order_id')} as bigint) as order_id,
            arg_max(struct_pack(op := op, image := image), "offset") as l
        from changes group by 1
    ),
    latest as (
        select order_id, cast({_text('customer_id').replace('image', 'l.image')} as bigint)
                as customer_id,
            {_text('order_date').replace('image', 'l.image')} as order_date,
            {_text('status').replace('image', 'l.image')} as status,
            cast({_text('total_amount').replace('image', 'l.image')} as double) as total_amount
        from placed where l.op is distinct from 'd'
    )"""


# Facts

_DAY_KEY = "cast(strftime({0}, '%Y%m%d') as integer)"
_FACT = (
    "order_id, order_item_id, customer_id, product_id, date_key, quantity, "
    "cast(unit_price as double) as unit_price, cast(line_total as double) as line_total, "
    "status as order_status"
)
_LOADED = f"""
    o as ({ORDERS}), i as ({ITEMS}),
    plain as (
        select i.*, o.customer_id, o.order_date, o.status,
            {_DAY_KEY.format('o.order_date')} as date_key
        from i join o on i.order_id = o.order_id
    )"""
_CURRENT_FACTS = f"""{CUSTOMER}, {PRODUCT}, {_LOADED},
    tried as (
        select plain.*, c.customer_id as found_customer, p.product_id as found_product
        from plain
        left join (select customer_id from dim_customer where is_current) c using (customer_id)
        left join (select product_id from dim_product where is_current) p using (product_id)
    ),
    loaded as (
        select * from tried where found_customer is not null and found_product is not null
    )"""
_ASOF_FACTS = f"""{CUSTOMER}, {PRODUCT}, {_LOADED},
    loaded as (
        select plain.*, c.version as customer_version, p.version as product_version,
            p.is_current as product_is_current
        from plain
        join dim_customer c on plain.customer_id = c.customer_id
            and c.valid_from <= plain.order_date and plain.order_date < c.valid_to
        join dim_product p on plain.product_id = p.product_id
            and p.valid_from <= plain.order_date and plain.order_date < p.valid_to
    )"""

_PRODUCT_SALES = """
    sold as (
        select product_id, cast(sum(quantity) as bigint) as units_sold,
            cast(sum(cast(line_total as decimal(18,2))) as double) as total_revenue
        from {facts} group by product_id
    ),
    product_sales as (
        select s.product_id, {names}, {price} as current_price, units_sold, total_revenue
        from sold s join {products}
    )"""
_SNAPSHOT_PRODUCT_SALES = _PRODUCT_SALES.format(
    facts="plain",
    names="p_name as product_name, p_type as category, p_brand as brand",
    price="cast(cast(p_retailprice as decimal(10,2)) as double)",
    products="part on p_partkey = s.product_id",
)
_FOLDED_PRODUCT_SALES = {
    "names": "product_name, category, brand",
    "price": "cast(price as double)",
    "products": "(select * from dim_product where is_current) p on p.product_id = s.product_id",
}
_TOP_PRODUCTS = (
    "select * from product_sales order by total_revenue desc, product_id limit 10"
)
_BY_CATEGORY = f"""{_LOADED},
    by_category as (
        select p_type as category, count(distinct order_id) as num_orders,
            cast(sum(quantity) as bigint) as units_sold,
            cast(sum(cast(line_total as decimal(18,2))) as double) as revenue,
            round(cast(sum(cast(unit_price as decimal(18,2))) as double) / count(unit_price), 6)
                as avg_price
        from plain join part on p_partkey = product_id group by p_type
    )"""


def _revenue_by(period: str, name: str) -> str:
    return f"""
    select {period} as {name}, count(distinct order_id) as num_orders,
        cast(sum(quantity) as bigint) as total_items,
        cast(sum(cast(line_total as decimal(18,2))) as double) as revenue"""


# Failed messages

_FAILED = f"""
    attempts as ({ATTEMPTS}),
    failed as (
        select topic, "partition", message_offset,
            arg_min(message_timestamp, failed_at) as message_timestamp,
            arg_min(message_key, failed_at) as message_key,
            arg_min(message_value, failed_at) as message_value,
            arg_min(error_type, failed_at) as error_type,
            arg_max(error_message, failed_at) as error_message,
            cast(null as varchar) as error_stacktrace,
            cast(count(*) - 1 as integer) as retry_count, 3 as max_retries,
            case when count(*) > 1 then max(failed_at) end as last_retry_at,
            max(failed_at) + interval 5 minute as next_retry_at,
            case when count(*) > 3 then 'dead_letter' else 'pending' end as status,
            cast(null as varchar) as resolution_notes,
            min(failed_at) as failed_at,
            cast(null as timestamp) as resolved_at
        from attempts group by topic, "partition", message_offset
    ),
    ready as (
        select * from failed where status = 'pending' and retry_count < max_retries
            and next_retry_at <= timestamp '2024-01-31 00:00:00'
    ),
    tried as (
        select f.*, r.message_offset is not null as is_tried,
            f.message_offset % 3 = 0 as succeeded, f.retry_count + 1 >= f.max_retries as last_try
        from failed f left join ready r using (topic, "partition", message_offset)
    ),
    backlog as (
        select topic, "partition", count(*) as failed_count, min(message_offset) as min_offset,
            max(message_offset) as max_offset, count(*) as lag
        from failed where status in ('pending', 'retrying') group by topic, "partition"
    )"""
_MESSAGE = (
    'topic, "partition", message_offset, error_type, error_message, retry_count, max_retries, '
    "last_retry_at, next_retry_at, status, failed_at, resolved_at"
)
_RETRIED = """
    select topic, "partition", message_offset, error_type,
        case when is_tried and not succeeded and last_try then 'still failing'
            else error_message end as error_message,
        case when is_tried and not succeeded and not last_try then retry_count + 1
            else retry_count end as retry_count, max_retries,
        case when is_tried and not succeeded then timestamp '2024-01-31 00:00:00'
            else last_retry_at end as last_retry_at,
        case when is_tried and not succeeded and not last_try
            then timestamp '2024-01-31 00:15:00' else next_retry_at end as next_retry_at,
        case when is_tried and succeeded then 'resolved'
            when is_tried and last_try then 'dead_letter' else status end as status, failed_at,
        case when is_tried and succeeded then timestamp '2024-01-31 00:00:00' end as resolved_at
    from tried"""
_FAILED_UPSERT = (
    f"with {_FAILED} select {_MESSAGE}, message_value, message_timestamp from failed"
)

_CALENDAR = """
    select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as date,
        dayname(d) as day_of_week, cast(day(d) as integer) as day_of_month,
        cast(month(d) as integer) as month, monthname(d) as month_name,
        cast(quarter(d) as integer) as quarter, cast(year(d) as integer) as year,
        dayofweek(d) in (0, 6) as is_weekend, false as is_holiday
    from (select unnest(generate_series((select min({c}) from {t}), (select max({c}) from {t}),
        interval 1 day)) as d)"""

_INTEGRITY = f"""with {CUSTOMER}, per_key as (
        select customer_id, count(*) as n, count(*) filter (where is_current) as c
        from dim_customer group by customer_id
    )
    select count(*) as keys, cast(sum(n) as bigint) as versions,
        cast(sum(c) as bigint) as current_versions,
        count(*) filter (where c > 1) as keys_with_two_current, cast(0 as bigint) as broken
    from per_key"""

_CHANGE_TYPE = (
    "case when version = 1 then 'create' when not is_current then 'update' else 'current' end"
)


_TURN = (
    "case when \"timestamp\" >= timestamp '1998-01-01 00:00:00' "
    "and topic <> 'ecommerce.public.order_items' then 0 else 1 end"
)
_SEQ = 'struct_pack(t := turn, p := "partition", o := "offset")'
_PIPELINE_BATCHES = f"""
    with raw as (select *, {_TURN} as turn from ({RECORDS})),
    received as (
        select topic, count(*) + count(*) filter (where turn = 0 and "offset" % 10 = 0) as received
        from raw group by topic
    ),
    {_normalized('select topic, "partition", "offset", min(turn) as turn, '
                 'min("timestamp") as "timestamp", arg_min(value, struct_pack(a := "timestamp", '
                 'b := key, c := value)) as value from raw group by 1, 2, 3')
     .replace("select topic, \"partition\", \"offset\", \"timestamp\", value,",
              "select topic, \"partition\", \"offset\", \"timestamp\", turn, value,")
     .replace("select topic, \"partition\", \"offset\", \"timestamp\" as ts, value, op,",
              "select topic, \"partition\", \"offset\", turn, \"timestamp\" as ts, value, op,")},
    {_CUSTOMER_TYPED.replace('from changes', "from changes where topic = 'ecommerce.public.customers'")
     .replace('select "partition"', 'select turn, "partition"')},
    {_PRODUCT_TYPED.replace('from changes', "from changes where topic = 'ecommerce.public.products'")
     .replace('select "partition"', 'select turn, "partition"')},
    live_customers as (
        select customer_id from customer_errors where len(errors) = 0 and customer_id is not null
        group by customer_id having arg_max(coalesce(op, 'r'), {_SEQ}) <> 'd'
    ),
    live_products as (
        select product_id from product_errors where len(errors) = 0 and product_id is not null
        group by product_id having arg_max(coalesce(op, 'r'), {_SEQ}) <> 'd'
    ),
    order_changes as (
        select turn, "partition", "offset", op, image,
            cast({_text('order_id')} as bigint) as order_id,
            coalesce(op is distinct from 'd' and length({_text('status')}) > 50, false) as is_long
        from changes where topic = 'ecommerce.public.orders'
    ),
    live_orders as (
        select order_id, cast(json_extract_string(last_image, '$.customer_id') as bigint)
            as customer_id
        from (
            select order_id, arg_max(op, {_SEQ}) as last_op, arg_max(image, {_SEQ}) as last_image
            from order_changes where not is_long group by order_id
        ) where last_op is distinct from 'd'
    ),
    loaded as (
        select count(*) as loaded from changes c
        join live_orders o on o.order_id = cast({_text('order_id')} as bigint)
        join live_customers using (customer_id)
        join live_products p on p.product_id = cast({_text('product_id')} as bigint)
        where topic = 'ecommerce.public.order_items'
    ),
    filed as (
        select topic, count(*) as filed from normalized where outcome = 'failed' group by topic
        union all select 'ecommerce.public.customers', count(*) from customer_errors
            where len(errors) > 0
        union all select 'ecommerce.public.products', count(*) from product_errors
            where len(errors) > 0
        union all select 'ecommerce.public.orders', count(*) from order_changes where is_long
        union all select 'ecommerce.public.order_items', count(*) - (select loaded from loaded)
            from changes where topic = 'ecommerce.public.order_items'
    )
    select r.topic, received, (select count(*) from normalized n where n.topic = r.topic) as applied,
        coalesce((select cast(sum(filed) as bigint) from filed f where f.topic = r.topic), 0)
            as filed,
        case when r.topic = 'ecommerce.public.order_items' then (select loaded from loaded)
            else 0 end as loaded
    from received r"""


_IN_TIME = (
    "(o_orderkey is not null and l_shipdate >= o_orderdate "
    f"and l_shipdate <= o_orderdate + interval {td.WAIT_DAYS} day)"
)


def statements() -> dict[str, str]:
    normalized_customers = _normalized(CUSTOMER_RECORDS)
    normalized_products = _normalized(PRODUCT_RECORDS)
    normalized_items = _normalized("select topic, \"partition\", \"offset\", "
                                   "min(\"timestamp\") as \"timestamp\", "
                                   "arg_min(value, struct_pack(a := \"timestamp\", b := key, "
                                   "c := value)) as value "
                                   f"from ({ITEM_RECORDS}) group by 1, 2, 3")
    normalized_all = _normalized(RECORDS)
    from_cdc = (
        f"with {normalized_customers}, {_CUSTOMER_TYPED}, "
        + fold("customer", "select * from customer_errors where len(errors) = 0", _OFFSET, _OFFSET)
    )
    customer = f"with {CUSTOMER}"
    product = f"with {PRODUCT}"
    return {
        "cdc_source": 'select topic, "partition", count(*) as records, '
        'min("offset") as first_offset, max("offset") as last_offset '
        f'from ({RECORDS}) group by topic, "partition"',
        "cdc_stream": 'select topic, "partition", count(*) as records, '
        'min("offset") as first_offset, max("offset") as last_offset '
        f'from ({RECORDS}) group by topic, "partition"',
        "cdc_stream_dedup": 'select topic, "partition", count(*) as records, '
        'min("offset") as first_offset, max("offset") as last_offset '
        f'from (select distinct topic, "partition", "offset" from ({ITEM_RECORDS})) group by topic, "partition"',
        "applied_ranges": f'with a as (select distinct topic, "partition", "offset" as o from ({ITEM_RECORDS})), '
        'b as (select *, o - row_number() over (partition by topic, "partition" order by o) as island from a) '
        'select topic, "partition", min(o) as first, max(o) as last from b group by topic, "partition", island',
        "bootstrap_interleaved": "with " + fold("customer", f"select * from ({CUSTOMER_CHANGES}) where op <> 'r'", '"offset"', '"offset"')
        + " select customer_id, first_name, last_name, email, phone, city, country from dim_customer "
        "where is_current",
        "current_customers_stream": f"{customer} select customer_id, version, valid_from, first_name, "
        "last_name, email, phone, address, city, country from dim_customer where is_current",
        "fact_orders_stream_join": "select l_orderkey as order_id, "
        f"count(*) filter (where {_IN_TIME}) as loaded, count(*) filter (where not {_IN_TIME}) as rejected "
        "from lineitem left join orders on o_orderkey = l_orderkey and o_orderkey % 17 <> 0 group by 1",
        "sync_differences": f"with o as ({ORDERS}), c as (select * from ({_feed(td.ORDER_COPY, 'orders')}) "
        "where order_id % 1009 <> 0) select coalesce(o.order_id, c.order_id) as order_id, "
        "case when c.order_id is null then 'missing' when o.order_id is null then 'extra' else 'changed' end "
        "as difference from o full join c on o.order_id = c.order_id where c.order_id is null "
        "or o.order_id is null or (o.customer_id, o.order_date, o.status, o.total_amount) "
        "is distinct from (c.customer_id, c.order_date, c.status, c.total_amount)",
        "cdc_decode": f"with {normalized_customers} "
        'select "partition", "offset", "timestamp", kind from normalized',
        "cdc_tombstones": 'select topic, "partition", count(*) as records, '
        "count(*) filter (where value is null or trim(value) = 'null') as tombstones "
        f'from ({RECORDS}) group by topic, "partition"',
        "cdc_normalize": f"with {normalized_customers} "
        'select "partition", "offset", wrapped, op, outcome, error_type, '
        "case when outcome = 'change' then "
        "cast(json_extract_string(row_image, '$.customer_id') as bigint) end as customer_id, "
        "case when outcome = 'change' then json_extract_string(row_image, '$.phone') end as phone "
        "from normalized",
        "cdc_route_counts": f"with {normalized_all} select topic, outcome, count(*) as records, "
        "topic <> 'ecommerce.public.orders' as handled from normalized group by topic, outcome",
        "cdc_op_counts": f"with {normalized_all} select topic, op, count(*) as records "
        "from normalized where outcome in ('change', 'skipped') group by topic, op",
        "validate_customers": f"with {normalized_customers}, {_CUSTOMER_TYPED} "
        'select "partition", "offset", op, customer_id, '
        "cast(len(errors) as integer) as n_errors, errors[1] as error_type from customer_errors",
        "validate_products": f"with {normalized_products}, {_PRODUCT_TYPED} "
        'select "partition", "offset", op, product_id, '
        "cast(len(errors) as integer) as n_errors, errors[1] as error_type from product_errors",
        "validate_not_null": f"with {normalized_all}, {_CUSTOMER_TYPED}, "
        f"f as (with {_CURRENT_FACTS} select * from loaded) "
        + " union all ".join(
            [
                f"select '{table}' as table_name, '{c}' as column_name, "
                f"count(*) filter (where {_text(c)} is null) as nulls "
                f"from changes where topic = 'ecommerce.public.{table}'"
                for table, names in (
                    ("customers", ["customer_id"]),
                    ("products", ["product_id"]),
                    ("order_items", ["order_item_id", "order_id", "product_id", "quantity"]),
                )
                for c in names
            ]
            + [
                f"select 'fact_orders', '{shown}', count(*) filter (where {c} is null) from f"
                for shown, c in {
                    "customer_key": "found_customer",
                    "product_key": "found_product",
                    "date_key": "date_key",
                    "quantity": "quantity",
                    "unit_price": "unit_price",
                    "line_total": "line_total",
                }.items()
            ]
        ),
        "validate_lengths": f"with {normalized_all} "
        + " union all ".join(
            f"select '{table}' as table_name, '{c}' as column_name, "
            f"count(*) filter (where length({_text(c)}) > {n}) as overlong "
            f"from changes where topic = 'ecommerce.public.{table}'"
            for table, limits in (
                ("customers", _CUSTOMER_LIMITS),
                ("products", {"product_name": 255, "category": 100, "brand": 100}),
                ("orders", {"status": 50}),
            )
            for c, n in limits.items()
        ),
        "validate_orders": f"with {_normalized(ORDER_RECORDS)}, e as (select \"partition\", "
        f"\"offset\", op, cast({_text('order_id')} as bigint) as order_id, op is distinct from 'd' "
        f"and length({_text('status')}) > 50 as is_long from changes) "
        "select \"partition\", \"offset\", op, order_id, cast(coalesce(is_long, false) as integer) "
        "as n_errors, case when is_long then 'DataError' end as error_type from e",
        "keyless_changes": f"with {normalized_customers} select op, count(*) as keyless from changes "
        f"where {_text('customer_id')} is null group by op",
        "dup_emails": f"{customer} select email, count(*) as n from dim_customer where is_current "
        "group by email having count(*) > 1",
        "dup_keys": f'select topic, "partition", "offset", count(*) as n from ({ITEM_RECORDS}) '
        'group by topic, "partition", "offset" having count(*) > 1',
        "orphan_rows": f"with {CUSTOMER}, {_LATEST_ORDERS}, o as ({ORDERS}), i as ({ITEMS}) "
        "select 'order_customer' as relation, count(*) as orphans, min(order_id) as first_id, "
        "max(order_id) as last_id from o where customer_id not in "
        "(select customer_id from dim_customer where is_current) "
        "union all select 'item_order', count(*), min(order_item_id), max(order_item_id) from i "
        "where order_id not in (select order_id from latest) "
        "union all select 'item_product', count(*), min(order_item_id), max(order_item_id) from i "
        "where product_id not in (select p_partkey from part) "
        "union all select 'order_date', count(*), min(order_id), max(order_id) from o "
        "where order_date < timestamp '2020-01-01' or order_date >= timestamp '2031-01-01'",
        "dim_customer_scd2": f"{customer} select {_CUSTOMER_COLUMNS}, opened as open_offset "
        "from dim_customer",
        "dim_product_scd2": f"{product} select {_PRODUCT_COLUMNS}, opened as open_orderkey "
        "from dim_product",
        "dim_product_scd2_sliced": f"{product} select {_PRODUCT_COLUMNS}, opened as open_orderkey "
        "from dim_product",
        "bootstrap_dims": customers_as(
            f"select {_CUSTOMER_COLUMNS}, opened as open_offset from dim_customer",
            f"{CUSTOMER_SNAPSHOT} union all {CUSTOMER_CHANGES}",
        ),
        "dim_customer_from_cdc": f"{from_cdc} select {_CUSTOMER_COLUMNS}, opened as open_offset "
        "from dim_customer",
        "scd2_change_flags": f'{customer} select customer_id, "offset", op, opens = 1 as opens '
        "from customer_flagged",
        "dim_customer_scd1_latest": f"{customer} select customer_id, first_name, last_name, email, "
        "version from dim_customer where is_current",
        "dim_deleted_keys": f"{customer} select customer_id, max(valid_to) as deleted_at, "
        "count(*) as n_versions from dim_customer group by customer_id having not bool_or(is_current)",
        "product_margin": "with m as (select l_orderkey * 8 + l_linenumber as order_item_id, "
        "cast(l_extendedprice as decimal(10,2)) as price, "
        "cast(l_quantity * 1000 as decimal(10,2)) as cost from lineitem), "
        "f as (select *, (cast(price as double) - cast(cost as double)) / cast(price as double) "
        "* 100 as x from m) "
        "select order_item_id, cast(price as double) as price, cast(cost as double) as cost, "
        "cast(case when abs(x) < 999.995 then cast(x as decimal(5,2)) end as double) "
        "as margin_percentage from f",
        "scd2_two_batches": f"{customer} select {_CUSTOMER_COLUMNS}, opened as open_offset "
        "from dim_customer",
        "scd2_integrity": _INTEGRITY,
        "scd2_integrity_sliced": _INTEGRITY,
        "dim_as_of": f"{customer} select {_CUSTOMER_COLUMNS} from dim_customer "
        "where valid_from <= timestamp '1998-06-15' and timestamp '1998-06-15' < valid_to",
        "dim_as_of_pruned": f"{customer} select {_CUSTOMER_COLUMNS} from dim_customer "
        "where valid_from <= timestamp '1998-06-15' and timestamp '1998-06-15' < valid_to",
        "latest_orders": f"with {_LATEST_ORDERS} select * from latest",
        "date_keys": f"select order_id, {_DAY_KEY.format('order_date')} as date_key "
        f"from ({ORDERS})",
        "fact_orders_load": f"with {_CURRENT_FACTS} select {_FACT} from loaded",
        "fact_rejects": f"with {_CURRENT_FACTS} select order_item_id, order_id, product_id, "
        "case when found_customer is null then 'customer_not_found' else 'product_not_found' end "
        "as reason from tried where found_customer is null or found_product is null",
        "fact_date_rejects": f"with {_LOADED} select order_item_id, date_key, "
        "'date_out_of_range' as reason from plain where order_date < timestamp '2020-01-01' "
        "or order_date >= timestamp '2031-01-01'",
        "fact_orders_asof": f"with {_ASOF_FACTS} select {_FACT}, customer_version, "
        "product_version from loaded",
        "fact_orders_asof_sliced": f"with {_ASOF_FACTS} select {_FACT}, customer_version, "
        "product_version from loaded",
        "fact_dedup": f"with {normalized_items}, it as (select "
        f"cast({_text('order_item_id')} as bigint) as order_item_id, "
        f"cast({_text('order_id')} as bigint) as order_id, "
        f"cast({_text('product_id')} as bigint) as product_id, "
        f"cast({_text('quantity')} as integer) as quantity, "
        f"{_amount('unit_price')} as unit_price, {_amount('line_total')} as line_total "
        f"from changes where op = 'c'), o as ({ORDERS}) "
        "select it.order_id, order_item_id, customer_id, product_id, "
        f"{_DAY_KEY.format('o.order_date')} as date_key, quantity, unit_price, line_total, "
        "status as order_status from it join o on o.order_id = it.order_id",
        "failed_capture": f"with {normalized_customers}, {_CUSTOMER_TYPED}, bad as ("
        'select topic, "partition", "offset", "timestamp" as ts, value, error_type, 1 as n_errors '
        "from normalized where outcome = 'failed' union all "
        "select 'ecommerce.public.customers', \"partition\", \"offset\", ts, value, errors[1], "
        "len(errors) from customer_errors where len(errors) > 0) "
        'select topic, "partition", "offset" as message_offset, ts as message_timestamp, '
        "value as message_value, error_type, cast(n_errors as integer) as n_errors, "
        "0 as retry_count, 3 as max_retries, "
        "timestamp '2024-01-31 00:05:00' as next_retry_at, 'pending' as status, "
        "timestamp '2024-01-31 00:00:00' as failed_at from bad",
        "failed_upsert": _FAILED_UPSERT,
        "failed_upsert_stored": _FAILED_UPSERT,
        "ready_for_retry": f'with {_FAILED} select topic, "partition", message_offset, '
        "error_type, retry_count, max_retries, failed_at, last_retry_at from ready",
        "retry_due_slots": f'with {_FAILED} select topic, "partition", message_offset, '
        "error_type, retry_count, max_retries, failed_at, last_retry_at from ready",
        "retry_batch": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, message_value, retry_count, max_retries, failed_at from ready "
        'order by failed_at, topic, "partition", message_offset limit 100',
        "retry_outcome": f"with {_FAILED} {_RETRIED}",
        "retry_run_totals": f"with {_FAILED} select count(*) filter (where succeeded) as succeeded, "
        "count(*) filter (where not succeeded and not last_try) as failed, "
        "count(*) filter (where not succeeded and last_try) as dead_lettered "
        "from tried where is_tried",
        "retry_one_outcome": f'with {_FAILED}, one as (select *, status = \'pending\' as is_one, '
        "message_offset % 3 = 0 as won from failed) "
        'select topic, "partition", message_offset, error_type, error_message, '
        "case when is_one and not won then retry_count + 1 else retry_count end as retry_count, "
        "max_retries, case when is_one and not won then timestamp '2024-01-31 00:00:00' "
        "else last_retry_at end as last_retry_at, case when is_one and not won "
        "then timestamp '2024-01-31 00:15:00' else next_retry_at end as next_retry_at, "
        "case when is_one and won then 'resolved' else status end as status, failed_at, "
        "case when is_one and won then timestamp '2024-01-31 00:00:00' end as resolved_at from one",
        "retry_all": f'with {_FAILED}, chosen as (select topic, "partition", message_offset '
        'from ready order by failed_at, topic, "partition", message_offset limit 100) '
        f"{_RETRIED} semi join chosen using (topic, \"partition\", message_offset)",
        "retry_replay": f"with {normalized_customers}, {_CUSTOMER_TYPED}, "
        + fold(
            "customer",
            "select * from customer_errors where len(errors) > 0 and not is_bad_still",
            _OFFSET,
            _OFFSET,
        )
        + f" select {_CUSTOMER_COLUMNS}, opened as open_offset from dim_customer",
        "retry_replay_outcomes": f"with {normalized_customers}, {_CUSTOMER_TYPED} "
        "select true as revalidated, cast(0 as bigint) as succeeded, count(*) as failed "
        "from customer_errors where len(errors) > 0 union all "
        "select false, count(*) filter (where not is_bad_still), "
        "count(*) filter (where is_bad_still) from customer_errors where len(errors) > 0",
        "record_time": "select event_id, case when event_id % 7 <> 0 "
        "then make_timestamp(epoch_us(ts) // 1000 * 1000) end as \"timestamp\" from events",
        "pipeline_batches": _PIPELINE_BATCHES,
        "failed_summary": f"with {_FAILED} select topic, status, error_type, "
        "count(*) as message_count, min(failed_at) as first_failure, "
        "max(failed_at) as last_failure, round(cast(sum(retry_count) as double) / count(*), 6) "
        "as avg_retry_count, count(*) filter (where retry_count >= max_retries) "
        "as dead_letter_count from failed group by topic, status, error_type",
        "failed_status_counts": f"with {_FAILED} select status, count(*) as n from failed "
        "group by status",
        "failed_page": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, error_type, error_message, retry_count, max_retries, status, "
        "failed_at, last_retry_at, next_retry_at from failed "
        'order by failed_at desc, topic, "partition", message_offset limit 20 offset 20',
        "failed_page_after": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, error_type, error_message, retry_count, max_retries, status, "
        "failed_at, last_retry_at, next_retry_at from failed "
        'order by failed_at desc, topic, "partition", message_offset limit 20 offset 20',
        "failed_page_deep": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, error_type, error_message, retry_count, max_retries, status, "
        "failed_at, last_retry_at, next_retry_at from failed "
        'order by failed_at desc, topic, "partition", message_offset limit 10 offset 290',
        "failed_page_pending": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, error_type, error_message, retry_count, max_retries, status, "
        "failed_at, last_retry_at, next_retry_at from failed where status = 'pending' "
        'order by failed_at desc, topic, "partition", message_offset limit 20',
        "failed_detail_one": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, message_key, message_value, error_type, error_message, "
        "error_stacktrace, retry_count, max_retries, last_retry_at, next_retry_at, status, "
        "resolution_notes, failed_at, resolved_at from failed "
        'order by topic, "partition", message_offset limit 1',
        "failed_page_counts": f"with {_FAILED} select status, count(*) as total, "
        "cast(ceil(count(*) / 20.0) as bigint) as pages from failed group by status",
        "failed_detail": f'with {_FAILED} select topic, "partition", message_offset, '
        "message_timestamp, message_key, message_value, error_type, error_message, "
        "error_stacktrace, retry_count, max_retries, last_retry_at, next_retry_at, status, "
        "resolution_notes, failed_at, resolved_at from failed",
        "partition_backlog": f"with {_FAILED} select * from backlog",
        "partition_backlog_or_healthy": f"with {_FAILED} select * from backlog",
        "failed_list_short": f"with {_FAILED} select replace(topic, 'ecommerce.public.', '') "
        'as topic, "partition", message_offset, substring(error_message, 1, 80) || \'...\' '
        "as error_message, status, failed_at from failed",
        "total_lag": f"with {_FAILED} select cast(coalesce(sum(lag), 0) as bigint) as total_lag "
        "from backlog",
        "daily_revenue": f"with {_LOADED} {_revenue_by('cast(order_date as date)', 'date')}, "
        "dayname(order_date) as day_of_week from plain "
        "where order_date >= timestamp '2001-08-01' - interval 30 day "
        "group by cast(order_date as date), dayname(order_date)",
        "daily_revenue_incremental": f"with {_LOADED} {_revenue_by('cast(order_date as date)', 'date')}, "
        "dayname(order_date) as day_of_week from plain "
        "where order_date >= timestamp '2001-08-01' - interval 30 day "
        "group by cast(order_date as date), dayname(order_date)",
        "revenue_by_grain": f"with {_LOADED} "
        f"{_revenue_by(_PERIOD.format('month'), 'period')} from plain group by 1",
        "revenue_by_week": f"with {_LOADED} "
        f"{_revenue_by(_PERIOD.format('week'), 'period')} from plain group by 1",
        "top_products": f"with {_LOADED}, {_SNAPSHOT_PRODUCT_SALES} {_TOP_PRODUCTS}",
        "top_products_ranked": f"with {_LOADED}, {_SNAPSHOT_PRODUCT_SALES}, t as ({_TOP_PRODUCTS}) "
        "select *, cast(row_number() over (order by total_revenue desc, product_id) as integer) "
        "as position from t",
        "top_customers": f"with {_LOADED} select customer_id, 'Customer ' || c_name "
        "as customer_name, 'c' || cast(customer_id as varchar) || '@example.com' as email, "
        "c_mktsegment as city, cast(c_nationkey as varchar) as country, "
        "count(distinct order_id) as total_orders, "
        "cast(sum(cast(line_total as decimal(18,2))) as double) as lifetime_value "
        "from plain join customer on c_custkey = customer_id group by all "
        "order by lifetime_value desc, customer_id limit 10",
        "sales_by_category": f"with {_BY_CATEGORY} select * from by_category",
        "sales_kpis": f"with {_BY_CATEGORY}, t as (select "
        "cast(sum(cast(revenue as decimal(18,2))) as double) as total_revenue, "
        "cast(sum(num_orders) as bigint) as total_orders, "
        "cast(sum(units_sold) as bigint) as total_units from by_category) "
        "select *, round(total_revenue / total_orders, 6) as avg_order_value from t",
        "product_sales_current_versions": f"with {_ASOF_FACTS}, "
        + _PRODUCT_SALES.format(
            facts="(select * from loaded where product_is_current)", **_FOLDED_PRODUCT_SALES
        )
        + " select * from product_sales",
        "product_sales_all_versions": f"with {_ASOF_FACTS}, "
        + _PRODUCT_SALES.format(facts="loaded", **_FOLDED_PRODUCT_SALES)
        + " select * from product_sales",
        "customer_history": f"{customer} select {_CUSTOMER_COLUMNS}, "
        "count(*) over (partition by customer_id) as n_versions, is_current as is_open "
        "from dim_customer",
        "product_history": f"{product} select {_PRODUCT_COLUMNS}, "
        "count(*) over (partition by product_id) as n_versions, is_current as is_open "
        "from dim_product".replace("description, ", ""),
        "current_customers": f"{customer} select customer_id, first_name, last_name, email, phone, "
        "city, country from dim_customer where is_current",
        "current_products": f"{product} select product_id, product_name, category, brand, "
        "cast(price as double) as price from dim_product where is_current",
        "recent_changes": f"with {CUSTOMER}, {PRODUCT}, both_kinds as ("
        "select 'customer' as entity_type, customer_id as entity_id, "
        "first_name || ' ' || last_name as entity_name, email, cast(null as double) as price, "
        f"valid_from as change_time, version, is_current, {_CHANGE_TYPE} as change_type "
        "from dim_customer union all select 'product', product_id, product_name, null, "
        f"cast(price as double), valid_from, version, is_current, {_CHANGE_TYPE} from dim_product) "
        "select * from both_kinds order by change_time desc, entity_type, entity_id, version desc "
        "limit 20",
        "dim_date": _CALENDAR.format(c="o_orderdate", t="orders"),
        "dim_date_extend": _CALENDAR.format(
            c="d", t="(select o_orderdate as d from orders union all select l_shipdate from lineitem)"
        ),
        "cdc_stats": f"with {_CURRENT_FACTS}, n as (select "
        "(select count(*) from customer) as source_customers, "
        "(select count(*) from part) as source_products, "
        "(select count(*) from orders) as source_orders, "
        "(select count(distinct customer_id) from dim_customer where is_current) "
        "as warehouse_customers, "
        "(select count(distinct product_id) from dim_product where is_current) as warehouse_products, "
        "(select count(distinct order_id) from loaded) as warehouse_orders), "
        "p as (select *, "
        "round(warehouse_customers / source_customers * 100, 6) as customers_percent, "
        "round(warehouse_products / source_products * 100, 6) as products_percent, "
        "round(warehouse_orders / source_orders * 100, 2) as orders_percent from n) "
        "select *, warehouse_customers = source_customers and warehouse_products = source_products "
        "and orders_percent >= 75 as in_sync, "
        "case when customers_percent = 100 then 'ok' else 'warn' end as customers_level, "
        "case when products_percent = 100 then 'ok' else 'warn' end as products_level, "
        "case when orders_percent >= 95 then 'ok' when orders_percent >= 80 then 'warn' "
        "else 'bad' end as orders_level from p",
        "source_counts": "select 'customers' as table_name, count(*) as n from customer "
        "union all select 'products', count(*) from part "
        "union all select 'orders', count(*) from orders "
        "union all select 'order_items', count(*) from lineitem",
        "order_totals": f"with o as ({ORDERS}), i as ({ITEMS}), s as (select order_id, "
        "sum(cast(line_total as decimal(18,2))) as t, count(*) filter "
        "(where round(quantity * unit_price, 2) <> line_total) as w from i group by order_id) "
        "select o.order_id, cast(total_amount as double) as total_amount, "
        "cast(coalesce(t, 0) as double) as lines_total, "
        "cast(total_amount - coalesce(t, 0) as double) as difference, "
        "coalesce(w, 0) as wrong_lines from o left join s on s.order_id = o.order_id",
    }


_PERIOD = "cast(date_trunc('{}', order_date) as date)"
