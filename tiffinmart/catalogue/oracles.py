"""DuckDB SQL for the registered queries, written from the definitions and not from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from tiffinmart import entities
from tiffinmart.catalogue.standins import stage_sql
from tiffinmart.functions.places import CAPITALS, STATE_CODES, TIER_1, TIER_2, UNION_TERRITORIES

__all__ = ["stage_sql"]

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
EARLY, MIDDLE = "1990-01-01 00:00:00", "1998-06-01 00:00:00"
AS_OF = "2001-12-31"


# -- scalar pieces -------------------------------------------------------------------------------


def number(x: str) -> str:
    return f"TRY_CAST(TRY_CAST({x} AS DECIMAL(38,0)) AS BIGINT)"


def dec(x: str, p: int, s: int) -> str:
    return f"CAST(TRY_CAST({x} AS DECIMAL({p},{s})) AS DOUBLE)"


def _raw_dec(x: str, p: int, s: int) -> str:
    return f"TRY_CAST({x} AS DECIMAL({p},{s}))"


def hash60(text: str) -> str:
    return f"CAST('0x' || substr(sha1({text}), 1, 15) AS BIGINT)"


def netstring(cols: Sequence[str]) -> str:
    parts = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in cols]
    return " || ".join(parts)


def _in(values: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


STATE_NAME = "CASE WHEN state = 'Delhi' THEN 'New Delhi' ELSE state END"
STATE_CODE = "CASE state " + " ".join(f"WHEN '{s}' THEN '{k}'" for s, k in STATE_CODES.items()) + " END"
UNION_TERRITORY = f"CASE WHEN state IN {_in(UNION_TERRITORIES)} THEN TRUE ELSE FALSE END"
CAPITAL = "CASE " + " ".join(f"WHEN state = '{s}' AND city = '{c}' THEN TRUE" for s, c in CAPITALS) + " ELSE FALSE END"
TIER = f"CASE WHEN city IN {_in(TIER_1)} THEN 'Tier-1' WHEN city IN {_in(TIER_2)} THEN 'Tier-2' ELSE 'Tier-3' END"


# -- clean tables --------------------------------------------------------------------------------


def _typed_sql(entity: str, day: int, mode: str = "default", initial: bool = False) -> str:
    """Typed rows with decimals kept as decimals, for use inside other oracles."""
    src = f"({stage_sql(entity, day)})"
    if entity == "location":
        return f"""SELECT CAST(locationid AS BIGINT) AS location_id, city, {STATE_NAME} AS state, {STATE_CODE} AS state_code,
            {UNION_TERRITORY} AS is_union_territory, {CAPITAL} AS capital_city_flag, {TIER} AS city_tier,
            zipcode AS zip_code, activeflag AS active_flag,
            strptime(createddate, '%Y-%m-%d %H:%M:%S') AS created_ts, strptime(modifieddate, '%Y-%m-%d %H:%M:%S') AS modified_ts
            FROM {src} WHERE {STATE_CODE} IS NOT NULL"""
    if entity == "restaurant":
        return f"""SELECT {number('restaurantid')} AS restaurant_id, name, cuisinetype AS cuisine_type,
            {_raw_dec('pricing_for_2', 10, 2)} AS pricing_for_two, restaurant_phone, operatinghours AS operating_hours,
            {number('locationid')} AS location_id_fk, activeflag AS active_flag, openstatus AS open_status, locality,
            restaurant_address, {_raw_dec('latitude', 9, 6)} AS latitude, {_raw_dec('longitude', 9, 6)} AS longitude,
            TRY_CAST(substr(createddate, 1, 26) AS TIMESTAMP) AS created_dt, TRY_CAST(modifieddate AS TIMESTAMP) AS modified_dt
            FROM {src}"""
    if entity == "customer":
        masks = ["%Y-%m-%d %H:%M:%S"] if initial else ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f"]

        def ts(x: str) -> str:
            return "coalesce(" + ", ".join(f"try_strptime({x}, '{m}')" for m in masks) + ")"

        return f"""SELECT customerid AS customer_id, name, mobile, email, loginbyusing AS login_by_using, gender,
            CAST(try_strptime(dob, '%Y-%m-%d') AS DATE) AS dob, CAST(try_strptime(anniversary, '%Y-%m-%d') AS DATE) AS anniversary,
            preferences, {ts('createddate')} AS created_dt, {ts('modifieddate')} AS modified_dt FROM {src}"""
    if entity == "customer_address":
        return f"""SELECT CAST(addressid AS BIGINT) AS address_id, CAST(customerid AS BIGINT) AS customer_id_fk, flatno AS flat_no,
            houseno AS house_no, floor, building, landmark, locality, city, state, pincode, coordinates,
            primaryflag AS primary_flag, addresstype AS address_type,
            try_strptime(createddate, '%Y-%m-%dT%H:%M:%S') AS created_date, try_strptime(modifieddate, '%Y-%m-%dT%H:%M:%S') AS modified_date
            FROM {src}"""
    if entity == "menu":
        return f"""SELECT {number('menuid')} AS menu_id, {number('restaurantid')} AS restaurant_id_fk, trim(itemname) AS item_name,
            trim(description) AS description, {_raw_dec('price', 10, 2)} AS price, trim(category) AS category,
            CASE lower(availability) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS availability, trim(itemtype) AS item_type,
            TRY_CAST(createddate AS TIMESTAMP) AS created_dt, TRY_CAST(modifieddate AS TIMESTAMP) AS modified_dt
            FROM {src} WHERE {_raw_dec('price', 10, 2)} IS NOT NULL"""
    if entity == "delivery_agent":
        return f"""SELECT {number('deliveryagentid')} AS delivery_agent_id, name, phone, vehicletype AS vehicle_type,
            {number('locationid')} AS location_id_fk, status, gender, {_raw_dec('rating', 4, 2)} AS rating,
            TRY_CAST(createddate AS TIMESTAMP) AS created_dt, TRY_CAST(modifieddate AS TIMESTAMP) AS modified_dt FROM {src}"""
    if entity == "delivery":
        return f"""SELECT CAST(deliveryid AS BIGINT) AS delivery_id, CAST(orderid AS BIGINT) AS order_id_fk,
            CAST(deliveryagentid AS BIGINT) AS delivery_agent_id_fk, deliverystatus AS delivery_status,
            estimatedtime AS estimated_time, CAST(addressid AS BIGINT) AS customer_address_id_fk,
            CAST(deliverydate AS TIMESTAMP) AS delivery_date, CAST(createddate AS TIMESTAMP) AS created_date,
            CAST(modifieddate AS TIMESTAMP) AS modified_date FROM {src}"""
    if entity == "orders":
        return f"""SELECT {number('orderid')} AS order_id, {number('customerid')} AS customer_id_fk,
            {number('restaurantid')} AS restaurant_id_fk, TRY_CAST(orderdate AS TIMESTAMP) AS order_date,
            {_raw_dec('totalamount', 10, 2)} AS total_amount, status, paymentmethod AS payment_method,
            TRY_CAST(createddate AS TIMESTAMP) AS created_dt, TRY_CAST(modifieddate AS TIMESTAMP) AS modified_dt FROM {src}"""
    return f"""SELECT CAST(orderitemid AS BIGINT) AS order_item_id, CAST(orderid AS BIGINT) AS order_id_fk,
        CAST(menuid AS BIGINT) AS menu_id_fk, CAST(quantity AS DECIMAL(10,2)) AS quantity, CAST(price AS DECIMAL(10,2)) AS price,
        CAST(subtotal AS DECIMAL(10,2)) AS subtotal, CAST(createddate AS TIMESTAMP) AS created_dt,
        CAST(modifieddate AS TIMESTAMP) AS modified_dt FROM {src}"""


def _decimals(entity: str) -> list[str]:
    return [f.name for f in entities.get(entity).fields if f.type.startswith("decimal")]


def _plain(entity: str, sql: str) -> str:
    """Decimals of an entity shown as doubles."""
    swaps = ", ".join(f"CAST({d} AS DOUBLE) AS {d}" for d in _decimals(entity))
    return f"SELECT * REPLACE ({swaps}) FROM ({sql})" if swaps else sql


def clean_sql(entity: str, day: int, initial: bool = False) -> str:
    return _plain(entity, _typed_sql(entity, day, initial=initial))


# -- change feed, upsert, dimensions -------------------------------------------------------------


def _two_days(entity: str) -> str:
    return f"WITH v0 AS ({_typed_sql(entity, 0)}), v1 AS ({_typed_sql(entity, 1)})"


def _using(cols: Sequence[str]) -> str:
    return "USING (" + ", ".join(cols) + ")"


def _differs(cols: Sequence[str], a: str, b: str, op: str = "IS DISTINCT FROM") -> str:
    return "(" + " OR ".join(f"{a}.{c} {op} {b}.{c}" for c in cols) + ")"


def feed_sql(entity: str) -> str:
    e = entities.get(entity)
    rest = [c for c in e.columns if c not in e.key]
    key = e.key[0]
    sql = f"""{_two_days(entity)}
        SELECT v0.*, 'DELETE' AS _action, v1.{key} IS NOT NULL AS _is_update FROM v0 LEFT JOIN v1 {_using(e.key)}
        WHERE v1.{key} IS NULL OR {_differs(rest, 'v0', 'v1')}
        UNION ALL
        SELECT v1.*, 'INSERT', v0.{key} IS NOT NULL FROM v1 LEFT JOIN v0 {_using(e.key)}
        WHERE v0.{key} IS NULL OR {_differs(rest, 'v0', 'v1')}"""
    return _plain(entity, sql)


def change_detect_sql(op: str) -> str:
    cols = ["login_by_using", "gender", "dob"]
    return f"""{_two_days('customer')}
        SELECT customer_id, coalesce({_differs(cols, 'v0', 'v1', op)}, FALSE) AS changed FROM v0 JOIN v1 USING (customer_id)"""


def upsert_sql(entity: str, mode: str = "default") -> str:
    """Rows of day 0, overwritten by day 1 where the entity allows, plus the new keys of day 1."""
    e = entities.get(entity)
    updates = [c for c in e.update_columns if c in e.columns]
    hit = f"v1.{e.key[0]} IS NOT NULL"
    if entity == "location":
        compared = [c for c in e.columns if c not in e.key and c != "created_ts"]
        hit += f" AND {_differs(compared, 'v0', 'v1')}"
    kept = [f"CASE WHEN {hit} THEN v1.{c} ELSE v0.{c} END AS {c}" if c in updates else f"v0.{c} AS {c}" for c in e.columns]
    new = [
        "CAST(round(v1.rating) AS DECIMAL(4,2))" if entity == "delivery_agent" and mode == "reference" and c == "rating" else f"v1.{c}"
        for c in e.columns
    ]
    sql = f"""{_two_days(entity)}
        SELECT {', '.join(kept)} FROM v0 LEFT JOIN v1 {_using(e.key)}
        UNION ALL SELECT {', '.join(new)} FROM v1 ANTI JOIN v0 {_using(e.key)}"""
    return _plain(entity, sql)


def full_source_sql(entity: str) -> str:
    """The source is both days; per key the row modified last counts, then the greatest."""
    e = entities.get(entity)
    order = [e.modified] + [c for c in e.columns if c != e.modified]
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    sql = f"""WITH everything AS ({_typed_sql(entity, 0)} UNION ALL {_typed_sql(entity, 1)})
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(e.key)} ORDER BY {ranked}) AS rn FROM everything)
        WHERE rn = 1"""
    return _plain(entity, sql)


def _version_columns(spec, row: str, hk: str, start: str, end: str, flag: str) -> str:
    attrs = ", ".join(f"{row}.{a} AS {a}" for a in spec.attributes)
    return (
        f"{hk} AS {spec.key}, {attrs}, {start} AS {spec.start}, {end} AS {spec.end}, {flag} AS {spec.flag}"
    )


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _plain_dim(entity: str, spec, sql: str) -> str:
    swaps = [f"CAST({d} AS DOUBLE) AS {d}" for d in _decimals(entity) if d in spec.attributes]
    swaps.append(f"CAST({spec.key} AS VARCHAR) AS {spec.key}")
    return f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({sql})"


def _reference_scd2(entity: str, spec=None) -> str:
    e = entities.get(entity)
    spec = spec or e.dimension
    rest = [c for c in e.columns if c not in e.key]
    key = e.key[0]

    def hk(row: str) -> str:
        return hash60(" || ".join(f"CAST({row}.{h} AS VARCHAR)" for h in spec.hash_cols))

    def match(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{m} = {b}.{m}" for m in spec.match_cols)

    return f"""{_two_days(entity)},
        old_images AS (SELECT v0.* FROM v0 JOIN v1 USING ({key}) WHERE {_differs(rest, 'v0', 'v1')}),
        new_images AS (SELECT v1.* FROM v1 LEFT JOIN v0 USING ({key}) WHERE v0.{key} IS NULL OR {_differs(rest, 'v0', 'v1')}),
        marked AS (SELECT v0.*, EXISTS (SELECT 1 FROM old_images o WHERE {match('o', 'v0')}) AS hit FROM v0)
        SELECT {_version_columns(spec, 'd', hk('d'), _ts(T0), f"CASE WHEN d.hit THEN {_ts(T1)} END", 'NOT d.hit')} FROM marked d
        UNION ALL
        SELECT {_version_columns(spec, 'i', hk('i'), _ts(T1), 'NULL', 'TRUE')} FROM new_images i
        WHERE NOT EXISTS (SELECT 1 FROM v0 WHERE {match('v0', 'i')})"""


def reference_scd2_sql(entity: str, spec=None) -> str:
    return _plain_dim(entity, spec or entities.get(entity).dimension, _reference_scd2(entity, spec))


def _keyed_scd2(entity: str, t0: str = T0, t1: str = T1) -> str:
    """Day-0 rows, closed when day 1 shows other attributes, and the day-1 rows that differ or are new."""
    e = entities.get(entity)
    spec = e.dimension
    key = e.key[0]
    differs = _differs(spec.attributes, "v0", "v1")
    closed = f"(v1.{key} IS NOT NULL AND {differs})"

    def hk(row: str, start: str) -> str:
        return hash60(netstring([f"{row}.{a}" for a in spec.attributes] + [f"'{start}'"]))

    return f"""{_two_days(entity)}
        SELECT {_version_columns(spec, 'v0', hk('v0', t0), _ts(t0), f"CASE WHEN {closed} THEN {_ts(t1)} END", f'NOT {closed}')}
        FROM v0 LEFT JOIN v1 ON v0.{key} = v1.{key}
        UNION ALL
        SELECT {_version_columns(spec, 'v1', hk('v1', t1), _ts(t1), 'NULL', 'TRUE')}
        FROM v1 LEFT JOIN v0 ON v0.{key} = v1.{key} WHERE v0.{key} IS NULL OR {differs}"""


def keyed_scd2_sql(entity: str) -> str:
    return _plain_dim(entity, entities.get(entity).dimension, _keyed_scd2(entity))


def as_of_sql() -> str:
    return f"""SELECT o.o_orderkey AS order_id, CAST(d.customer_id AS BIGINT) AS customer_id, o.o_orderdate AS order_date,
        d.login_by_using, d.gender, d.is_current
        FROM orders o JOIN ({_keyed_scd2('customer', EARLY, MIDDLE)}) d ON CAST(d.customer_id AS BIGINT) = o.o_custkey
        AND d.eff_start_date <= o.o_orderdate AND (d.eff_end_date IS NULL OR o.o_orderdate < d.eff_end_date)"""


def star_join_as_of_sql() -> str:
    """Every dimension joined by the interval that holds the order's time."""
    rows = _fact_select(_typed_sql("order_item", 0), _typed_sql("orders", 0), _typed_sql("delivery", 0))
    dims = ", ".join(f"d_{n} AS ({_keyed_scd2(n, EARLY, MIDDLE)})" for n in _DIMS)
    within = []
    for n, alias in zip(_DIMS, ("c", "ca", "r", "rl", "m", "da"), strict=True):
        spec = entities.get(n).dimension
        within.append(f"{alias}.{spec.start} <= o.order_date AND ({alias}.{spec.end} IS NULL OR o.order_date < {alias}.{spec.end})")
    return f"WITH {dims} {rows} WHERE {' AND '.join(within)}"


#: When customers were corrected, confirmed and gone, in the query on valid time.
CORRECTED, CONFIRMED, LEFT = "1995-03-01 00:00:00", "1999-01-01 00:00:00", "2000-01-01 00:00:00"


def valid_time_sql() -> str:
    """All points at once, in order of time: equal neighbours fall together, the next turn ends a version."""
    spec = entities.get("customer").dimension
    attrs = ", ".join(spec.attributes)
    corrected = ", ".join("'phone' AS login_by_using" if a == "login_by_using" else a for a in spec.attributes)
    day = [f"({_typed_sql('customer', d)})" for d in (0, 1)]
    number = "CAST(customer_id AS BIGINT)"
    key = hash60(netstring([*spec.attributes, f"CAST({spec.start} AS VARCHAR)"]))
    return _plain_dim(
        "customer",
        spec,
        f"""WITH p AS (
            SELECT {attrs}, {_ts(EARLY)} AS at_, FALSE AS gone FROM {day[0]} UNION ALL SELECT {attrs}, {_ts(MIDDLE)}, FALSE FROM {day[1]}
            UNION ALL SELECT {corrected}, {_ts(CORRECTED)}, FALSE FROM {day[0]} WHERE {number} % 5 = 0
            UNION ALL SELECT {attrs}, {_ts(CONFIRMED)}, FALSE FROM {day[1]} UNION ALL SELECT {attrs}, {_ts(LEFT)}, TRUE FROM {day[1]} WHERE {number} % 7 = 0),
        s AS (SELECT *, CASE WHEN NOT gone THEN row({attrs}) END AS said FROM p),
        m AS (SELECT *, CASE WHEN lag(gone) OVER w IS NULL THEN gone ELSE lag(gone) OVER w = gone AND lag(said) OVER w IS NOT DISTINCT FROM said END AS again
            FROM s WINDOW w AS (PARTITION BY customer_id ORDER BY at_)),
        v AS (SELECT *, at_ AS {spec.start}, lead(at_) OVER (PARTITION BY customer_id ORDER BY at_) AS {spec.end} FROM m WHERE NOT again)
        SELECT {key} AS {spec.key}, {attrs}, {spec.start}, {spec.end}, {spec.end} IS NULL AS {spec.flag} FROM v WHERE NOT gone""",
    )


# -- calendar ------------------------------------------------------------------------------------


def calendar_sql(days: str, key: str | None = None) -> str:
    first = f"{key}, " if key else ""
    return f"""SELECT {first}year(d) AS year, quarter(d) AS quarter, month(d) AS month, weekofyear(d) AS week,
        dayofyear(d) AS day_of_year, dayofweek(d) AS day_of_week, day(d) AS day_of_the_month, strftime(d, '%a') AS day_name
        FROM ({days})"""


def _date_key(d: str) -> str:
    return hash60(netstring([d]))


def date_dim_sql(skip_first: bool = False) -> str:
    lo = "min(CAST(o_orderdate AS DATE))" + (" + INTERVAL 1 DAY" if skip_first else "")
    days = f"""SELECT CAST(d AS DATE) AS d, CAST(d AS DATE) AS calendar_date, CAST({_date_key('CAST(d AS DATE)')} AS VARCHAR) AS date_dim_hk
        FROM (SELECT unnest(generate_series({lo}, DATE '{AS_OF}', INTERVAL 1 DAY)) AS d FROM orders)"""
    return calendar_sql(days, "date_dim_hk, calendar_date")


# -- KPIs ----------------------------------------------------------------------------------------

SALES = """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_suppkey AS restaurant_id,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS subtotal,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END AS delivery_status,
    CAST(o_orderdate AS DATE) AS day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

MEASURE_NAMES = "total_revenue, total_orders, avg_revenue_per_order, avg_revenue_per_item, max_order_value"


def _ratio(n: str) -> str:
    # Half-up rounding to cents in whole numbers; DuckDB divides decimals as doubles.
    return f"CAST((CAST(sum(subtotal) * 100 AS HUGEINT) * 2 + {n}) // ({n} * 2) AS DOUBLE) / 100.0"


_MEASURES = f"""CAST(sum(subtotal) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS total_orders,
    {_ratio('count(DISTINCT order_id)')} AS avg_revenue_per_order, {_ratio('count(order_item_id)')} AS avg_revenue_per_item,
    CAST(max(subtotal) AS DOUBLE) AS max_order_value"""
_DAY_PARTS = "year(day) AS year, month(day) AS month, day(day) AS day_of_month, strftime(day, '%a') AS day_name"


def kpi_sql(by: str, show: str | None = None, where: str = "delivery_status = 'Delivered'") -> str:
    return f"SELECT {show or by}, {_MEASURES} FROM (SELECT *, {_DAY_PARTS} FROM ({SALES})) WHERE {where} GROUP BY {by}"


def restaurant_kpi_sql() -> str:
    rows = f"SELECT s.*, {_DAY_PARTS}, s_name AS restaurant_name FROM ({SALES}) s JOIN supplier ON restaurant_id = s_suppkey"
    by = "year, month, delivery_status, restaurant_name"
    return f"SELECT {by}, {_MEASURES} FROM ({rows}) GROUP BY {by}"


def yoy_sql() -> str:
    names = MEASURE_NAMES.split(", ")
    # Differences of cents, taken in decimals as the KPIs themselves are.
    diffs = ", ".join(
        f"k.{n} - p.{n} AS {n}_diff"
        if n == "total_orders"
        else f"CAST(CAST(k.{n} AS DECIMAL(28,2)) - CAST(p.{n} AS DECIMAL(28,2)) AS DOUBLE) AS {n}_diff"
        for n in names
    )
    return f"WITH k AS ({kpi_sql('year')}) SELECT k.*, {diffs} FROM k LEFT JOIN k p ON p.year = k.year - 1"


# -- fact ----------------------------------------------------------------------------------------

_DIMS = {
    "customer": ("customer_hk", "customer_id"),
    "customer_address": ("customer_address_hk", "address_id"),
    "restaurant": ("restaurant_hk", "restaurant_id"),
    "location": ("restaurant_location_hk", "location_id"),
    "menu": ("menu_dim_hk", "menu_id"),
    "delivery_agent": ("delivery_agent_hk", "delivery_agent_id"),
}
_FACT_KEYS = {
    "customer_dim_key": "c.customer_hk",
    "customer_address_dim_key": "ca.customer_address_hk",
    "restaurant_dim_key": "r.restaurant_hk",
    "restaurant_location_dim_key": "rl.restaurant_location_hk",
    "menu_dim_key": "m.menu_dim_hk",
    "delivery_agent_dim_key": "da.delivery_agent_hk",
}


def _dim_ctes(dims: str) -> str:
    if dims == "reference":
        return ", ".join(f"d_{n} AS ({_reference_scd2(n)})" for n in _DIMS)
    if dims == "initial":  # day 0 only
        parts = []
        for n, (hk, _) in _DIMS.items():
            attrs = entities.get(n).dimension.attributes
            key = hash60(netstring([*attrs, f"'{T0}'"]))
            parts.append(f"d_{n} AS (SELECT *, {key} AS {hk} FROM ({_typed_sql(n, 0)}))")
        return ", ".join(parts)
    return ", ".join(
        f"d_{n} AS (SELECT * FROM ({_keyed_scd2(n)}) WHERE {entities.get(n).dimension.flag})" for n in _DIMS
    )


def _fact_select(items: str, orders: str, deliveries: str, reference: bool = False) -> str:
    keys = ", ".join(f"CAST({e} AS VARCHAR) AS {k}" for k, e in _FACT_KEYS.items())
    day = "CAST(o.order_date AS DATE)"
    address = "ca.customer_id_fk = CAST(c.customer_id AS BIGINT)" if reference else "ca.address_id = d.customer_address_id_fk"
    return f"""SELECT oi.order_item_id, oi.order_id_fk AS order_id, {keys},
        CAST({_date_key(day)} AS VARCHAR) AS order_date_dim_key, CAST(CAST(oi.quantity AS DECIMAL(12,0)) AS BIGINT) AS quantity,
        CAST(oi.price AS DOUBLE) AS price, CAST(oi.subtotal AS DOUBLE) AS subtotal, d.delivery_status, d.estimated_time
        FROM ({items}) oi JOIN ({orders}) o ON oi.order_id_fk = o.order_id JOIN ({deliveries}) d ON d.order_id_fk = o.order_id
        JOIN d_customer c ON CAST(c.customer_id AS BIGINT) = o.customer_id_fk
        JOIN d_customer_address ca ON {address}
        JOIN d_restaurant r ON r.restaurant_id = o.restaurant_id_fk JOIN d_location rl ON rl.location_id = r.location_id_fk
        JOIN d_menu m ON m.menu_id = oi.menu_id_fk JOIN d_delivery_agent da ON da.delivery_agent_id = d.delivery_agent_id_fk"""


def star_join_current_sql() -> str:
    rows = _fact_select(_typed_sql("order_item", 0), _typed_sql("orders", 0), _typed_sql("delivery", 0))
    return f"WITH {_dim_ctes('current')} {rows}"


def star_join_reference_sql() -> str:
    rows = _fact_select(_typed_sql("order_item", 0), _typed_sql("orders", 0), _typed_sql("delivery", 0), True)
    bounds = []
    for k in [*_FACT_KEYS, "order_date_dim_key"]:
        for f in ("min", "max"):
            bounds.append(f"CAST({f}(CAST({k} AS BIGINT)) AS VARCHAR) AS {f}_{k}")
    return f"""WITH {_dim_ctes('reference')}, rows_ AS ({rows})
        SELECT order_id, count(*) AS fact_rows, CAST(sum(quantity) AS BIGINT) AS quantity,
        CAST(sum(CAST(subtotal AS DECIMAL(10,2))) AS DOUBLE) AS subtotal, {', '.join(bounds)} FROM rows_ GROUP BY order_id"""


def _five_views() -> str:
    """The five views over the rows of `k`, under one another."""
    names = "year, month, day_of_month, day_name, delivery_status, restaurant_name".split(", ")

    def view(name: str, by: str, where: str = "TRUE") -> str:
        shown = ", ".join(n if n in by.split(", ") else f"NULL AS {n}" for n in names)
        return f"SELECT '{name}' AS view_name, {shown}, {_MEASURES} FROM k WHERE {where} GROUP BY {by}"

    delivered = "delivery_status = 'Delivered'"
    views = [
        view("yearly", "year", delivered),
        view("monthly", "year, month", delivered),
        view("daily", "year, month, day_of_month", delivered),
        view("weekday", "year, month, day_name"),
        view("restaurant", "year, month, delivery_status, restaurant_name"),
    ]
    return " UNION ALL ".join(views)


def maintained_sql() -> str:
    return f"""WITH s AS (SELECT s.*, s_name AS restaurant_name FROM ({SALES}) s JOIN supplier ON s_suppkey = restaurant_id), k AS (SELECT *, {_DAY_PARTS} FROM s) {_five_views()}"""


def warehouse_kpis_sql() -> str:
    """The five views over the fact of day 0, under one another."""
    orders = _typed_sql("orders", 0)
    rows = _fact_select(_typed_sql("order_item", 0), orders, _typed_sql("delivery", 0))
    views = _five_views()
    return f"""WITH {_dim_ctes('initial')}, f AS ({rows}),
        s AS (SELECT f.order_id, f.order_item_id, CAST(f.subtotal AS DECIMAL(10,2)) AS subtotal, f.delivery_status,
            CAST(o.order_date AS DATE) AS day, r.name AS restaurant_name
            FROM f JOIN ({orders}) o USING (order_id) JOIN d_restaurant r ON CAST(r.restaurant_hk AS VARCHAR) = f.restaurant_dim_key),
        k AS (SELECT *, {_DAY_PARTS} FROM s) {views}"""


def merge_fact_sql() -> str:
    """Fact rows of day 0, replaced by those of day 1 with the same item and order, plus new ones.

    A delivery has one row per order in either day, so no key has two source rows."""
    before = _fact_select(_typed_sql("order_item", 0), _typed_sql("orders", 0), _typed_sql("delivery", 0))
    after = _fact_select(_typed_sql("order_item", 1), _typed_sql("orders", 0), _typed_sql("delivery", 1))
    return f"""WITH {_dim_ctes('current')}, before_ AS ({before}), after_ AS ({after})
        SELECT * FROM after_ UNION ALL SELECT * FROM before_ ANTI JOIN after_ USING (order_item_id, order_id)"""


def stream_fact_sql() -> str:
    """Day-0 events and dimensions with the order items of both days."""
    e = entities.ORDER_ITEM
    items = f"""SELECT * FROM ({_typed_sql('order_item', 1)})
        UNION ALL SELECT * FROM ({_typed_sql('order_item', 0)}) ANTI JOIN ({_typed_sql('order_item', 1)}) {_using(e.key)}"""
    return f"WITH {_dim_ctes('initial')} {_fact_select(items, _typed_sql('orders', 0), _typed_sql('delivery', 0))}"


# -- quality -------------------------------------------------------------------------------------


def null_counts_sql(entity: str, day: int, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM ({clean_sql(entity, day)})"
        for c in columns
    )


def lengths_sql(entity: str, day: int) -> str:
    limits = [(f.name, f.max_len) for f in entities.get(entity).fields if f.max_len]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE length({c}) > {n}) AS too_long FROM ({clean_sql(entity, day)})" for c, n in limits
    )


def null_rates_sql(entity: str, day: int, limits: dict[str, float]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, r AS null_rate, CAST({m} AS DOUBLE) AS max_rate, r <= {m} AS within_limit
        FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE) AS r FROM ({clean_sql(entity, day)}))"""
        for c, m in limits.items()
    )


def foreign_key_sql() -> str:
    refs = {
        "customer": ("o_custkey", f"SELECT CAST(customer_id AS BIGINT) AS k FROM ({_typed_sql('customer', 1)})"),
        "customer_address": ("o_custkey", f"SELECT address_id AS k FROM ({_typed_sql('customer_address', 1)})"),
        "restaurant": ("o_orderkey % 10", f"SELECT restaurant_id AS k FROM ({_typed_sql('restaurant', 1)})"),
        "restaurant_location": ("o_orderkey % 10", f"SELECT location_id AS k FROM ({_typed_sql('location', 1)})"),
        "menu": ("l_partkey", f"SELECT menu_id AS k FROM ({_typed_sql('menu', 1)})"),
        "delivery_agent": ("o_orderkey % 10", f"SELECT delivery_agent_id AS k FROM ({_typed_sql('delivery_agent', 1)})"),
        "order_date": (
            "CAST(o_orderdate AS DATE)",
            f"SELECT calendar_date AS k FROM ({date_dim_sql(skip_first=True)})",
        ),
    }
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS foreign_key, count(*) AS orphan_rows FROM
        (SELECT {fk} AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey) f ANTI JOIN ({ref}) r USING (k)"""
        for name, (fk, ref) in refs.items()
    )


def reconcile_sql() -> str:
    return f"""SELECT trim(itemtype) AS item_type, count(*) AS stage_rows,
        count(*) FILTER (WHERE {_raw_dec('price', 10, 2)} IS NOT NULL) AS clean_rows,
        count(*) FILTER (WHERE {_raw_dec('price', 10, 2)} IS NULL) AS quarantine_rows
        FROM ({stage_sql('menu')}) GROUP BY ALL"""


def on_time_sql() -> str:
    return f"""SELECT CASE WHEN location_id IS NULL THEN 'unknown' ELSE city_tier END AS city_tier, count(*) AS deliveries, count(*) FILTER (WHERE late = FALSE) AS on_time,
        count(*) FILTER (WHERE late = FALSE) / CAST(count(*) AS DOUBLE) AS on_time_rate
        FROM (SELECT o_custkey AS k, (o_orderkey % 60) > (o_orderkey % 50 + 10) AS late FROM orders)
        LEFT JOIN ({_typed_sql('location', 0)}) ON k = location_id GROUP BY ALL"""
