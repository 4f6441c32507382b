"""The driver tables in the shape of the nine stage tables.

Each entity is one whole table projected to all-text stage columns. Day 0 is the first delivery of
a table, day 1 a second, full delivery of it: some rows changed, some lost an attribute, and some
come under a new id, which makes the old id a deletion and the new one an insertion. Some values
are malformed on purpose. The expressions are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinmart.functions.places import STATE_CODES

RENUMBER = 1_000_000_000
CITIES = (
    "New Delhi", "Mumbai", "Delhi", "Bengaluru", "Jaipur", "Chandigarh", "Shimla", "Kochi", "Pune", "Ranchi",
    "Agra", "Gangtok", "Panaji",
)
# Two states without a code: one unknown, one missing.
STATES = (*STATE_CODES, "Atlantis", None)


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def _pick(expr: str, values: tuple[str | None, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {expr} % {len(values)} {arms} END"


def _two(expr: str) -> str:
    return f"lpad({_text(expr)}, 2, '0')"


def _day_of_2023(key: str) -> str:
    return f"'2023-' || {_two(f'{key} % 12 + 1')} || '-' || {_two(f'{key} % 28 + 1')}"


def _id(key: str, day: int, moved: str) -> str:
    return _text(f"{key} + CASE WHEN {moved} THEN {RENUMBER} ELSE 0 END" if day else key)


def _day1(day: int, cond: str, then: str, other: str) -> str:
    return f"CASE WHEN {cond} THEN {then} ELSE {other} END" if day else other


def _modified(day: int, cond: str, sep: str = " ") -> str:
    return _day1(day, cond, f"'2024-01-02{sep}10:00:00'", f"'2024-01-01{sep}10:00:00'")


def location(day: int) -> tuple[str, dict[str, str]]:
    k, flips, rezoned = "c_custkey", "c_acctbal < 0", "c_acctbal > 9000"
    return "customer", {
        "locationid": _id(k, day, "c_mktsegment = 'BUILDING'"),
        "city": _pick(k, CITIES),
        "state": _pick(k, STATES),
        "zipcode": _day1(day, rezoned, "'999999'", f"lpad({_text(k + ' % 1000000')}, 6, '0')"),
        "activeflag": _day1(day, flips, "'No'", "'Yes'"),
        "createddate": f"{_day_of_2023(k)} || ' 08:30:00'",
        "modifieddate": _modified(day, f"{flips} OR {rezoned}"),
    }


def restaurant(day: int) -> tuple[str, dict[str, str]]:
    k, shut, lost = "s_suppkey", "s_acctbal < 3000", "s_nationkey % 8 = 3"
    return "supplier", {
        "restaurantid": _id(k, day, "s_acctbal > 9000"),
        "name": "s_name",
        "cuisinetype": _day1(day, lost, "NULL", _pick("s_nationkey", ("Indian", "Thai", "Italian"))),
        "pricing_for_2": f"CASE WHEN s_nationkey = 5 THEN 'n/a' WHEN s_nationkey = 6 THEN '250.555' ELSE {_money('s_acctbal')} END",
        "restaurant_phone": f"'+91' || lpad({_text(k)}, 10, '0')",
        "operatinghours": "'10:00 - 22:00'",
        "locationid": _text(k),
        "activeflag": "'Yes'",
        "openstatus": _day1(day, shut, "'Closed'", "'Open'"),
        "locality": "'Block ' || " + _text("s_nationkey"),
        "restaurant_address": f"{_text(k)} || ' High Street'",
        "latitude": "CASE WHEN s_nationkey = 9 THEN '12345.6' ELSE " + _text("s_nationkey") + " || '.1234567' END",
        "longitude": _text("s_nationkey + 60") + " || '.5'",
        "createddate": f"{_day_of_2023(k)} || CASE WHEN s_nationkey % 2 = 0 THEN ' 09:15:00.123456789' ELSE ' bad' END",
        "modifieddate": _modified(day, f"{shut} OR {lost}"),
    }


def customer(day: int) -> tuple[str, dict[str, str]]:
    k, app, lost = "c_custkey", "c_acctbal < 2000", "c_nationkey % 9 = 3"
    stamp = f"{_day_of_2023(k)} || CASE WHEN c_nationkey % 2 = 0 THEN ' 08:00:00' ELSE 'T08:00:00.250000' END"
    return "customer", {
        "customerid": _id(k, day, "c_mktsegment = 'BUILDING'"),
        "name": "c_name",
        "mobile": f"'+91' || lpad({_text(k)}, 10, '0')",
        "email": "lower(c_name) || '@example.com'",
        "loginbyusing": _day1(day, app, "'app'", "lower(c_mktsegment)"),
        "gender": _day1(day, lost, "NULL", "CASE WHEN c_nationkey % 3 = 0 THEN 'F' ELSE 'M' END"),
        "dob": f"CASE WHEN c_nationkey = 7 THEN '1990-13-45' ELSE '19' || {_two(k + ' % 50 + 50')} || '-' || {_two(k + ' % 12 + 1')} || '-' || {_two(k + ' % 28 + 1')} END",
        "anniversary": f"'2010-' || {_two(k + ' % 12 + 1')} || '-15'",
        "preferences": "CASE WHEN c_acctbal > 5000 THEN 'veg' ELSE 'all' END",
        "createddate": stamp,
        "modifieddate": _modified(day, f"{app} OR {lost}"),
    }


def customer_address(day: int) -> tuple[str, dict[str, str]]:
    k, moved, lost = "c_custkey", "c_acctbal > 8000", "c_nationkey % 9 = 4"
    return "customer", {
        "addressid": _id(k, day, "c_mktsegment = 'FURNITURE'"),
        "customerid": _text(k),
        "flatno": _text(k + " % 40"),
        "houseno": _text(k + " % 300"),
        "floor": _day1(day, lost, "NULL", _text("c_nationkey")),
        "building": "'Building ' || " + _text("c_nationkey"),
        "landmark": _day1(day, moved, "'New Market'", "'Old Fort'"),
        "locality": "'Sector ' || " + _text(k + " % 90"),
        "city": _pick(k, CITIES),
        "state": f"coalesce({_pick(k, STATES)}, 'Unknown')",
        "pincode": f"lpad({_text(k + ' % 1000000')}, 6, '0')",
        "coordinates": f"{_text(k + ' % 90')} || ',' || {_text(k + ' % 180')}",
        "primaryflag": "CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END",
        "addresstype": "CASE WHEN c_nationkey % 2 = 0 THEN 'Home' ELSE 'Office' END",
        "createddate": f"{_day_of_2023(k)} || CASE WHEN c_nationkey = 11 THEN ' 08:00:00' ELSE 'T08:00:00' END",
        "modifieddate": _modified(day, f"{moved} OR {lost}", "T"),
    }


def menu(day: int) -> tuple[str, dict[str, str]]:
    k, dearer, lost = "p_partkey", "p_size < 10", "p_brand = 'Brand#17'"
    price = f"CASE WHEN p_size = 13 THEN 'free' ELSE {_money('p_retailprice')} END"
    return "part", {
        "menuid": _id(k, day, "p_size > 45"),
        "restaurantid": "CASE WHEN p_size = 20 THEN '7.5' ELSE " + _text(k + " % 10") + " END",
        "itemname": "'  ' || p_name || ' '",
        "description": "p_name || ' of ' || p_brand || ' '",
        "price": _day1(day, f"{dearer}", _money("p_retailprice + 10"), price),
        "category": _day1(day, lost, "NULL", "' ' || p_type"),
        "availability": "CASE WHEN p_size % 3 = 0 THEN 'TRUE' WHEN p_size % 3 = 1 THEN 'false' ELSE 'maybe' END",
        "itemtype": "CASE WHEN p_size % 2 = 0 THEN 'Veg' ELSE 'Non-Veg ' END",
        "createddate": f"{_day_of_2023(k)} || CASE WHEN p_size = 21 THEN ' noon' ELSE ' 07:45:30' END",
        "modifieddate": _modified(day, f"{dearer} OR {lost}"),
    }


def delivery_agent(day: int) -> tuple[str, dict[str, str]]:
    k, rated, lost = "s_suppkey", "s_acctbal < 4000", "s_nationkey % 8 = 5"
    return "supplier", {
        "deliveryagentid": _id(k, day, "s_acctbal > 8500"),
        "name": _day1(day, rated, "s_name || ' Jr'", "s_name"),
        "phone": f"'+44' || lpad({_text(k)}, 10, '0')",
        "vehicletype": _pick("s_nationkey", ("Bike", "Scooter", "Cycle")),
        "locationid": "CASE WHEN s_nationkey = 4 THEN 'depot' ELSE " + _text(k) + " END",
        "status": _day1(day, lost, "NULL", "'Active'"),
        "gender": "CASE WHEN s_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
        "rating": _day1(
            day, rated, "'3.256'", "CASE WHEN s_nationkey = 12 THEN '123.4' ELSE " + _text("s_nationkey % 5") + " || '.75' END"
        ),
        "createddate": f"{_day_of_2023(k)} || ' 06:00:00'",
        "modifieddate": _modified(day, f"{rated} OR {lost}"),
    }


def orders(day: int) -> tuple[str, dict[str, str]]:
    k, paid = "o_orderkey", "o_orderstatus = 'O'"
    return "orders", {
        "orderid": _id(k, day, "o_orderpriority = '5-LOW'"),
        "customerid": _text("o_custkey"),
        "restaurantid": _text("o_orderkey % 10"),
        "orderdate": _text("o_orderdate"),
        "totalamount": _day1(day, paid, _money("o_totalprice + 1"), _money("o_totalprice")),
        "status": _day1(day, paid, "'PAID'", "o_orderstatus"),
        "paymentmethod": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END",
        "createddate": _text("o_orderdate"),
        "modifieddate": _modified(day, paid),
    }


def delivery(day: int) -> tuple[str, dict[str, str]]:
    k, arrived, reassigned = "o_orderkey", "o_orderstatus = 'O'", "o_orderpriority = '2-HIGH'"
    status = "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END"
    return "orders", {
        "deliveryid": _text(k),
        "orderid": _text(k),
        # Another agent makes another row of the three-column key.
        "deliveryagentid": _day1(day, reassigned, _text("(o_orderkey + 1) % 10"), _text("o_orderkey % 10")),
        "deliverystatus": _day1(day, arrived, "'Delivered'", status),
        "estimatedtime": _text("o_orderkey % 50 + 10") + " || ' minutes'",
        "addressid": _text("o_custkey"),
        "deliverydate": _text("o_orderdate"),
        "createddate": _text("o_orderdate"),
        "modifieddate": _modified(day, arrived),
    }


def _cents(expr: str) -> str:
    return _text(f"CAST(floor({expr} * 100 + 0.5) AS BIGINT)")


_LINE_TEXT = " || '|' || ".join(
    [
        _text("l_orderkey"), _text("l_partkey"), _text("l_suppkey"), _text("l_linenumber"), _cents("l_quantity"),
        _cents("l_extendedprice"), _cents("l_discount"), _cents("l_tax"), "l_returnflag", "l_linestatus",
        _text("CAST(l_shipdate AS DATE)"),
    ]
)


def order_item(day: int) -> tuple[str, dict[str, str]]:
    more, lost, moved = "l_returnflag = 'R'", "l_returnflag = 'N' AND l_linestatus = 'O'", (
        "l_returnflag = 'A' AND l_linestatus = 'F'"
    )
    # (order, line) repeats in the driver data; only the whole row identifies an item.
    item = "HASH60(" + _LINE_TEXT + ")"
    return "lineitem", {
        "orderitemid": _text(f"{item} + CASE WHEN {moved} THEN 1000000000000000000 ELSE 0 END" if day else item),
        "orderid": _text("l_orderkey"),
        "menuid": _text("l_partkey"),
        "quantity": _day1(day, more, _money("l_quantity + 1"), _money("l_quantity")),
        "price": _money("floor(l_extendedprice / l_quantity)"),
        "subtotal": _day1(day, lost, "NULL", _money("l_extendedprice")),
        "createddate": _text("l_shipdate"),
        "modifieddate": _modified(day, f"({more}) OR ({lost})"),
    }


STANDINS: dict[str, Callable[[int], tuple[str, dict[str, str]]]] = {
    "location": location,
    "restaurant": restaurant,
    "customer": customer,
    "customer_address": customer_address,
    "menu": menu,
    "delivery_agent": delivery_agent,
    "delivery": delivery,
    "orders": orders,
    "order_item": order_item,
}


def _hash60(expr: str, dialect: str) -> str:
    """Expands HASH60(text), the 60 leading bits of SHA-1 as a number."""
    mark = "HASH60("
    while mark in expr:
        at = expr.index(mark)
        end, depth = at + len(mark), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(expr[end], 0)
            end += 1
        text = expr[at + len(mark) : end - 1]
        if dialect == "spark":
            # The driver tables hold no NULL; saying so spares a second hash for NULL checks.
            number = f"coalesce(CAST(conv(substr(sha1({text}), 1, 15), 16, 10) AS BIGINT), 0)"
        else:
            number = f"CAST('0x' || substr(sha1({text}), 1, 15) AS BIGINT)"
        expr = expr[:at] + number + expr[end:]
    return expr


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, sf_dir: str, entity: str, day: int = 0) -> DataFrame:
    """Stage rows of an entity as Spark reads them from the driver tables."""
    name, columns = STANDINS[entity](day)
    return table(spark, sf_dir, name).select(
        *[F.expr(_hash60(e, "spark")).cast("string").alias(c) for c, e in columns.items()]
    )


def stage_sql(entity: str, day: int = 0) -> str:
    """The same rows as a DuckDB query."""
    name, columns = STANDINS[entity](day)
    cols = ", ".join(f"CAST({_hash60(e, 'duckdb')} AS STRING) AS {c}" for c, e in columns.items())
    return f"SELECT {cols} FROM {name}"
