"""All-text stage rows to typed rows, one narrow projection per entity.

Rows that break a declared rule (missing required value, text too long) are marked, not dropped:
`clean` returns them as the second frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import AUDIT, Entity
from tiffinmart.functions import casts as K
from tiffinmart.functions import places

REJECT = "_reject_reason"

# Timestamp masks of the source files.
SECONDS = "yyyy-MM-dd HH:mm:ss"
NANOS = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
T_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
T_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

Columns = dict[str, Column]
c = F.col


def _location(mode: str) -> Columns:
    city, state = c("city"), c("state")
    return {
        "location_id": K.number(c("locationid")),
        "city": city,
        "state": places.state_name(state),
        "state_code": places.state_code(state),
        "is_union_territory": places.is_union_territory(state),
        "capital_city_flag": places.is_capital_city(state, city),
        "city_tier": places.city_tier(city),
        "zip_code": c("zipcode"),
        "active_flag": c("activeflag"),
        "created_ts": K.timestamp(c("createddate"), SECONDS),
        "modified_ts": K.timestamp(c("modifieddate"), SECONDS),
    }


def _restaurant(mode: str) -> Columns:
    return {
        "restaurant_id": K.try_number(c("restaurantid")),
        "name": c("name"),
        "cuisine_type": c("cuisinetype"),
        "pricing_for_two": K.try_decimal(c("pricing_for_2"), 10, 2),
        "restaurant_phone": c("restaurant_phone"),
        "operating_hours": c("operatinghours"),
        "location_id_fk": K.try_number(c("locationid")),
        "active_flag": c("activeflag"),
        "open_status": c("openstatus"),
        "locality": c("locality"),
        "restaurant_address": c("restaurant_address"),
        "latitude": K.try_decimal(c("latitude"), 9, 6),
        "longitude": K.try_decimal(c("longitude"), 9, 6),
        "created_dt": K.try_timestamp(c("createddate"), NANOS),
        "modified_dt": K.try_timestamp(c("modifieddate"), NANOS),
    }


def _customer(mode: str) -> Columns:
    # The first fill and the later merges know one mask each; by default either is accepted.
    masks = {"initial": (SECONDS,), "reference": (T_MICROS,)}.get(mode, (SECONDS, T_MICROS))
    return {
        "customer_id": c("customerid"),
        "name": c("name"),
        "mobile": c("mobile"),
        "email": c("email"),
        "login_by_using": c("loginbyusing"),
        "gender": c("gender"),
        "dob": K.try_date(c("dob")),
        "anniversary": K.try_date(c("anniversary")),
        "preferences": c("preferences"),
        "created_dt": K.try_timestamp(c("createddate"), *masks),
        "modified_dt": K.try_timestamp(c("modifieddate"), *masks),
    }


def _customer_address(mode: str) -> Columns:
    # The reference load binds state and pincode crosswise.
    state, pincode = ("pincode", "state") if mode == "reference" else ("state", "pincode")
    return {
        "address_id": K.number(c("addressid")),
        "customer_id_fk": K.number(c("customerid")),
        "flat_no": c("flatno"),
        "house_no": c("houseno"),
        "floor": c("floor"),
        "building": c("building"),
        "landmark": c("landmark"),
        "locality": c("locality"),
        "city": c("city"),
        "state": c(state),
        "pincode": c(pincode),
        "coordinates": c("coordinates"),
        "primary_flag": c("primaryflag"),
        "address_type": c("addresstype"),
        "created_date": K.try_timestamp(c("createddate"), T_SECONDS),
        "modified_date": K.try_timestamp(c("modifieddate"), T_SECONDS),
    }


def _menu(mode: str) -> Columns:
    return {
        "menu_id": K.try_number(c("menuid")),
        "restaurant_id_fk": K.try_number(c("restaurantid")),
        "item_name": F.trim(c("itemname")),
        "description": F.trim(c("description")),
        "price": K.try_decimal(c("price"), 10, 2),
        "category": F.trim(c("category")),
        "availability": K.text_boolean(c("availability")),
        "item_type": F.trim(c("itemtype")),
        "created_dt": K.try_timestamp_ntz(c("createddate")),
        "modified_dt": K.try_timestamp_ntz(c("modifieddate")),
    }


def _delivery_agent(mode: str) -> Columns:
    return {
        "delivery_agent_id": K.try_number(c("deliveryagentid")),
        "name": c("name"),
        "phone": c("phone"),
        "vehicle_type": c("vehicletype"),
        "location_id_fk": K.try_number(c("locationid")),
        "status": c("status"),
        "gender": c("gender"),
        "rating": K.try_decimal(c("rating"), 4, 2),
        "created_dt": K.try_timestamp_ntz(c("createddate")),
        "modified_dt": K.try_timestamp_ntz(c("modifieddate")),
    }


def _delivery(mode: str) -> Columns:
    return {
        "delivery_id": K.number(c("deliveryid")),
        "order_id_fk": K.number(c("orderid")),
        "delivery_agent_id_fk": K.number(c("deliveryagentid")),
        "delivery_status": c("deliverystatus"),
        "estimated_time": c("estimatedtime"),
        "customer_address_id_fk": K.number(c("addressid")),
        "delivery_date": K.timestamp_ntz(c("deliverydate")),
        "created_date": K.timestamp_ntz(c("createddate")),
        "modified_date": K.timestamp_ntz(c("modifieddate")),
    }


def _orders(mode: str) -> Columns:
    # The reference converts the amount with scale 0 and so loses the cents.
    amount = K.try_decimal(c("totalamount"), 38, 0) if mode == "reference" else c("totalamount")
    return {
        "order_id": K.try_number(c("orderid")),
        "customer_id_fk": K.try_number(c("customerid")),
        "restaurant_id_fk": K.try_number(c("restaurantid")),
        "order_date": K.try_timestamp_ntz(c("orderdate")),
        "total_amount": K.try_decimal(amount, 10, 2),
        "status": c("status"),
        "payment_method": c("paymentmethod"),
        "created_dt": K.try_timestamp(c("createddate")),
        "modified_dt": K.try_timestamp(c("modifieddate")),
    }


def _order_item(mode: str) -> Columns:
    return {
        "order_item_id": K.number(c("orderitemid")),
        "order_id_fk": K.number(c("orderid")),
        "menu_id_fk": K.number(c("menuid")),
        "quantity": K.decimal(c("quantity"), 10, 2),
        "price": K.decimal(c("price"), 10, 2),
        "subtotal": K.decimal(c("subtotal"), 10, 2),
        "created_dt": K.timestamp_ntz(c("createddate")),
        "modified_dt": K.timestamp_ntz(c("modifieddate")),
    }


EXPRESSIONS: dict[str, Callable[[str], Columns]] = {
    "location": _location,
    "restaurant": _restaurant,
    "customer": _customer,
    "customer_address": _customer_address,
    "menu": _menu,
    "delivery_agent": _delivery_agent,
    "delivery": _delivery,
    "orders": _orders,
    "order_item": _order_item,
}


def reject_reason(entity: Entity | str, typed: Columns) -> Column:
    """First broken rule of a row, NULL when there is none.

    A strict conversion is tested on its source text, which is as good and saves converting twice
    when the test is pushed below the projection.
    """
    reason = F.lit(None).cast("string")
    for f in reversed(entities.get(entity).fields):
        if f.max_len:
            reason = F.when(F.length(typed[f.name]) > f.max_len, f"{f.name} too long").otherwise(reason)
        if f.required:
            missing = (c(f.raw) if f.raw else typed[f.name]).isNull()
            reason = F.when(missing, f"{f.name} missing").otherwise(reason)
    return reason


def clean_all(entity: Entity | str, stage: DataFrame, mode: str = "default") -> DataFrame:
    """Every stage row typed, with the column `_reject_reason`.

    Audit columns pass through when the stage frame has them. `mode="reference"` keeps the known
    defects of the reference load; for customers `mode="initial"` is the mask of the first fill.
    """
    e = entities.get(entity)
    typed = EXPRESSIONS[e.name](mode)
    cols = [typed[f.name].cast(f.type).alias(f.name) for f in e.fields]
    audit = [a for a in AUDIT if a in stage.columns]
    return stage.select(*cols, *audit, reject_reason(e, typed).alias(REJECT))


def split_rejects(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = marked.filter(F.col(REJECT).isNull()).drop(REJECT)
    return accepted, marked.filter(F.col(REJECT).isNotNull())


def clean(entity: Entity | str, stage: DataFrame, mode: str = "default") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) typed rows."""
    return split_rejects(clean_all(entity, stage, mode))


def quarantine_null_keys(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL in the key)."""
    has_null = F.lit(False)
    for k in key:
        has_null = has_null | F.col(k).isNull()
    return df.filter(~has_null), df.filter(has_null)
