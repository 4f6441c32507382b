"""The nine entities as data: file layout, typed columns, keys, update rules, dimension rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AUDIT = ("_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_len: int | None = None
    tag: str | None = None
    # Source column of a strict conversion: NULL there is the only way to NULL here.
    raw: str | None = None


@dataclass(frozen=True)
class Dimension:
    """How an entity is versioned. `attributes` starts with the business key."""

    key: str
    attributes: tuple[str, ...]
    hash_cols: tuple[str, ...]
    match_cols: tuple[str, ...]
    start: str = "eff_start_date"
    end: str = "eff_end_date"
    flag: str = "is_current"


@dataclass(frozen=True)
class Entity:
    name: str
    source_columns: tuple[str, ...]  # in file order
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    modified: str  # newest value wins among several source rows of one key
    frozen: tuple[str, ...] = ()  # never overwritten by an update
    update_only: tuple[str, ...] = ()  # when set, the only business columns an update touches
    dimension: Dimension | None = None
    # The part of the key that tables are cut into slices by; the whole key when empty.
    slice_by: tuple[str, ...] = ()

    @property
    def slice_key(self) -> tuple[str, ...]:
        return self.slice_by or self.key

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def update_columns(self) -> tuple[str, ...]:
        """Columns an upsert overwrites on a match, audit columns included."""
        business = self.update_only or tuple(
            c for c in self.columns if c not in self.key and c not in self.frozen
        )
        return business + AUDIT

    def stage_schema(self) -> T.StructType:
        """All-text schema of the file; columns bind by position."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.source_columns])


# File layouts, types, lengths, keys and tags of the nine entities.
LOCATION = Entity(
    name="location",
    source_columns=("locationid", "city", "state", "zipcode", "activeflag", "createddate", "modifieddate"),
    fields=(
        Field("location_id", "bigint", required=True, raw="locationid"),
        Field("city", "string", required=True, max_len=100),
        Field("state", "string", required=True, max_len=100),
        Field("state_code", "string", required=True, max_len=2),
        Field("is_union_territory", "boolean", required=True),
        Field("capital_city_flag", "boolean", required=True),
        Field("city_tier", "string", max_len=6),
        Field("zip_code", "string", required=True, max_len=10),
        Field("active_flag", "string", required=True, max_len=10),
        Field("created_ts", "timestamp", required=True, raw="createddate"),
        Field("modified_ts", "timestamp"),
    ),
    key=("location_id",),
    modified="modified_ts",
    frozen=("created_ts",),
    dimension=Dimension(
        key="restaurant_location_hk",
        attributes=(
            "location_id", "city", "state", "state_code", "is_union_territory", "capital_city_flag",
            "city_tier", "zip_code", "active_flag",
        ),
        hash_cols=("city", "state", "state_code", "zip_code"),
        match_cols=("location_id", "active_flag"),
        start="eff_start_dt",
        end="eff_end_dt",
        flag="current_flag",
    ),
)

_RESTAURANT_ATTRS = (
    "restaurant_id", "name", "cuisine_type", "pricing_for_two", "restaurant_phone", "operating_hours",
    "location_id_fk", "active_flag", "open_status", "locality", "restaurant_address", "latitude", "longitude",
)
RESTAURANT = Entity(
    name="restaurant",
    source_columns=(
        "restaurantid", "name", "cuisinetype", "pricing_for_2", "restaurant_phone", "operatinghours",
        "locationid", "activeflag", "openstatus", "locality", "restaurant_address", "latitude", "longitude",
        "createddate", "modifieddate",
    ),
    fields=(
        Field("restaurant_id", "bigint", required=True),
        Field("name", "string", required=True, max_len=100),
        Field("cuisine_type", "string"),
        Field("pricing_for_two", "decimal(10,2)"),
        Field("restaurant_phone", "string", max_len=15, tag="SENSITIVE"),
        Field("operating_hours", "string", max_len=100),
        Field("location_id_fk", "bigint"),
        Field("active_flag", "string", max_len=10),
        Field("open_status", "string", max_len=10),
        Field("locality", "string", max_len=100),
        Field("restaurant_address", "string"),
        Field("latitude", "decimal(9,6)"),
        Field("longitude", "decimal(9,6)"),
        Field("created_dt", "timestamp"),
        Field("modified_dt", "timestamp"),
    ),
    key=("restaurant_id",),
    modified="modified_dt",
    dimension=Dimension("restaurant_hk", _RESTAURANT_ATTRS, _RESTAURANT_ATTRS, _RESTAURANT_ATTRS),
)

_CUSTOMER_ATTRS = (
    "customer_id", "name", "mobile", "email", "login_by_using", "gender", "dob", "anniversary", "preferences",
)
CUSTOMER = Entity(
    name="customer",
    source_columns=(
        "customerid", "name", "mobile", "email", "loginbyusing", "gender", "dob", "anniversary", "preferences",
        "createddate", "modifieddate",
    ),
    fields=(
        Field("customer_id", "string", required=True),
        Field("name", "string", required=True, max_len=100),
        Field("mobile", "string", max_len=15, tag="PII"),
        Field("email", "string", max_len=100, tag="EMAIL"),
        Field("login_by_using", "string", max_len=50),
        Field("gender", "string", max_len=10, tag="PII"),
        Field("dob", "date", tag="PII"),
        Field("anniversary", "date"),
        Field("preferences", "string"),
        Field("created_dt", "timestamp"),
        Field("modified_dt", "timestamp"),
    ),
    key=("customer_id",),
    modified="modified_dt",
    dimension=Dimension("customer_hk", _CUSTOMER_ATTRS, _CUSTOMER_ATTRS, _CUSTOMER_ATTRS),
)

_ADDRESS_ATTRS = (
    "address_id", "customer_id_fk", "flat_no", "house_no", "floor", "building", "landmark", "locality", "city",
    "state", "pincode", "coordinates", "primary_flag", "address_type",
)
CUSTOMER_ADDRESS = Entity(
    name="customer_address",
    source_columns=(
        "addressid", "customerid", "flatno", "houseno", "floor", "building", "landmark", "locality", "city",
        "state", "pincode", "coordinates", "primaryflag", "addresstype", "createddate", "modifieddate",
    ),
    fields=(
        Field("address_id", "bigint", required=True, raw="addressid"),
        Field("customer_id_fk", "bigint"),
        Field("flat_no", "string"),
        Field("house_no", "string"),
        Field("floor", "string"),
        Field("building", "string"),
        Field("landmark", "string"),
        Field("locality", "string"),
        Field("city", "string"),
        Field("state", "string"),
        Field("pincode", "string"),
        Field("coordinates", "string"),
        Field("primary_flag", "string"),
        Field("address_type", "string"),
        Field("created_date", "timestamp"),
        Field("modified_date", "timestamp"),
    ),
    key=("address_id",),
    modified="modified_date",
    frozen=("customer_id_fk",),
    dimension=Dimension("customer_address_hk", _ADDRESS_ATTRS, _ADDRESS_ATTRS, _ADDRESS_ATTRS),
)

_MENU_ATTRS = (
    "menu_id", "restaurant_id_fk", "item_name", "description", "price", "category", "availability", "item_type",
)
MENU = Entity(
    name="menu",
    source_columns=(
        "menuid", "restaurantid", "itemname", "description", "price", "category", "availability", "itemtype",
        "createddate", "modifieddate",
    ),
    fields=(
        Field("menu_id", "bigint", required=True),
        Field("restaurant_id_fk", "bigint"),
        Field("item_name", "string", required=True),
        Field("description", "string", required=True),
        Field("price", "decimal(10,2)", required=True),
        Field("category", "string"),
        Field("availability", "boolean"),
        Field("item_type", "string"),
        Field("created_dt", "timestamp_ntz"),
        Field("modified_dt", "timestamp_ntz"),
    ),
    key=("menu_id",),
    modified="modified_dt",
    dimension=Dimension("menu_dim_hk", _MENU_ATTRS, _MENU_ATTRS, _MENU_ATTRS),
)

_AGENT_ATTRS = (
    "delivery_agent_id", "name", "phone", "vehicle_type", "location_id_fk", "status", "gender", "rating",
)
DELIVERY_AGENT = Entity(
    name="delivery_agent",
    source_columns=(
        "deliveryagentid", "name", "phone", "vehicletype", "locationid", "status", "gender", "rating",
        "createddate", "modifieddate",
    ),
    fields=(
        Field("delivery_agent_id", "bigint", required=True),
        Field("name", "string", required=True),
        Field("phone", "string", required=True),
        Field("vehicle_type", "string", required=True),
        Field("location_id_fk", "bigint"),
        Field("status", "string"),
        Field("gender", "string"),
        Field("rating", "decimal(4,2)"),
        Field("created_dt", "timestamp_ntz"),
        Field("modified_dt", "timestamp_ntz"),
    ),
    key=("delivery_agent_id",),
    modified="modified_dt",
    frozen=("name",),
    dimension=Dimension("delivery_agent_hk", _AGENT_ATTRS, _AGENT_ATTRS, _AGENT_ATTRS),
)

DELIVERY = Entity(
    name="delivery",
    source_columns=(
        "deliveryid", "orderid", "deliveryagentid", "deliverystatus", "estimatedtime", "addressid",
        "deliverydate", "createddate", "modifieddate",
    ),
    fields=(
        Field("delivery_id", "bigint", required=True, raw="deliveryid"),
        Field("order_id_fk", "bigint", required=True, raw="orderid"),
        Field("delivery_agent_id_fk", "bigint", required=True, raw="deliveryagentid"),
        Field("delivery_status", "string"),
        Field("estimated_time", "string"),
        Field("customer_address_id_fk", "bigint", required=True, raw="addressid"),
        Field("delivery_date", "timestamp_ntz"),
        Field("created_date", "timestamp_ntz"),
        Field("modified_date", "timestamp_ntz"),
    ),
    key=("delivery_id", "order_id_fk", "delivery_agent_id_fk"),
    modified="modified_date",
    slice_by=("order_id_fk",),
)

ORDERS = Entity(
    name="orders",
    source_columns=(
        "orderid", "customerid", "restaurantid", "orderdate", "totalamount", "status", "paymentmethod",
        "createddate", "modifieddate",
    ),
    fields=(
        Field("order_id", "bigint", required=True),
        Field("customer_id_fk", "bigint"),
        Field("restaurant_id_fk", "bigint"),
        Field("order_date", "timestamp_ntz"),
        Field("total_amount", "decimal(10,2)"),
        Field("status", "string"),
        Field("payment_method", "string"),
        Field("created_dt", "timestamp"),
        Field("modified_dt", "timestamp"),
    ),
    key=("order_id",),
    modified="modified_dt",
    update_only=("total_amount", "status", "payment_method", "modified_dt"),
)

ORDER_ITEM = Entity(
    name="order_item",
    source_columns=(
        "orderitemid", "orderid", "menuid", "quantity", "price", "subtotal", "createddate", "modifieddate",
    ),
    fields=(
        Field("order_item_id", "bigint", required=True, raw="orderitemid"),
        Field("order_id_fk", "bigint", required=True, raw="orderid"),
        Field("menu_id_fk", "bigint", required=True, raw="menuid"),
        Field("quantity", "decimal(10,2)"),
        Field("price", "decimal(10,2)"),
        Field("subtotal", "decimal(10,2)"),
        Field("created_dt", "timestamp_ntz"),
        Field("modified_dt", "timestamp_ntz"),
    ),
    key=("order_item_id", "order_id_fk", "menu_id_fk"),
    modified="modified_dt",
    slice_by=("order_id_fk",),
)

ENTITIES = {
    e.name: e
    for e in (
        LOCATION, RESTAURANT, CUSTOMER, CUSTOMER_ADDRESS, MENU, DELIVERY_AGENT, DELIVERY, ORDERS, ORDER_ITEM,
    )
}
DIMENSION_ENTITIES = tuple(e for e in ENTITIES.values() if e.dimension)


def get(entity: Entity | str) -> Entity:
    return entity if isinstance(entity, Entity) else ENTITIES[entity]
