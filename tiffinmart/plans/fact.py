"""Order-item fact: the star join and its incremental form."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.operators.merge import latest_per_key, replace_rows
from tiffinmart.operators.skew import skew_join
from tiffinmart.operators.valid_time import Lookup, as_of_keys
from tiffinmart.plans.date_dim import date_key

FACT_KEY = ["order_item_id", "order_id"]
#: The key with the order first: rows of an order, which share most of their columns, stay side by side and pack well.
SORT_KEY = ["order_id", "order_item_id"]
DIM_KEYS = (
    "customer_dim_key", "customer_address_dim_key", "restaurant_dim_key", "restaurant_location_dim_key",
    "menu_dim_key", "delivery_agent_dim_key", "order_date_dim_key",
)
FACT_COLUMNS = (*FACT_KEY, *DIM_KEYS, "quantity", "price", "subtotal", "delivery_status", "estimated_time")
LAYOUT = ("order_year", "order_month")


def _keys(name: str, dims: Mapping[str, DataFrame], mode: str, as_id: str, *more: str) -> DataFrame:
    """Business key, surrogate key and `more` columns of a dimension: the open versions, or in
    reference mode every version."""
    spec = entities.get(name).dimension
    dim = dims[name]
    if mode != "reference":
        dim = dim.filter(F.col(spec.flag))
    return dim.select(
        F.col(spec.attributes[0]).cast("bigint").alias(as_id), F.col(spec.key), *[F.col(m) for m in more]
    )


#: Rows of a lookup that goes to every task: two or three numbers each, so at most some 80 MB.
MOST_SENT = 1_000_000


def _sent(lookups: Mapping[str, DataFrame], most: int = MOST_SENT) -> list[DataFrame]:
    """The lookups, those of at most `most` rows marked for broadcast. Spark's estimate goes by the width of the whole
    dimension and by products of joins, and would move the events for lookups of some MB. One job counts all."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name)) for name, df in lookups.items()]
    rows = {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()}
    return [F.broadcast(df) if rows[name] <= most else df for name, df in lookups.items()]


def build_fact_changes(
    order_items: DataFrame,
    orders: DataFrame,
    deliveries: DataFrame,
    dims: Mapping[str, DataFrame],
    mode: str = "current",
    with_layout: bool = False,
    salt_hot_orders: bool = False,
) -> DataFrame:
    """Fact rows of the given events. `dims` maps entity names and "date" to frames.

    All lookups but the menu's happen at order grain, before the join to the several times larger item table,
    which moves once for the menu, if that is large, and once for the order. What an order names is looked up apart
    from what its delivery names, so that neither moves with the columns of the other. Dimensions of up to `MOST_SENT`
    rows to look up are broadcast; for others Spark decides by their size. They are counted, so pass stored ones.
    Orders with very many items are left to the adaptive skew join, or with `salt_hot_orders` counted and salted.

    `current` takes the open version of every dimension and the address the delivery names, and the
    calendar key from the order day itself, so that no order waits for the calendar to reach its day.
    `reference` joins all versions, every address of the customer, and the calendar.
    """
    reference = mode == "reference"
    o = orders.select(
        "order_id",
        F.col("customer_id_fk").cast("bigint").alias("_customer_id"),
        F.col("restaurant_id_fk").cast("bigint").alias("_restaurant_id"),
        F.to_date("order_date").alias("_order_day"),
    )
    d = deliveries.select(
        F.col("order_id_fk").alias("order_id"),
        F.col("delivery_agent_id_fk").alias("_agent_id"),
        F.col("customer_address_id_fk").alias("_address_id"),
        "delivery_status",
        "estimated_time",
    )
    restaurants = _keys("restaurant", dims, mode, "_restaurant_id", "location_id_fk").withColumnRenamed(
        "location_id_fk", "_location_id"
    )
    if reference:
        addresses = (
            dims["customer_address"]
            .select(F.col("customer_id_fk").cast("bigint").alias("_customer_id"), "customer_address_hk")
        )
    else:
        addresses = _keys("customer_address", dims, mode, "_address_id")
    restaurants, agents, customers, addresses, menu = _sent({
        "restaurant": restaurants.join(_keys("location", dims, mode, "_location_id"), "_location_id"),
        "delivery_agent": _keys("delivery_agent", dims, mode, "_agent_id"),
        "customer": _keys("customer", dims, mode, "_customer_id"),
        "customer_address": addresses,
        "menu": _keys("menu", dims, mode, "_menu_id").withColumnRenamed("menu_dim_hk", "menu_dim_key"),
    })

    if reference:
        days = dims["date"].select(
            F.col("calendar_date").alias("_order_day"), F.col("date_dim_hk").alias("order_date_dim_key")
        )
        o = o.join(F.broadcast(days), "_order_day")
    else:
        o = o.filter("_order_day IS NOT NULL").withColumn("order_date_dim_key", date_key(F.col("_order_day")))
    o = o.join(restaurants, "_restaurant_id").join(customers, "_customer_id")
    d = d.join(agents, "_agent_id")
    if reference:
        o = o.join(addresses, "_customer_id")
    else:
        d = d.join(addresses, "_address_id")
    context = (
        o.join(d, "order_id")
        .select(
            "order_id",
            F.col("customer_hk").alias("customer_dim_key"),
            F.col("customer_address_hk").alias("customer_address_dim_key"),
            F.col("restaurant_hk").alias("restaurant_dim_key"),
            F.col("restaurant_location_hk").alias("restaurant_location_dim_key"),
            F.col("delivery_agent_hk").alias("delivery_agent_dim_key"),
            "order_date_dim_key",
            "delivery_status",
            "estimated_time",
            "_order_day",
        )
    )
    items = order_items.select(
        "order_item_id",
        F.col("order_id_fk").alias("order_id"),
        F.col("menu_id_fk").cast("bigint").alias("_menu_id"),
        # The fact keeps whole quantities.
        F.col("quantity").cast("decimal(12,0)").cast("bigint").alias("quantity"),
        "price",
        "subtotal",
    )
    # The menu comes first: what moves for it is an item, not yet widened and multiplied by its order's context.
    priced = items.join(menu, "_menu_id")
    fact = skew_join(priced, context, "order_id", count_on=items) if salt_hot_orders else priced.join(context, "order_id")
    layout = [
        F.year("_order_day").alias("order_year"), F.month("_order_day").alias("order_month")
    ] if with_layout else []
    return fact.select(*FACT_COLUMNS, *layout)


def build_fact_as_of(
    order_items: DataFrame, orders: DataFrame, deliveries: DataFrame, dims: Mapping[str, DataFrame], hot_rows: int = 1_000_000
) -> DataFrame:
    """Fact rows of the given events, each with the versions that were valid at the time of its order.

    A later change of a price, an address or a name does not move an order to another version. The four dimensions an
    order names are looked up first, then the restaurant's location (of its version then), and the menu entry at item
    grain; see `as_of_keys`. An order without a version in some dimension gives no row.
    """

    def lookup(name: str, column: str, more: str | None = None) -> Lookup:
        return Lookup(column, dims[name], entities.get(name).dimension, more)

    o = orders.select(
        "order_id", F.col("order_date").cast("timestamp").alias("_at"), F.col("customer_id_fk").alias("_customer_id"), F.col("restaurant_id_fk").alias("_restaurant_id")
    )
    d = deliveries.select(
        F.col("order_id_fk").alias("order_id"), F.col("delivery_agent_id_fk").alias("_agent_id"), F.col("customer_address_id_fk").alias("_address_id"),
        "delivery_status", "estimated_time",
    )
    context = as_of_keys(
        o.join(d, "order_id"),
        "_at",
        {
            "customer_dim_key": lookup("customer", "_customer_id"),
            "customer_address_dim_key": lookup("customer_address", "_address_id"),
            "restaurant_dim_key": lookup("restaurant", "_restaurant_id", "location_id_fk"),
            "delivery_agent_dim_key": lookup("delivery_agent", "_agent_id"),
        },
        hot_rows,
    )
    context = as_of_keys(context, "_at", {"restaurant_location_dim_key": lookup("location", "restaurant_dim_key_more")}, hot_rows)
    items = order_items.select(
        "order_item_id",
        F.col("order_id_fk").alias("order_id"),
        F.col("menu_id_fk").alias("_menu_id"),
        F.col("quantity").cast("decimal(12,0)").cast("bigint").alias("quantity"),
        "price",
        "subtotal",
    )
    keys = [k for k in DIM_KEYS if k not in ("menu_dim_key", "order_date_dim_key")]
    context = context.select("order_id", "_at", *keys, "delivery_status", "estimated_time")
    fact = as_of_keys(items.join(context, "order_id"), "_at", {"menu_dim_key": lookup("menu", "_menu_id")}, hot_rows, counted=items)
    return fact.withColumn("order_date_dim_key", date_key(F.to_date("_at"))).select(*FACT_COLUMNS)


def single_rows(changes: DataFrame) -> DataFrame:
    """One source row per item and order."""
    return latest_per_key(changes, SORT_KEY, ["order_date_dim_key"])


def merge_fact(fact: DataFrame, changes: DataFrame) -> DataFrame:
    """Upsert fact rows by order item and order; of several source rows per key one wins.

    Rows that come out of joins on the order are partitioned by it already, and none moves again.
    """
    return replace_rows(fact, single_rows(changes), SORT_KEY)


def merge_stored_fact(fact: DataFrame, single: DataFrame) -> DataFrame:
    """`merge_fact` of stored rows, the changes being one per key. Both move once, by order: so they stay packed."""
    return replace_rows(fact.repartition("order_id"), single.repartition("order_id"), SORT_KEY)


def affected_orders(
    item_changes: DataFrame | None, order_changes: DataFrame | None, delivery_changes: DataFrame | None
) -> DataFrame:
    """Distinct ids of the orders any of the three change feeds touches."""
    ids = [
        df.select(F.col(c).alias("order_id"))
        for df, c in ((item_changes, "order_id_fk"), (order_changes, "order_id"), (delivery_changes, "order_id_fk"))
        if df is not None
    ]
    out = ids[0]
    for df in ids[1:]:
        out = out.unionByName(df)
    return out.distinct()


def incremental_fact_changes(
    affected: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    deliveries: DataFrame,
    dims: Mapping[str, DataFrame],
    with_layout: bool = False,
) -> DataFrame:
    """Fact rows of the affected orders, joined against the clean tables.

    So a status or delivery change alone reaches the fact, which it does not when only the three
    change feeds are joined with each other. Another agent or another menu entry makes another
    clean row; the newest delivery of an order and the newest row of an item count.
    """
    ids = affected.select(F.col("order_id").alias("_affected"))

    def only(df: DataFrame, column: str) -> DataFrame:
        return df.join(ids, F.col(column) == F.col("_affected"), "left_semi")

    return build_fact_changes(
        latest_per_key(only(order_items, "order_id_fk"), ["order_item_id", "order_id_fk"], ["modified_dt"]),
        only(orders, "order_id"),
        latest_per_key(only(deliveries, "order_id_fk"), ["order_id_fk"], ["modified_date"]),
        dims,
        with_layout=with_layout,
    )


def write_fact_by_month(fact: DataFrame, path: str) -> None:
    """Parquet by order year and month; a large month is split over several files, each sorted by
    day so that a day filter skips row groups."""
    (
        fact.hint("rebalance", *LAYOUT)
        .sortWithinPartitions(*LAYOUT, "order_date_dim_key")
        .write.mode("overwrite")
        .partitionBy(*LAYOUT)
        .parquet(path)
    )
