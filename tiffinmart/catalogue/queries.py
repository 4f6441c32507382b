"""The registered queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart import entities
from tiffinmart.catalogue import oracles as O
from tiffinmart.catalogue.standins import stage, table
from tiffinmart.entities import AUDIT, DIMENSION_ENTITIES, LOCATION
from tiffinmart.functions import casts as K
from tiffinmart.functions import places
from tiffinmart.functions.calendar import calendar_parts
from tiffinmart.functions.keys import hash_key
from tiffinmart.operators import changes as C
from tiffinmart.operators import masking, merge, quality, scd2, valid_time
from tiffinmart.operators import clean as clean_op
from tiffinmart.operators.sequence import add_sequence, append_numbered
from tiffinmart.plans import dashboard, fact, kpis
from tiffinmart.plans.clustering import ClusteredFact
from tiffinmart.plans.date_dim import date_bounds, date_dim, date_key
from tiffinmart.plans.maintained import KpiTable
from tiffinmart.plans.warehouse import Warehouse
from tiffinmart.session import materialize, materialize_all, remove_dir, shared_dir
from tiffinmart.sources.csv_stage import CORRUPT, copy_into, csv_schema, load_stage, read_stage, scan_csv
from tiffinmart.sources.files import fingerprints, list_files
from tiffinmart.sources.ledger import copy_history, pending_files, read_ledger
from tiffinmart.store import SnapshotTable
from tiffinmart.streaming.incremental import run_incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

T0, T1 = O.T0, O.T1
c = F.col


def edge(df: DataFrame) -> DataFrame:
    """Plain client types: decimals as double, whole numbers as bigint, times without a zone,
    hash keys as text."""

    def cast(f: T.StructField):
        col = F.col(f.name)
        if f.name.endswith(("_hk", "_dim_key")) and not isinstance(f.dataType, T.StringType):
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, T.IntegerType | T.ShortType | T.ByteType):
            return col.cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return col.cast("timestamp_ntz").alias(f.name)
        return col

    return df.select(*[cast(f) for f in df.schema.fields])


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# -- inputs --------------------------------------------------------------------------------------


def typed(spark: SparkSession, sf: str, entity: str, day: int = 0, mode: str = "default") -> DataFrame:
    return clean_op.clean(entity, stage(spark, sf, entity, day), mode)[0]


def dates(spark: SparkSession, sf: str) -> DataFrame:
    return date_dim(date_bounds(table(spark, sf, "orders"), "o_orderdate", O.AS_OF))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows straight from line items and orders, for the KPIs; the supplier's number stands
    for the restaurant key."""
    status = F.when(c("o_orderstatus") == "F", "Delivered").when(c("o_orderstatus") == "O", "Pending")
    o = table(spark, sf, "orders").select(
        c("o_orderkey").alias("order_id"),
        status.otherwise("Cancelled").alias("delivery_status"),
        date_key(c("o_orderdate")).alias("order_date_dim_key"),
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
    )
    items = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("order_id"),
        c("l_linenumber").alias("order_item_id"),
        c("l_suppkey").alias("restaurant_dim_key"),
        c("l_extendedprice").cast("decimal(10,2)").alias("subtotal"),
    )
    # An order is one row, so a task's share of the orders fits a hash map, and the lines need no sort.
    return items.join(o.hint("shuffle_hash"), "order_id")


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(c("s_suppkey").alias("restaurant_hk"), c("s_name").alias("name"))


def feed(spark: SparkSession, sf: str, entity: str, compare=None) -> DataFrame:
    e = entities.get(entity)
    return C.change_feed(typed(spark, sf, entity, 0), typed(spark, sf, entity, 1), e.key, compare)


def dim_after_two_days(spark: SparkSession, sf: str, entity: str, t0: str = T0, t1: str = T1) -> DataFrame:
    """The keyed dimension after both deliveries."""
    e = entities.get(entity)
    initial = C.change_feed(None, typed(spark, sf, entity, 0), e.key)
    dim = scd2.scd2_keyed(None, initial, e.dimension, t0)
    return scd2.scd2_keyed(dim, feed(spark, sf, entity, e.dimension.attributes), e.dimension, t1)


def reference_dim_after_two_days(spark: SparkSession, sf: str, entity: str, spec=None) -> DataFrame:
    e = entities.get(entity)
    spec = spec or e.dimension
    initial = C.change_feed(None, typed(spark, sf, entity, 0), e.key)
    dim = scd2.scd2_attribute_match(None, initial, spec, T0)
    return scd2.scd2_attribute_match(dim, feed(spark, sf, entity), spec, T1)


def write_csv(df: DataFrame, path: str, by: str | None = None) -> str:
    """Landing files with a header and \\N for NULL, optionally one folder per value of `by`."""
    writer = df.write.mode("overwrite").option("header", "true").option("nullValue", "\\N")
    (writer.partitionBy(by) if by else writer).csv(path)
    return path


# -- sources -------------------------------------------------------------------------------------


@register("csv_scan_stage", O.stage_sql("orders"))
def csv_scan_stage(spark, sf):
    path = write_csv(stage(spark, sf, "orders"), shared_dir(spark, "csv-scan"))
    return scan_csv(spark, "orders", path).drop(CORRUPT)


@register("csv_prefix_scan", f"{O.stage_sql('customer', 0)} UNION ALL {O.stage_sql('customer', 1)}")
def csv_prefix_scan(spark, sf):
    root = shared_dir(spark, "csv-prefix")
    for day in (0, 1):
        write_csv(stage(spark, sf, "customer", day), f"{root}/day-{day}")
    return scan_csv(spark, "customer", root).drop(CORRUPT)


def _landing_by_login(spark, sf, purpose):
    root = shared_dir(spark, purpose)
    rows = stage(spark, sf, "customer").withColumn("folder", c("loginbyusing"))
    return root, write_csv(rows, f"{root}/initial/customer", by="folder")


def _folder():
    return F.regexp_extract("_stg_file_name", "folder=([a-z]+)", 1).alias("folder")


@register(
    "file_lineage_columns",
    f"SELECT 'initial/customer' AS prefix, loginbyusing AS folder, count(*) AS row_count, count(*) AS stamped_rows "
    f"FROM ({O.stage_sql('customer')}) GROUP BY loginbyusing",
)
def file_lineage_columns(spark, sf):
    root, path = _landing_by_login(spark, sf, "lineage")
    rows = load_stage(spark, "customer", path, T0, root)
    return rows.groupBy(
        F.regexp_extract("_stg_file_name", "^(initial/customer)/folder=", 1).alias("prefix"), _folder()
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(c("_stg_file_load_ts").isNotNull() & c("_copy_data_ts").isNotNull()).alias("stamped_rows"),
    )


def _orders_by_month(spark, sf, purpose) -> str:
    """One file per month of orders, its lines in order: SQL knows its bytes."""
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_orderpriority")
    return write_csv(o.repartition("month").sortWithinPartitions("month", "o_orderkey"), shared_dir(spark, purpose), by="month")


_MONTH_FILES = """SELECT strftime(o_orderdate, '%Y-%m') AS month, 'o_orderkey,o_orderpriority' || chr(10)
    || string_agg(o_orderkey || ',' || o_orderpriority || chr(10), '' ORDER BY o_orderkey) AS content FROM orders GROUP BY 1"""


@register("file_content_md5", f"SELECT md5(content) AS md5, octet_length(encode(content)) AS length FROM ({_MONTH_FILES})")
def file_content_md5(spark, sf):
    return fingerprints(spark, _orders_by_month(spark, sf, "md5"), "*.csv").select("md5", "length")


@register("list_stage_files", f"SELECT month, octet_length(encode(content)) AS length FROM ({_MONTH_FILES})")
def list_stage_files(spark, sf):
    files = list_files(spark, _orders_by_month(spark, sf, "listing"), "*.csv")
    return files.select(F.regexp_extract("path", "month=([0-9-]+)/", 1).alias("month"), "length")


def _load_twice(spark, sf, purpose):
    """Both days of the customer files copied in two loads; the second sees the first day's files again."""
    root = shared_dir(spark, purpose)
    landing, stage_path, ledger = f"{root}/landing", f"{root}/stage", f"{root}/ledger"
    for day, ts in ((0, T0), (1, T1)):
        write_csv(stage(spark, sf, "customer", day), f"{landing}/day-{day}")
        copy_into(spark, "customer", landing, stage_path, ledger, day, ts, landing)
    return landing, stage_path, ledger


@register(
    "copy_into_stage",
    " UNION ALL ".join(
        f"SELECT *, {d} AS load_id, 'day-{d}' AS folder FROM ({O.stage_sql('customer', d)})" for d in (0, 1)
    ),
)
def copy_into_stage(spark, sf):
    _, stage_path, _ = _load_twice(spark, sf, "copy-into")
    rows = read_stage(spark, "customer", stage_path)
    folder = F.regexp_extract("_stg_file_name", "^(day-[0-9])/", 1)
    return rows.select(*entities.CUSTOMER.source_columns, "load_id", folder.alias("folder"))


@register(
    "load_once_ledger",
    "SELECT d AS load_id, n AS row_count, 0 AS corrupt_count, 0 AS still_pending FROM (SELECT count(*) AS n FROM customer), "
    "(SELECT 0 AS d UNION ALL SELECT 1)",
)
def load_once_ledger(spark, sf):
    landing, _, ledger_path = _load_twice(spark, sf, "load-once")
    ledger = read_ledger(spark, ledger_path)
    pending = pending_files(fingerprints(spark, landing, "*.csv"), ledger, "customer")
    loaded = ledger.select("load_id", "row_count", "corrupt_count", F.lit(0).alias("waits"))
    waiting = pending.select(F.lit(None).cast("long").alias("load_id"), F.lit(0).alias("row_count"), F.lit(0).alias("corrupt_count"), F.lit(1).alias("waits"))
    loads = loaded.unionByName(waiting).groupBy("load_id").agg(*[F.sum(x).alias(x) for x in ("row_count", "corrupt_count", "waits")])
    # One row per load is left.
    total = F.sum("waits").over(Window.partitionBy())
    return loads.withColumn("still_pending", total).filter("load_id IS NOT NULL").drop("waits")


@register(
    "copy_history",
    "SELECT event_type AS table_name, CAST(event_id AS VARCHAR) AS path, ts AS load_ts FROM events "
    "WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 24 HOUR",
)
def copy_history_query(spark, sf):
    ledger = table(spark, sf, "events").select(
        c("event_type").alias("table_name"), c("event_id").cast("string").alias("path"), c("ts").alias("load_ts")
    )
    now = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return copy_history(ledger, "purchase", now, hours=24)


@register("table_scan", "SELECT * FROM customer")
def table_scan(spark, sf):
    return table(spark, sf, "customer")


@register("preview_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def preview_limit(spark, sf):
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(100)


@register("insert_select_clean", O.clean_sql("customer", 0, initial=True))
def insert_select_clean(spark, sf):
    path = shared_dir(spark, "insert-select")
    typed(spark, sf, "customer", 0, "initial").write.mode("append").parquet(path)
    return spark.read.parquet(path)


# -- change capture ------------------------------------------------------------------------------


@register(
    "append_only_stream",
    "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS load_day FROM events WHERE day(ts) > 15",
)
def append_only_stream(spark, sf):
    appended = table(spark, sf, "events").withColumn("load_id", F.dayofmonth("ts"))
    return C.append_changes(appended, 15).select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("load_day")
    )


@register("snapshot_change_feed", O.feed_sql("orders"))
def snapshot_change_feed(spark, sf):
    return feed(spark, sf, "orders")


def seed_stage(warehouse: Warehouse, entity: str, rows: DataFrame, load_id: int) -> None:
    """Stage rows written directly, without files to trace them to."""
    audit = {a: F.lit(None).cast("timestamp_ntz" if a.endswith("_ts") else "string") for a in (*AUDIT, CORRUPT)}
    rows.withColumns(audit).write.mode("overwrite").parquet(f"{warehouse.stage_path(entity)}/load_id={load_id}")


@register(
    "stream_offset_advance",
    "SELECT step, load_offset, pending_rows, clean_rows FROM (SELECT count(*) AS n, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS b FROM customer), "
    "LATERAL (VALUES (0, 0, 0, n), (1, 0, n, n), (2, 1, 0, n + b), (3, 1, 0, n + b)) v(step, load_offset, pending_rows, clean_rows)",
)
def stream_offset_advance(spark, sf):
    warehouse = Warehouse(spark, shared_dir(spark, "offsets"), buckets=4)
    clean_table = warehouse.clean_table("customer")

    def state(step: int) -> DataFrame:
        pending = C.append_changes(
            read_stage(spark, "customer", warehouse.stage_path("customer")), clean_table.batch_id()
        )
        # Counted now: the folder is read again later, when it holds more.
        return spark.createDataFrame(
            [(step, clean_table.batch_id(), pending.count(), clean_table.read().count())],
            "step bigint, load_offset bigint, pending_rows bigint, clean_rows bigint",
        )

    seed_stage(warehouse, "customer", stage(spark, sf, "customer", 0), 0)
    warehouse.refresh_clean("customer")
    states = state(0)
    seed_stage(warehouse, "customer", stage(spark, sf, "customer", 1), 1)
    states = states.unionByName(state(1))
    warehouse.refresh_clean("customer")
    states = states.unionByName(state(2))
    warehouse.refresh_clean("customer")  # nothing is waiting
    return states.unionByName(state(3))


@register(
    "pending_change_count",
    f"SELECT _action, _is_update, count(*) AS changes FROM ({O.feed_sql('menu')}) GROUP BY ALL",
)
def pending_change_count(spark, sf):
    return C.pending_change_count(feed(spark, sf, "menu"))


# -- typed cleaning ------------------------------------------------------------------------------


def _stage_query(entity: str, **columns: str) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {cols} FROM ({O.stage_sql(entity)})"


@register(
    "strict_cast",
    _stage_query(
        "delivery", delivery_id="CAST(deliveryid AS BIGINT)", order_id="CAST(orderid AS BIGINT)",
        agent_id="CAST(deliveryagentid AS BIGINT)", address="CAST(addressid AS VARCHAR)",
    ),
)
def strict_cast(spark, sf):
    return stage(spark, sf, "delivery").select(
        K.number(c("deliveryid")).alias("delivery_id"),
        K.number(c("orderid")).alias("order_id"),
        K.number(c("deliveryagentid")).alias("agent_id"),
        c("addressid").cast("string").alias("address"),
    )


@register(
    "try_cast_number",
    _stage_query("menu", menuid="menuid", restaurant_id=O.number("restaurantid"), price=O.number("price"),
                 item_type=O.number("itemtype")),
)
def try_cast_number(spark, sf):
    return stage(spark, sf, "menu").select(
        "menuid",
        K.try_number(c("restaurantid")).alias("restaurant_id"),
        K.try_number(c("price")).alias("price"),
        K.try_number(c("itemtype")).alias("item_type"),
    )


@register(
    "try_cast_decimal",
    _stage_query(
        "restaurant", restaurantid="restaurantid", pricing=O.dec("pricing_for_2", 10, 2), lat=O.dec("latitude", 9, 6),
        lon=O.dec("longitude", 9, 6),
    ),
)
def try_cast_decimal(spark, sf):
    return stage(spark, sf, "restaurant").select(
        "restaurantid",
        K.try_decimal(c("pricing_for_2"), 10, 2).alias("pricing"),
        K.try_decimal(c("latitude"), 9, 6).alias("lat"),
        K.try_decimal(c("longitude"), 9, 6).alias("lon"),
    )


@register(
    "try_cast_timestamp",
    _stage_query("menu", menuid="menuid", created="TRY_CAST(createddate AS TIMESTAMP)",
                 modified="TRY_CAST(modifieddate AS TIMESTAMP)"),
)
def try_cast_timestamp(spark, sf):
    return stage(spark, sf, "menu").select(
        "menuid",
        K.try_timestamp_ntz(c("createddate")).alias("created"),
        K.try_timestamp_ntz(c("modifieddate")).alias("modified"),
    )


@register(
    "try_to_date",
    _stage_query("customer", customerid="customerid", dob="CAST(try_strptime(dob, '%Y-%m-%d') AS DATE)",
                 anniversary="CAST(try_strptime(anniversary, '%Y-%m-%d') AS DATE)"),
)
def try_to_date(spark, sf):
    return stage(spark, sf, "customer").select(
        "customerid", K.try_date(c("dob")).alias("dob"), K.try_date(c("anniversary")).alias("anniversary")
    )


@register(
    "try_to_timestamp_fmt",
    _stage_query(
        "customer", customerid="customerid", by_seconds="try_strptime(createddate, '%Y-%m-%d %H:%M:%S')",
        by_micros="try_strptime(createddate, '%Y-%m-%dT%H:%M:%S.%f')",
        by_nanos="CASE WHEN createddate NOT LIKE '%T%' THEN TRY_CAST(substr(createddate || '.123456789', 1, 26) AS TIMESTAMP) END",
    ),
)
def try_to_timestamp_fmt(spark, sf):
    nanos = F.concat("createddate", F.lit(".123456789"))
    return stage(spark, sf, "customer").select(
        "customerid",
        K.try_timestamp(c("createddate"), clean_op.SECONDS).alias("by_seconds"),
        K.try_timestamp(c("createddate"), clean_op.T_MICROS).alias("by_micros"),
        K.try_timestamp_ntz(nanos, clean_op.NANOS).alias("by_nanos"),
    )


@register(
    "strict_to_timestamp",
    _stage_query("location", locationid="locationid", created="strptime(createddate, '%Y-%m-%d %H:%M:%S')",
                 modified="strptime(modifieddate, '%Y-%m-%d %H:%M:%S')"),
)
def strict_to_timestamp(spark, sf):
    return stage(spark, sf, "location").select(
        "locationid",
        K.timestamp(c("createddate"), clean_op.SECONDS).alias("created"),
        K.timestamp(c("modifieddate"), clean_op.SECONDS).alias("modified"),
    )


@register(
    "try_to_decimal",
    f"SELECT deliveryagentid AS id, {O.dec('rating', 4, 2)} AS two_digits, {O.dec('rating', 38, 0)} AS whole "
    f"FROM ({O.stage_sql('delivery_agent')}) UNION ALL "
    f"SELECT orderid, {O.dec('totalamount', 4, 2)}, {O.dec('totalamount', 38, 0)} FROM ({O.stage_sql('orders')})",
)
def try_to_decimal(spark, sf):
    def both(df, key, value):
        return df.select(
            c(key).alias("id"),
            K.try_decimal(c(value), 4, 2).alias("two_digits"),
            K.try_decimal(c(value), 38, 0).alias("whole"),
        )

    agents = both(stage(spark, sf, "delivery_agent"), "deliveryagentid", "rating")
    return agents.unionByName(both(stage(spark, sf, "orders"), "orderid", "totalamount"))


@register(
    "implicit_coercion",
    _stage_query(
        "order_item", order_id="CAST(orderid AS BIGINT)", menu_id="CAST(menuid AS BIGINT)",
        quantity="CAST(CAST(quantity AS DECIMAL(10,2)) AS DOUBLE)", subtotal="CAST(CAST(subtotal AS DECIMAL(10,2)) AS DOUBLE)",
        created="CAST(createddate AS TIMESTAMP)", bulk="CASE WHEN CAST(quantity AS DECIMAL(10,2)) > 25 THEN TRUE ELSE FALSE END",
    ),
)
def implicit_coercion(spark, sf):
    flag = F.when(K.decimal(c("quantity"), 10, 2) > 25, "Y").otherwise("N")
    return stage(spark, sf, "order_item").select(
        K.number(c("orderid")).alias("order_id"),
        K.number(c("menuid")).alias("menu_id"),
        K.decimal(c("quantity"), 10, 2).alias("quantity"),
        K.decimal(c("subtotal"), 10, 2).alias("subtotal"),
        K.timestamp_ntz(c("createddate")).alias("created"),
        flag.cast("boolean").alias("bulk"),
    )


@register(
    "surrogate_sequence",
    "SELECT o_orderkey, o_custkey, 100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders",
)
def surrogate_sequence(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return add_sequence(o, ["o_orderdate", "o_orderkey"], 101, "order_sk").drop("o_orderdate")


@register(
    "surrogate_sequence_loads",
    f"""SELECT customerid, load_id, row_number() OVER (ORDER BY load_id, customerid) AS sk FROM (
        SELECT customerid, 1 AS load_id FROM ({O.stage_sql('customer')})
        UNION ALL SELECT customerid, 2 FROM ({O.stage_sql('customer', 1)}) ANTI JOIN ({O.stage_sql('customer')}) USING (customerid))""",
)
def surrogate_sequence_loads(spark, sf):
    """Numbers that go on over two loads, the second of which comes twice."""
    numbers = SnapshotTable(spark, shared_dir(spark, "numbers"), ["customerid"], 8)
    first = stage(spark, sf, "customer").select("customerid")
    new = stage(spark, sf, "customer", 1).select("customerid").join(first, "customerid", "left_anti")
    for load_id, rows in ((1, first), (2, new), (2, new)):
        append_numbered(numbers, rows.withColumn("load_id", F.lit(load_id)), ["customerid"], load_id)
    return numbers.read()


@register(
    "trim_lower_clean",
    _stage_query("menu", menuid="menuid", item_name="trim(itemname)", description="trim(description)",
                 category="trim(category)", item_type="lower(trim(itemtype))"),
)
def trim_lower_clean(spark, sf):
    return stage(spark, sf, "menu").select(
        "menuid",
        F.trim("itemname").alias("item_name"),
        F.trim("description").alias("description"),
        F.trim("category").alias("category"),
        F.lower(F.trim("itemtype")).alias("item_type"),
    )


@register(
    "text_to_boolean",
    _stage_query("menu", menuid="menuid",
                 available="CASE lower(availability) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END"),
)
def text_to_boolean(spark, sf):
    return stage(spark, sf, "menu").select("menuid", K.text_boolean(c("availability")).alias("available"))


@register(
    "value_normalise",
    _stage_query("location", locationid="locationid", state=O.STATE_NAME),
)
def value_normalise(spark, sf):
    return stage(spark, sf, "location").select("locationid", places.state_name(c("state")).alias("state"))


@register("code_lookup", _stage_query("location", locationid="locationid", state_code=O.STATE_CODE))
def code_lookup(spark, sf):
    return stage(spark, sf, "location").select("locationid", places.state_code(c("state")).alias("state_code"))


@register("membership_flag", _stage_query("location", locationid="locationid", is_union_territory=O.UNION_TERRITORY))
def membership_flag(spark, sf):
    return stage(spark, sf, "location").select(
        "locationid", places.is_union_territory(c("state")).alias("is_union_territory")
    )


@register("pair_flag", _stage_query("location", locationid="locationid", capital_city_flag=O.CAPITAL))
def pair_flag(spark, sf):
    return stage(spark, sf, "location").select(
        "locationid", places.is_capital_city(c("state"), c("city")).alias("capital_city_flag")
    )


@register("tier_bucket", _stage_query("location", locationid="locationid", city_tier=O.TIER))
def tier_bucket(spark, sf):
    return stage(spark, sf, "location").select("locationid", places.city_tier(c("city")).alias("city_tier"))


def _register_clean(entity: str) -> None:
    @register(f"clean_{entity}", O.clean_sql(entity, 0))
    def job(spark, sf):
        return typed(spark, sf, entity)


for _name in entities.ENTITIES:
    _register_clean(_name)


# -- predicates ----------------------------------------------------------------------------------


@register(
    "filter_delivered",
    f"SELECT order_id, order_item_id, CAST(subtotal AS DOUBLE) AS subtotal FROM ({O.SALES}) WHERE delivery_status = 'Delivered'",
)
def filter_delivered(spark, sf):
    return (
        sales(spark, sf).filter(c("delivery_status") == "Delivered").select("order_id", "order_item_id", "subtotal")
    )


@register(
    "filter_year_month",
    f"SELECT * FROM ({O.kpi_sql('year, month')}) WHERE year = 1998 AND month = 7",
)
def filter_year_month(spark, sf):
    k = kpis.monthly_kpis(sales(spark, sf), dates(spark, sf))
    return spark.sql("SELECT * FROM {k} WHERE year = :year AND month = :month", args={"year": 1998, "month": 7}, k=k)


def _changed(spark, sf, test) -> DataFrame:
    compared = ["login_by_using", "gender", "dob"]
    t, s = typed(spark, sf, "customer", 0).alias("t"), typed(spark, sf, "customer", 1).alias("s")
    changed = F.coalesce(test(compared), F.lit(False)).alias("changed")
    return t.join(s, c("t.customer_id") == c("s.customer_id")).select(c("t.customer_id").alias("customer_id"), changed)


@register("change_detect_reference", O.change_detect_sql("!="))
def change_detect_reference(spark, sf):
    return _changed(spark, sf, merge.changed_reference)


@register("change_detect_nullsafe", O.change_detect_sql("IS DISTINCT FROM"))
def change_detect_nullsafe(spark, sf):
    return _changed(spark, sf, merge.changed_nullsafe)


# -- upserts -------------------------------------------------------------------------------------


def _register_upsert(name: str, entity: str, mode: str = "default") -> None:
    @register(name, O.upsert_sql(entity, mode))
    def job(spark, sf):
        return merge.upsert_entity(
            entity, typed(spark, sf, entity, 0, mode), typed(spark, sf, entity, 1, mode), mode
        )


_register_upsert("merge_upsert_conditional", "location")
_register_upsert("merge_upsert_full", "customer")
_register_upsert("merge_upsert_keep_fk", "customer_address")
_register_upsert("merge_upsert_partial", "orders")
_register_upsert("merge_upsert_asymmetric", "delivery_agent", "reference")
_register_upsert("merge_upsert_composite", "delivery")


@register("merge_upsert_restaurant", O.upsert_sql("restaurant"))
def merge_upsert_restaurant(spark, sf):
    """The same upsert, without a shuffle of the target while the source is small."""
    return merge.upsert_entity(
        "restaurant", typed(spark, sf, "restaurant", 0), typed(spark, sf, "restaurant", 1)
    )


_register_upsert("merge_upsert_order_item", "order_item")


@register("merge_upsert_full_source", O.full_source_sql("menu"))
def merge_upsert_full_source(spark, sf):
    everything = typed(spark, sf, "menu", 0).unionByName(typed(spark, sf, "menu", 1))
    return merge.upsert_entity("menu", typed(spark, sf, "menu", 0), everything)


@register(
    "latest_per_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (SELECT *, row_number() OVER ("
    "PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn "
    "FROM lineitem) WHERE rn = 1",
)
def latest_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return merge.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register(
    "quarantine_null_keys",
    f"SELECT delivery_agent_id, name, location_id_fk, location_id_fk IS NULL AS quarantined FROM ({O.clean_sql('delivery_agent', 0)})",
)
def quarantine_null_keys(spark, sf):
    agents = typed(spark, sf, "delivery_agent").select("delivery_agent_id", "name", "location_id_fk")
    good, bad = clean_op.quarantine_null_keys(agents, ["delivery_agent_id", "location_id_fk"])
    return good.withColumn("quarantined", F.lit(False)).unionByName(bad.withColumn("quarantined", F.lit(True)))


# -- dimensions ----------------------------------------------------------------------------------


def _register_reference_scd2(name: str, entity: str, spec=None) -> None:
    @register(name, O.reference_scd2_sql(entity, spec))
    def job(spark, sf):
        return reference_dim_after_two_days(spark, sf, entity, spec)


_register_reference_scd2("scd2_key_and_flag", "location")
_register_reference_scd2("scd2_restaurant", "restaurant")
_register_reference_scd2("scd2_customer", "customer")
_register_reference_scd2("scd2_customer_address", "customer_address")
_register_reference_scd2("scd2_menu", "menu")
_register_reference_scd2("scd2_delivery_agent", "delivery_agent")
_register_reference_scd2(
    "scd2_attribute_match", "location", replace(LOCATION.dimension, match_cols=("location_id", "zip_code", "active_flag"))
)


def _register_keyed_scd2(name: str, entity: str) -> None:
    @register(name, O.keyed_scd2_sql(entity))
    def job(spark, sf):
        return dim_after_two_days(spark, sf, entity)


_register_keyed_scd2("scd2_keyed", "customer")
_register_keyed_scd2("scd2_keyed_menu", "menu")


@register(
    "hash_surrogate_key",
    f"SELECT orderid, CAST({O.hash60(O.netstring(['orderid', 'customerid', 'paymentmethod', 'status']))} AS VARCHAR) AS safe_hk, "
    f"CAST({O.hash60('orderid || customerid || paymentmethod || status')} AS VARCHAR) AS reference_hk FROM ({O.stage_sql('orders')})",
)
def hash_surrogate_key(spark, sf):
    cols = ["orderid", "customerid", "paymentmethod", "status"]
    return stage(spark, sf, "orders").select(
        "orderid", hash_key(cols).alias("safe_hk"), hash_key(cols, "reference").alias("reference_hk")
    )


@register("dim_current", f"SELECT * FROM ({O.keyed_scd2_sql('delivery_agent')}) WHERE is_current")
def dim_current(spark, sf):
    return scd2.current(dim_after_two_days(spark, sf, "delivery_agent"), entities.DELIVERY_AGENT.dimension)


@register("dim_as_of_join", O.as_of_sql())
def dim_as_of_join(spark, sf):
    dim = dim_after_two_days(spark, sf, "customer", O.EARLY, O.MIDDLE).withColumn(
        "customer_id", c("customer_id").cast("bigint")
    )
    o = table(spark, sf, "orders").select(
        c("o_orderkey").alias("order_id"), c("o_custkey").alias("cust"), c("o_orderdate").alias("order_date")
    )
    return scd2.as_of(o, dim, entities.CUSTOMER.dimension, "cust", "order_date").select(
        "order_id", "customer_id", "order_date", "login_by_using", "gender", "is_current"
    )


@register("scd2_valid_time", O.valid_time_sql())
def scd2_valid_time(spark, sf):
    """Customers whose second delivery comes first, and whose corrections come last."""
    spec = entities.CUSTOMER.dimension
    day = [typed(spark, sf, "customer", d) for d in (0, 1)]
    number = c("customer_id").cast("bigint")
    points = None
    for rows, when, gone in (
        (day[1].unionByName(day[1]), O.MIDDLE, None),
        (day[0], O.EARLY, None),
        (day[0].filter(number % 5 == 0).withColumn("login_by_using", F.lit("phone")), O.CORRECTED, None),
        (day[1].filter(number % 7 == 0), O.LEFT, F.lit(True)),
        (day[1], O.CONFIRMED, None),
    ):
        points = materialize(valid_time.splice(points, rows.withColumn("_when", F.lit(when)), spec, "_when", gone), "points")
    return valid_time.history(points, spec)


# -- joins and fact ------------------------------------------------------------------------------


@register(
    "join_fact_date",
    f"SELECT order_id, order_item_id, CAST(subtotal AS DOUBLE) AS subtotal, day AS calendar_date, "
    f"strftime(day, '%a') AS day_name FROM ({O.SALES})",
)
def join_fact_date(spark, sf):
    d = dates(spark, sf)
    return sales(spark, sf).join(F.broadcast(d), c("order_date_dim_key") == c("date_dim_hk")).select(
        "order_id", "order_item_id", "subtotal", "calendar_date", "day_name"
    )


def _star_inputs(spark, sf, build, events: dict[str, tuple[str, int]]) -> tuple[dict, dict]:
    """Clean events, by name as (entity, day), and dimensions, stored as a warehouse has them."""
    dims = materialize_all({e.name: build(spark, sf, e.name) for e in DIMENSION_ENTITIES}, "dim")
    dims["date"] = dates(spark, sf)
    return {name: typed(spark, sf, entity, day) for name, (entity, day) in events.items()}, dims


_DAY_0 = {"items": ("order_item", 0), "orders": ("orders", 0), "deliveries": ("delivery", 0)}


@register("star_join_fact", O.star_join_reference_sql())
def star_join_fact(spark, sf):
    """Every version of every dimension, reported per order."""
    e, dims = _star_inputs(spark, sf, reference_dim_after_two_days, _DAY_0)
    rows = fact.build_fact_changes(e["items"], e["orders"], e["deliveries"], dims, "reference")
    bounds = [f(k).alias(f"{n}_{k}") for k in fact.DIM_KEYS for n, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("subtotal"), *bounds
    )


@register("star_join_fact_current", O.star_join_current_sql())
def star_join_fact_current(spark, sf):
    e, dims = _star_inputs(spark, sf, dim_after_two_days, _DAY_0)
    return fact.build_fact_changes(e["items"], e["orders"], e["deliveries"], dims)


@register("star_join_fact_as_of", O.star_join_as_of_sql())
def star_join_fact_as_of(spark, sf):
    """Facts with the versions of the order's time: a later price leaves earlier orders alone."""
    e, dims = _star_inputs(spark, sf, lambda *a: dim_after_two_days(*a, O.EARLY, O.MIDDLE), _DAY_0)
    return fact.build_fact_as_of(e["items"], e["orders"], e["deliveries"], dims)


@register("merge_fact", O.merge_fact_sql())
def merge_fact(spark, sf):
    day_1 = {"new_items": ("order_item", 1), "new_deliveries": ("delivery", 1)}
    e, dims = _star_inputs(spark, sf, dim_after_two_days, _DAY_0 | day_1)
    before = fact.build_fact_changes(e["items"], e["orders"], e["deliveries"], dims)
    changes = fact.build_fact_changes(e["new_items"], e["orders"], e["new_deliveries"], dims)
    return fact.merge_fact(before, changes)


# -- KPIs and dashboard --------------------------------------------------------------------------


@register("kpi_yearly", O.kpi_sql("year"))
def kpi_yearly(spark, sf):
    return dashboard.yearly(kpis.yearly_kpis(sales(spark, sf), dates(spark, sf)))


@register("kpi_monthly", O.kpi_sql("year, month"))
def kpi_monthly(spark, sf):
    return kpis.monthly_kpis(sales(spark, sf), dates(spark, sf))


@register("kpi_daily", O.kpi_sql("year, month, day_of_month", "year, month, day_of_month AS day"))
def kpi_daily(spark, sf):
    return kpis.daily_kpis(sales(spark, sf), dates(spark, sf))


@register("kpi_weekday", O.kpi_sql("year, month, day_name", where="TRUE"))
def kpi_weekday(spark, sf):
    return kpis.weekday_kpis(sales(spark, sf), dates(spark, sf))


@register("kpi_monthly_restaurant", O.restaurant_kpi_sql())
def kpi_monthly_restaurant(spark, sf):
    return kpis.monthly_restaurant_kpis(sales(spark, sf), dates(spark, sf), restaurants(spark, sf))


@register("kpi_views", O.kpi_sql("year, month"))
def kpi_views(spark, sf):
    """The monthly view by name, as a client reads it."""
    kpis.create_views(sales(spark, sf), dates(spark, sf), restaurants(spark, sf))
    return spark.sql("SELECT * FROM vw_monthly_revenue_kpis")


@register("kpi_weekday_delivered", O.kpi_sql("year, month, day_name"))
def kpi_weekday_delivered(spark, sf):
    """The weekday view over delivered orders alone."""
    return kpis.weekday_kpis(sales(spark, sf), dates(spark, sf), delivered_only=True)


@register("kpi_maintained", O.maintained_sql())
def kpi_maintained(spark, sf):
    """The five views from aggregates kept with the fact, after a version with wrong amounts was put right."""
    right = sales(spark, sf).select("order_item_id", "order_id", "restaurant_dim_key", "subtotal", "delivery_status", "order_date_dim_key", "order_year", "order_month")
    fact_table = SnapshotTable(spark, shared_dir(spark, "kept-fact"), ["order_id"], 2, fact.LAYOUT)
    kept = KpiTable(spark, shared_dir(spark, "kept-kpis"), fact_table)
    late = (c("order_year") == 1998) & (c("order_month") > 6)
    wrong = right.withColumn("subtotal", F.when(late, c("subtotal") + 1).otherwise(c("subtotal")).cast("decimal(10,2)"))
    fact_table.commit(wrong.filter(~late | (c("order_id") % 7 != 0)))
    kept.refresh()
    again = right.filter(late)
    fact_table.commit(again, replace=fact_table.touched_slices(again))
    kept.refresh()
    d, names = dates(spark, sf), ["year", "month", "day_of_the_month", "day_name", "delivery_status", "restaurant_name"]

    def view(name: str, by: list[str], *more) -> DataFrame:
        rows = kept.kpis(d, by, *more)
        missing = {n: F.lit(None).cast("bigint" if n in names[:3] else "string") for n in names if n not in by}
        return rows.withColumns(missing).select(F.lit(name).alias("view_name"), *names, *kpis.MEASURES)

    views = [
        view("yearly", ["year"]),
        view("monthly", ["year", "month"]),
        view("daily", ["year", "month", "day_of_the_month"]),
        view("weekday", ["year", "month", "day_name"], None),
        view("restaurant", ["year", "month", "delivery_status", "restaurant_name"], None, restaurants(spark, sf)),
    ]
    return reduce(DataFrame.unionByName, views).withColumnRenamed("day_of_the_month", "day_of_month")


@register(
    "kpi_all_years",
    f"SELECT sum(total_revenue) AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders, "
    f"max(max_order_value) AS max_order_value FROM ({O.kpi_sql('year')})",
)
def kpi_all_years(spark, sf):
    return dashboard.all_years(kpis.yearly_kpis(sales(spark, sf), dates(spark, sf)))


@register("kpi_yoy", O.yoy_sql())
def kpi_yoy(spark, sf):
    return dashboard.yoy(kpis.yearly_kpis(sales(spark, sf), dates(spark, sf)))


@register(
    "kpi_monthly_rounded",
    f"SELECT month, CAST(round(total_revenue) AS DOUBLE) AS total_revenue FROM ({O.kpi_sql('year, month')}) WHERE year = 1998",
)
def kpi_monthly_rounded(spark, sf):
    return dashboard.monthly_rounded(kpis.monthly_kpis(sales(spark, sf), dates(spark, sf)), 1998)


@register(
    "monthly_trend",
    f"SELECT month, strftime(make_date(1998, month, 1), '%b') AS month_name, CAST(round(total_revenue) AS DOUBLE) AS total_revenue "
    f"FROM ({O.kpi_sql('year, month')}) WHERE year = 1998",
)
def monthly_trend(spark, sf):
    return dashboard.monthly_trend(kpis.monthly_kpis(sales(spark, sf), dates(spark, sf)), 1998)


@register("distinct_months", f"SELECT DISTINCT month FROM ({O.restaurant_kpi_sql()}) WHERE year = 1998")
def distinct_months(spark, sf):
    k = kpis.monthly_restaurant_kpis(sales(spark, sf), dates(spark, sf), restaurants(spark, sf))
    return dashboard.months_present(k, 1998)


@register(
    "top10_restaurants",
    f"SELECT restaurant_name, {O.MEASURE_NAMES} FROM ({O.restaurant_kpi_sql()}) WHERE year = 1998 AND month = 7 "
    f"ORDER BY total_revenue DESC, restaurant_name, delivery_status LIMIT 10",
)
def top10_restaurants(spark, sf):
    k = kpis.monthly_restaurant_kpis(sales(spark, sf), dates(spark, sf), restaurants(spark, sf))
    return dashboard.top_restaurants(k, 1998, 7)


@register(
    "latest_period",
    f"SELECT year, month FROM ({O.kpi_sql('year, month')}) ORDER BY year DESC, month DESC LIMIT 1",
)
def latest_period(spark, sf):
    return dashboard.latest_period(kpis.monthly_kpis(sales(spark, sf), dates(spark, sf)))


# -- calendar ------------------------------------------------------------------------------------


@register("calendar_parts", O.calendar_sql("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders", "o_orderkey"))
def calendar_parts_query(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", *[e.alias(n) for n, e in calendar_parts(F.to_date("o_orderdate")).items()])


@register("date_dim", O.date_dim_sql())
def date_dim_query(spark, sf):
    return dates(spark, sf)


@register("date_dim_reference", O.date_dim_sql(skip_first=True))
def date_dim_reference(spark, sf):
    bounds = date_bounds(table(spark, sf, "orders"), "o_orderdate", O.AS_OF)
    return date_dim(bounds, include_first=False)


# -- governance and quality ----------------------------------------------------------------------


@register(
    "mask_pii",
    "SELECT customer_id, name, '** Phone **' AS mobile, '** EAMIL **' AS email, '** PII **' AS gender "
    f"FROM ({O.clean_sql('customer', 0)})",
)
def mask_pii(spark, sf):
    people = typed(spark, sf, "customer").select("customer_id", "name", "mobile", "email", "gender")
    return masking.mask_columns(people, {"mobile": "phone", "email": "email", "gender": "pii"})


@register(
    "mask_by_tag",
    "SELECT customer_id, '** PII **' AS mobile, '** EAMIL **' AS email, '** PII **' AS gender, '** PII **' AS dob, preferences "
    f"FROM ({O.clean_sql('customer', 0)})",
)
def mask_by_tag(spark, sf):
    people = typed(spark, sf, "customer").select("customer_id", "mobile", "email", "gender", "dob", "preferences")
    return masking.mask_by_tag(masking.tag_columns(people, masking.entity_tags("customer")))


@register(
    "check_not_null",
    O.null_counts_sql("customer", 1, ["customer_id", "name", "gender", "dob", "created_dt"]),
)
def check_not_null(spark, sf):
    return quality.check_not_null(
        typed(spark, sf, "customer", 1), ["customer_id", "name", "gender", "dob", "created_dt"]
    )


@register("check_lengths", O.lengths_sql("customer", 1))
def check_lengths(spark, sf):
    return quality.check_lengths(typed(spark, sf, "customer", 1), "customer")


@register(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def check_unique(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "check_unique_delta",
    f"""WITH a AS (SELECT mobile, customerid FROM ({O.stage_sql('customer')}) WHERE mobile IS NOT NULL),
        b AS (SELECT mobile, count(*) AS new_rows, min(customerid) AS customerid FROM ({O.stage_sql('customer', 1)}) WHERE mobile IS NOT NULL GROUP BY mobile)
        SELECT b.mobile, new_rows, CAST(a.mobile IS NOT NULL AND (a.customerid <> b.customerid OR new_rows > 1) AS BIGINT) AS stored_rows
        FROM b LEFT JOIN a USING (mobile) WHERE new_rows > 1 OR (a.mobile IS NOT NULL AND a.customerid <> b.customerid)""",
)
def check_unique_delta(spark, sf):
    """Mobile numbers of the second delivery that another customer has, looked up in an index of the first."""
    index = quality.UniqueIndex(spark, shared_dir(spark, "unique-mobile"), ["mobile"], ["customerid"], 16)
    index.add(stage(spark, sf, "customer"), 1)
    return index.violations(stage(spark, sf, "customer", 1))


@register("check_foreign_keys", O.foreign_key_sql())
def check_foreign_keys(spark, sf):
    """Seven keys of the day-0 events against the day-1 tables, where renumbered ids are gone."""
    o = typed(spark, sf, "orders").join(
        typed(spark, sf, "delivery").withColumnRenamed("order_id_fk", "order_id"), "order_id"
    )
    items = typed(spark, sf, "order_item").select(c("order_id_fk").alias("order_id"), "menu_id_fk")
    rows = items.join(o, "order_id").select(
        c("customer_id_fk").alias("customer"),
        c("customer_address_id_fk").alias("customer_address"),
        c("restaurant_id_fk").alias("restaurant"),
        c("restaurant_id_fk").alias("restaurant_location"),
        c("menu_id_fk").alias("menu"),
        c("delivery_agent_id_fk").alias("delivery_agent"),
        F.to_date("order_date").alias("order_date"),
    )

    def ids(entity: str, key: str) -> DataFrame:
        return typed(spark, sf, entity, 1).select(c(key).cast("bigint").alias(key))

    bounds = date_bounds(table(spark, sf, "orders"), "o_orderdate", O.AS_OF)
    return quality.check_foreign_keys(
        rows,
        {
            "customer": (ids("customer", "customer_id"), "customer_id"),
            "customer_address": (ids("customer_address", "address_id"), "address_id"),
            "restaurant": (ids("restaurant", "restaurant_id"), "restaurant_id"),
            "restaurant_location": (ids("location", "location_id"), "location_id"),
            "menu": (ids("menu", "menu_id"), "menu_id"),
            "delivery_agent": (ids("delivery_agent", "delivery_agent_id"), "delivery_agent_id"),
            "order_date": (date_dim(bounds, include_first=False), "calendar_date"),
        },
    )


@register(
    "lineage_by_file",
    f"SELECT loginbyusing AS folder, count(*) AS row_count FROM ({O.stage_sql('customer')}) GROUP BY loginbyusing",
)
def lineage_by_file(spark, sf):
    root, path = _landing_by_login(spark, sf, "lineage-clean")
    rows = clean_op.clean("customer", load_stage(spark, "customer", path, T0, root))[0]
    per_file = quality.lineage_by_file(rows).filter(c("_stg_file_md5").isNotNull())
    return per_file.groupBy(_folder()).agg(F.sum("row_count").alias("row_count"))


@register("reconcile_counts", O.reconcile_sql())
def reconcile_counts(spark, sf):
    rows = stage(spark, sf, "menu")
    accepted, rejected = clean_op.clean("menu", rows)
    return quality.reconcile_counts(
        {
            "stage": rows.select(F.trim("itemtype").alias("item_type")),
            "clean": accepted.select("item_type"),
            "quarantine": rejected.select("item_type"),
        },
        ["item_type"],
    )


NULL_LIMITS = {"gender": 0.1, "dob": 0.5, "created_dt": 0.0, "name": 0.0}


@register("null_rates", O.null_rates_sql("customer", 1, NULL_LIMITS))
def null_rates(spark, sf):
    return quality.null_rates(typed(spark, sf, "customer", 1), NULL_LIMITS)


@register("on_time_by_tier", O.on_time_sql())
def on_time_by_tier(spark, sf):
    d = typed(spark, sf, "delivery").select(
        c("customer_address_id_fk").alias("place"),
        "estimated_time",
        (c("order_id_fk") % 60).alias("actual_minutes"),
    )
    return quality.on_time_by_tier(d, typed(spark, sf, "location"), "place")


@register(
    "fact_partitioned_write",
    f"SELECT year(day) AS order_year, month(day) AS order_month, count(*) AS fact_rows, CAST(sum(subtotal) AS DOUBLE) AS revenue "
    f"FROM ({O.SALES}) GROUP BY ALL",
)
def fact_partitioned_write(spark, sf):
    path = shared_dir(spark, "fact-by-month")
    fact.write_fact_by_month(sales(spark, sf), path)
    return spark.read.parquet(path).groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("subtotal").alias("revenue")
    )


@register(
    "fact_reclustered",
    f"SELECT year(day) AS order_year, month(day) AS order_month, count(*) AS fact_rows, CAST(sum(subtotal) AS DOUBLE) AS revenue, "
    f"TRUE AS few_overlaps FROM ({O.SALES}) GROUP BY ALL",
)
def fact_reclustered(spark, sf):
    """The fact in six deliveries of all its months, then files that overlap more than twice rewritten."""
    grown = ClusteredFact(spark, shared_dir(spark, "fact-clustered"), rows_per_file=100_000, most_depth=2)
    landing = shared_dir(spark, "fact-deliveries")
    rows = sales(spark, sf).withColumn("delivery", F.pmod(F.xxhash64("order_id"), F.lit(6)))
    rows.write.partitionBy("delivery").parquet(landing)
    for batch in range(6):
        # Each delivery is a folder, so that it alone is read.
        grown.append(spark.read.schema(rows.schema).parquet(landing).filter(c("delivery") == batch).drop("delivery"), batch)
    grown.recluster(6)
    few = grown.depth() <= 2
    return grown.read().groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("subtotal").alias("revenue"), F.lit(few).alias("few_overlaps")
    )


# -- incremental ---------------------------------------------------------------------------------


def _stream_customers(spark, sf, purpose, then) -> Warehouse:
    """Day 0 arrives and is drained, then day 1; one checkpoint remembers the files."""
    root = shared_dir(spark, purpose)
    warehouse = Warehouse(spark, f"{root}/warehouse", buckets=4)
    for day, ts in ((0, T0), (1, T1)):
        write_csv(stage(spark, sf, "customer", day), f"{root}/landing/day-{day}")
        run_incremental(
            warehouse, "customer", f"{root}/landing", f"{root}/checkpoint", ts, then, root=f"{root}/landing"
        )
    return warehouse


@register("warehouse_kpis", O.warehouse_kpis_sql())
def warehouse_kpis(spark, sf):
    """All nine entities from files to the five views."""
    root = shared_dir(spark, "warehouse-kpis")
    warehouse = Warehouse(spark, f"{root}/warehouse", buckets=2)
    for name in entities.ENTITIES:
        write_csv(stage(spark, sf, name), f"{root}/landing/{name}")
        warehouse.load(name, f"{root}/landing/{name}", 0, T0, f"{root}/landing")
        remove_dir(spark, f"{root}/landing/{name}")  # loaded, and as text the largest copy of the rows
    warehouse.refresh_all(T0, O.AS_OF)
    rows, days, places_ = warehouse.fact(), warehouse.dates(), warehouse.dim("restaurant")
    views = {
        "yearly": kpis.yearly_kpis(rows, days),
        "monthly": kpis.monthly_kpis(rows, days),
        "daily": kpis.daily_kpis(rows, days).withColumnRenamed("day", "day_of_month"),
        "weekday": kpis.weekday_kpis(rows, days),
        "restaurant": kpis.monthly_restaurant_kpis(rows, days, places_),
    }
    whole = {"year": "bigint", "month": "bigint", "day_of_month": "bigint", "day_name": "string", "delivery_status": "string", "restaurant_name": "string"}

    def same(name, df):
        shown = [(c(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in whole.items()]
        return df.select(F.lit(name).alias("view_name"), *shown, *kpis.MEASURES)

    frames = [same(name, df) for name, df in views.items()]
    return reduce(DataFrame.unionByName, frames)


@register("stream_append_ingest", f"{O.stage_sql('customer', 0)} UNION ALL {O.stage_sql('customer', 1)}")
def stream_append_ingest(spark, sf):
    warehouse = _stream_customers(spark, sf, "stream-append", ())
    return read_stage(spark, "customer", warehouse.stage_path("customer")).select(
        *entities.CUSTOMER.source_columns
    )


@register("stream_merge_clean", O.upsert_sql("customer"))
def stream_merge_clean(spark, sf):
    warehouse = _stream_customers(spark, sf, "stream-clean", ("clean",))
    return warehouse.clean("customer").select(*entities.CUSTOMER.columns)


@register("stream_scd2", O.keyed_scd2_sql("customer"))
def stream_scd2(spark, sf):
    return _stream_customers(spark, sf, "stream-scd2", ("clean", "dim")).dim("customer")


@register("stream_merge_fact", O.stream_fact_sql())
def stream_merge_fact(spark, sf):
    """Two deliveries of order items streamed into a warehouse that holds everything else."""
    root = shared_dir(spark, "stream-fact")
    warehouse = Warehouse(spark, f"{root}/warehouse", buckets=2)
    for name in entities.ENTITIES:
        if name != "order_item":
            seed_stage(warehouse, name, stage(spark, sf, name), 0)
    warehouse.refresh_dimensions(T0)
    warehouse.refresh_dates(O.AS_OF)
    for day, ts in ((0, T0), (1, T1)):
        write_csv(stage(spark, sf, "order_item", day), f"{root}/landing/day-{day}")
        run_incremental(
            warehouse, "order_item", f"{root}/landing", f"{root}/checkpoint", ts, ("clean", "fact"),
            root=f"{root}/landing",
        )
        remove_dir(spark, f"{root}/landing/day-{day}")  # its checkpoint knows the files as read
    return warehouse.fact().select(*fact.FACT_COLUMNS)
