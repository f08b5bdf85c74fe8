"""Build order of the detail layer (B12) and its materialisation.

{couriers, users, restaurants, timestamps} -> products -> orders -> {sales,
deliveries}.  Each table is built on first use and written once to the
shared checkpoint folder (a lineage cut: later marts read files, not the
whole upstream plan, and survive executor loss); the marts then read those
files.  A query builds only the tables it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import (PACKED, configure, dropping_scratch, open_writers, scratch_path, shuffle_partitions,
                       size_shuffles, stored)
from .. import schemas as S
from ..sources import adapters
from ..sources.landing import land_pages, read_pages
from . import dims, facts

DDS_TABLES = ["dm_couriers", "dm_users", "dm_restaurants", "dm_timestamps", "dm_products",
              "dm_orders", "fct_product_sales", "fct_deliveries"]

STG_FEEDS = ["orders", "restaurants", "users", "events", "couriers", "deliveries", "ranks", "bonus_users"]

# Orders and facts are stored by order month, so month filters prune whole
# folders.  Every task writes the months of its own rows, as its joins or its read left
# them: no shuffle for the write (it was the widest of a build), a busy month has as
# many writers as there are tasks, and a month as many files.  A writing task takes
# ``JOINED_A_WRITER`` shuffle partitions in turn, each sorted by itself, and holds its
# months' files open, so narrow partitions make neither sorts by month nor small files.
JOINED_A_WRITER, OPEN_MONTHS = 16, 128
PARTITION_BY = {
    "dm_orders": ("order_month", None),
    "fct_product_sales": ("order_month", None),
    "fct_deliveries": ("order_month", lambda: F.trunc("order_ts", "month")),
}

_BUILT: dict[tuple[str, str], dict[str, DataFrame]] = {}
_STG: dict[tuple[str, str], dict[str, DataFrame]] = {}


def build_dds(spark: SparkSession, feeds: dict[str, DataFrame]) -> dict[str, dims.Built]:
    """Every dds table from stg feeds, written in build order; with the rows
    that wait for a parent and those rejected, written too."""
    out: dict[str, dims.Built] = {}

    def put(name: str, built: dims.Built) -> DataFrame:
        def kept(df, what):
            return None if df is None else _written(spark, df, f"dds-{name}-{what}")

        out[name] = dims.Built(_written(spark, built.table, f"dds-{name}", PARTITION_BY.get(name)),
                               kept(built.rejected, "rejected"), kept(built.pending, "pending"))
        return out[name].table

    couriers = put("dm_couriers", dims.dim_couriers(feeds["couriers"]))
    users = put("dm_users", dims.dim_users(feeds["users"]))
    restaurants = put("dm_restaurants", dims.dim_restaurants(feeds["restaurants"]))
    parsed = stored(dims.parsed_orders(feeds["orders"]), "parsed-orders")
    calendar = put("dm_timestamps", dims.dim_timestamps(feeds["orders"], parsed=parsed))
    products = put("dm_products", dims.dim_products(feeds["restaurants"], restaurants, kept=stored))
    orders = put("dm_orders", dims.dim_orders(feeds["orders"], restaurants, calendar, users, kept=stored,
                                               parsed=parsed))
    put("fct_product_sales", facts.fct_product_sales(feeds["events"], orders, products, kept=stored))
    put("fct_deliveries", facts.fct_deliveries(feeds["deliveries"], orders, couriers, kept=stored))
    return out


class Lazy(dict):
    """A table mapping whose entries are built and written on first use.

    A query that needs three tables builds those three (and what they
    depend on), not the whole layer; every table is built once per session.
    """

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        value = self._builders[name](self)
        self[name] = value
        return value

    def names(self) -> list[str]:
        return list(self._builders)

    def with_(self, **others: DataFrame) -> "Lazy":
        """The same tables with ``others`` in place of some; the rest stay unbuilt
        until someone asks for them."""
        out = Lazy({n: lambda _, n=n: self[n] for n in self._builders})
        out.update(others)
        return out

    def all(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self._builders}


def _written(spark: SparkSession, df: DataFrame, name: str, partition=None) -> DataFrame:
    path = scratch_path(spark, name)
    if partition:
        col, expr = partition
        df = df.withColumn(col, expr()) if expr else df
        writers = max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark) // JOINED_A_WRITER)
        with open_writers(spark, OPEN_MONTHS):
            df.coalesce(writers).write.mode("overwrite").options(**PACKED).partitionBy(col).parquet(path)
    else:
        df.write.mode("overwrite").options(**PACKED).parquet(path)
    return spark.read.parquet(path)


def materialized_stg(spark: SparkSession, sf_dir: str) -> Lazy:
    """stg feeds of a driver folder (landed source rows), each written on first use."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STG:
        return _STG[key]
    t = adapters.Tables(spark, sf_dir)
    size_shuffles(spark, max(t.lineitem.count(), t.events.count()))  # counts of file footers
    pages = {"couriers": (S.COURIER_PAGE, "_id"), "deliveries": (S.DELIVERY_PAGE, "delivery_id")}

    def feed(name):
        def build(_):
            df = adapters.FEED_BUILDERS[name](t)
            if name in pages:
                # API pages: landed as JSON lines, read back with their schema.
                schema, required = pages[name]
                landed = scratch_path(spark, f"landing-{name}")
                land_pages(df, landed)
                df, _bad = read_pages(spark, landed, schema, required=[required])
            return _written(spark, df, f"stg-{name}")
        return build

    _STG[key] = Lazy({name: feed(name) for name in STG_FEEDS})
    return _STG[key]


def materialized_dds(spark: SparkSession, sf_dir: str) -> Lazy:
    """dds tables of a driver folder, each built (and written) on first use.

    Every table is written with its ids, so marts read plain columns.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _BUILT:
        return _BUILT[key]
    stg = materialized_stg(spark, sf_dir)
    # Order documents with their fields, read once for the calendar and the orders.
    parsed = Lazy({"orders": lambda _: _written(spark, dims.parsed_orders(stg["orders"]), "dds-parsed-orders")})
    builders = {
        "dm_couriers": lambda t: dims.dim_couriers(stg["couriers"]),
        "dm_users": lambda t: dims.dim_users(stg["users"]),
        "dm_restaurants": lambda t: dims.dim_restaurants(stg["restaurants"]),
        "dm_timestamps": lambda t: dims.dim_timestamps(stg["orders"], parsed=parsed["orders"]),
        "dm_products": lambda t: dims.dim_products(stg["restaurants"], t["dm_restaurants"]),
        "dm_orders": lambda t: dims.dim_orders(stg["orders"], t["dm_restaurants"],
                                               t["dm_timestamps"], t["dm_users"],
                                               parsed=parsed["orders"]),
        "fct_product_sales": lambda t: facts.fct_product_sales(stg["events"], t["dm_orders"],
                                                               t["dm_products"]),
        "fct_deliveries": lambda t: facts.fct_deliveries(stg["deliveries"], t["dm_orders"],
                                                         t["dm_couriers"]),
    }
    def table(name, build):
        def write(t):
            with dropping_scratch(spark):
                return _written(spark, build(t).table, f"dds-{name}", PARTITION_BY.get(name))
        return write

    _BUILT[key] = Lazy({name: table(name, build) for name, build in builders.items()})
    return _BUILT[key]
