"""The driver tables read as a graph: typed nodes, edges with facets, a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quadloom.model import FACETS, wide_to_facts
from quadloom.plans.spread import dealt

# Type codes: uid = code * 2^40 + key, so keys may start at 0 and types never collide.
TYPE_CODES = {
    "Region": 1,
    "Nation": 2,
    "Supplier": 3,
    "Customer": 4,
    "Part": 5,
    "Order": 6,
    "Document": 7,
    "Vector": 8,
    "Event": 9,
    "Conversation": 10,
}
UID_SPAN = 1 << 40


def uid_of(type_name: str, key: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.lit(TYPE_CODES[type_name] * UID_SPAN) + key.cast("long")


def key_of(type_name: str, uid: int) -> int:
    """The table key behind a uid, so that a uid test becomes a test on a stored column and
    reaches the scan."""
    return uid - TYPE_CODES[type_name] * UID_SPAN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Graph:
    """Lazy frames over one data folder. Nothing is read before an action, but for the row
    counts of a graph whose scans are `dealt`."""

    def __init__(self, spark: SparkSession, sf_dir: str, deal: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.deal = deal

    def raw(self, name: str) -> DataFrame:
        rows = table(self.spark, self.sf_dir, name)
        return dealt(rows) if self.deal else rows

    def dealt(self) -> Graph:
        """The same graph with every scan dealt out by rows, for queries that fold facts."""
        return Graph(self.spark, self.sf_dir, deal=True)

    # nodes -----------------------------------------------------------------
    def region(self) -> DataFrame:
        return self.raw("region").select(uid_of("Region", "r_regionkey").alias("uid"), "*")

    def nation(self) -> DataFrame:
        return self.raw("nation").select(
            uid_of("Nation", "n_nationkey").alias("uid"),
            uid_of("Region", "n_regionkey").alias("in_region"),
            "*",
        )

    def customer(self) -> DataFrame:
        return self.raw("customer").select(
            uid_of("Customer", "c_custkey").alias("uid"),
            uid_of("Nation", "c_nationkey").alias("in_nation"),
            "*",
        )

    def supplier(self) -> DataFrame:
        return self.raw("supplier").select(
            uid_of("Supplier", "s_suppkey").alias("uid"),
            uid_of("Nation", "s_nationkey").alias("in_nation"),
            "*",
        )

    def part(self) -> DataFrame:
        return self.raw("part").select(uid_of("Part", "p_partkey").alias("uid"), "*")

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            uid_of("Order", "o_orderkey").alias("uid"),
            uid_of("Customer", "o_custkey").alias("placed_by"),
            "*",
        )

    def documents(self) -> DataFrame:
        return self.raw("documents").select(uid_of("Document", "doc_id").alias("uid"), "*")

    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select(uid_of("Vector", "vec_id").alias("uid"), "*")

    def events(self) -> DataFrame:
        return self.raw("events").select(
            uid_of("Event", "event_id").alias("uid"),
            uid_of("Customer", "user_id").alias("user"),
            "*",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    # edges -----------------------------------------------------------------
    def contains(self) -> DataFrame:
        """Order -> Part, one edge per distinct pair; repeated lines fold into facets."""
        return (
            self.raw("lineitem")
            .groupBy("l_orderkey", "l_partkey")
            .agg(
                F.sum("l_quantity").alias("quantity"),
                F.round(F.sum("l_extendedprice"), 2).alias("price"),
                F.count(F.lit(1)).alias("lines"),
                F.min("l_shipdate").alias("first_ship"),
            )
            .select(
                uid_of("Order", "l_orderkey").alias("src"),
                uid_of("Part", "l_partkey").alias("dst"),
                "quantity",
                "price",
                "lines",
                "first_ship",
            )
        )

    def order_parts(self) -> DataFrame:
        """(order, part) of every line, repetitions included."""
        return self.raw("lineitem").select(uid_of("Order", "l_orderkey").alias("src"), uid_of("Part", "l_partkey").alias("dst"))

    def contains_pairs(self) -> DataFrame:
        """The contains edges without facets."""
        return self.order_parts().distinct()

    def part_suppliers(self) -> DataFrame:
        """(part, supplier) of every line, repetitions included."""
        return self.raw("lineitem").select(uid_of("Part", "l_partkey").alias("src"), uid_of("Supplier", "l_suppkey").alias("dst"))

    def supplied_by(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy("l_partkey", "l_suppkey")
            .agg(F.count(F.lit(1)).alias("lines"))
            .select(uid_of("Part", "l_partkey").alias("src"), uid_of("Supplier", "l_suppkey").alias("dst"), "lines")
        )

    # facts -----------------------------------------------------------------
    def customer_facts(self) -> DataFrame:
        return wide_to_facts(
            self.customer(),
            "uid",
            {
                "c_name": ("c_name", "string"),
                "c_acctbal": ("c_acctbal", "float"),
                "c_mktsegment": ("c_mktsegment", "string"),
            },
            {"in_nation": "in_nation"},
        )

    def order_facts(self) -> DataFrame:
        return wide_to_facts(
            self.orders(),
            "uid",
            {
                "o_orderstatus": ("o_orderstatus", "string"),
                "o_totalprice": ("o_totalprice", "float"),
                "o_orderpriority": ("o_orderpriority", "string"),
            },
            {"placed_by": "placed_by"},
        )

    # change log -------------------------------------------------------------
    def log(self) -> DataFrame:
        """One change per event; commit_ts is null where the transaction was aborted."""
        k = F.col("k")
        return self.events().select(
            (F.col("user_id") % 5).cast("long").alias("namespace"),
            F.col("user").alias("subject"),
            F.col("event_type").alias("predicate"),
            F.lit(None).cast("long").alias("object_uid"),
            F.col("value").cast("string").alias("value"),
            F.lit("float").alias("value_type"),
            F.lit(None).cast("string").alias("lang"),
            F.create_map(F.lit("k"), k.cast("string")).cast(FACETS).alias("facets"),
            F.when(k % 10 == 0, "DEL").when(k % 10 == 1, "OVR").otherwise("SET").alias("op"),
            F.col("event_id").alias("seq"),
            F.col("event_id").alias("start_ts"),
            (F.col("event_id") + 1).alias("commit_ts"),
        )

    def txn_status(self) -> DataFrame:
        """start_ts and commit_ts per transaction; aborted ones carry no commit."""
        return self.events().select(
            F.col("event_id").alias("start_ts"),
            F.when(F.col("k") % 20 != 5, F.col("event_id") + 1).alias("commit_ts"),
        )
