"""The retail tables read as a clinical record.

An order is an encounter of its customer, a line is an event of that encounter, and a
part is a drug or a diagnosis.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.operators.cohort import anchors_per_day, copies_per_key, select_cohort
from wardlens.operators.lookback import prior_events
from wardlens.operators.prefilter import reduce_by_ids
from wardlens.sources.staging import Stage
from wardlens.sources.tables import parquet_table

AS_OF = datetime(1999, 1, 16)
COHORT_DAYS = (-30, -1)
PRIOR_DAYS = (-367, -31)

# Stated, so that opening a table needs no job that reads file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

# The cohort in SQL: 30 days up to, but not including, the as-of day.
COHORT_SQL = """
cohort AS (
  SELECT o_custkey, o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-12-17' AND o_orderdate < TIMESTAMP '1999-01-16'
)"""

PRIOR_SQL = """
prior AS (
  SELECT o_custkey, o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-14' AND o_orderdate < TIMESTAMP '1998-12-17'
)"""


class Retail:
    """The tables of one folder and the relations most queries start from."""

    def __init__(self, spark: SparkSession, folder: str, **tables: DataFrame):
        self.spark = spark
        self.folder = folder
        self.tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self.tables:
            self.tables[name] = parquet_table(self.spark, self.folder, name, SCHEMAS[name])
        return self.tables[name]

    @cached_property
    def stage(self) -> Stage:
        return Stage(self.spark)

    @cached_property
    def cohort(self) -> DataFrame:
        return select_cohort(
            self.orders,
            as_of=AS_OF,
            encounter="o_orderkey",
            admitted="o_orderdate",
            first_day=COHORT_DAYS[0],
            last_day=COHORT_DAYS[1],
        ).select("o_custkey", "o_orderkey", "o_orderdate")

    @cached_property
    def copies(self) -> DataFrame:
        """One row per cohort customer, staged: broadcast by its real size, and where it
        is too large, a customer with many orders can be split."""
        return self.stage.keep(copies_per_key(self.cohort, "o_custkey"), "copies")

    @cached_property
    def anchors(self) -> DataFrame:
        return anchors_per_day(self.cohort, "o_custkey", "o_orderdate")

    @cached_property
    def prior(self) -> DataFrame:
        return prior_events(
            self.orders,
            ts="o_orderdate",
            as_of=AS_OF,
            first_day=PRIOR_DAYS[0],
            last_day=PRIOR_DAYS[1],
        ).select("o_custkey", "o_orderkey", "o_orderdate")

    def cohort_orders(self) -> DataFrame:
        """All orders of the cohort's customers."""
        return self.orders.join(self.copies, "o_custkey", "left_semi")

    @cached_property
    def ordered(self) -> DataFrame:
        """Lines of all orders of the cohort's customers."""
        return self.cohort_orders().join(self.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))

    @cached_property
    def bought(self) -> DataFrame:
        """Lines and parts of all orders of the cohort's customers."""
        return self.ordered.join(self.part, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def conditions(self) -> DataFrame:
        """Every line of the cohort's customers as a condition: noted when ordered, ended
        when shipped if the line is final, else still open."""
        return self.ordered.select(
            "o_custkey",
            "l_partkey",
            F.to_date("o_orderdate").alias("noted"),
            F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("ended"),
        )


class CohortRecord(Retail):
    """The same relations out of tables that hold the cohort's customers only.

    For many features at once: orders and lines are restricted and joined one time and
    staged, so that no feature shuffles the whole line table again. Repeated order, line or
    part rows count as often as in the whole tables.
    """

    def __init__(self, whole: Retail):
        super().__init__(whole.spark, whole.folder, **whole.tables)
        # The cohort comes from all orders: rows without a customer belong to it.
        self.whole, self.stage, self.cohort, self.copies = whole, whole.stage, whole.cohort, whole.copies

    @cached_property
    def orders(self) -> DataFrame:
        columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
        return self.stage.keep(self.whole.cohort_orders().select(*columns), "cohort-orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        columns = ["l_orderkey", "l_partkey", "l_quantity", "l_linestatus", "l_shipdate"]
        ids = self.orders.select(F.col("o_orderkey").alias("l_orderkey"))
        lines = reduce_by_ids(self.whole.lineitem.select(*columns), "l_orderkey", ids)
        return self.stage.keep(lines.join(ids, "l_orderkey", "left_semi"), "cohort-lines")

    def cohort_orders(self) -> DataFrame:
        return self.orders

    @cached_property
    def ordered(self) -> DataFrame:
        columns = ["o_custkey", "o_orderdate", "l_partkey", "l_linestatus", "l_shipdate"]
        return self.stage.keep(super().ordered.select(*columns), "ordered")

    @cached_property
    def bought(self) -> DataFrame:
        columns = ["o_custkey", "o_orderdate", "l_shipdate", "p_name", "p_brand"]
        return self.stage.keep(super().bought.select(*columns), "bought")


# All lines and parts of the cohort's customers, in SQL.
BOUGHT_SQL = f"""
{COHORT_SQL},
bought AS (
  SELECT * FROM orders
  JOIN lineitem ON o_orderkey = l_orderkey
  JOIN part ON l_partkey = p_partkey
  WHERE o_custkey IN (SELECT o_custkey FROM cohort)
)"""

CONDITIONS_SQL = """
conditions AS (
  SELECT o_custkey, l_partkey, CAST(o_orderdate AS DATE) AS noted,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS ended
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""
