"""Code flags, value sets, episodes, diagnosis roll-up, categories and result chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlens.codes.codebook import category_map, category_weights, code_table
from wardlens.functions.text import contains_any
from wardlens.functions.times import compact_minute, on_days
from wardlens.operators import comorbid, flags
from wardlens.operators.lookback import prior_events
from workload.registry import query
from workload.retail import AS_OF, BOUGHT_SQL, COHORT_SQL, CONDITIONS_SQL, Retail

# Overlapping on Brand#5: the earlier category wins.
BRAND_CATEGORIES = (
    ("a", 7, ("Brand#1", "Brand#5")),
    ("b", -2, ("Brand#5", "Brand#7")),
    ("c", 4, tuple(f"Brand#{n}" for n in range(19, 26))),
)

ACTIVE_SQL = """
  JOIN conditions ON conditions.o_custkey = cohort.o_custkey
  WHERE noted <= o_orderdate - INTERVAL 2 DAY
    AND (ended >= o_orderdate - INTERVAL 367 DAY OR ended IS NULL)
"""


def active(r: Retail, name: str, coded):
    return flags.active_flags(
        r.conditions,
        flags.stack_flags({name: coded.select(F.col("p_partkey").alias("l_partkey"))}, "l_partkey"),
        r.anchors,
        key="o_custkey",
        code_id="l_partkey",
        noted="noted",
        ended="ended",
        flags=[name],
    )


@query(
    "q08_code_or_range_flag",
    f"""
    WITH {COHORT_SQL}, {CONDITIONS_SQL}
    SELECT DISTINCT cohort.o_custkey, 'YES' AS flag FROM cohort {ACTIVE_SQL}
    AND l_partkey IN (
      SELECT p_partkey FROM part
      WHERE p_brand IN ('Brand#3', 'Brand#9') OR p_brand BETWEEN 'Brand#10' AND 'Brand#14')
    """,
)
def listed_or_ranged(r):
    coded = r.part.where(
        flags.code_in(F.col("p_brand"), ["Brand#3", "Brand#9"], [("Brand#10", "Brand#14")])
    )
    return active(r, "listed", coded).select("o_custkey", F.lit("YES").alias("flag"))


@query(
    "q09_valueset_flag",
    f"""
    WITH {COHORT_SQL}, {CONDITIONS_SQL}
    SELECT DISTINCT cohort.o_custkey, 1 AS in_set FROM cohort {ACTIVE_SQL}
    AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_type = 'PROMO')
    """,
)
def in_value_set(r):
    value_set = r.part.where(F.col("p_type") == "PROMO").select("p_partkey")
    coded = r.part.join(value_set, "p_partkey", "left_semi")
    return active(r, "in_set", coded)


@query(
    "q38_timed_conditions",
    f"""
    WITH {COHORT_SQL}, admitted AS (
      SELECT o_custkey, o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS at FROM cohort
    ), timed AS (
      SELECT o_custkey, l_partkey, o_orderdate + to_hours((l_partkey % 24)::INTEGER) AS noted,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_hours((l_suppkey % 24)::INTEGER) END AS ended
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    )
    SELECT a.o_custkey, max(CASE WHEN p_type = 'PROMO' THEN 1 END) AS promo,
      max(CASE WHEN p_brand BETWEEN 'Brand#10' AND 'Brand#14' THEN 1 END) AS branded
    FROM admitted a JOIN timed t ON t.o_custkey = a.o_custkey
    JOIN part ON p_partkey = l_partkey
      AND (p_type = 'PROMO' OR p_brand BETWEEN 'Brand#10' AND 'Brand#14')
    WHERE noted <= a.at - INTERVAL 2 DAY
      AND (ended IS NULL OR ended >= a.at - INTERVAL 367 DAY)
    GROUP BY a.o_custkey
    """,
)
def timed_conditions(r):
    """Conditions and admissions with times of day, compared as instants."""

    def later(moment: str, by: str):
        return F.col(moment).cast("timestamp_ntz") + F.expr(f"make_dt_interval(0, cast({by} % 24 AS int))")

    orders = r.cohort_orders().select("o_custkey", "o_orderkey", "o_orderdate")
    lines = r.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    conditions = lines.select(
        "o_custkey",
        "l_partkey",
        later("o_orderdate", "l_partkey").alias("noted"),
        F.when(F.col("l_linestatus") == "F", later("l_shipdate", "l_suppkey")).alias("ended"),
    )
    part = r.part.withColumnRenamed("p_partkey", "l_partkey")
    coded = flags.stack_flags(
        {
            "promo": part.where(F.col("p_type") == "PROMO"),
            "branded": part.where(flags.code_in(F.col("p_brand"), [], [("Brand#10", "Brand#14")])),
        },
        "l_partkey",
    )
    return flags.active_flags(
        conditions,
        coded,
        r.anchors,
        key="o_custkey",
        code_id="l_partkey",
        noted="noted",
        ended="ended",
        flags=["promo", "branded"],
        admissions=r.cohort.select("o_custkey", later("o_orderdate", "o_orderkey").alias("admitted")).distinct(),
    )


@query(
    "q10_composite_episode",
    f"""
    WITH {COHORT_SQL}
    SELECT DISTINCT o.o_custkey, l_suppkey
    FROM orders o
    JOIN lineitem ON l_orderkey = o.o_orderkey
    JOIN customer ON c_custkey = o.o_custkey
    JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey
    WHERE o.o_custkey IN (SELECT o_custkey FROM cohort)
      AND o.o_orderdate >= TIMESTAMP '1998-01-14' AND o.o_orderdate < TIMESTAMP '1999-01-15'
    """,
)
def home_suppliers(r):
    window = prior_events(r.cohort_orders(), ts="o_orderdate", as_of=AS_OF)
    episodes = (
        window.join(r.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_custkey", "l_suppkey")
        .distinct()
        .join(r.customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    suppliers = r.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("c_nationkey")
    )
    return flags.composite_episodes(
        episodes, suppliers, on=["l_suppkey", "c_nationkey"]
    ).select("o_custkey", "l_suppkey")


@query(
    "q20_code_case_flag",
    f"""
    WITH {COHORT_SQL}
    SELECT o_custkey, o_orderkey, l_linenumber, p_brand,
           CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'YES' ELSE 'NO' END AS flag
    FROM cohort
    JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey
    WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 367 DAY AND o_orderdate
    """,
)
def listed_or_not(r):
    ordered = r.cohort.join(r.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    recent = ordered.where(
        F.col("l_shipdate").between(
            F.col("o_orderdate") - F.expr("INTERVAL 367 DAYS"), F.col("o_orderdate")
        )
    ).join(r.part, F.col("l_partkey") == F.col("p_partkey"))
    codes = code_table(r.spark, ["Brand#1", "Brand#2", "Brand#3"], "p_brand")
    return flags.code_case_flag(
        recent.select("o_custkey", "o_orderkey", "l_linenumber", "p_brand"),
        codes,
        code="p_brand",
        name="flag",
    )


@query(
    "q21_rollup_parent",
    f"""
    WITH {BOUGHT_SQL}
    SELECT DISTINCT o_custkey, bought.p_partkey, bought.p_name, parent.p_brand AS parent_code
    FROM bought JOIN part parent ON parent.p_name = bought.p_name AND parent.p_size <= 5
    WHERE l_shipdate >= TIMESTAMP '1998-01-16'
    """,
)
def parents_by_name(r):
    seen = r.ordered.where(on_days(r.ordered, "l_shipdate", AS_OF, -365)).select(
        "o_custkey", F.col("l_partkey").alias("p_partkey")
    )
    parents = comorbid.parent_codes(
        r.part,
        r.part.where(F.col("p_size") <= 5).withColumnRenamed("p_partkey", "parent_key"),
        group="p_name",
        parent="p_partkey",
        code_id="parent_key",
        code="p_brand",
    )
    return comorbid.rollup_to_parent(
        seen, r.part.select("p_partkey", "p_name"), parents, code_id="p_partkey", group="p_name"
    ).select("o_custkey", "p_partkey", "p_name", "parent_code")


CATEGORY_SQL = """
  CASE WHEN p_brand IN ('Brand#1', 'Brand#5') THEN 'a'
       WHEN p_brand IN ('Brand#5', 'Brand#7') THEN 'b'
       WHEN CAST(substr(p_brand, 7) AS INTEGER) > 18 THEN 'c' END
"""


def categorized(r: Retail):
    categories = comorbid.first_match(category_map(r.spark, BRAND_CATEGORIES))
    return comorbid.categorize(r.bought.select("o_custkey", "p_brand"), categories, "p_brand")


@query(
    "q22_first_match",
    f"""
    WITH {BOUGHT_SQL}
    SELECT o_custkey, {CATEGORY_SQL} AS category, CAST(count(*) AS BIGINT) AS lines
    FROM bought GROUP BY ALL
    """,
)
def first_category(r):
    rows = categorized(r)
    return rows.groupBy("o_custkey", "category").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "q23_category_weight",
    f"""
    WITH {BOUGHT_SQL}, once AS (SELECT DISTINCT o_custkey, {CATEGORY_SQL} AS category FROM bought)
    SELECT o_custkey, category,
           CAST(CASE category WHEN 'a' THEN 7 WHEN 'b' THEN -2 WHEN 'c' THEN 4 ELSE 0 END
                AS INTEGER) AS weight
    FROM once
    """,
)
def weighed_categories(r):
    once = categorized(r).select("o_custkey", "category").distinct()
    return comorbid.weigh(once, category_weights(r.spark, BRAND_CATEGORIES))


@query(
    "q24_weighted_index",
    f"""
    WITH {BOUGHT_SQL}, once AS (SELECT DISTINCT o_custkey, {CATEGORY_SQL} AS category FROM bought)
    SELECT o_custkey, CAST(sum(CASE category WHEN 'a' THEN 7 WHEN 'b' THEN -2 WHEN 'c' THEN 4
                                    ELSE 0 END) AS BIGINT) AS weighted_index
    FROM once GROUP BY o_custkey
    """,
)
def weighted(r):
    return comorbid.weighted_index(weighed_categories(r), "o_custkey", "weighted_index")


@query(
    "q25_result_chain",
    f"""
    WITH {COHORT_SQL}
    SELECT DISTINCT o_custkey AS patient_id, o_orderkey AS order_id,
           strftime(o_orderdate, '%Y%m%d %H:%M') AS collected_at, o_orderkey AS result_id,
           p_partkey AS organism_id, p_type AS record_type, p_name AS organism
    FROM orders
    JOIN lineitem grown ON grown.l_orderkey = o_orderkey
    JOIN part ON p_partkey = grown.l_partkey
    JOIN lineitem line ON line.l_orderkey = o_orderkey
                      AND line.l_linenumber = grown.l_linenumber
    JOIN lineitem val ON val.l_orderkey = o_orderkey AND val.l_suppkey = line.l_suppkey
                     AND val.l_linenumber <> 1
    WHERE o_custkey IN (SELECT o_custkey FROM cohort)
      AND val.l_returnflag = 'R' AND lower(p_name) LIKE '%gear%' AND p_type <> 'SMALL'
    """,
)
def result_chain(r):
    lines = r.lineitem
    orders = r.cohort_orders()
    hits = flags.positive_cultures(
        orders.select(F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("order_id")),
        r.orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("taken_at")
        ),
        r.orders.select(
            F.col("o_orderkey").alias("result_id"), F.col("o_orderkey").alias("order_id")
        ),
        lines.select(
            F.col("l_orderkey").alias("result_id"),
            F.col("l_suppkey").alias("component_id"),
            F.col("l_linenumber").alias("line"),
        ),
        lines.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") != 1)).select(
            F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("component_id")
        ),
        lines.select(
            F.col("l_orderkey").alias("result_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("organism_id"),
        ),
        r.part.where(contains_any(F.col("p_name"), ["GEAR"]) & (F.col("p_type") != "SMALL")).select(
            F.col("p_partkey").alias("organism_id"),
            F.col("p_type").alias("record_type"),
            F.col("p_name").alias("organism"),
        ),
    )
    return hits.select(
        "patient_id",
        "order_id",
        compact_minute(F.col("taken_at")).alias("collected_at"),
        "result_id",
        "organism_id",
        "record_type",
        "organism",
    )


@query(
    "q26_registry_flag",
    """
    SELECT DISTINCT o_custkey, 1 AS registered FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' AND o_orderstatus <> 'F'
    """,
)
def registered(r):
    return flags.registry_keys(
        r.orders,
        key="o_custkey",
        kind="o_orderpriority",
        kind_is="1-URGENT",
        status="o_orderstatus",
        status_not=["P", "F"],
    ).withColumn("registered", F.lit(1))


@query(
    "q32_code_flag",
    f"""
    WITH {BOUGHT_SQL}
    SELECT DISTINCT o_custkey, 'YES' AS present, 1 AS present_num
    FROM bought JOIN part parent ON parent.p_name = bought.p_name AND parent.p_size <= 5
    WHERE parent.p_brand IN ('Brand#10', 'Brand#11', 'Brand#12')
      AND l_shipdate >= TIMESTAMP '1998-01-16'
    """,
)
def coded_parent(r):
    parents = parents_by_name(r)
    return (
        parents.where(flags.code_in(F.col("parent_code"), ["Brand#10", "Brand#11", "Brand#12"]))
        .select("o_custkey")
        .distinct()
        .select("o_custkey", F.lit("YES").alias("present"), F.lit(1).alias("present_num"))
    )
