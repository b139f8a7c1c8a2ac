"""Catalog matching, administrations and days of therapy."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wardlens.functions.text import contains_any, first_token, starts_with_any
from wardlens.functions.times import on_days
from wardlens.operators import exposure, sliding
from workload.registry import query
from workload.retail import AS_OF, BOUGHT_SQL, COHORT_SQL


@query(
    "q11_terms",
    """
    SELECT DISTINCT 'trimmed' AS kind, upper(split_part(ltrim(p_name), ' ', 1)) AS term
    FROM part WHERE p_type = 'PROMO'
    UNION ALL
    SELECT DISTINCT 'as is', upper(split_part(p_name, ' ', 1)) FROM part WHERE p_type = 'PROMO'
    """,
)
def terms(r):
    part = r.part
    promo = F.col("p_type") == "PROMO"
    trimmed = exposure.catalog_terms(part, first_token(F.col("p_name")), promo)
    as_is = exposure.catalog_terms(part, first_token(F.col("p_name"), trim=False), promo)
    return trimmed.select(F.lit("trimmed").alias("kind"), "term").union(
        as_is.select(F.lit("as is"), "term")
    )


@query(
    "q12_semi_first_token",
    """
    SELECT p_partkey, p_name FROM part WHERE upper(split_part(ltrim(p_name), ' ', 1)) IN (
      SELECT upper(split_part(p_name, ' ', 1)) FROM part WHERE p_type = 'PROMO' AND p_size < 3)
    """,
)
def named_alike(r):
    part = r.part
    words = exposure.catalog_terms(
        part,
        first_token(F.col("p_name"), trim=False),
        (F.col("p_type") == "PROMO") & (F.col("p_size") < 3),
    )
    return exposure.match_first_token(part, words, "p_name").select("p_partkey", "p_name")


@query(
    "q13_union_catalog",
    """
    SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO'
    UNION
    SELECT p_partkey, p_name FROM part WHERE p_size < 10
    """,
)
def union_catalog(r):
    part = r.part
    columns = ["p_partkey", "p_name"]
    return exposure.union_distinct(
        part.where(F.col("p_type") == "PROMO").select(*columns),
        part.where(F.col("p_size") < 10).select(*columns),
    )


@query(
    "q14_like_any",
    """
    SELECT p_partkey, p_name FROM part
    WHERE lower(p_name) LIKE '%gear%' OR lower(p_name) LIKE '%anvil%' OR lower(p_name) LIKE '%old%'
    """,
)
def like_any(r):
    part = r.part
    return exposure.named_like(part, "p_name", ["Gear", "ANVIL", "old"]).select(
        "p_partkey", "p_name"
    )


@query(
    "q15_not_like_all",
    """
    SELECT p_partkey, p_name, p_size FROM part
    WHERE p_name NOT LIKE 'old%' AND p_name NOT LIKE 'red%' AND p_size NOT IN (2, 3, 4)
    """,
)
def not_like_all(r):
    part = r.part
    return part.where(
        ~starts_with_any(F.col("p_name"), ["OLD", "RED"]) & ~F.col("p_size").isin(2, 3, 4)
    ).select("p_partkey", "p_name", "p_size")


@query(
    "q16_in_or_exists",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') OR l_returnflag = 'R'
    """,
)
def in_or_exists(r):
    promo = r.part.where(F.col("p_type") == "PROMO").select("p_partkey")
    return exposure.in_or(
        r.lineitem, "l_partkey", promo, "p_partkey", F.col("l_returnflag") == "R"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query(
    "q17_days_of_therapy",
    f"""
    WITH {BOUGHT_SQL}
    SELECT o_custkey, CAST(count(DISTINCT concat(strftime(l_shipdate, '%m/%d/%y'),
             upper(split_part(ltrim(p_name), ' ', 1)))) AS BIGINT) AS therapy_days
    FROM bought
    WHERE o_orderdate >= TIMESTAMP '1998-01-14' AND o_orderdate < TIMESTAMP '1999-01-16'
    GROUP BY o_custkey
    """,
)
def therapy_days(r):
    bought = r.bought
    rows = bought.where(on_days(bought, "o_orderdate", AS_OF, -367, -1)).select(
        "o_custkey",
        F.to_date("l_shipdate").alias("day"),
        first_token(F.col("p_name")).alias("drug"),
        F.lit(True).alias("given"),
    )
    return exposure.days_of_therapy(
        rows, key="o_custkey", day="day", drug="drug", flags={"given": "therapy_days"}
    )


@query(
    "q18_current_exposure",
    f"""
    WITH {COHORT_SQL}
    SELECT DISTINCT l_orderkey, CAST(l_shipdate AS DATE) AS day
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM cohort)
    """,
)
def current_exposure(r):
    rows = r.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("day"))
    cohort = r.cohort.select(F.col("o_orderkey").alias("l_orderkey"))
    return exposure.current_stay_days(rows, cohort, encounter="l_orderkey", day="day")


@query(
    "q19_class_or_pattern_days",
    f"""
    WITH {BOUGHT_SQL}
    SELECT o_custkey, CAST(count(DISTINCT concat(strftime(l_shipdate, '%m/%d/%y'),
             upper(split_part(ltrim(p_name), ' ', 1)))) AS BIGINT) AS therapy_days
    FROM bought
    WHERE (p_brand IN ('Brand#3', 'Brand#9') OR p_name LIKE '%gear%' OR p_name LIKE '%rod%')
      AND l_shipdate >= o_orderdate - INTERVAL 367 DAY AND l_shipdate < TIMESTAMP '1999-01-16'
    GROUP BY o_custkey
    """,
)
def class_or_pattern_days(r):
    bought = r.bought
    chosen = F.col("p_brand").isin("Brand#3", "Brand#9") | contains_any(
        F.col("p_name"), ["gear", "rod"]
    )
    recent = F.col("l_shipdate") >= F.col("o_orderdate") - F.expr("INTERVAL 367 DAYS")
    rows = bought.where(chosen & recent & on_days(bought, "l_shipdate", AS_OF, None, -1)).select(
        "o_custkey",
        F.to_date("l_shipdate").alias("day"),
        first_token(F.col("p_name")).alias("drug"),
        F.lit(True).alias("given"),
    )
    return exposure.days_of_therapy(
        rows, key="o_custkey", day="day", drug="drug", flags={"given": "therapy_days"}
    )


#: Days the sliding queries go on by, one at a time, after their first state.
STEPS = 3


def bought_days(r):
    """Lines of the cohort's customers with the days of their orders."""
    return r.bought.select(
        "o_custkey",
        F.to_date("o_orderdate").alias("ordered"),
        F.to_date("l_shipdate").alias("day"),
        first_token(F.col("p_name")).alias("drug"),
        F.lit(True).alias("given"),
    )


def therapy_by_day(r, path, rows, last_day, steps=STEPS, ordered="ordered", reach=366):
    """The state of ``last_day``, gone on from day to day; windows reach back ``reach`` days."""
    names = {"key": "o_custkey", "drug": "drug", "ordered": ordered, "flags": ["given"]}

    for day in (last_day - timedelta(days=back) for back in range(steps, -1, -1)):
        first = None if reach is None else day - timedelta(days=reach)

        def step(before, since, day=day, first=first):
            entered = first if since is None else since + timedelta(days=1)
            new = rows.where(sliding.within(ordered, entered, day))
            new = sliding.therapy_state(new, day="day", **names)
            if before is None:
                return new
            kept = before.where(sliding.within(ordered, first, None))
            return sliding.merge_therapy([kept, new], **names)

        state = sliding.roll(r.spark, path, day, step)
    return state


@query(
    "q38_therapy_by_day",
    f"""
    WITH {BOUGHT_SQL}
    SELECT o_custkey, CAST(count(DISTINCT concat(strftime(l_shipdate, '%m/%d/%y'),
             upper(split_part(ltrim(p_name), ' ', 1)))) AS BIGINT) AS therapy_days
    FROM bought
    WHERE o_orderdate >= TIMESTAMP '1998-01-14' AND o_orderdate < TIMESTAMP '1999-01-16'
    GROUP BY o_custkey
    """,
)
def therapy_from_state(r):
    """As q17, from bitmaps that go on from day to day."""
    last_day = AS_OF.date() - timedelta(days=1)
    state = therapy_by_day(r, f"{r.stage.folder}/therapy", bought_days(r), last_day)
    return sliding.therapy_counts(
        state, key="o_custkey", drug="drug", ordered="ordered", flags={"given": "therapy_days"}
    )
