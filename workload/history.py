"""Cohort, demographics, lookups and prior stays."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from wardlens.functions.times import compact_day
from wardlens.operators import lookback, sliding
from wardlens.operators.cohort import Lookup, demographics, enrich, keep_cohort_keys, select_cohort
from workload.registry import query
from workload.retail import AS_OF, COHORT_DAYS, COHORT_SQL, PRIOR_DAYS, PRIOR_SQL


def birth_date():
    return F.date_add(F.lit(date(1940, 1, 1)), F.floor("c_acctbal").cast("int"))


@query(
    "q01_cohort",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-12-17' AND o_orderdate < TIMESTAMP '1999-01-16'
      AND o_orderkey IS NOT NULL AND o_orderstatus = 'F'
    """,
)
def cohort(r):
    return select_cohort(
        r.orders,
        as_of=AS_OF,
        encounter="o_orderkey",
        admitted="o_orderdate",
        first_day=COHORT_DAYS[0],
        last_day=COHORT_DAYS[1],
        where=F.col("o_orderstatus") == "F",
    ).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query(
    "q02_demographics",
    f"""
    WITH {COHORT_SQL}
    SELECT o_orderkey, c_custkey, c_name, n_name AS label,
           CAST(floor(date_diff('day', DATE '1940-01-01' + CAST(floor(c_acctbal) AS INTEGER),
                                DATE '1999-01-16') / 365.25) AS INTEGER) AS age
    FROM cohort JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    """,
)
def customer_ages(r):
    people = demographics(
        r.customer.withColumn("birth", birth_date()),
        birth="birth",
        as_of=AS_OF,
        lookups=[Lookup("c_nationkey", r.nation, "n_nationkey", {"n_name": "label"})],
    )
    return people.join(r.cohort, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "c_custkey", "c_name", "label", "age"
    )


@query(
    "q03_enrich_star",
    f"""
    WITH {COHORT_SQL}
    SELECT o_orderkey, c_name, c_mktsegment, n_name, r_name,
           strftime(o_orderdate, '%Y%m%d') AS admit_day
    FROM cohort
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def order_star(r):
    rows = enrich(
        r.cohort,
        [
            Lookup(
                "o_custkey",
                r.customer,
                "c_custkey",
                {"c_name": "c_name", "c_mktsegment": "c_mktsegment", "c_nationkey": "nation_id"},
            ),
            Lookup(
                "nation_id",
                r.nation,
                "n_nationkey",
                {"n_name": "n_name", "n_regionkey": "region_id"},
            ),
            Lookup("region_id", r.region, "r_regionkey", {"r_name": "r_name"}),
        ],
    )
    return rows.select(
        "o_orderkey",
        "c_name",
        "c_mktsegment",
        "n_name",
        "r_name",
        compact_day(F.col("o_orderdate")).alias("admit_day"),
    )


@query(
    "q04_within_24h",
    """
    WITH joined AS (
      SELECT user_id, min(ts) AS joined_at FROM events
      WHERE event_type = 'signup' GROUP BY user_id
    )
    SELECT user_id, joined_at, event_id, ts AS failed_at
    FROM joined JOIN events USING (user_id)
    WHERE event_type = 'error' AND ts >= joined_at AND ts <= joined_at + INTERVAL 24 HOUR
    """,
)
def errors_after_signup(r):
    events = r.events
    first = events.where(F.col("event_type") == "signup").groupBy("user_id")
    signups = r.stage.keep(first.agg(F.min("ts").alias("joined_at")), "signups")
    errors = events.where(F.col("event_type") == "error").select(
        "user_id", "event_id", F.col("ts").alias("failed_at")
    )
    return lookback.within_hours(
        signups, errors, on="user_id", anchor="joined_at", start="failed_at", hours=24
    ).select("user_id", "joined_at", "event_id", "failed_at")


@query(
    "q05_prior_count",
    f"""
    WITH {COHORT_SQL}, {PRIOR_SQL}
    SELECT cohort.o_custkey, CAST(count(prior.o_orderkey) AS BIGINT) AS prior_orders
    FROM cohort JOIN prior ON cohort.o_custkey = prior.o_custkey
    GROUP BY cohort.o_custkey
    """,
)
def prior_orders(r):
    counts = lookback.count_per_key(r.prior, "o_custkey", "o_orderkey", "prior_orders")
    counts = keep_cohort_keys(counts, r.copies, "o_custkey")
    return lookback.times_copies(counts, r.copies, "o_custkey", ["prior_orders"])


@query(
    "q06_episode_days",
    f"""
    WITH {COHORT_SQL}, {PRIOR_SQL},
    again AS (
      SELECT cohort.o_custkey, prior.o_orderkey
      FROM cohort JOIN prior ON cohort.o_custkey = prior.o_custkey
    )
    SELECT cohort.o_custkey, CAST(sum(abs(date_diff('day',
             CAST(l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS DATE),
             CAST(l_shipdate AS DATE)))) AS BIGINT) AS episode_days
    FROM cohort
    JOIN again ON again.o_custkey = cohort.o_custkey
    JOIN lineitem ON l_orderkey = again.o_orderkey
    WHERE CAST(l_shipdate AS DATE) >= CAST(cohort.o_orderdate - INTERVAL 367 DAY AS DATE)
    GROUP BY cohort.o_custkey
    """,
)
def shipping_days(r):
    ends = F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate"))
    return lookback.episode_days(
        r.prior,
        r.lineitem.select(
            F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", ends.alias("ended_at")
        ),
        r.anchors,
        key="o_custkey",
        item="o_orderkey",
        start="l_shipdate",
        end="ended_at",
        name="episode_days",
    )


@query(
    "q07_total_mean",
    f"""
    WITH {COHORT_SQL}, {PRIOR_SQL}
    SELECT cohort.o_custkey,
           coalesce(sum(l_quantity), 0) AS total_quantity,
           coalesce(sum(l_quantity) / count(DISTINCT prior.o_orderkey), 0) AS mean_quantity
    FROM cohort JOIN prior ON cohort.o_custkey = prior.o_custkey
    LEFT JOIN lineitem ON l_orderkey = prior.o_orderkey
    GROUP BY cohort.o_custkey
    """,
)
def quantities(r):
    return lookback.total_and_mean(
        r.prior,
        r.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"),
        key="o_custkey",
        item="o_orderkey",
        amount="l_quantity",
        total_name="total_quantity",
        mean_name="mean_quantity",
        copies=r.copies,
    )


#: Days the sliding queries go on by, one at a time, after their first state.
STEPS = 3


def totals_by_day(r, path, daily, last_day, keys, names, steps=STEPS):
    """Sums of the window that ends on ``last_day``, gone on from day to day.

    ``daily`` are the stored partial sums; a step reads the day that enters and the one that
    leaves.
    """
    span = timedelta(days=PRIOR_DAYS[1] - PRIOR_DAYS[0])
    one = timedelta(days=1)
    given = {"keys": keys, "names": names}

    for day in (last_day - one * back for back in range(steps, -1, -1)):

        def step(before, since, day=day):
            if before is None:
                return sliding.window_totals(daily, day="day", first=day - span, last=day, **given)
            entering = daily.where(sliding.within("day", since + one, day))
            leaving = daily.where(sliding.within("day", since - span, day - span - one))
            return sliding.slide_totals(before, entering, leaving, **given)

        window = sliding.roll(r.spark, path, day, step)
    return window


def prior_end():
    return AS_OF.date() + timedelta(days=PRIOR_DAYS[1])


@query(
    "q39_totals_by_day",
    f"""
    WITH {COHORT_SQL}, {PRIOR_SQL}, counted AS (
      SELECT o_custkey, count(*) AS copies FROM cohort GROUP BY o_custkey
    ), quantities AS (
      SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey
    )
    SELECT o_custkey, CAST(copies * count(o_orderkey) AS BIGINT) AS prior_orders,
           copies * coalesce(sum(quantity), 0) AS total_quantity,
           copies * coalesce(sum(quantity), 0) / count(o_orderkey) AS mean_quantity
    FROM counted JOIN prior USING (o_custkey) LEFT JOIN quantities ON l_orderkey = o_orderkey
    GROUP BY o_custkey, copies
    """,
)
def totals_from_state(r):
    """As q05 and q07, from sums that go on from day to day."""
    quantity = r.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    orders = r.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    daily = sliding.day_totals(
        orders.join(quantity, "o_orderkey", "left"),
        keys=["o_custkey"],
        day="day",
        counts=["o_orderkey"],
        sums=["quantity"],
    )
    daily = r.stage.keep(daily, "daily")
    window = totals_by_day(
        r, f"{r.stage.folder}/window", daily, prior_end(), ["o_custkey"], ["o_orderkey", "quantity"]
    )
    total = F.col("copies") * F.col("quantity").cast("double")
    return window.join(r.copies, "o_custkey").select(
        "o_custkey",
        (F.col("copies") * F.col("o_orderkey")).alias("prior_orders"),
        total.alias("total_quantity"),
        (total / F.col("o_orderkey")).alias("mean_quantity"),
    )


@query(
    "q40_episodes_by_day",
    f"""
    WITH {COHORT_SQL}, {PRIOR_SQL}
    SELECT cohort.o_custkey, CAST(sum(abs(date_diff('day',
             CAST(l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS DATE),
             CAST(l_shipdate AS DATE)))) AS BIGINT) AS episode_days
    FROM cohort
    JOIN prior ON prior.o_custkey = cohort.o_custkey
    JOIN lineitem ON l_orderkey = prior.o_orderkey
    WHERE CAST(l_shipdate AS DATE) >= CAST(cohort.o_orderdate - INTERVAL 367 DAY AS DATE)
    GROUP BY cohort.o_custkey
    """,
)
def episodes_from_state(r):
    """As q06, from episode days by starting day that go on from day to day."""
    orders = r.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    lines = r.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.to_date("l_shipdate").alias("start_date"),
        F.abs(F.col("l_quantity").cast("int")).alias("days"),
    )
    keys = ["o_custkey", "start_date"]
    daily = sliding.day_totals(orders.join(lines, "o_orderkey"), keys=keys, day="day", sums=["days"])
    daily = r.stage.keep(daily, "daily")
    window = totals_by_day(r, f"{r.stage.folder}/window", daily, prior_end(), keys, ["days"])
    reached = window.join(r.anchors, "o_custkey").where(
        F.col("start_date") >= F.date_sub("admit_date", 367)
    )
    days = F.sum(F.col("days").cast("bigint") * F.col("copies"))
    return reached.groupBy("o_custkey").agg(days.alias("episode_days"))
