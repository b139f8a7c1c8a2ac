"""Feature assembly, scores, model versions and the scalar rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wardlens.codes import models
from wardlens.functions import numeric, text, times
from wardlens.operators import assemble
from wardlens.operators.cohort import keep_cohort_keys
from wardlens.operators.score import score, score_versions
from workload import conditions, drugs, history
from workload.registry import ORACLES, query
from workload.retail import AS_OF, COHORT_SQL, CohortRecord

FEATURES_SQL = f"""
WITH {COHORT_SQL}
SELECT cohort.o_custkey, o_orderkey,
       CAST(floor(date_diff('day', DATE '1940-01-01' + CAST(floor(c_acctbal) AS INTEGER),
                            DATE '1999-01-16') / 365.25) AS INTEGER) AS patient_age_at_visit,
       coalesce(prior_orders, 0) AS prior_hosp,
       coalesce(total_quantity, 0) AS los_prev,
       coalesce(mean_quantity, 0) AS los_prev_mean,
       CASE WHEN episode_days > 0 THEN 'YES' ELSE 'NO' END AS icu_prev,
       CASE WHEN episode_days > 0 THEN 1 ELSE 0 END AS icu_prev_num,
       coalesce(flag, 'NO') AS imm_comp_prev,
       CASE WHEN in_set = 1 THEN 1 ELSE 0 END AS inf_prev_num,
       coalesce(dot.therapy_days, 0) AS prev_dot,
       CAST(CASE WHEN dot.therapy_days IS NULL THEN 0 ELSE ln(dot.therapy_days) END
            AS DECIMAL(10, 6)) AS prev_dot_log,
       coalesce(chosen.therapy_days, 0) AS prev_blactam,
       coalesce(present, 'NO') AS diabetes_present,
       CASE WHEN present_num = 1 THEN 1 ELSE 0 END AS diabetes_num,
       registered AS cre_prev,
       coalesce(weighted_index, 0) AS cci_score
FROM cohort
LEFT JOIN customer ON c_custkey = cohort.o_custkey
LEFT JOIN ({ORACLES["q05_prior_count"]}) stays USING (o_custkey)
LEFT JOIN ({ORACLES["q07_total_mean"]}) lengths USING (o_custkey)
LEFT JOIN ({ORACLES["q06_episode_days"]}) days USING (o_custkey)
LEFT JOIN ({ORACLES["q08_code_or_range_flag"]}) listed USING (o_custkey)
LEFT JOIN ({ORACLES["q09_valueset_flag"]}) sets USING (o_custkey)
LEFT JOIN ({ORACLES["q17_days_of_therapy"]}) dot USING (o_custkey)
LEFT JOIN ({ORACLES["q19_class_or_pattern_days"]}) chosen USING (o_custkey)
LEFT JOIN ({ORACLES["q32_code_flag"]}) coded USING (o_custkey)
LEFT JOIN ({ORACLES["q26_registry_flag"]}) registry USING (o_custkey)
LEFT JOIN ({ORACLES["q24_weighted_index"]}) idx USING (o_custkey)
"""


@query("q27_assemble", FEATURES_SQL)
def features(r):
    r = CohortRecord(r)
    copies = r.copies
    ages = r.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        times.age_years(history.birth_date(), AS_OF).alias("patient_age_at_visit"),
    )
    registered = conditions.registered(r)
    wide = assemble.stack_features(
        [
            ages.join(copies, "o_custkey", "left_semi"),
            history.prior_orders(r),
            history.quantities(r),
            history.shipping_days(r),
            conditions.listed_or_ranged(r),
            conditions.in_value_set(r),
            drugs.therapy_days(r),
            drugs.class_or_pattern_days(r).withColumnRenamed(
                "therapy_days", "chosen_days"
            ),
            conditions.coded_parent(r),
            registered.join(copies, "o_custkey", "left_semi"),
            conditions.weighted(r),
        ],
        "o_custkey",
    )
    rows = r.cohort.join(r.stage.keep(wide, "features"), "o_custkey", "left")
    episode = F.col("episode_days") > 0
    return rows.select(
        "o_custkey",
        "o_orderkey",
        "patient_age_at_visit",
        F.coalesce("prior_orders", F.lit(0)).alias("prior_hosp"),
        F.coalesce("total_quantity", F.lit(0)).alias("los_prev"),
        F.coalesce("mean_quantity", F.lit(0)).alias("los_prev_mean"),
        assemble.yes_no(episode).alias("icu_prev"),
        assemble.one_zero(episode).alias("icu_prev_num"),
        F.coalesce("flag", F.lit("NO")).alias("imm_comp_prev"),
        assemble.one_zero(F.col("in_set") == 1).alias("inf_prev_num"),
        F.coalesce("therapy_days", F.lit(0)).alias("prev_dot"),
        assemble.log_or_zero(F.col("therapy_days")).cast("decimal(10,6)").alias("prev_dot_log"),
        F.coalesce("chosen_days", F.lit(0)).alias("prev_blactam"),
        F.coalesce("present", F.lit("NO")).alias("diabetes_present"),
        assemble.one_zero(F.col("present_num") == 1).alias("diabetes_num"),
        F.col("registered").alias("cre_prev"),
        F.coalesce("weighted_index", F.lit(0)).alias("cci_score"),
    )


@query(
    "q28_group_collapse",
    f"""
    WITH {COHORT_SQL}
    SELECT o_custkey, o_orderkey,
           CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE 'NO' END AS returned
    FROM cohort LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_custkey, o_orderkey, CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE 'NO' END
    """,
)
def collapsed(r):
    cohort = r.cohort.select("o_custkey", "o_orderkey")
    returned = assemble.flag_values(
        r.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"),
        ["o_orderkey"],
        F.col("l_returnflag") == "R",
        "returned",
    )
    returned = keep_cohort_keys(returned, cohort, "o_orderkey")
    rows = cohort.join(returned, "o_orderkey", "left")
    return assemble.each_flag_value(rows, "returned", one_row=False).distinct()


def linear_sql(model) -> str:
    """The model as a SQL sum over whole (cut) or nearest (rounded) features."""
    parts = [f"CAST({model.intercept} AS DECIMAL(18, 4))"]
    for term in model.terms:
        rule = "round" if term.cast == "nearest" else "trunc"
        parts.append(
            f"CAST({term.coefficient} AS DECIMAL(18, 4)) * CAST({rule}({term.feature}) AS INTEGER)"
        )
    return f"CAST({' + '.join(parts)} AS DECIMAL(18, 4))"


PCT_SQL = """
CAST(round(100 * exp(CAST(score AS DOUBLE)) / (1 + exp(CAST(score AS DOUBLE))), 2)
     AS DECIMAL(10, 2)) AS score_pct
"""


@query(
    "q29_logistic",
    f"""
    SELECT o_custkey, o_orderkey, score, {PCT_SQL}
    FROM (SELECT *, {linear_sql(models.CURRENT)} AS score FROM ({FEATURES_SQL}))
    """,
)
def scored(r):
    rows = score(
        features(r), models.CURRENT, score_name="score", pct_name="score_pct"
    )
    return rows.select(
        "o_custkey", "o_orderkey", "score", F.col("score_pct").cast("decimal(10,2)").alias("score_pct")
    )


@query(
    "q30_model_versions",
    f"""
    WITH features AS MATERIALIZED ({FEATURES_SQL}),
    versions AS (
      {" UNION ALL ".join(
          f"SELECT o_custkey, o_orderkey, '{m.version}' AS model_version, {linear_sql(m)} AS score "
          "FROM features" for m in models.ALL)}
    )
    SELECT o_custkey, o_orderkey, model_version, score, {PCT_SQL} FROM versions
    """,
)
def versions(r):
    rows = score_versions(
        features(r), models.ALL, score_name="score", pct_name="score_pct"
    )
    return rows.select(
        "o_custkey",
        "o_orderkey",
        "model_version",
        "score",
        F.col("score_pct").cast("decimal(10,2)").alias("score_pct"),
    )


SCALAR_DAY = datetime(2024, 2, 1)


@query(
    "q31_scalars",
    """
    SELECT event_id,
           strftime(ts, '%Y%m%d') AS day_text,
           strftime(ts, '%m/%d/%y') AS short_day_text,
           strftime(ts, '%Y%m%d %H:%M') AS minute_text,
           ts - INTERVAL 367 DAY AS year_before,
           ts + INTERVAL 24 HOUR AS day_later,
           CAST(date_diff('day', ts, ts + INTERVAL 3 HOUR) AS INTEGER) AS midnights,
           CAST(abs(date_diff('day', ts + INTERVAL 30 HOUR, ts)) AS INTEGER) AS days_apart,
           CAST(floor(date_diff('day', CAST(ts AS DATE) - CAST(user_id * 9 AS INTEGER),
                                DATE '2024-02-01') / 365.25) AS INTEGER) AS age,
           user_id // 7 AS whole_ratio,
           user_id / 7.0 AS exact_ratio,
           CAST(ln(user_id + 1) AS DECIMAL(18, 9)) AS log_user,
           CAST(round(100 * exp(value / 50 - 3) / (1 + exp(value / 50 - 3)), 2)
                AS DECIMAL(10, 2)) AS logistic,
           concat(event_type, NULL, strftime(ts, '%m/%d/%y')) AS joined_text,
           upper(split_part(ltrim('  ' || event_type || ' ' || props), ' ', 1)) AS first_word,
           upper(split_part(' ' || event_type, ' ', 1)) AS first_word_untrimmed,
           coalesce(CASE WHEN value > 50 THEN value END, 0) AS value_or_zero,
           CAST(trunc(-value) AS INTEGER) AS cut,
           CAST(round(-value) AS BIGINT) AS nearest,
           CASE WHEN lower(event_type) LIKE '%i%' AND event_type NOT LIKE 'view%' THEN 'YES'
                ELSE 'NO' END AS matched
    FROM events
    """,
)
def scalars(r):
    events = r.events
    ts, value, user, kind = (F.col(c) for c in ("ts", "value", "user_id", "event_type"))
    birth = F.date_sub(F.to_date(ts), (user * 9).cast("int"))
    padded = F.concat(F.lit("  "), kind, F.lit(" "), F.col("props"))
    return events.select(
        "event_id",
        times.compact_day(ts).alias("day_text"),
        times.short_day(ts).alias("short_day_text"),
        times.compact_minute(ts).alias("minute_text"),
        (ts - F.expr("INTERVAL 367 DAYS")).alias("year_before"),
        (ts + F.expr("INTERVAL 24 HOURS")).alias("day_later"),
        times.day_diff(ts, ts + F.expr("INTERVAL 3 HOURS")).alias("midnights"),
        F.abs(times.day_diff(ts + F.expr("INTERVAL 30 HOURS"), ts)).alias("days_apart"),
        times.age_years(birth, SCALAR_DAY).alias("age"),
        numeric.ratio(user, F.lit(7), integral=True).alias("whole_ratio"),
        numeric.ratio(user, F.lit(7.0), integral=False).alias("exact_ratio"),
        F.ln(user + 1).cast("decimal(18,9)").alias("log_user"),
        numeric.logistic_pct(value / 50 - 3).cast("decimal(10,2)").alias("logistic"),
        text.joined(kind, F.lit(None).cast("string"), times.short_day(ts)).alias("joined_text"),
        text.first_token(padded).alias("first_word"),
        text.first_token(F.concat(F.lit(" "), kind), trim=False).alias("first_word_untrimmed"),
        F.coalesce(F.when(value > 50, value), F.lit(0)).alias("value_or_zero"),
        numeric.whole(-value).alias("cut"),
        numeric.nearest(-value).cast("bigint").alias("nearest"),
        assemble.yes_no(
            text.contains_any(kind, ["I"]) & ~text.starts_with_any(kind, ["VIEW"])
        ).alias("matched"),
    )
