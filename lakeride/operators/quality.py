"""Data-quality checks and the gate in front of the gold write.

A check passes only if every value of its first row is truthy; a NULL or a
missing row fails it. So an empty day fails validity (ratio NULL) but passes
the null check (0 = 0). Freshness has no upper bound: future rows are fresh.

Each check is one aggregate; :func:`dq_checks` fuses the three into a single
scan with conditional counts. Only the three result rows reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import date_of, ts_lit

CRITICAL_COLUMNS = ("trip_id", "route_name", "base_fare")
# Check names (the scheduler's task ids) and their thresholds.
FRESHNESS = "dq_check_freshness"
VALIDITY = "dq_check_invalid_ratio"
NULLS = "dq_check_null_critical_fields"
FRESHNESS_HOURS = 2
MAX_INVALID_RATIO = 0.1


def fresh_bound(as_of, hours: int):
    return ts_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def dq_freshness(silver: DataFrame, as_of=None, hours: int = FRESHNESS_HOURS) -> DataFrame:
    bound = fresh_bound(as_of, hours)
    # implied partition filter: event_date is the date of created_at (both
    # NULL together), so this prunes partitions without changing the result
    rows = silver.filter((F.col("event_date") >= F.to_date(bound)) & (F.col("created_at") >= bound))
    return rows.agg((F.count(F.lit(1)) > 0).alias("passed"),
                    F.count(F.lit(1)).cast("double").alias("observed"))


def _invalid_ratio(today_cond):
    invalid = F.count_if(today_cond & (F.col("is_valid") == F.lit(False))).cast("double")
    total = F.count_if(today_cond)
    return invalid / F.nullif(total, F.lit(0))


def dq_validity(silver: DataFrame, as_of=None, max_ratio: float = MAX_INVALID_RATIO) -> DataFrame:
    rows = silver.filter(F.col("event_date") >= date_of(as_of))
    ratio = _invalid_ratio(F.lit(True))
    return rows.agg((ratio < F.lit(max_ratio)).alias("passed"), ratio.alias("observed"))


def any_null(cols):
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def dq_nulls(silver: DataFrame, as_of=None, cols=CRITICAL_COLUMNS) -> DataFrame:
    rows = silver.filter(any_null(cols) & (F.col("event_date") >= date_of(as_of)))
    return rows.agg((F.count(F.lit(1)) == 0).alias("passed"),
                    F.count(F.lit(1)).cast("double").alias("observed"))


def dq_checks(silver: DataFrame, as_of=None, hours: int = FRESHNESS_HOURS,
              max_ratio: float = MAX_INVALID_RATIO, cols=CRITICAL_COLUMNS) -> DataFrame:
    """All three checks in one scan -> rows (check, passed, observed, as_of)."""
    bound = fresh_bound(as_of, hours)
    today = date_of(as_of)
    rows = silver.filter(F.col("event_date") >= F.least(F.to_date(bound), today))
    is_today = F.col("event_date") >= today
    fresh_n = F.count_if(F.col("created_at") >= bound)
    ratio = _invalid_ratio(is_today)
    null_n = F.count_if(is_today & any_null(cols))
    one = rows.agg(fresh_n.alias("fresh_n"), ratio.alias("ratio"), null_n.alias("null_n"))
    return verdicts(one, as_of, max_ratio)


def verdicts(counts: DataFrame, as_of=None, max_ratio: float = MAX_INVALID_RATIO) -> DataFrame:
    """The three check rows from one row (fresh_n, ratio, null_n)."""
    checks = F.array(
        F.struct(F.lit(FRESHNESS).alias("check"), (F.col("fresh_n") > 0).alias("passed"),
                 F.col("fresh_n").cast("double").alias("observed")),
        F.struct(F.lit(VALIDITY).alias("check"), (F.col("ratio") < F.lit(max_ratio)).alias("passed"),
                 F.col("ratio").alias("observed")),
        F.struct(F.lit(NULLS).alias("check"), (F.col("null_n") == 0).alias("passed"),
                 F.col("null_n").cast("double").alias("observed")),
    )
    return (counts.select(F.inline(checks))
            .select("check", F.coalesce("passed", F.lit(False)).alias("passed"), "observed",
                    ts_lit(as_of).alias("as_of")))


def check_passes(check_result: DataFrame) -> bool:
    """SQL-check semantics: first row exists and all its values are truthy."""
    rows = check_result.take(1)
    return bool(rows) and all(bool(v) for v in rows[0])


@dataclass
class GateOutcome:
    passed: bool
    results: DataFrame
    written: bool


def dq_gate(silver: DataFrame, as_of=None, **kw) -> tuple[bool, DataFrame]:
    """Evaluate the fused checks once; the result frame holds the three rows themselves, nothing stays cached."""
    checks = dq_checks(silver, as_of, **kw)
    rows = checks.collect()  # exactly three rows
    results = silver.sparkSession.createDataFrame(rows, checks.schema)
    return (len(rows) == 3 and all(r.passed for r in rows)), results


def gated_gold(silver: DataFrame, gold_path: str, as_of=None, now=None, mode: str = "replace",
               results_path: str | None = None) -> GateOutcome:
    """Gate -> rollup -> write; no write at all unless every check passes."""
    from .gold import covered_dates, hourly_gold, write_gold

    passed, results = dq_gate(silver, as_of)
    if results_path:
        results.write.mode("append").parquet(results_path)
    if not passed:
        return GateOutcome(False, results, False)
    write_gold(hourly_gold(silver, as_of, now), gold_path, mode, covered_dates(as_of))
    return GateOutcome(True, results, True)


INSERT_TASK = "insert_gold_trips_hourly"


def task_states(results: DataFrame, dag_id: str = "gold_aggregation", insert_task: str = INSERT_TASK,
                insert_failed: bool = False) -> DataFrame:
    """Run states of one gate run: each check is ``success`` or ``failed``;
    the insert task is ``upstream_failed`` when any check failed (it never
    runs, so it is not counted as failed), otherwise ``success`` or
    ``failed`` as reported by ``insert_failed``. These are the states the
    task-finish counter is labelled with."""
    checks = results.select(F.lit(dag_id).alias("dag_id"), F.col("check").alias("task_id"),
                            F.when(F.col("passed"), "success").otherwise("failed").alias("state"))
    any_failed = F.max(F.when(F.col("passed"), 0).otherwise(1))
    insert = results.agg(any_failed.alias("_f")).select(
        F.lit(dag_id).alias("dag_id"), F.lit(insert_task).alias("task_id"),
        F.when(F.col("_f") == 1, "upstream_failed")
         .otherwise("failed" if insert_failed else "success").alias("state"))
    return checks.unionByName(insert)
