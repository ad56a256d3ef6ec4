"""Metric-series analytics over labelled samples ``(metric, labels, ts, value)``.

Evaluation happens on a step grid: eval instant ``t = m * step`` (epoch
aligned). A range ``[r]`` at ``t`` holds the samples with ``t - r < ts <= t``.

Scaling approach for range functions (increase, rate, last-in-lookback):
samples are first reduced per (series, bucket) with mergeable aggregates
(map-side combined, so a hot series does not sit in one task), buckets of
width ``gcd(range, step)``. From then on a series holds at most
span / bucket rows, however many samples it had, so the bucket rows are
processed per series with windows: each bucket emits exactly the eval
instants it is the latest bucket for (up to the next bucket or the end of
the range), and the first bucket inside each range is found with a
descending running ``last`` (an incremental frame). Every output row is
produced once; nothing is replicated range/step times.

Counter increase = reset-corrected difference between the last and the
first sample in the range (a drop is a reset: the new value counts from 0).
At least two samples are required; Prometheus' extrapolation to the range
edges is deliberately not applied, so values are the observed increase.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import from_micros, micros, seconds

SERIES = ("metric", "labels_key")
US = 1_000_000


# ---- series identity & selection ------------------------------------------

def labels_key(labels: Column) -> Column:
    """Canonical text of a label set: k="v" pairs sorted by key, comma-joined. Backslash, quote and
    line break in a value are escaped, so different label sets have different texts."""
    def escaped(v: Column) -> Column:
        v = F.replace(v, F.lit("\\"), F.lit("\\\\"))
        v = F.replace(v, F.lit('"'), F.lit('\\"'))
        return F.replace(v, F.lit("\n"), F.lit("\\n"))
    return F.array_join(F.transform(F.array_sort(F.map_entries(labels)),
                                    lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"'))),
                        ",")


def with_series(samples: DataFrame) -> DataFrame:
    if "labels_key" in samples.columns:
        return samples
    return samples.withColumn("labels_key", labels_key(F.col("labels")))


def label(name: str) -> Column:
    """Value of one label ('' when absent, as in label matching)."""
    return F.coalesce(F.col("labels")[name], F.lit(""))


def matcher(name: str, spec) -> Column:
    """``spec`` is a value (equality) or a pair (op, value) with op in
    = != =~ !~ ; regex matchers are fully anchored."""
    op, val = ("=", spec) if isinstance(spec, str) else spec
    v = label(name)
    if op == "=":
        return v == F.lit(val)
    if op == "!=":
        return v != F.lit(val)
    if op == "=~":
        return v.rlike(f"^(?:{val})$")
    if op == "!~":
        return ~v.rlike(f"^(?:{val})$")
    raise ValueError(f"unknown matcher {op!r}")


def select_series(samples: DataFrame, metric: str | None = None,
                  matchers: Mapping[str, object] | None = None) -> DataFrame:
    cond = F.lit(True) if metric is None else (F.col("metric") == F.lit(metric))
    for k, spec in (matchers or {}).items():
        cond = cond & matcher(k, spec)
    return samples.filter(cond)


# ---- step-grid helpers ------------------------------------------------------

def _grid(range_s: int, step_s: int) -> tuple[int, int, int]:
    g = math.gcd(range_s, step_s)
    return g, range_s // g, step_s // g


def _bucket(g: int) -> Column:
    gu = g * US
    # bucket b holds ((b-1)g, bg]; timestamps are after the epoch
    return F.expr(f"(unix_micros(cast(ts as timestamp)) + {gu - 1}) div {gu}")


def _owned_evals(pre: DataFrame, R: int, S: int, keys, chunk: int) -> DataFrame:
    """Adds ``_m`` (exploded): the eval indices bucket ``_b`` is the latest
    bucket for, i.e. m*S in [b, min(next bucket - 1, b + R - 1)].

    Time is cut into chunks of ``chunk`` buckets (at least one lookback), so
    no window spans a series' history. A chunk also gets the buckets of one
    lookback after it: only such a near one can end what a bucket owns."""
    C = max(R, chunk)
    own = F.expr(f"_b div {C}")
    d = pre.select("*", own.alias("_own"), F.explode(F.sequence(F.expr(f"(_b - {R - 1}) div {C}"), own)).alias("_c"))
    w = Window.partitionBy(*keys, "_c").orderBy("_b")
    d = d.select("*", F.lead("_b").over(w).alias("_nb")).where("_c = _own")
    last_pos = F.least(F.coalesce(F.col("_nb") - 1, F.col("_b") + (R - 1)), F.col("_b") + (R - 1))
    lo = F.expr(f"(_b + {S - 1}) div {S}")
    hi = F.floor(last_pos / F.lit(S)).cast("long")
    return (d.withColumn("_lo", lo).withColumn("_hi", hi)
            .filter(F.col("_lo") <= F.col("_hi"))
            .withColumn("_m", F.explode(F.sequence("_lo", "_hi")))
            .drop("_lo", "_hi", "_nb", "_c", "_own"))


def _eval_ts(step_s: int) -> Column:
    return from_micros(F.col("_m") * F.lit(step_s * US)).alias("eval_ts")


# ---- counters ----------------------------------------------------------------
# Aggregation buffers below are fixed-width (min/max/sum/count/max_by over
# numbers), so every aggregate stays a partial+final HashAggregate. Label
# values a consumer needs are carried as extra string grouping keys
# (``keep``), never as a map in an aggregation buffer. Samples of one series
# have distinct timestamps (a scrape store rejects duplicates).

def _keep_cols(df: DataFrame, keep) -> tuple[DataFrame, list[str]]:
    keep = [k for k in (keep or ()) if k]
    for k in keep:
        if k not in df.columns:
            df = df.withColumn(k, label(k))
    return df, keep


def bucket_deltas(samples: DataFrame, width_s: int, keep=()) -> DataFrame:
    """One row per (metric, labels_key, *keep, _b): the counter inside one bucket of time.

    _first / _last value, _t0 / _t1 their times, _inner the reset-corrected
    increase from the first to the last, _n the samples. Samples are ordered
    within (series, bucket) only.
    """
    d, keep = _keep_cols(with_series(samples), keep)
    keys = [*SERIES, *keep, "_b"]
    d = d.select(*SERIES, *keep, "ts", "value", F.coalesce(_bucket(width_s), F.lit(0)).cast("long").alias("_b"))
    w = Window.partitionBy(*keys).orderBy("ts", "value")
    prev = F.lag("value").over(w)
    rows = d.select("*", prev.isNull().alias("_is_first"), F.lead("value").over(w).isNull().alias("_is_last"),
                    F.when(prev.isNull(), F.lit(0.0)).otherwise(_step(prev, F.col("value"))).alias("_delta"))
    return rows.groupBy(*keys).agg(
        F.max(F.when(F.col("_is_first"), F.col("value"))).alias("_first"),
        F.max(F.when(F.col("_is_last"), F.col("value"))).alias("_last"),
        F.min(micros(F.col("ts"))).alias("_t0"), F.max(micros(F.col("ts"))).alias("_t1"),
        F.sum("_delta").alias("_inner"), F.count(F.lit(1)).alias("_n"))


def _step(prev: Column, value: Column) -> Column:
    """Increase between neighbouring samples; a fall is a reset to zero."""
    return F.when(value < prev, value).otherwise(value - prev)


def increase_from_buckets(buckets: DataFrame, width_s: int, range_: str = "1h", step: str = "1m", min_samples: int = 2,
                          keep=(), extrapolate: bool = False, chunk: str | int | None = None) -> DataFrame:
    """Increase vector from :func:`bucket_deltas` (several ranges can share it).

    Time is cut into chunks of ``chunk`` (at least one range); a chunk also
    gets the buckets of one range before it, so every evaluation instant finds
    its whole range in its own chunk and no window spans a series' history.
    The increase is the sum of the deltas between the first and the last
    sample inside the range, taken within the chunk: a flat range gives
    exactly 0.0, and no range a negative value.

    Each bucket row emits itself and its owned query rows in one generator;
    one descending running ``last`` over them finds, for every query, the
    earliest bucket inside its range.
    """
    r, s = seconds(range_), seconds(step)
    if r % width_s or s % width_s:
        raise ValueError("the bucket width must divide range and step")
    R, S = r // width_s, s // width_s
    C = max(R, seconds(chunk) // width_s if chunk else max(4 * R, 720))
    keep = [k for k in (keep or ()) if k]
    keys = [*SERIES, *keep, "_c"]
    d = buckets.select("*", F.explode(F.sequence(F.expr(f"_b div {C}"), F.expr(f"(_b + {R - 1}) div {C}"))).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_b")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("_last").over(w)
    d = d.select("*", F.lead("_b").over(w).alias("_nb"), F.sum("_n").over(upto).alias("_cum_n"),
                 (F.col("_inner") + F.when(before.isNull(), F.lit(0.0)).otherwise(_step(before, F.col("_first")))).alias("_grown"))
    d = d.withColumn("_cum", F.sum("_grown").over(upto))
    lo = F.greatest(F.expr(f"(_b + {S - 1}) div {S}"), F.expr(f"(_c * {C} + {S - 1}) div {S}"))
    last_pos = F.least(F.coalesce(F.col("_nb") - 1, F.col("_b") + (R - 1)), F.col("_b") + (R - 1), (F.col("_c") + 1) * C - 1)
    hi = F.floor(last_pos / F.lit(S)).cast("long")
    row_t = "struct<pos:bigint,q:int,m:bigint,cum:double,inner:double,cb:bigint,t0:bigint,v0:double>"

    def entry(pos, q, m, cum, inner, cb, t0, v0):
        return F.struct(pos.alias("pos"), F.lit(q).alias("q"), m.alias("m"), cum.alias("cum"), inner.alias("inner"),
                        cb.alias("cb"), t0.alias("t0"), v0.alias("v0")).cast(row_t)

    none = F.lit(None)
    me = entry(F.col("_b"), 0, none, F.col("_cum"), F.col("_inner"), F.col("_cum_n") - F.col("_n"), F.col("_t0"), F.col("_first"))
    owned = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    queries = F.transform(owned, lambda m: entry(m * S - (R - 1), 1, m, none, none, none, none, none))
    rows = d.select(*keys, F.col("_cum").alias("_end"), "_cum_n", "_t1", F.explode(F.concat(F.array(me), queries)).alias("_r"))
    down = (Window.partitionBy(*keys).orderBy(F.col("_r.pos").desc(), F.col("_r.q").asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = {c: F.last(f"_r.{c}", ignorenulls=True).over(down).alias(f"_f_{c}") for c in ("cum", "inner", "cb", "t0", "v0")}
    out = (rows.select("*", *first.values()).filter(F.col("_r.q") == 1)
           .select(*SERIES, *keep, F.col("_r.m").alias("_m"), "_t1", "_f_t0", "_f_v0",
                   ((F.col("_end") - F.col("_f_cum")) + F.col("_f_inner")).alias("increase"),
                   (F.col("_cum_n") - F.col("_f_cb")).alias("samples"))
           .filter(F.col("samples") >= min_samples))
    if extrapolate:
        out = out.withColumn("increase", _extrapolated(out, s, r))
    return out.select(*SERIES, *keep, _eval_ts(s), "increase", "samples")


def _extrapolated(d: DataFrame, step_s: int, range_s: int) -> Column:
    """The increase scaled to the whole range, as rule engines for scraped counters define it.

    The sampled interval is stretched to each edge of the range if that edge
    is nearer than 1.1 mean sample distances, else by half a distance; at the
    start never further than where the counter would have been zero.
    """
    end = F.col("_m") * F.lit(step_s * US)
    sampled = (F.col("_t1") - F.col("_f_t0")).cast("double")
    mean = sampled / (F.col("samples") - 1)
    to_start = (F.col("_f_t0") - (end - F.lit(range_s * US))).cast("double")
    to_end = (end - F.col("_t1")).cast("double")
    near = lambda gap: F.when(gap < mean * 1.1, gap).otherwise(mean / 2)
    to_zero = F.when((F.col("increase") > 0) & (F.col("_f_v0") >= 0), sampled * F.col("_f_v0") / F.col("increase"))
    stretched = sampled + F.least(near(to_start), F.coalesce(to_zero, near(to_start))) + near(to_end)
    return F.when(sampled > 0, F.col("increase") * stretched / sampled).otherwise(F.col("increase"))


def with_birth_zeros(samples: DataFrame, keep=()) -> DataFrame:
    """Adds a synthetic 0 sample 1 µs before each series' first sample, so a
    counter's value at birth counts as increase (the first real sample is
    otherwise only the baseline). One partial aggregate per series."""
    samples, keep = _keep_cols(with_series(samples), keep)
    born = (samples.groupBy(*SERIES, *keep).agg(F.min("ts").alias("_t0"))
            .select(*SERIES, *keep, (F.col("_t0") - F.expr("INTERVAL 1 MICROSECOND")).alias("ts"),
                    F.lit(0.0).alias("value")))
    return samples.select(*SERIES, *keep, "ts", "value").unionByName(born)


def counter_increase(samples: DataFrame, range_: str = "1h", step: str = "1m",
                     min_samples: int = 2, chunk: str | int | None = None, keep=(),
                     count_birth: bool = False, extrapolate: bool = False) -> DataFrame:
    """``increase(x[range])`` per series at every step -> (metric,
    labels_key, *keep, eval_ts, increase, samples). With ``count_birth`` a
    series' first value counts from 0 (see :func:`with_birth_zeros`). The
    default is the observed increase of the samples in the range;
    ``extrapolate`` scales it to the range's edges."""
    if count_birth:
        samples = with_birth_zeros(samples, keep)
    g = math.gcd(seconds(range_), seconds(step))
    return increase_from_buckets(bucket_deltas(samples, g, keep), g, range_, step, min_samples, keep, extrapolate, chunk)


def counter_rate(samples: DataFrame, range_: str = "5m", step: str = "1m", **kw) -> DataFrame:
    """Per-second rate: increase / range seconds."""
    inc = counter_increase(samples, range_, step, **kw)
    return inc.withColumn("rate", F.col("increase") / F.lit(float(seconds(range_)))).drop("increase")


# ---- gauges -------------------------------------------------------------------

def instant_last(samples: DataFrame, step: str = "1m", lookback: str = "5m", keep=(), chunk: str = "1d") -> DataFrame:
    """Instant vector: newest sample within ``(t - lookback, t]`` per series.
    The bucket that owns an eval instant holds that newest sample. Buckets are
    ordered within chunks of time, never over a series' history."""
    lb, s = seconds(lookback), seconds(step)
    g, R, S = _grid(lb, s)
    d, keep = _keep_cols(with_series(samples), keep)
    keys = [*SERIES, *keep]
    pre = (d.withColumn("_b", _bucket(g))
           .groupBy(*keys, "_b")
           # equal times: the larger value, so the choice is the same in every run
           .agg(F.max(F.struct("ts", "value")).alias("_v")).withColumn("value", F.col("_v.value")).drop("_v"))
    return _owned_evals(pre, R, S, keys, seconds(chunk) // g).select(*keys, _eval_ts(s), "value")


def _label_or_col(df: DataFrame, k: str) -> Column:
    return F.coalesce(F.col(k), F.lit("")) if k in df.columns else label(k)


def sum_by(vector: DataFrame, by: list[str] | None = None, value: str = "value",
           out: str = "value") -> DataFrame:
    """``sum by (labels) (v)`` per eval instant; ``by=None`` sums everything.
    The ``by`` labels must be carried by the vector (``keep=``)."""
    keys = [F.col("eval_ts")] + [_label_or_col(vector, k).alias(k) for k in (by or [])]
    return vector.groupBy(*keys).agg(F.sum(value).alias(out))


def series_ratio(vector: DataFrame, num_metric: str, den_metric: str, out: str = "value") -> DataFrame:
    """``a / b`` matched on identical labels at each eval instant, written as
    one conditional aggregation (no join); a zero denominator gives NULL."""
    num = F.max(F.when(F.col("metric") == num_metric, F.col("value")))
    den = F.max(F.when(F.col("metric") == den_metric, F.col("value")))
    return (vector.filter(F.col("metric").isin(num_metric, den_metric))
            .groupBy("labels_key", "eval_ts")
            .agg((num / F.nullif(den, F.lit(0.0))).alias(out),
                 F.count_if(F.col("metric") == num_metric).alias("_hn"),
                 F.count_if(F.col("metric") == den_metric).alias("_hd"))
            .filter((F.col("_hn") > 0) & (F.col("_hd") > 0)).drop("_hn", "_hd"))


def avg_duration(samples: DataFrame, base: str = "airflow_task_duration_seconds",
                 step: str = "1m", lookback: str = "5m") -> DataFrame:
    """Histogram average: ``<base>_sum / <base>_count`` per label set."""
    vec = instant_last(samples.filter(F.col("metric").isin(f"{base}_sum", f"{base}_count")),
                       step, lookback)
    return series_ratio(vec, f"{base}_sum", f"{base}_count", "avg_seconds")


def series_reduce(vector: DataFrame, start=None, end=None) -> DataFrame:
    """Panel reducers per series over ``[start, end]``: lastNotNull, sum,
    mean, max."""
    v = vector
    if start is not None:
        v = v.filter(F.col("eval_ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        v = v.filter(F.col("eval_ts") <= F.lit(end).cast("timestamp_ntz"))
    nn_ts = F.when(F.col("value").isNotNull(), F.col("eval_ts"))
    return (v.groupBy(*SERIES)
            .agg(F.max_by("value", nn_ts).alias("last_not_null"), F.sum("value").alias("total"),
                 F.avg("value").alias("mean"), F.max("value").alias("max")))


def threshold_bands(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Colour bands: ``steps`` is [(None, base), (t1, name1), (t2, name2) ...]
    ascending; a value >= t_i takes name_i, NULL stays NULL."""
    expr = F.when(value.isNull(), F.lit(None).cast("string"))
    for thr, name in reversed(steps[1:]):
        expr = expr.when(value >= F.lit(thr), F.lit(name))
    return expr.otherwise(F.lit(steps[0][1]))


# Dashboard thresholds.
LAG_BANDS = [(None, "green"), (1000, "yellow"), (10000, "red")]
RESTART_BANDS = [(None, "green"), (1, "yellow"), (3, "red")]
FAILED_CHECKPOINT_BANDS = [(None, "green"), (1, "yellow"), (5, "red")]
BYTES_BANDS = [(None, "green"), (10485760, "yellow"), (104857600, "red")]
RUNNING_JOB_BANDS = [(None, "red"), (1, "green")]
TWO_JOB_BANDS = [(None, "red"), (2, "green")]
OBJECT_BANDS = [(None, "blue"), (500, "yellow"), (5000, "red")]
SMALL_OBJECT_BANDS = [(None, "purple"), (200, "yellow"), (1000, "red")]


def up_down(value: Column) -> Column:
    return F.when(value == 1, F.lit("UP")).when(value == 0, F.lit("DOWN"))


def consumer_lag(samples: DataFrame, step: str = "1m", lookback: str = "5m",
                 by: list[str] | None = ("consumergroup", "topic")) -> DataFrame:
    by = list(by) if by else None
    vec = instant_last(select_series(samples, "kafka_consumergroup_lag"), step, lookback, keep=by or ())
    return sum_by(vec, by, out="lag")


def target_status(samples: DataFrame, step: str = "1m", lookback: str = "5m") -> DataFrame:
    vec = instant_last(select_series(samples, "up"), step, lookback, keep=("job",))
    return vec.select("job", "eval_ts", "value", up_down(F.col("value")).alias("status"))


# ---- StatsD name mapping ---------------------------------------------------------

# The exporter's mapping rules, in order (first match wins).
# (match, match_type, metric name, labels with $n group references, action)
STATSD_RULES = [
    ("airflow.dagrun.duration.success.*", "glob", "airflow_dagrun_duration_seconds",
     {"dag_id": "$1", "status": "success"}, "map"),
    ("airflow.dagrun.duration.failed.*", "glob", "airflow_dagrun_duration_seconds",
     {"dag_id": "$1", "status": "failed"}, "map"),
    ("airflow.ti.finish.*.*.*", "glob", "airflow_task_finish_total",
     {"dag_id": "$1", "task_id": "$2", "state": "$3"}, "map"),
    ("airflow.dag.*.*.duration", "glob", "airflow_task_duration_seconds",
     {"dag_id": "$1", "task_id": "$2"}, "map"),
    ("airflow.ti.start.*.*", "glob", "airflow_task_start_total",
     {"dag_id": "$1", "task_id": "$2"}, "map"),
    ("airflow.scheduler.tasks.running", "glob", "airflow_scheduler_tasks_running", {}, "map"),
    ("airflow.scheduler.tasks.starving", "glob", "airflow_scheduler_tasks_starving", {}, "map"),
    ("airflow.dag_processing.total_parse_time", "glob", "airflow_dag_processing_total_parse_time", {}, "map"),
    (".", "regex", "dropped", {}, "drop"),
]


def glob_regex(pattern: str) -> str:
    """Glob with ``*`` = one dot-free name part, anchored at both ends."""
    return "^" + "([^.]*)".join(re.escape(p) for p in pattern.split("*")) + "$"


def rule_regex(match: str, match_type: str) -> str:
    return glob_regex(match) if match_type == "glob" else match


def map_metric_names(lines: DataFrame, rules=STATSD_RULES, name_col: str = "name") -> DataFrame:
    """Map dotted names to (metric, labels): first matching rule wins; names
    that hit a drop rule or no rule at all are removed."""
    name = F.col(name_col)
    chosen = None
    for match, mtype, metric, labels, action in rules:
        rx = rule_regex(match, mtype)
        if action == "drop":
            target = F.lit(None).cast("struct<metric:string,labels:map<string,string>>")
        else:
            kv = []
            for k, v in sorted(labels.items()):
                ref = re.fullmatch(r"\$(\d+)", v)
                kv += [F.lit(k), F.regexp_extract(name, rx, int(ref.group(1))) if ref else F.lit(v)]
            lab = F.create_map(*kv) if kv else F.create_map().cast("map<string,string>")
            target = F.struct(F.lit(metric).alias("metric"), lab.alias("labels"))
        cond = name.rlike(rx)
        chosen = F.when(cond, target) if chosen is None else chosen.when(cond, target)
    out = lines.withColumn("_mapped", chosen).filter(F.col("_mapped").isNotNull())
    rest = [c for c in lines.columns if c != name_col]
    return out.select(F.col("_mapped.metric").alias("metric"), F.col("_mapped.labels").alias("labels"), *rest)


def run_state_counts(mapped: DataFrame) -> DataFrame:
    """Task finishes per (dag, task, state)."""
    fin = mapped.filter(F.col("metric") == "airflow_task_finish_total")
    return (fin.groupBy(label("dag_id").alias("dag_id"), label("task_id").alias("task_id"),
                        label("state").alias("state"))
            .agg(F.count(F.lit(1)).alias("finishes")))
