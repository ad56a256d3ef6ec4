"""Alert evaluation over metric series: threshold state, pending/firing
intervals, the rule set, notification routing and schedule, summary.

A rule is evaluated at every step of the grid. A series is *pending* from
the first step its condition holds and *firing* once it has held for the
rule's ``for`` duration without a gap; it resolves at the first step the
condition is false or the series is absent. Intervals are found with a
gaps-and-islands pass whose ordered part is chunked (see functions.runs).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runs import islands, merged_intervals
from ..functions.timecols import from_micros, micros, seconds
from ..session import materialize as materialize_df
from . import metrics as M

US = 1_000_000


@dataclass(frozen=True)
class AlertRule:
    name: str
    metric: str
    matchers: dict = field(default_factory=dict)
    range_: str | None = None          # None: instant value; else increase over range
    op: str = ">"
    threshold: float = 0.0
    for_: str = "0m"
    severity: str = "warning"
    component: str = ""


_DQ_DAGS = ("=~", "gold_aggregation|test_alert_scenarios")

# The seven alert rules (expression, threshold, for, labels).
ALERT_RULES = [
    AlertRule("DQGateFreshnessFailed", "airflow_task_finish_total",
              {"dag_id": _DQ_DAGS, "task_id": "dq_check_freshness", "state": "failed"},
              "1h", ">", 0, "0m", "critical", "dq_gate"),
    AlertRule("DQGateValidityFailed", "airflow_task_finish_total",
              {"dag_id": _DQ_DAGS, "task_id": "dq_check_invalid_ratio", "state": "failed"},
              "1h", ">", 0, "0m", "critical", "dq_gate"),
    AlertRule("DQGateNullCheckFailed", "airflow_task_finish_total",
              {"dag_id": _DQ_DAGS, "task_id": "dq_check_null_critical_fields", "state": "failed"},
              "1h", ">", 0, "0m", "critical", "dq_gate"),
    AlertRule("FlinkJobNotRunning", "flink_jobmanager_numRunningJobs", {},
              None, "<", 1, "2m", "critical", "flink"),
    AlertRule("FlinkJobRestarting", "flink_jobmanager_job_numRestarts", {},
              "10m", ">", 3, "0m", "warning", "flink"),
    AlertRule("KafkaConsumerLagHigh", "kafka_consumergroup_lag", {},
              None, ">", 10000, "5m", "warning", "kafka"),
    AlertRule("GoldAggregationFailed", "airflow_task_finish_total",
              {"dag_id": _DQ_DAGS, "task_id": "insert_gold_trips_hourly", "state": "failed"},
              "2h", ">", 0, "0m", "critical", "airflow"),
]


@dataclass(frozen=True)
class Route:
    matchers: dict
    group_wait: str
    repeat_interval: str
    group_interval: str = "5m"


# Notification policy (first matching route wins).
ROUTES = [
    Route({"severity": "critical", "component": "dq_gate"}, "10s", "30m"),
    Route({"severity": "critical", "component": ("=~", "flink|airflow")}, "10s", "30m"),
    Route({"severity": "warning"}, "1m", "2h"),
]
DEFAULT_ROUTE = Route({}, "30s", "1h")
GROUP_BY = ("alertname", "severity")


def _cmp(value: Column, op: str, thr: float) -> Column:
    ops = {">": value > thr, ">=": value >= thr, "<": value < thr, "<=": value <= thr,
           "==": value == thr, "!=": value != thr}
    return ops[op]


def threshold_state(vector: DataFrame, op: str, threshold: float, value: str = "value") -> DataFrame:
    """Rows of the vector where the condition holds (the active steps)."""
    return vector.filter(_cmp(F.col(value), op, threshold))


def _step_index(ts: Column, step_s: int) -> Column:
    return F.floor(micros(ts) / F.lit(step_s * US)).cast("long")


def _at(k: Column, step_s: int) -> Column:
    return from_micros(k * F.lit(step_s * US))


def firing_intervals(active: DataFrame, step: str = "1m", for_: str = "0m",
                     keys: tuple[str, ...] = ("metric", "labels_key")) -> DataFrame:
    """Active steps -> (keys, pending_at, firing_at, last_active_at, resolved_at).

    Only islands that last at least ``for_`` produce a row; ``firing_at`` is
    the first step at which the condition has held for ``for_``.
    """
    s = seconds(step)
    f = math.ceil(seconds(for_) / s)
    isl = islands(active.withColumn("_k", _step_index(F.col("eval_ts"), s)), list(keys), "_k")
    return (isl.filter(F.col("start_k") + f <= F.col("end_k"))
            .select(*keys, _at(F.col("start_k"), s).alias("pending_at"),
                    _at(F.col("start_k") + f, s).alias("firing_at"),
                    _at(F.col("end_k"), s).alias("last_active_at"),
                    _at(F.col("end_k") + 1, s).alias("resolved_at")))


def rule_vector(samples: DataFrame, rule: AlertRule, step: str = "1m") -> DataFrame:
    """The expression vector of one rule (before its threshold)."""
    sel = M.select_series(samples, rule.metric, rule.matchers)
    if rule.range_:
        vec = M.counter_increase(sel, rule.range_, step).withColumnRenamed("increase", "value")
    else:
        vec = M.instant_last(sel, step)
    return vec.select("metric", "labels_key", "eval_ts", "value")


def _rule_filter(rule: AlertRule) -> Column:
    """Matchers of one rule over label columns carried by a vector."""
    c = F.lit(True)
    for k, spec in rule.matchers.items():
        op, val = ("=", spec) if isinstance(spec, str) else spec
        v = F.coalesce(F.col(k), F.lit(""))
        c = c & {"=": lambda: v == F.lit(val), "!=": lambda: v != F.lit(val),
                 "=~": lambda: v.rlike(f"^(?:{val})$"), "!~": lambda: ~v.rlike(f"^(?:{val})$")}[op]()
    return c


def _tag(vec: DataFrame, rules, step_s: int) -> DataFrame:
    """Keep the vector rows that satisfy a rule (metric, matchers, threshold),
    one output row per satisfied rule."""
    tag_t = "struct<alertname:string,severity:string,component:string,_for_steps:int>"
    tags = F.array(*[
        F.when((F.col("metric") == F.lit(r.metric)) & _rule_filter(r) & _cmp(F.col("value"), r.op, r.threshold),
               F.struct(F.lit(r.name).alias("alertname"), F.lit(r.severity).alias("severity"),
                        F.lit(r.component).alias("component"),
                        F.lit(math.ceil(seconds(r.for_) / step_s)).alias("_for_steps")))
        .otherwise(F.lit(None).cast(tag_t)) for r in rules])
    return (vec.select("labels_key", "eval_ts", F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("_r"))
            .select("_r.alertname", "_r.severity", "_r.component", "labels_key", "eval_ts", "_r._for_steps"))


def _selection(samples: DataFrame, rules):
    cond = F.lit(False)
    for r in rules:
        cond = cond | ((F.col("metric") == F.lit(r.metric)) & _rule_filter_on_labels(r))
    keep = sorted({k for r in rules for k in r.matchers})
    return M.with_series(samples.filter(cond)), keep


def _rule_filter_on_labels(rule: AlertRule) -> Column:
    c = F.lit(True)
    for k, spec in rule.matchers.items():
        c = c & M.matcher(k, spec)
    return c


def rule_vectors(samples: DataFrame, rules=ALERT_RULES, step: str = "1m") -> DataFrame:
    """Active steps of every rule -> (alertname, severity, component,
    labels_key, eval_ts, _for_steps).

    Work is shared: all instant-vector rules are evaluated in one bucket pass
    over their metrics; range rules on one metric share one selection, one
    bucket pass and one vector per distinct range. Each vector row
    is then tagged with the rules whose metric, matchers and threshold it
    satisfies (an explode over a short array), so a vector is computed and
    referenced once however many rules use it.
    """
    s = seconds(step)
    parts = []
    instant = [r for r in rules if not r.range_]
    if instant:
        sel, keep = _selection(samples, instant)
        parts.append(_tag(M.instant_last(sel, step, keep=keep), instant, s))
    by_metric: dict[str, list[AlertRule]] = {}
    for r in rules:
        if r.range_:
            by_metric.setdefault(r.metric, []).append(r)
    for group in by_metric.values():
        sel, keep = _selection(samples, group)
        width = math.gcd(s, *(seconds(r.range_) for r in group))
        buckets = M.bucket_deltas(sel, width, keep=keep)
        for rng in sorted({r.range_ for r in group}):
            rs = [r for r in group if r.range_ == rng]
            vec = (M.increase_from_buckets(buckets, width, rng, step, keep=keep)
                   .withColumnRenamed("increase", "value"))
            parts.append(_tag(vec, rs, s))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alert_rules(samples: DataFrame, rules=ALERT_RULES, step: str = "1m",
                materialize: bool = False) -> DataFrame:
    """All rules -> one frame of firing intervals with the rule's labels.

    ``materialize`` writes the active steps to the shared checkpoint folder
    before the islands pass: the expensive vectors are then neither
    recomputed after a lost executor nor re-planned."""
    s = seconds(step)
    active = rule_vectors(samples, rules, step)
    if materialize:
        active = materialize_df(active, "alert-active-steps")
    keys = ["alertname", "severity", "component", "labels_key", "_for_steps"]
    # one vector row per (series, instant), tagged once per rule: unique steps
    isl = islands(active.withColumn("_k", _step_index(F.col("eval_ts"), s)), keys, "_k", distinct=False)
    return (isl.filter(F.col("start_k") + F.col("_for_steps") <= F.col("end_k"))
            .select("alertname", "severity", "component", "labels_key",
                    _at(F.col("start_k"), s).alias("pending_at"),
                    _at(F.col("start_k") + F.col("_for_steps"), s).alias("firing_at"),
                    _at(F.col("end_k"), s).alias("last_active_at"),
                    _at(F.col("end_k") + 1, s).alias("resolved_at")))


def _route_cond(route: Route) -> Column:
    cond = F.lit(True)
    for k, spec in route.matchers.items():
        op, val = ("=", spec) if isinstance(spec, str) else spec
        c = F.coalesce(F.col(k), F.lit(""))
        cond = cond & (c == F.lit(val) if op == "=" else c.rlike(f"^(?:{val})$"))
    return cond


def route_alerts(intervals: DataFrame, routes=ROUTES, default: Route = DEFAULT_ROUTE) -> DataFrame:
    """Adds route (1-based, 0 = default), group_wait_s and repeat_interval_s."""
    def sec(d):
        return F.lit(seconds(d)).cast("long")
    rid = F.lit(0)
    wait = sec(default.group_wait)
    rep = sec(default.repeat_interval)
    for i, r in reversed(list(enumerate(routes, start=1))):
        c = _route_cond(r)
        rid = F.when(c, F.lit(i)).otherwise(rid)
        wait = F.when(c, sec(r.group_wait)).otherwise(wait)
        rep = F.when(c, sec(r.repeat_interval)).otherwise(rep)
    return intervals.select("*", rid.alias("route"), wait.alias("group_wait_s"),
                            rep.alias("repeat_interval_s"))


def notification_schedule(intervals: DataFrame, step: str = "1m", routes=ROUTES,
                          default: Route = DEFAULT_ROUTE) -> DataFrame:
    """Notice times per alert group (alertname, severity): the group fires
    while any member fires; the first notice goes out ``group_wait`` after
    the group starts firing, then every ``repeat_interval`` while it still
    fires. Groups that stop before ``group_wait`` get no notice."""
    s = seconds(step)
    routed = route_alerts(intervals, routes, default)
    gkeys = [*GROUP_BY, "route", "group_wait_s", "repeat_interval_s"]
    episodes = merged_intervals(routed, gkeys, _step_index(F.col("firing_at"), s), _step_index(F.col("last_active_at"), s))
    start_us = F.col("start_k") * F.lit(s * US)
    end_us = F.col("end_k") * F.lit(s * US)
    first_us = start_us + F.col("group_wait_s") * F.lit(US)
    notices = (episodes.filter(first_us <= end_us)
               .select(*GROUP_BY, "route", _at(F.col("start_k"), s).alias("group_firing_at"),
                       F.posexplode(F.sequence(first_us, end_us, F.col("repeat_interval_s") * F.lit(US)))
                       .alias("notice_no", "_us")))
    return notices.select(*GROUP_BY, "route", "group_firing_at", (F.col("notice_no") + 1).cast("long").alias("notice_no"),
                          from_micros(F.col("_us")).alias("notify_at"))


def _episodes(routed: DataFrame, gkeys: list[str], s: int) -> DataFrame:
    """(gkeys, group_start, group_end) in seconds: the life of a group, from its first firing
    member to the first flush that finds none firing.

    Flushes lie at start + wait + n * interval. A group's merged intervals are
    at most one row per two steps of time, however many series it has; where
    a gap is longer than a flush can reach a new episode is certain, and only
    the intervals between such gaps are folded one after the other."""
    wait, every = F.col("group_wait_s"), F.col("group_interval_s")
    merged = (merged_intervals(routed, gkeys, _step_index(F.col("firing_at"), s), _step_index(F.col("last_active_at"), s))
              .select(*gkeys, (F.col("start_k") * s).alias("_s"), ((F.col("end_k") + 1) * s).alias("_e")))
    w = Window.partitionBy(*gkeys).orderBy("_s")
    apart = F.coalesce(F.col("_s") > F.lag("_e").over(w) + F.greatest(wait, every), F.lit(True))
    runs = (merged.withColumn("_new", apart.cast("int")).withColumn("_run", F.sum("_new").over(w))
            .groupBy(*gkeys, "_run").agg(F.sort_array(F.collect_list(F.struct("_s", "_e"))).alias("_x")))

    def flush_after(start, end):
        n = F.ceil(F.greatest(end - start - wait, F.lit(0)) / every)
        return start + wait + n * every

    def step(acc, x):
        joins = x["_s"] <= acc["f"]
        reached = F.when(x["_e"] > acc["f"], flush_after(acc["s"], x["_e"])).otherwise(acc["f"])
        closed = F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["f"].alias("f"))))
        return F.struct(F.when(joins, acc["done"]).otherwise(closed).alias("done"),
                        F.when(joins, acc["s"]).otherwise(x["_s"]).alias("s"),
                        F.when(joins, reached).otherwise(flush_after(x["_s"], x["_e"])).alias("f"))

    head = F.element_at("_x", 1)
    first = F.struct(F.array().cast("array<struct<s:bigint,f:bigint>>").alias("done"), head["_s"].alias("s"),
                     flush_after(head["_s"], head["_e"]).alias("f"))
    folded = F.aggregate("_x", first, step, lambda acc: F.concat(
        acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["f"].alias("f")))))
    return runs.select(*gkeys, F.inline(folded)).withColumnsRenamed({"s": "group_start", "f": "group_end"})


def group_notices(intervals: DataFrame, step: str = "1m", routes=ROUTES, default: Route = DEFAULT_ROUTE,
                  chunk: str = "1d") -> DataFrame:
    """Every notice of an alert group (alertname, severity), resolved ones included.

    A group is born with its first firing member and flushed ``group_wait``
    later, then every ``group_interval`` until a flush finds no member firing;
    the next member makes a new group. A flush sends a notice if members
    joined or left since the flush before (``joined``, ``left``; the last one
    has status ``resolved``), or if ``repeat_interval`` has passed since the
    last notice (rounded up to whole flushes). A member that comes and goes
    between two flushes is not told, nor a group none of whose members lives
    to the first flush."""
    s = seconds(step)
    secs = lambda c: F.expr(f"unix_micros(cast({c} as timestamp)) div {US}")
    routed = route_alerts(intervals, routes, default)
    gap = F.lit(seconds(default.group_interval))
    for i, r in enumerate(routes, start=1):
        gap = F.when(F.col("route") == i, F.lit(seconds(r.group_interval))).otherwise(gap)
    routed = routed.withColumn("group_interval_s", gap.cast("long"))
    gkeys = [*GROUP_BY, "route", "group_wait_s", "repeat_interval_s", "group_interval_s"]
    day = F.lit(seconds(chunk))
    lives = _episodes(routed, gkeys, s).withColumn("_day", F.explode(F.sequence(
        F.floor(F.col("group_start") / day), F.floor(F.col("group_end") / day))))
    members = routed.select(*gkeys, "labels_key", secs("firing_at").alias("_a"), secs("resolved_at").alias("_b"))
    # a group's episodes are disjoint: each member's interval meets one
    placed = (members.withColumn("_day", F.floor(F.col("_a") / day)).join(lives, [*gkeys, "_day"])
              .where(F.col("_a").between(F.col("group_start"), F.col("group_end"))))
    ekeys = [*gkeys, "group_start", "group_end"]

    def flush(at):
        return F.ceil(F.greatest(F.col(at) - F.col("group_start") - F.col("group_wait_s"), F.lit(0)) / F.col("group_interval_s"))

    turns = placed.select(*ekeys, "labels_key", F.inline(F.array(
        F.struct(flush("_a").alias("_n"), F.lit(1).alias("_d")), F.struct(flush("_b").alias("_n"), F.lit(-1).alias("_d")))))
    # a member that left and came back before the flush is as it was
    net = turns.groupBy(*ekeys, "labels_key", "_n").agg(F.sum("_d").alias("_d")).where("_d <> 0")
    changes = net.groupBy(*ekeys, "_n").agg(F.count_if(F.col("_d") > 0).alias("joined"), F.count_if(F.col("_d") < 0).alias("left"))
    w = Window.partitionBy(*ekeys).orderBy("_n")
    per = F.ceil(F.col("repeat_interval_s") / F.col("group_interval_s"))
    told = (changes.withColumn("firing", F.sum(F.col("joined") - F.col("left")).over(w))
            .withColumn("_until", F.coalesce(F.lead("_n").over(w) - 1, F.col("_n")))
            .withColumn("_at", F.explode(F.sequence("_n", "_until", per))))
    again = F.col("_at") > F.col("_n")
    return told.select(
        *GROUP_BY, "route", from_micros(F.col("group_start") * US).alias("group_firing_at"),
        from_micros((F.col("group_start") + F.col("group_wait_s") + F.col("_at") * F.col("group_interval_s")) * US).alias("notify_at"),
        F.when(again, "repeat").when(F.col("firing") > 0, "firing").otherwise("resolved").alias("status"),
        F.col("firing").cast("long").alias("firing"),
        F.when(again, 0).otherwise(F.col("joined")).cast("long").alias("joined"),
        F.when(again, 0).otherwise(F.col("left")).cast("long").alias("left"))


def rules_frame(spark: SparkSession, rules=ALERT_RULES) -> DataFrame:
    schema = T.StructType([T.StructField("alertname", T.StringType()),
                           T.StructField("severity", T.StringType()),
                           T.StructField("component", T.StringType())])
    return spark.createDataFrame([(r.name, r.severity, r.component) for r in rules], schema)


def firing_summary(intervals: DataFrame, rules=ALERT_RULES) -> DataFrame:
    """Per rule: FIRING if it fired at all in the evaluated range, else
    inactive; intervals and distinct series; how many rules fired.
    The rule list is configuration (a handful of rows), hence broadcast."""
    per = intervals.groupBy("alertname").agg(F.count(F.lit(1)).alias("intervals"),
                                            F.countDistinct("labels_key").alias("series"),
                                            F.min("firing_at").alias("first_firing_at"))
    spark = intervals.sparkSession
    out = (F.broadcast(rules_frame(spark, rules)).join(per, "alertname", "left")
           .select("alertname", "severity", "component",
                   F.coalesce("intervals", F.lit(0)).alias("intervals"),
                   F.coalesce("series", F.lit(0)).alias("series"), "first_firing_at",
                   F.when(F.col("intervals") > 0, "FIRING").otherwise("inactive").alias("state")))
    return out.withColumn("rules_fired", F.count_if(F.col("state") == "FIRING").over(Window.partitionBy()))
