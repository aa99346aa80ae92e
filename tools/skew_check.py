"""Measure per-task load of the skew-handling operators from Spark's event log.

Usage: python tools/skew_check.py [sf_dir] [out.md]

Builds skewed inputs from the test tables and runs each operator both ways,
reading the largest number of shuffle records one task read in any stage
(from the event log written to a fresh scratch folder):

* null keys: ``events`` left-joined to ``customer`` with every ``click``
  event's key set to null (a fifth of the rows), shuffled; plain join vs
  ``left_join``, which does not shuffle them;
* copies: the same null-key rows made identical (one group of copies), over
  64 input splits;
* hot key: every ``view`` event's key set to one customer (a fifth of the
  rows) over 64 input splits, ``left_join`` with AQE's skew split off vs on
  (thresholds scaled down to the input size);
* hot right key: customers left-joined to events with every ``view``
  event on one customer (a fifth of the right side); ``left_join`` with
  AQE's skew split on (it cannot split the right side of a left outer join)
  vs ``left_join_split``;
* per-key cap: first 100 events per ``event_type`` (5 keys, each a fifth
  of the rows) over 64 input splits; one ``row_number`` window vs the
  two-level ``cap_per_key``.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aerostat.operators import joins, topk  # noqa: E402
from aerostat.session import build_session  # noqa: E402
from aerostat.testdata import table  # noqa: E402


def max_task_records(log_dir: str, job_group: str) -> int:
    """Largest shuffle-read record count of one task over the jobs of a group."""
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f)]
    stage_jobs, group_jobs, best = {}, set(), 0
    events = []
    for f in files:
        with open(f) as fh:
            events += [json.loads(line) for line in fh if line.strip()]
    for e in events:
        if e.get("Event") == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            if props.get("spark.jobGroup.id") == job_group:
                group_jobs.add(e["Job ID"])
                for s in e.get("Stage IDs", []):
                    stage_jobs[s] = e["Job ID"]
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and stage_jobs.get(e.get("Stage ID")) in group_jobs:
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            best = max(best, int(m.get("Total Records Read", 0)))
    return best


NOTES = """The plain join sends every null-key row to the null key's single partition; `left_join` unites them with
the result unjoined, so neither their number nor how alike they are matters. A hot non-null key is left to AQE:
with its skew split on, the hot partition is read by several tasks, each taking a range of map outputs (so it needs
more than one input split; at cluster scale there are thousands). A hot key on the right (fan-out) side of a left
join is not split by AQE, which may only split the preserved side; `left_join_split` deals the rows of a right key
with more than `rows_per_task` rows into as many parts as they need. The single window gathers up to 100 rows per
key from each of the 64 input splits in one task; the two-level cap gathers at most 100 rows from each of 8 split
buckets per task at either level.
Regenerate with `python tools/skew_check.py /root/testdata/sf0.1 SKEW.md`."""


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else None
    log_dir = tempfile.mkdtemp(prefix="aerostat-eventlog-")
    spark = build_session("local[8]", app_name="aerostat-skew", shuffle_partitions=64, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    sc = spark.sparkContext
    ev = table(spark, sf, "events")
    fact = ev.select("event_id", F.when(F.col("event_type") == "click", F.lit(None)).otherwise(F.col("user_id")).alias("uid"))
    dim = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    total, nulls = ev.count(), fact.where(F.col("uid").isNull()).count()
    runs = {
        "null keys: plain shuffled left join": lambda: fact.join(dim, fact.uid == dim.c_custkey, "left"),
        "null keys: left_join": lambda: joins.left_join(fact, dim, "uid", "c_custkey"),
    }
    # a group of copies: every click event is the same row (null key), over
    # 64 input splits as at cluster scale
    copies = ev.select(
        F.when(F.col("event_type") == "click", F.lit(0)).otherwise(F.col("event_id")).alias("event_id"),
        F.when(F.col("event_type") == "click", F.lit(None)).otherwise(F.col("user_id")).alias("uid")).repartition(64)
    runs["copies: plain shuffled left join"] = lambda: copies.join(dim, copies.uid == dim.c_custkey, "left")
    # 64 input splits: AQE splits a skewed partition along map-task boundaries
    hot = ev.select("event_id", F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id")).alias("uid")) \
        .repartition(64)
    skew_on = {"spark.sql.adaptive.skewJoin.enabled": "true",
               # thresholds scaled down to this input; the defaults (256 MB) apply at cluster scale
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    runs["hot key: left_join, AQE skew split off"] = lambda: joins.left_join(hot, dim, "uid", "c_custkey")
    runs["hot key: left_join, AQE skew split on"] = (
        lambda: joins.left_join(hot, dim, "uid", "c_custkey"), skew_on)
    # a hot key on the fan-out (right) side: customers left-joined to their
    # events, every view event on customer 1; AQE cannot split the right side
    # of a left outer join, so only the hot-key split spreads it
    fanout = ev.select(F.when(F.col("event_type") == "view", F.lit(1)).otherwise(F.col("user_id")).alias("uid"),
                       "event_id").repartition(64)
    custs = dim.select(F.col("c_custkey"))
    runs["hot right key: left_join, AQE skew split on"] = (
        lambda: joins.left_join(custs, fanout, "c_custkey", "uid"), skew_on)
    runs["hot right key: left_join_split, 1,000 rows a task"] = (
        lambda: joins.left_join_split(custs, fanout, "c_custkey", "uid", spread_by=["event_id"], rows_per_task=1000), skew_on)
    split = ev.select("event_type", "event_id").repartition(64)
    w = Window.partitionBy("event_type").orderBy("event_id")
    runs["copies: left_join"] = lambda: joins.left_join(copies, dim, "uid", "c_custkey")
    runs["per-key cap: one row_number window"] = lambda: split.withColumn("rn", F.row_number().over(w)).where("rn <= 100").drop("rn")
    runs["per-key cap: two-level cap_per_key (fanout 8)"] = lambda: topk.cap_per_key(split, ["event_type"], ["event_id"], 100, fanout=8)
    rows = []
    for i, (name, run) in enumerate(runs.items()):
        build, conf = run if isinstance(run, tuple) else (run, {})
        saved = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = build()
        sc.setJobGroup(f"skew-{i}", name)  # measured: the query itself, written to the noop sink
        df.write.format("noop").mode("overwrite").save()
        sc.setJobGroup(f"rows-{i}", name)
        rows.append((name, df.count()))
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    spark.stop()
    lines = ["# Skew check", "",
             f"Input `{os.path.basename(sf)}`: {total} events, {nulls} of them with a null join key; 5 cap keys. "
             "`local[8]`, 64 shuffle partitions, AQE skew splitting / coalescing / runtime broadcast off.", "",
             "| run | result rows | max shuffle records read by one task |", "| --- | --- | --- |"]
    for i, (name, n) in enumerate(rows):
        lines.append(f"| {name} | {n} | {max_task_records(log_dir, f'skew-{i}')} |")
    text = "\n".join(lines) + "\n\n" + NOTES + "\n"
    print(text)
    if out:
        with open(out, "w") as f:
            f.write(text)


if __name__ == "__main__":
    main()
