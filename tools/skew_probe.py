"""Measure reduce-side balance under a hot key from Spark's event log.

    python tools/skew_probe.py /root/testdata/sf0.1 <scratch_dir>

``events`` is replicated 10x; a third of the rows get one site and one user
(the hot key). PV by site/hour and UV by day run with the event log on, and
per stage the shuffle rows read by each task are summarised (total, max,
median): with map-side partial aggregation the hot key cannot pile its raw
rows onto one reduce task.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventide.operators import logs  # noqa: E402
from eventide.session import build_session  # noqa: E402
from eventide.sources.records import event_records  # noqa: E402


def shuffle_reads(log_dir: str) -> dict[tuple[str, int], list[int]]:
    """(job description, stage) -> shuffle records read per task."""
    stages: dict[tuple[str, int], list[int]] = {}
    names: dict[int, str] = {}
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):  # Spark writes many zstd frames per file
            raw = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(raw), read_across_frames=True).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                names.update({s: desc for s in e.get("Stage IDs", [])})
            elif e.get("Event") == "SparkListenerTaskEnd":
                metrics = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                n = metrics.get("Total Records Read", 0)
                if n:
                    sid = e["Stage ID"]
                    stages.setdefault((names.get(sid, ""), sid), []).append(n)
    return stages


def main(src: str, scratch: str) -> None:
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.agg(F.max("event_id") + 1).first()[0]
    hot = F.col("event_id") % 3 == 0
    big = (ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
           .select((F.col("event_id") + F.col("k") * n).alias("event_id"), "ts",
                   F.when(hot, F.lit(1)).otherwise(F.col("user_id")).alias("user_id"),
                   F.when(hot, F.lit("hot")).otherwise(F.col("event_type")).alias("event_type"),
                   "value", "props")
           .repartition(16, "event_id"))
    parsed = logs.parse_log(event_records(big, "log", keep=()))
    for name, df in [("pv_by_site_hour", logs.pv_by_site_hour(parsed)),
                     ("uv_by_day", logs.uv_by_day(parsed))]:
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    for (name, sid), rows in sorted(shuffle_reads(log_dir).items(), key=lambda x: x[0][1]):
        print(f"{name:16s} stage {sid:3d} tasks {len(rows):3d} rows read: total {sum(rows)} "
              f"max {max(rows)} median {statistics.median(rows)}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
