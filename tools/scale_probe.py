"""Derive a denser dataset from the given tables for a local scale probe.

    python tools/scale_probe.py /root/testdata/sf0.1 <out_dir> [events_x] [documents_x]
    BENCH_SF_DIR=<out_dir> BENCH_STREAMS=0 python bench.py

``events`` is replicated ``events_x`` times into the same time range (ids
shifted past the original range, times jittered by 0.2 s per copy), so the
event rate grows as it would at a larger scale factor; ``documents`` is
replicated ``documents_x`` times with shifted ids. Every row is derived from
the given tables; the output directory must be given.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from eventide.session import build_session  # noqa: E402


def main(src: str, out: str, events_x: int = 100, documents_x: int = 10) -> None:
    spark = build_session(extra={"spark.driver.memory": "16g"})
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.agg(F.max("event_id") + 1).first()[0]
    copies = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(events_x - 1))).alias("k"))
    (copies.select((F.col("event_id") + F.col("k") * n).alias("event_id"),
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                     F.col("k") * 0.2)).alias("ts"),
                   "user_id", "event_type", "value", "props")
     .repartition(32, "event_id").sortWithinPartitions("event_id")
     .write.parquet(f"{out}/events.parquet"))
    docs = spark.read.parquet(f"{src}/documents.parquet")
    m = docs.agg(F.max("doc_id") + 1).first()[0]
    dcopies = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(documents_x - 1))).alias("k"))
    (dcopies.select((F.col("doc_id") + F.col("k") * m).alias("doc_id"), "text", "lang", "source",
                    "n_chars")
     .repartition(32, "doc_id").write.parquet(f"{out}/documents.parquet"))
    spark.stop()


if __name__ == "__main__":
    a = sys.argv[1:]
    main(a[0], a[1], *(int(x) for x in a[2:4]))
