"""A corpus cleaned in five stages and packed into batches.

Each stage takes (spark, docs, sf_dir) and returns a table that is written to
the shared folder and read back as the next one's ``docs``. The first four
return the columns of ``documents``:

* ``toxicity``: documents scored toxic (0.5 or more) go;
* ``line_dedup``: lines that stand in 10 or more of the remaining documents go,
  ``n_chars`` is counted anew;
* ``near_dedup``: of documents linked at 80 % of 5-word shingles one stays;
* ``decontaminate``: documents that hold a benchmark window of 10 words go;
* ``packing``: length buckets and batches, one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontaminate, line_dedup, minhash, packing, toxicity
from eventide.llm.common import written
from eventide.sources.records import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # names of its own: documents may have columns of the operator's names
    out = line_dedup.drop_common_lines(docs, counts=("_pl_lines", "_pl_dropped"))
    # texts that lost no line keep their row as it is
    out = out.withColumn("n_chars", F.when(F.col("_pl_dropped") > 0, F.length("text").cast("long"))
                         .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, threshold=80).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("text_key")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

# A learned classifier and union of links are not SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
