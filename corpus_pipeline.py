"""From raw documents to a training mix, in five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindlewatch.llm.common import keep, table
from spindlewatch.llm.decontamination import drop_contaminated
from spindlewatch.llm.minhash_dedup import near_duplicates
from spindlewatch.llm.mixing import sample
from spindlewatch.llm.suffix_dedup import cut_repeats
from spindlewatch.llm.toxicity import drop_toxic

# Rows that go to a Python process at a time. With Spark's 10,000 a task holds tens of MB of texts
# twice, in the JVM and in Python. Only a bound on memory: every row goes there.
BATCH_ROWS = 1_000
# Shorter than the operator's 400 bytes: passages of more than 50 words are to go.
PASSAGE_BYTES = 200


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session to batches of ``BATCH_ROWS`` rows, unless they are smaller already.

    The setting stays, as a stage's result is computed when it is written.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples don't call toxic."""
    bounded_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Rows with a null id stay; a row repeated with its id is one document and
    stays as often as it is there.
    """
    bounded_batches(spark)
    found = near_duplicates(docs, percent=80)
    gone = keep(found.where("not kept").select("doc_id"), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document, or an earlier place, has too."""
    bounded_batches(spark)
    return cut_repeats(docs, PASSAGE_BYTES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    bounded_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by weights raked to source, language and topic targets."""
    return sample(docs)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
]

ORACLE_SQL = None  # the votes of nearest examples and string tiling are not SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
