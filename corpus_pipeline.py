"""Clean, deduplicate, mix and pack the documents: five stages, each on all rows that the one before kept.

Every stage is a function of the session, the documents of the stage before and the folder of the tables. All but the last
return the columns of ``documents``. A stage's result is written to the folder that ``spark.checkpoint.dir`` names and read again, so
that no stage computes another's work a second time and lost executors cost a stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsieve.llm import jaccard, linededup, mixing, packing, toxicity
from callsieve.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; learned from the labels of documents that are not held out."""
    tagged = toxicity.tagged(docs, table(spark, sf_dir, "labels"))
    return tagged.filter("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that five or more hold; a document that loses all lines stays, empty."""
    kept = linededup.deduplicated(docs, carried=["lang", "source"])
    return kept.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id; rows without words are no copies and all stay.

    Rows are told apart by all their columns. A null id is no id that rows share: such rows stay unless their texts are near copies, and
    stand behind any id in a group. Different texts with one id are different documents.
    """
    keyed = docs.withColumn("_key", F.xxhash64(*[F.struct(F.col(c).isNull(), c) for c in COLUMNS]))
    groups = written(jaccard.joined(keyed.select(F.col("_key").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_key"), F.col("n_shingles").alias("_n"), "component_id").distinct())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key"))
    leads = groups.filter("_n > 0").join(keyed.select("_key", "doc_id"), "_key").groupBy("component_id").agg(first.alias("lead"))
    kept = leads.select(F.col("lead._key").alias("_key"), F.lit(True).alias("_once")).unionByName(
        groups.filter("_n = 0").select("_key", F.lit(False).alias("_once")))
    rows = keyed.join(kept, "_key")
    # Of equal rows one stays.
    return rows.filter("_once").dropDuplicates(["_key"]).unionByName(rows.filter("not _once")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each document and pass over its source, the words that the mix takes."""
    return mixing.mixture(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.sequences(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("best-fit packing", pack)]

#: SQL can express neither the tagger nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
