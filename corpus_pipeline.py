"""The corpus pipeline: documents that pass the quality classifier, one of each near-duplicate group, without
personal data, packed into training sequences.

Every stage works on all rows its predecessor kept and leaves rows with null ids or null texts in their place:
a null text is scored like an empty one, is nobody's duplicate, has nothing to redact and packs to its closing token. An empty
table stays empty. Columns beside those of documents are carried through to the last stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import byte_bpe, hyperminhash, packing, pii_crf, quality_fm
from tallybook.llm.common import unused
from tallybook.llm.queries import ACCEPTED, BPE_JSON, table
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir, scratch_scope


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the factorisation machine, learnt from the labels, does not reject."""
    machine = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs.columns, "_score")
    return quality_fm.score(docs, machine, name=score).where(F.col(score) >= ACCEPTED).drop(score)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Rows that repeat an id and its text are one document; rows of an id with other texts are documents of their own.
    """
    mine, other, kept = (unused(docs.columns, name) for name in ("_row", "_other", "_kept"))
    keyed = docs.where("doc_id IS NOT NULL").withColumn(mine, F.xxhash64("doc_id", "text"))
    found = hyperminhash.near_duplicates(keyed.select(mine, "text"), key=mine).select(F.col(mine).alias("row"), "component_id")
    ids = keyed.select(F.col(mine).alias("id_row"), "doc_id").distinct()
    first = found.distinct().join(ids, F.col("row") == F.col("id_row")).groupBy("component_id").agg(
        F.min(F.struct("doc_id", "row")).alias("first")).select(F.col("first.row").alias(kept))
    # two documents of one hash, rare as they are, are both kept: another hash and the id tell them apart
    one = keyed.join(first, F.col(mine) == F.col(kept), "left_semi").withColumn(other, F.xxhash64(F.lit(1), "text"))
    one = one.dropDuplicates([mine, other, "doc_id"]).drop(mine, other)
    return one.unionByName(docs.where("doc_id IS NULL"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and their new lengths."""
    return pii_crf.redact(docs, pii_crf.train_table(pii_crf.labelled_table(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, each a sequence of a power-of-two length."""
    path = BPE_JSON
    return packing.pack(docs, lambda: byte_bpe.tokenizer_of_json(path))


#: Each stage takes what the one before it kept.
STAGES = [("quality", accepted), ("near-duplicates", deduplicated), ("personal-data", redacted), ("packing", packed)]
#: No SQL can train the classifier and the tagger; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = scratch_dir(spark, f"pipeline-{name}")
        with scratch_scope(spark, name):  # what a stage writes for itself goes when its rows are written
            done = written(stage(spark, docs, sf_dir), kept)
        docs = done
    return docs
