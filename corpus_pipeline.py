"""Corpus pipeline: classify, deduplicate, redact, mix and encode the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns the columns of
documents; the last returns the encoding's digests. run() writes each stage's result as Parquet in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import mixing, pieces, quality, secrets, simhash
from maskwright.llm.common import row_key, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the co-trained classifiers find good and not toxic."""
    models = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select(*COLUMNS), models).filter("keep").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least doc_id (none comes last), then the least content key.

    Rows are told apart by a key of all their columns, so two texts under one doc_id in different groups both stay."""
    keyed = docs.select(*COLUMNS).withColumn("own", row_key(*COLUMNS))
    fps = stored(simhash.fingerprints(keyed, keep=("own", "doc_id")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")
    # by fingerprint first, so that copies meet before the shuffle
    first = fps.groupBy("fp").agg(F.min(order).alias("o")).join(simhash.classes(fps), "fp").groupBy("class").agg(F.min("o").alias("o"))
    return keyed.join(first.select("o.own"), "own", "left_semi").dropDuplicates(["own"]).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with every secret in their texts replaced by a mark and n_chars set anew where one was."""
    found = secrets.find_secrets(docs.select(*COLUMNS))
    text = secrets.redact(F.col("text"), F.col("found"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix uses a document, whole, in training order."""
    return mixing.schedule(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the encoding of every row."""
    return pieces.digested(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", deduplicate),
    ("secret scans", redact),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]
#: Classifier and n-best search are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{n}")
    return docs
