"""Corpus pipeline: language ID, near duplicates, repeated substrings, mixing, subword encoding.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and works on all that the
stage before kept.  All but the last return the columns of ``documents``; the last returns one row
per document: doc_id, n_tokens, ids_sha256, decoded_sha256.  ``run`` writes every stage's result as
Parquet in the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import langid, minhash, mixing, pieces, suffix
from cyclewise.llm.common import fold, materialise, table
from cyclewise.llm.queries import piece_model

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000  # rows that Spark hands a Python worker at once
NEAR_PERCENT = 80  # similarity of word shingle sets at which the stage takes two documents for one


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows, unless the session sets its own number.

    Spark's 10,000 whole texts are held at once, and more than once, on both sides of every running task."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text or without a letter go."""
    _small_batches(spark)
    net = langid.train(docs.filter(fold("doc_id", 3) != 1))
    return langid.keep_identified(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.80 or more): the one with the smallest id.

    Rows that repeat the kept id are one document and stay together."""
    _small_batches(spark)
    kept = minhash.near_duplicates(docs, percent=NEAR_PERCENT).filter("kept or doc_id is null").select(F.col("doc_id").alias("_kept")).distinct()
    # a merge join at every size: both sides grow with the corpus
    return docs.join(kept.hint("merge"), docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def exact_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes that an earlier place of the corpus holds."""
    _small_batches(spark)
    return suffix.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document is there as often as it is taken (0, 1 or 2 times)."""
    copies = mixing.mix(docs).filter("copies > 0").groupBy("doc_id").agg(F.max("copies").alias("_copies")).hint("merge")
    taken = docs.join(copies.withColumnRenamed("doc_id", "_id"), docs["doc_id"].eqNullSafe(F.col("_id")))
    return taken.withColumn("_nth", F.explode(F.sequence(F.lit(1), "_copies"))).select(*[docs[c] for c in docs.columns])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Subword ids of every document of the mix and their decoding, as digests."""
    _small_batches(spark)
    return pieces.digests(docs, piece_model())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("exact_substrings", exact_substrings),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

# Components, a trained model and subword merges are not expressible in SQL; the tests hold run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
