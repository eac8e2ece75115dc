"""A training corpus from ``documents``: toxic documents go, near copies go, secrets are cut, sources are mixed, texts packed.

Each stage takes (spark, docs, sf_dir), reads all rows of its predecessor, and returns the columns of documents (the last one
the packed pieces). ``run`` writes every stage to the work folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import mixing, neardup, packing, secret_scan, toxicity
from stratalake.llm.common import WORD, shuffle_join
from stratalake.session import work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a row number that stays the same however often they are read, as ids may repeat."""
    folder = work_folder(spark, "numbered")
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not mark. Texts that are null or empty are clean."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.train(docs, labels)
    return toxicity.clean_documents(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component; of rows with its smallest id, the first."""
    rows = _numbered(spark, docs)
    found = neardup.near_duplicates(rows.select("row", "text"), id_column="row")
    # Before it is measured, this is expected to be large, so that it is broadcast only if it is measured as small.
    kept = found.where("kept").select("row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark, with n_chars of the new text."""
    rows = docs.select(*COLUMNS)
    made = secret_scan.redact(rows, secret_scan.train(rows))
    changed = F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return made.withColumn("n_chars", changed)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule's pieces hold them; one that it holds in part is cut to the first words.

    Every file is in the order of the schedule: a task holds documents of all places, sorted by the position of their first piece. A
    sort over all files would shuffle the texts once more.
    """
    rows = _numbered(spark, docs)
    pieces = mixing.mix(rows, id_column="row").pieces
    mixed = pieces.groupBy(F.col("id").alias("taken_row"), "pass_no").agg(F.sum("length").alias("words"), F.min("position").alias("position"))
    both = shuffle_join(rows, mixed, rows["row"] == mixed["taken_row"])
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") == mixing.word_count(F.col("text")), F.col("text")).otherwise(part)
    made = both.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return made.sortWithinPartitions("position", "taken_row", "pass_no").select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("secrets", cut_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# Trained models and packing cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
