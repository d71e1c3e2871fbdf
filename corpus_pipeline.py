"""The corpus pipeline: language ID, near-duplicates, repeated passages, personal data, packing.

Every stage reads the rows that the stage before it kept, takes only the columns of ``documents`` from them (others, of
whatever name, are left out), and all but the last return these columns. A stage on an empty table returns an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import dart, langid, packing, pii, repeats
from tradeloom.llm.common import small_batches
from tradeloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Posterior below which a language is a guess.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an undetermined language go: null texts, texts without a letter, and guesses. A language that was
    null is filled in. Repeated rows are judged one by one."""
    small_batches(spark)
    docs = docs.select(COLUMNS)
    model = langid.train(docs.where(~langid.held_out()))
    told = langid.with_language(docs, model, names=("told", "score"))
    sure = told.where((F.col("told") != "und") & (F.col("score") >= LEAST_SCORE))
    return sure.withColumn("lang", F.coalesce("lang", "told")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays. Rows that share an id are one document and
    stay or go together; rows with a null id stay; so do documents without words."""
    small_batches(spark)
    docs = docs.select(COLUMNS)
    classes = dart.near_duplicates(docs.where("doc_id is not null"))
    copies = classes.where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat 50 bytes of a smaller document go, and with them what they leave of a character that they cut.
    A document of which nothing is left goes; one that was empty or null before stays."""
    small_batches(spark)
    docs = docs.select(COLUMNS)
    cut = repeats.repeats(docs, carry=("lang", "source"))
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    whole = F.when(text.isNotNull(), text).otherwise(F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("�"), F.lit("")))
    kept = cut.where((F.col("n_removed") == 0) | (F.length("kept") > 0)).withColumn("text", whole)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind in angle brackets. No document goes; null texts stay null."""
    small_batches(spark)
    docs = docs.select(COLUMNS)
    found = materialize(pii.find(docs), "pii-candidates")
    clean = pii.redacted(docs, pii.learn(found))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bucket and the batch of every document that is left."""
    return packing.pack(docs.select(COLUMNS), packing.word_count(F.col("text")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Languages, signatures and passages are not for SQL; tests compare with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
