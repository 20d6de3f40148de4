"""From raw documents to token ids: quality, near duplicates, secrets, mixing, pieces.

Every stage takes all rows that its predecessor kept and writes its own to the shared
folder, so that a lost executor costs part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm import quality, secrets
from loomframe.llm.common import kept
from loomframe.llm.lsh_forest import representatives
from loomframe.llm.mixing import take
from loomframe.llm.queries import PIECES
from loomframe.llm.segmentation import encode_texts


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among them.

    Null and empty texts get the score of a text without words, like any other row.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.score_quality(docs, model).where("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of every group of near duplicates (five-word shingles, similarity 0.8), that of the smallest id.

    Repeated rows become one; different texts of one id are documents of their own; rows without an id all stay.
    """
    return representatives(docs, size=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and ``n_chars`` to match; null texts stay null."""
    scanned = secrets.scan(docs, secrets.fit(secrets.labelled_findings(spark)))
    changed = ~F.col("redacted").eqNullSafe(F.col("text"))
    n_chars = F.when(changed, F.length("redacted")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return scanned.withColumn("n_chars", n_chars).withColumn("text", F.col("redacted")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that sources meet their target weights."""
    return take(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The numbers of the pieces of every document, the scores of its best segmentations, and whether they restore it."""
    encoded = encode_texts(docs, PIECES, n=3, decoded=True)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        F.col("nbest.score").alias("nbest_scores"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("restored"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("pieces", to_pieces),
]

#: SQL has no counterpart of the classifier, the forests and the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
