"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the
next stage's docs. All but the last return the columns of ``documents``. Rows whose id is null pass the stages
that decide by id; extra columns are carried along up to the last stage. The stages hand whole documents to Python
workers, ``ARROW_ROWS`` at a time unless the session sets another number than Spark's default, because a batch is
held several times over on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.llm.bpe import encode_digests
from histora.llm.common import fresh, rows_without_ids, stored, table
from histora.llm.decontaminate import contaminated
from histora.llm.langid import held_out, language_of, train_model
from histora.llm.near_dup import near_duplicates
from histora.llm.pii import checked

ARROW_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH) == "10000":      # Spark's default
        spark.conf.set(_BATCH, str(ARROW_ROWS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the models accept as one of the learned languages; a missing language is filled in."""
    small_batches(spark)
    model = train_model(docs.where(~held_out()).select("lang", "text"))
    own = fresh(docs.columns, "language")
    found = docs.withColumn(own, language_of(F.col("text"), model, spark))
    kept = found.where(~found[own]["rejected"])
    return kept.select(*[F.coalesce(kept["lang"], kept[own]["lang_pred"]).alias("lang") if c == "lang" else kept[c]
                         for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies."""
    small_batches(spark)
    dropped = stored(near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    return rows_without_ids(docs, dropped)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    small_batches(spark)
    leaks = stored(contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "pipeline-leaks")
    return rows_without_ids(docs, leaks)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; the character count follows the text."""
    small_batches(spark)
    out = checked(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in out.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    small_batches(spark)
    import public_tokenizers

    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii_surrogates", replace_private),
    ("byte_bpe", encode),
]

#: Not expressible in SQL (language models, latent search, keyed surrogates, byte pairs).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
