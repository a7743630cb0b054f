"""The corpus pipeline: quality rules, exact dedup, near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and
returns documents again; the last returns the packed pieces. ``run`` writes each stage's result
to the shared folder and reads it back, so a lost executor costs one stage's work at most; a
stage's table is deleted once the next one is written, and with it what its operators wrote.

Null texts count as empty, and the quality rules reject them, as they do texts of few words. Texts
of any length are handled whole. Rows are what is kept or dropped: where ids repeat or are null,
rows are told apart by a number, so one text of each group stays, whatever its id. Of documents
with different ids the smallest id stays. No documents give no rows. Columns beside those of
COLUMNS aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import exact_dedup, near_dedup, packing, quality_rules, queries, secret_scans
from tagweave.llm.common import discard, materialize, written_tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _restored(judged: DataFrame) -> DataFrame:
    return judged.select(*[F.col(f"kept_{c}").alias(c) for c in COLUMNS])


def _kept_by(docs: DataFrame, operator: Callable[..., DataFrame], **how: int) -> DataFrame:
    """The rows that ``operator`` keeps. Rows are known by doc_id; where ids repeat or are null, by a number."""
    docs, key = docs.select(*COLUMNS), "doc_id"
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        docs, key = materialize(docs.withColumn("row_number", F.monotonically_increasing_id()), "numbered"), "row_number"
    gone = operator(docs, id_column=key, **how).where("not kept").select(F.col("doc_id").alias("gone"))
    return docs.join(gone, F.col(key) == F.col("gone"), "left_anti").select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that the rules remove."""
    judged = quality_rules.judge(docs, keep=COLUMNS, cleaned=True).where("kept")
    shorter = F.col("n_lines_removed") > 0
    chars = F.when(shorter, F.length("cleaned").cast("long")).otherwise(F.col("kept_n_chars"))
    return _restored(judged.withColumns({"kept_text": F.when(shorter, F.col("cleaned")).otherwise(F.col("kept_text")), "kept_n_chars": chars}))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _kept_by(docs, exact_dedup.exact_dedup)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return _kept_by(docs, near_dedup.near_dedup, width=5)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    found = secret_scans.scan(docs, keep=COLUMNS)
    whole = F.when(F.size("found") == 0, F.col("kept_text")).otherwise(secret_scans.redacted())
    chars = F.when(F.size("found") == 0, F.col("kept_n_chars")).otherwise(F.length(secret_scans.redacted()).cast("long"))
    return _restored(found.withColumns({"kept_text": whole, "kept_n_chars": chars}))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(docs, queries.tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("secret scans", hide_secrets),
    ("packing", pack_sequences),
]
#: Packing and near-dedup can't be put in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for n, (_, stage) in enumerate(STAGES[:-1]):
        with written_tables() as tables:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{n}")
        discard(*last, *tables[:-1])  # what the operators wrote for this stage, and the stage before
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
