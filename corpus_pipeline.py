"""Corpus pipeline: from documents to token ids, in five stages.

Each stage gets all rows that the one before it kept, written as Parquet in the
shared scratch folder and read again.  All stages but the last return the
columns of ``documents``.

1. quality_classifier: documents scored under the threshold go.
2. line_dedup: later occurrences of repeated line windows are cut from the
   texts (n_chars follows); documents that lose all their lines go.
3. ngram_join: one document of each near-duplicate component stays.
4. decontamination: documents contaminated by a benchmark passage go.
5. byte_bpe: token ids of what is left, checked by decoding them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import bpe, decontaminate, line_dedup, ngram_join, quality_crf
from verdant.llm.common import stored, table
from verdant.llm.queries import QUALITY_AT, quality_model, tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality_crf.with_score(docs, model, out="__score")
    return scored.filter(F.col("__score") >= QUALITY_AT).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.strip_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256)"""
    ranks, pattern = tokenizer(spark)
    out = bpe.decode(bpe.encode(docs, ranks, pattern, keep=["doc_id"]), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The classifier and the encoder have no SQL form; tests/llm hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": (run, ORACLE_SQL)}
