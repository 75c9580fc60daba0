"""Corpus pipeline: five stages of training-data preparation over `documents`, each on all that its predecessor kept.

The first four stages return the columns of documents and keep clean documents: a stage drops documents of low quality (score
under 0.3), lines that a document with a smaller doc_id holds too, all but the first of each group of near copies (shingles of five
words, a similarity of 0.8 or more: wide fingerprints find candidates, shingles prove those near the border), and documents that hold a passage of the benchmark. The last
gives each piece of a document its place in a training sequence. n_chars follows the text. SQL cannot express the chain (trees, fingerprints, tokens); tests/llm hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.llm import decontaminate, line_dedup, near_copies, packing, quality
from runscope.llm.queries import table, tokenizer_file
from runscope.llm.shared import beside_text, landed

ORACLE_SQL = None


def with_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The columns of docs from rows (row: the document, kept: its new text as binary)."""
    text = F.decode("kept", "UTF-8")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated(docs, line_dedup.LineStore.of(docs), *beside_text(docs, "text"))
    return with_text(docs, rows)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
