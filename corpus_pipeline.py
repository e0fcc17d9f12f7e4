"""A corpus from raw documents to token files, each stage one of the operators.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns what it keeps of
``docs`` with the columns of documents, the last one the digests of the written tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from provtrail.llm import decontaminate, jaccard, mixing, tokens, toxicity
from provtrail.session import materialize, work_dir
from provtrail.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit the lexicon on the labelled documents and drop what it rejects.

    Null and empty texts score 0 and stay; repeated rows are judged alike; rows without an id have no
    label but are judged; without labels of both classes, or with no documents, nothing is dropped.
    """
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id.

    Texts without words are linked with nothing and stay; rows that repeat an id all stay or none.
    """
    return jaccard.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain benchmark windows.

    Null and empty texts and rows without an id stay or go by their text alone; a benchmark without
    rows drops nothing.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lay the documents out in the order of the mixture; none is dropped.

    A null source is a source; rows of one id, or of none, have a place each; ties go by row.
    """
    return mixing.mixed_order(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the tokens in the order in which the documents are stored, and read them back.

    Null and empty texts are the end id alone; repeated rows and rows without an id are written each.
    Files are in the order of their numbers, however many digits these have.
    """
    path = f"{work_dir(spark)}/provtrail/tokens-{uuid.uuid4().hex}"
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long")
    stored = docs.select(
        "doc_id", "text", number.alias("_part"), name.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    tokens.write_tokens(stored, path, order=("_part", "_file", "_row"), chunk_ids=1 << 17, remembered=50_000)
    return tokens.read_digests(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]

#: Trained weights and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one keeps is written and read again by the next.

    Columns beyond those of documents go along, whatever their names, until the last stage; no documents
    give no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
