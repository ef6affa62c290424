"""Training-data pipeline over ``documents``: each stage's output is written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return
the columns of ``documents``. Models are learned from the documents that the stage gets.

Defined cases of all stages: an empty table gives an empty one; other columns are kept as they are (the last stage
returns its own); a very long text is handled whole, as a slice of its own inside its task; ties are broken by doc_id
and then by text. What each stage makes of nulls and repeated rows is said at the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import jaccard, language, pii
from kiln.llm.bpe import bpe_encode
from kiln.llm.common import Workspace, read_table
from kiln.llm.decontaminate import remove_contamination


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters (``und``), or in no learned language, go; a missing ``lang`` gets the prediction.

    A null text goes; repeated rows are judged alike. The least score accepted is half of what nearly all learned
    documents reach, so clean documents stay.
    """
    return language.keep_languages(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by n-gram Jaccard similarity the one with the least doc_id stays.

    Repeated rows are one document; different texts under one doc_id are documents of their own; rows without doc_id
    come after all others; a null text is empty.
    """
    return jaccard.one_of_each(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items leave the texts, those of items without an id too.

    A null text stays null; repeated rows are cut alike; a document that is a passage whole stays with what is left.
    """
    return _recounted(remove_contamination(docs, read_table(spark, sf_dir, "benchmark")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes placeholders. A null text stays null; repeated rows are treated alike."""
    return _recounted(pii.redact(docs, pii.learn(docs)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids and decoded bytes of every document kept. A null text is empty; repeated rows stay."""
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminate), ("PII", redact), ("byte-level BPE", encode)]

#: the stages use trained models, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
