"""From the documents table to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, lines, neardup, packing, toxicity
from tidemark.llm.common import RID, numbered
from tidemark.llm.queries import table, tokenizer_path
from tidemark.operators.sizes import broadcast_if, fits_broadcast
from tidemark.workspace import Workspace

ROW = "__row"


def _without(rows: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` whose number is not in ``dropped``."""
    small = fits_broadcast(dropped, rows)
    return rows.join(broadcast_if(dropped, small), ROW, "left_anti").select(*columns)


def _rows(docs: DataFrame, workspace: Workspace) -> DataFrame:
    return numbered(docs, "doc_id", "text", workspace).withColumnRenamed(RID, ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model).filter("__score < 0.5").drop("__score")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share stay in the first of them only; every document stays."""
    left = lines.drop_repeated_lines(docs, Workspace(spark), min_documents=10, keep_first=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.length("text").cast(kind))
    return left.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    workspace = Workspace(spark)
    rows = _rows(docs, workspace)
    found = neardup.near_duplicates(rows, workspace, id_col=ROW)
    dropped = workspace.store(found.filter("not kept").select(ROW), "dropped")
    return _without(rows, dropped, docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    workspace = Workspace(spark)
    rows = _rows(docs, workspace)
    found = decontaminate.contained_items(rows, table(spark, sf_dir, "benchmark"), id_col=ROW)
    dropped = workspace.store(found.select(ROW).distinct(), "contaminated")
    return _without(rows, dropped, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack(docs, Workspace(spark), tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer are part of it, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workspace.store(stage(spark, docs, sf_dir), name)
    return docs
