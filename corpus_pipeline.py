"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage as Parquet
in the shared folder and reads it back as the next one's input.

Edge cases are those of the operators: nulls, empty tables and repeated rows
pass through the stages as their docstrings say. SQL cannot express the
learned, hashed and drawn stages, so there is no SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontam, lines, mixing, simhash, toxicity
from ledgerlake.llm.common import fresh, materialize, prepare, table

ORACLE_SQL = None


def _only(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents not scored as toxic (0.5 or more)."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return _only(scored.where(F.col(fresh(docs.columns, "toxicity")) < 0.5), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that occurred earlier; n_chars follows.

    A document whose last word went with such a run is a copy and goes too; one
    that never had a word stays.
    """
    counts = fresh(docs.columns, "line_counts")
    d = lines.dedup_lines(docs)
    removed = F.col(counts)["n_removed"] > 0
    d = d.where(~removed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return d.select(*[F.when(removed, F.length("text")).otherwise(F.col("n_chars"))
                      .cast(docs.schema["n_chars"].dataType).alias("n_chars")
                      if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return _only(found.where(F.size(fresh(docs.columns, "items")) == 0), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: blocks of words with the documents they come from."""
    return mixing.mix_documents(spark, docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash", dedup_near),
          ("decontamination", drop_contaminated), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{i + 1}-{name.replace(' ', '-')}")
    return docs
