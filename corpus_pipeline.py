"""Preparing a training corpus: five stages over `documents`.

`STAGES` lists them in order; each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's
docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchcost.llm import decontaminate, mixing, near_dup, secrets, toxicity
from branchcost.llm.common import stage_table, table
from branchcost.llm.labelled import hash_remainder
from branchcost.session import ensure_checkpoint_dir, ship_package


#: Threshold of the near-duplicate stage; that of op7 (85) is the query's own.
NEAR_PERCENT = 80


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _measured(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """`changed` with the length of its texts in `n_chars`, if `docs` has that column."""
    if "n_chars" not in docs.columns:
        return changed
    n = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled rows of `docs`."""
    _ready(spark)
    train = hash_remainder(F.col("doc_id"), 5) != 0
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"), train)
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (0.8 or more) stays, the one with the smallest id; every text of an id counts."""
    _ready(spark)
    return near_dup.drop_near_duplicates(docs, percent=NEAR_PERCENT, one_per_id=False)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark passages go."""
    _ready(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays, `n_chars` follows the text."""
    _ready(spark)
    return _measured(secrets.mask_secrets(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken, texts cut at their source's target."""
    _ready(spark)
    return _measured(mixing.mixed_documents(docs), docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: The learned and verified stages have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage_table(docs, f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
