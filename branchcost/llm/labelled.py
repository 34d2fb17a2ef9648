"""Bounded samples of labelled rows for fitting the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(modulus))


def training_ids(labels: DataFrame, label_col: str, train: Column, per_class: int, id_col: str = "doc_id"):
    """(DataFrame of id, label; {label: share of all training labels / share of the sample}).

    At most `per_class` ids of each class, in an order that depends on the
    id only. An id with several labels takes the largest; rows without an
    id or label are unlabelled. The weights undo the sampling, so scores
    keep the shares of the whole training set.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train)
        .groupBy(F.col(id_col).alias("train_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("train_label"))
    )
    counts = {r["train_label"]: r["n"] for r in known.groupBy("train_label").agg(F.count("*").alias("n")).collect()}
    parts = [
        known.where(F.col("train_label") == y).orderBy(F.xxhash64("train_id"), "train_id").limit(per_class)
        for y in (0, 1)
    ]
    taken = {y: min(per_class, counts.get(y, 0)) for y in (0, 1)}
    weights = {y: counts.get(y, 0) / taken[y] if taken[y] else 0.0 for y in (0, 1)}
    return parts[0].unionByName(parts[1]), weights
