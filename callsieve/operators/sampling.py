"""Seeded samples, orders, splits and folds that do not change with partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import hash_numbered, hash_order


def sample_n(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows first in hash order."""
    return df.orderBy(hash_order(id_col, seed), id_col).limit(n)


def head_n(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def shuffled(df: DataFrame, id_col: str, seed: int, digits: int = 3) -> DataFrame:
    """Add each row's position in a seeded random order."""
    return hash_numbered(df, [], id_col, seed, "position", digits)


def stratified(df: DataFrame, label: str, id_col: str, seed: int, digits: int = 3) -> DataFrame:
    """Add the row's hash position within its label and the label's size."""
    sizes = df.groupBy(label).agg(F.count("*").alias("label_rows"))
    return hash_numbered(df, [label], id_col, seed, "label_position", digits).join(sizes, label)


def split_name(shares: list[tuple[str, float]]) -> Column:
    """Split by position within the label: the first share of rows gets the first name, and so on."""
    done, chain = 0.0, None
    for name, share in shares[:-1]:
        done += share
        test = F.col("label_position") <= F.round(F.col("label_rows") * done)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return F.lit(shares[-1][0]) if chain is None else chain.otherwise(shares[-1][0])


def stratified_split(df: DataFrame, label: str, id_col: str, shares: list[tuple[str, float]], seed: int = 42) -> DataFrame:
    return (stratified(df, label, id_col, seed).withColumn("split", split_name(shares))
            .drop("label_position", "label_rows"))


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    return (stratified(df, label, id_col, seed)
            .withColumn("fold", ((F.col("label_position") - 1) % k).cast("int"))
            .drop("label_position", "label_rows"))
