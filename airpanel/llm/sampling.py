"""Bounded, repeatable samples of labelled rows, for fitting classifiers only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(name: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 1."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % folds, F.lit(1))


def labelled_ids(labels: DataFrame, label: str, values: tuple, per_value: int, key: str = "doc_id") -> DataFrame:
    """(key, label): at most ``per_value`` ids of each value, those with the smallest hashes; safe to broadcast."""
    order = F.xxhash64(key, F.lit(7))
    parts = [labels.where(F.col(key).isNotNull() & (F.col(label) == F.lit(v))).select(key, label).orderBy(order, key).limit(per_value)
             for v in values]
    return reduce(DataFrame.union, parts)
