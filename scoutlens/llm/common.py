"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import materialize

__all__ = ["fold_of", "materialize", "text_of", "with_key"]


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (a null key counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def text_of(text: str) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def with_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only (key, text), under fixed names, so that further columns cannot clash."""
    return df.select(F.col(key).alias("key"), text_of(text).alias("text"))
