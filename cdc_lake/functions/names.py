"""Column names: accents off, separators to underscores, lower case."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


def normalize_name(name: str) -> str:
    letters = (c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn")
    return re.sub("[ ']", "_", "".join(letters)).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column in one projection; two names that become equal are an error."""
    names = [normalize_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalization: {clashes}")
    return df.toDF(*names)
