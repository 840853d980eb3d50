"""pandas UDFs for rules that follow Python's Unicode tables."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import text


def lexical(surface: str) -> str:
    """NFC without edge characters that are neither letters, digits nor marks."""
    word = unicodedata.normalize("NFC", surface)
    inner = [i for i, c in enumerate(word) if c.isalnum() or unicodedata.category(c).startswith("M")]
    return word[inner[0] : inner[-1] + 1] if inner else ""


@F.pandas_udf(StringType())
def slug(values: pd.Series) -> pd.Series:
    return values.map(text.slug, na_action="ignore")


@F.pandas_udf(StringType())
def lexical_surface(values: pd.Series) -> pd.Series:
    return values.map(lexical, na_action="ignore")


@F.pandas_udf(StringType())
def plain_text(values: pd.Series) -> pd.Series:
    return values.map(text.plain, na_action="ignore")
