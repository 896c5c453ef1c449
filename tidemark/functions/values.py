"""Value conversions: times, JSON, and the legacy text form of nested values."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value" in legacy archives.
NULL_TEXTS = ("None", "nan", "")


def epoch_seconds(c: Column) -> Column:
    return F.unix_micros(c) / F.lit(1e6)


def millis_to_timestamp(c: Column) -> Column:
    return F.timestamp_millis(c.cast("bigint"))


def parse_post_time(c: Column) -> Column:
    """``Wed Oct 10 20:19:24 +0000 2018`` or ISO text to a timestamp; unreadable text gives null."""
    text = c.cast("string")
    return F.coalesce(
        F.try_to_timestamp(F.substring(text, 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy")),
        text.try_cast("timestamp"),
    )


def to_json_string(c: Column, nan_is_null: bool = False) -> Column:
    """JSON text of any value; scalars pass through a one-element array.

    ``nan_is_null`` is for floating-point columns, where a NaN has no JSON form.
    """
    value = F.when(~F.isnan(c), c) if nan_is_null else c
    boxed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.when(value.isNotNull(), F.substring(boxed, F.lit(2), F.length(boxed) - 2))


def _literal_to_json(text: str | None) -> str:
    try:
        value = ast.literal_eval(text)
        return json.dumps({str(k): v for k, v in value.items()})
    except (ValueError, SyntaxError, TypeError, AttributeError, MemoryError, RecursionError):
        return "{}"


@F.pandas_udf(T.StringType())
def _repr_to_json(texts: pd.Series) -> pd.Series:
    # Shared posts repeat the same text, so each text of a batch is read once.
    codes, distinct = pd.factorize(texts, use_na_sentinel=False)
    return pd.Series([_literal_to_json(t) for t in distinct], dtype=object).take(codes).reset_index(drop=True)


def parse_repr_struct(c: Column, schema: T.StructType) -> Column:
    """Text of a Python literal to a struct; unreadable text gives a struct of nulls.

    The only Python function of the package. JSON readers reject ``None``, ``True`` and mixed
    quotes, so legacy archives go through the literal reader, one Arrow batch at a time.
    """
    return F.from_json(_repr_to_json(c), schema)
