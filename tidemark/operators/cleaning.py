"""Schema, projection and value cleaning. Every function is one narrow ``select``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import epoch_seconds, parse_post_time, to_json_string
from ..schemas import COERCE_RULES, DEFAULT_RULES, DROP_COLUMNS

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def quoted(name: str) -> Column:
    """Column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _present_as_is(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Replace or append columns in one projection."""
    kept = [new[c].alias(c) if c in new else quoted(c) for c in df.columns]
    return df.select(*kept, *[e.alias(c) for c, e in new.items() if c not in df.columns])


def fill_expected_columns(
    df: DataFrame, rules: Sequence[tuple[str, T.DataType, object]] = DEFAULT_RULES
) -> DataFrame:
    """Add each expected column that is missing, with its typed default."""
    return df.select(
        *[quoted(c) for c in df.columns],
        *[F.lit(default).cast(t).alias(name) for name, t, default in rules if name not in df.columns],
    )


def drop_columns(df: DataFrame, names: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*names)


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in sorted(df.columns)])


def coerce_columns(df: DataFrame, rules: Mapping[str, str] = COERCE_RULES) -> DataFrame:
    """Bring columns to archive form.

    ``json``: JSON text. ``bool``: null becomes false. ``id``: null becomes 0, as bigint.
    ``string``: text. ``keep``: untouched. Columns without a rule keep atomic types; nested ones
    become JSON text.
    """
    out = {}
    for field in df.schema.fields:
        c, rule = quoted(field.name), rules.get(field.name)
        if rule == "json":
            out[field.name] = to_json_string(c)
        elif rule == "bool":
            out[field.name] = F.coalesce(c, F.lit(False))
        elif rule == "id":
            out[field.name] = F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
        elif rule == "string":
            out[field.name] = c.cast("string")
        elif rule is None and isinstance(field.dataType, _NESTED):
            out[field.name] = F.to_json(c)
        elif rule is None and isinstance(field.dataType, T.NullType):
            out[field.name] = c.cast("string")
    return _present_as_is(df, out)


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Project to the schema's columns and order; returns the names of dropped extras.

    A missing column or a type that cannot be stored safely is an error.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    wanted = set(schema.fieldNames())
    return df.to(schema), [c for c in df.columns if c not in wanted]


def make_serializable(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Turn what a format cannot hold into text; columns without a type are dropped."""
    text_only = ("quote_url", "place")
    out = []
    for field in df.schema.fields:
        c = quoted(field.name)
        if isinstance(field.dataType, T.NullType):
            continue
        nested = isinstance(field.dataType, _NESTED)
        if nested and (fmt == "csv" or field.name in text_only):
            c = F.to_json(c)
        elif isinstance(field.dataType, T.BinaryType) and fmt == "csv":
            c = F.base64(c)
        elif field.name in text_only or isinstance(
            field.dataType, (T.DayTimeIntervalType, T.YearMonthIntervalType)
        ):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def rename_status_ids(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"id": "status_id", "id_str": "status_id_str"})


# Registry headers that change beyond lower case and underscores.
TRIAL_RENAMES = {"trialid": "trial_id", "web_address": "study_url"}


def normalize_headers(df: DataFrame, renames: Mapping[str, str] = TRIAL_RENAMES) -> DataFrame:
    """Lower case, blanks to underscores, then the given renames."""
    plain = [c.replace(" ", "_").lower() for c in df.columns]
    return df.toDF(*[renames.get(c, c) for c in plain])


def drop_columns_matching(df: DataFrame, pattern: str = "unnamed") -> DataFrame:
    """Drop columns whose name contains the pattern, whatever its case."""
    found = re.compile(pattern, re.IGNORECASE)
    return df.select(*[quoted(c) for c in df.columns if not found.search(c)])


def fill_blank(df: DataFrame) -> DataFrame:
    """Every value as text, nulls as ``''``."""
    return df.select(
        *[
            F.coalesce(
                F.to_json(quoted(f.name)) if isinstance(f.dataType, _NESTED)
                else quoted(f.name).cast("string"),
                F.lit(""),
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )


def project_properties(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """The requested columns, or all when none are named."""
    return df.select(*[quoted(c) for c in cols]) if cols else df


def clean_datetimes(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Parse the time text and add ``created_date`` in epoch seconds."""
    parsed = parse_post_time(quoted(col))
    return _present_as_is(df, {col: parsed, "created_date": epoch_seconds(parsed)})
