"""Scalar expressions: labels, tokens, sizes, states, times."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillvec import model as M


def namespace_label(namespace: Column) -> Column:
    return F.when(namespace == M.DEFAULT_NAMESPACE, M.DEFAULT_NAMESPACE_LABEL).otherwise(namespace)


def to_token(namespace: Column) -> Column:
    taken = F.raise_error(F.lit(f"the namespace name {M.DEFAULT_TOKEN} is reserved")).cast("string")
    return F.when(namespace == M.DEFAULT_NAMESPACE, M.DEFAULT_TOKEN) \
        .when(namespace == M.DEFAULT_TOKEN, taken).otherwise(namespace)


def from_token(token: Column) -> Column:
    return F.when(token == M.DEFAULT_TOKEN, M.DEFAULT_NAMESPACE).otherwise(token)


def megabytes(size: Column) -> Column:
    return size / F.lit(float(M.BYTES_PER_MB))


def is_import_done(status: Column) -> Column:
    return F.coalesce(status.isin(*M.IMPORT_TERMINAL), F.lit(False))


def is_backup_done(status: Column) -> Column:
    return F.coalesce(status.isin(*M.BACKUP_TERMINAL), F.lit(False))


def percent_text(percent: Column) -> Column:
    return F.when(percent.isNull(), "N/A").otherwise(F.format_string("%.1f%%", percent))


def error_mode(text: Column) -> Column:
    answer = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(answer.startswith("a"), M.ABORT).otherwise(M.CONTINUE)


def backup_name(index: Column, ts: Column) -> Column:
    return F.concat(index, F.lit("-backup-"), F.date_format(ts, "yyyyMMdd-HHmmss"))


def backup_description(index: Column, description: Column) -> Column:
    given = F.trim(F.coalesce(description, F.lit("")))
    return F.when(given != "", given).otherwise(F.concat(F.lit("Backup of "), index))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 on the column's own clock, for either timestamp type."""
    epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def whole_seconds(micros_: Column) -> Column:
    return F.floor(micros_ / 1_000_000)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _float_reprs(values: pd.Series) -> pd.Series:
    """Shortest decimal text of each number; Java 17 does not always print the shortest."""
    return values.map(lambda row: None if row is None else ["None" if x is None else repr(float(x)) for x in row])


def list_preview(values: Column) -> Column:
    """The first numbers and the length of a long list, else the whole list."""
    n = F.size(values)
    long = n > M.PREVIEW_LIST
    shown = _float_reprs(F.when(long, F.slice(values, 1, M.PREVIEW_SHOWN)).otherwise(values).cast("array<double>"))
    joined = F.array_join(shown, ", ")
    return F.when(long, F.concat(F.lit("["), joined, F.lit(", ... ] ("), n.cast("string"), F.lit(" elements)"))) \
        .when(n >= 0, F.concat(F.lit("["), joined, F.lit("]")))


def plain_list_preview(values: Column) -> Column:
    """As ``list_preview``, for a list of anything else, with its elements as text."""
    n = F.size(values)
    long = n > M.PREVIEW_LIST
    shown = F.when(long, F.slice(values, 1, M.PREVIEW_SHOWN)).otherwise(values)
    joined = F.array_join(F.transform(shown, lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ", ")
    return F.when(long, F.concat(F.lit("["), joined, F.lit(", ... ] ("), n.cast("string"), F.lit(" elements)"))) \
        .when(n >= 0, F.concat(F.lit("["), joined, F.lit("]")))


def text_preview(text: Column) -> Column:
    cut = F.concat(F.substring(text, 1, M.PREVIEW_TEXT), F.lit("..."))
    return F.when(F.length(text) > M.PREVIEW_TEXT, cut).otherwise(text)
