"""Row predicates and mappings over single columns."""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants as K
from paperloom.functions.text import strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def field_group(name: Column) -> Column:
    """Field group of a field name; unknown names belong to the default group."""
    mapped = F.lit(None).cast("string")
    for group, fields in K.GROUP_FIELDS.items():
        mapped = F.when(name.isin(*fields), F.lit(group)).otherwise(mapped)
    return F.coalesce(mapped, F.lit(K.DEFAULT_GROUP))


def is_accepted(flag: Column) -> Column:
    """A row without a verdict counts as accepted."""
    return F.coalesce(flag, F.lit(True))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(is_accepted(F.col("quality.accepted")))


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(~is_accepted(F.col("quality.accepted")))


def is_pending(path: Column, root: str) -> Column:
    """True when the first folder below the labelled root is the pending one."""
    prefix = root.rstrip("/") + "/" + K.PENDING_REVIEW
    return path.startswith(prefix + "/") | (path == prefix)


def mask_text(col: Column) -> Column:
    """Hide nine-digit tax numbers: first ddd-dd-dddd, then dd-ddddddd."""
    hidden = F.regexp_replace(col, r"(?U)\b\d{3}-\d{2}-\d{4}\b", "***-**-****")
    return F.regexp_replace(hidden, r"(?U)\b\d{2}-\d{7}\b", "**-*******")


def _masked(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return mask_text(col)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _masked(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: _masked(v, kind.valueType))
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(*[_masked(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), rebuilt)
    return col


def mask(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mask every string at any depth of the chosen columns (all by default)."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[_masked(F.col(f.name), f.dataType).alias(f.name) if f.name in chosen else F.col(f.name)
          for f in df.schema.fields]
    )


def valid_tin(col: Column) -> Column:
    return F.coalesce(strip(col).rlike(r"(?U)\A(?:\d{3}-\d{2}-\d{4}|\d{2}-\d{7})\z"), F.lit(False))


def plausible_date(col: Column) -> Column:
    """A short number, a four-digit number and an English month as a word."""
    months = "|".join(K.MONTHS)
    found = (
        col.rlike(r"(?U)\d{1,2}") & col.rlike(r"(?U)\d{4}") & col.rlike(rf"(?iuU)\b(?:{months})\b")
    )
    return F.coalesce(found, F.lit(False))


@F.pandas_udf(T.StringType())
def _compose(text: pd.Series) -> pd.Series:
    return text.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")


def nfc(col: Column) -> Column:
    """Composed Unicode form.  Spark has no such function, hence Arrow batches; see :func:`with_nfc`."""
    return _compose(col)


def with_nfc(df: DataFrame, column: str, into: str) -> DataFrame:
    """Add the composed form of ``column``; the worker gets null for ASCII-only rows."""
    plain = F.col(column).isNull() | F.col(column).rlike(r"\A\p{ASCII}*\z")
    return df.withColumn(into, F.coalesce(F.when(plain, F.col(column)), nfc(F.when(~plain, F.col(column)))))
