"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .money import is_money, money_ratio


def normalized_region(region: Column, location: Column, split_region: str) -> Column:
    """Region of a ledger line: for the split region, the first comma part of
    the location name (NULL location gives NULL); otherwise the region itself."""
    return F.when(region == F.lit(split_region), F.split_part(location, F.lit(","), F.lit(1))).otherwise(
        region
    )


def canonical_id(value: Column, dtype: T.DataType) -> Column:
    """Id as integer text: integral ids print as they are; decimal, floating or
    text ids go through a rounded integer first ('123.0' -> '123')."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("string")
    return F.round(value.cast("decimal(38,6)"), 0).cast("bigint").cast("string")


def deal_key(df: DataFrame, id_col: str = "deal_id", fallback_col: str = "deal_line_id") -> Column:
    """Deal id falling back to the deal line id, canonicalised to integer text."""
    a, b = df.schema[id_col].dataType, df.schema[fallback_col].dataType
    common = a if a == b else T.StringType() if isinstance(a, T.StringType) or isinstance(b, T.StringType) else T.DecimalType(38, 6)
    return canonical_id(F.coalesce(F.col(id_col).cast(common), F.col(fallback_col).cast(common)), common)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two money amounts (cents) as doubles, NULL on a zero
    denominator instead of failing or infinity."""
    return money_ratio(numerator, denominator)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def money_to_double(df: DataFrame) -> DataFrame:
    """Presentation of the registered queries: money in cents and decimal amounts
    become doubles."""
    def out(f: T.StructField) -> str:
        q = _quote(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return f"CAST({q} AS DOUBLE) AS {q}"
        if isinstance(f.dataType, T.IntegralType) and is_money(f.name):
            return f"{q} / 100.0D AS {q}"  # double literal: '100.0' alone is a decimal in SQL
        return q

    return df.selectExpr(*[out(f) for f in df.schema.fields])


def money_to_decimal(df: DataFrame) -> DataFrame:
    """Money as the sinks write it: every amount as ``decimal(38,2)``."""
    def out(f: T.StructField) -> str:
        q = _quote(f.name)
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale <= 2:
            return f"CAST({q} AS DECIMAL(38,2)) AS {q}"
        if isinstance(f.dataType, T.IntegralType) and is_money(f.name):
            return f"CAST(CAST({q} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(38,2)) AS {q}"
        return q

    return df.selectExpr(*[out(f) for f in df.schema.fields])


def fill_numeric_zero(df: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """NULL -> 0 for every numeric column, or for the ``only`` columns (strings
    and dates keep NULL)."""
    return df.selectExpr(
        *[
            f"COALESCE({_quote(f.name)}, CAST(0 AS {f.dataType.simpleString()})) AS {_quote(f.name)}"
            if isinstance(f.dataType, T.NumericType) and (only is None or f.name in only)
            else _quote(f.name)
            for f in df.schema.fields
        ]
    )
