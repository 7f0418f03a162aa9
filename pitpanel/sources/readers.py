"""Readers: typed CSV, Parquet tables, statement payloads, series alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions.columns import nan_to_null


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, dates: Sequence[str] = (),
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a header and a declared schema; date columns are parsed, bad values become NULL."""
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in typed.fields
    ])
    df = spark.read.schema(raw).option("header", True).csv(path)
    return nan_to_null(df.withColumns({c: F.try_to_timestamp(c, F.lit(date_format)).cast("date") for c in dates}))


# fixed values: statement columns and the payload keys that may hold them, in order of preference
INCOME_FIELDS = {
    "Revenue": ["totalRevenue", "revenue"], "Net_Income": ["netIncome"], "Gross_Profit": ["grossProfit"],
    "Operating_Income": ["operatingIncome"], "EBITDA": ["ebitda"], "EPS": ["reportedEPS", "eps"],
}
BALANCE_FIELDS = {
    "Total_Assets": ["totalAssets"], "Total_Liabilities": ["totalLiabilities"],
    "Total_Equity": ["totalShareholderEquity", "totalEquity"], "Current_Assets": ["totalCurrentAssets", "currentAssets"],
    "Current_Liabilities": ["totalCurrentLiabilities", "currentLiabilities"], "Long_Term_Debt": ["longTermDebt"],
    "Short_Term_Debt": ["shortTermDebt"], "Cash": ["cashAndCashEquivalentsAtCarryingValue", "cashAndCashEquivalents"],
}


def first_key(*keys: Column) -> Column:
    """The first payload value that is neither missing nor empty."""
    return F.coalesce(*[F.nullif(k, F.lit("")) for k in keys])


def statement_rows(payloads: DataFrame, entity: str, payload: str, fields: Mapping[str, Sequence[str]],
                   date_keys: Sequence[str] = ("fiscalDateEnding", "date"),
                   list_key: str = "quarterlyReports") -> DataFrame:
    """One row per report of a JSON payload; ``fields`` maps a column to its alternative JSON keys.

    Values that are no number and dates that do not parse become NULL.
    """
    keys = [*date_keys, *[k for ks in fields.values() for k in ks]]
    report = T.StructType([T.StructField(k, T.StringType()) for k in dict.fromkeys(keys)])
    schema = T.StructType([T.StructField(list_key, T.ArrayType(report))])
    parsed = payloads.select(entity, F.explode(F.from_json(payload, schema)[list_key]).alias("r"))
    date = first_key(*[F.col(f"r.{k}") for k in date_keys])
    return parsed.select(
        F.col(entity), F.to_date(F.try_to_timestamp(date)).alias("dt"),
        *[first_key(*[F.col(f"r.{k}") for k in ks]).try_cast("double").alias(name) for name, ks in fields.items()],
    )


def balance_ratios(df: DataFrame, liabilities: str, equity: str, current_assets: str,
                   current_liabilities: str) -> DataFrame:
    """Debt to equity and current ratio; a zero denominator counts as one."""
    def one_if_zero(c: str) -> Column:
        return F.when(F.col(c) == 0, F.lit(1.0)).otherwise(F.col(c))

    return df.withColumns({
        "debt_to_equity": F.col(liabilities) / one_if_zero(equity),
        "current_ratio": F.col(current_assets) / one_if_zero(current_liabilities),
    })


def tag_entities(df: DataFrame, key: str, dimension: DataFrame, columns: Sequence[str],
                 fallbacks: Mapping[str, str] = {}) -> DataFrame:
    """Project price columns and attach the entity attributes of a dimension table.

    ``fallbacks`` names the column to use where the source lacks one (decided by schema, not by row).
    """
    picked = [F.col(c if c in df.columns else fallbacks[c]).alias(c) for c in columns if c in df.columns or c in fallbacks]
    return df.select(key, *picked).join(dimension, key, "left")


def align_series(long: DataFrame, date: str, series: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long observations to one row per date and one column per series; NULL where none exists."""
    return long.groupBy(date).pivot(series, list(names)).agg(F.first(value))


def skip_processed(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not processed before."""
    return df.join(processed.select(key), key, "left_anti")
