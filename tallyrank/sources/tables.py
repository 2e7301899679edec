"""Readers and writers of the labelled-query tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrank import schemas
from tallyrank.sources.csv_records import read_records

FORMATS = ("parquet", "csv")

# Cell contents that a pandas CSV reader takes as missing by default.
PANDAS_MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# RFC 4180: a quote inside a quoted cell is doubled, and such a cell may hold line feeds.
# Blanks belong to the cell. Spark's reader does not split a file with line feeds in cells, so it
# reads a single file in one task; ``splits`` reads byte ranges of it (see csv_records).
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types, whatever integer or text types the file has."""
    schemas.require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.EXAMPLES)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path), schemas.PRODUCTS)


def read_sources(spark: SparkSession, path: str, splits: bool = False) -> DataFrame:
    """A CSV file with a header and unknown columns; every column is read as a string.

    ``splits`` reads large files by many tasks; quotes must then follow RFC 4180.
    """
    # An empty cell is missing, a quoted empty one is the empty text.
    whole = spark.read.options(**_CSV, multiLine=True, nullValue="\0").csv(path)
    if not splits:
        return whole
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _CSV.items()}
    return read_records(spark, path, whole.columns, options | {"nullValue": "\0"})


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")


def read_processed(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    csv_na_compat: bool = False,
    splits: bool = False,
) -> DataFrame:
    """The processed data set, with its required columns checked.

    ``splits`` reads large CSV files by many tasks. ``csv_na_compat`` turns text cells such as ``nan`` or ``null`` into missing values, as
    a pandas reader would.
    """
    _check_format(fmt)
    if fmt == "csv":
        header = read_sources(spark, path, splits)
        schemas.require_columns(header, schemas.PROCESSED.fieldNames())
        kinds = {f.name: f.dataType for f in schemas.PROCESSED.fields}
        df = header.select(*[F.col(c).cast(kinds.get(c, "string")) for c in header.columns])
    else:
        df = spark.read.parquet(path)
        schemas.require_columns(df, schemas.PROCESSED.fieldNames())
    if csv_na_compat:
        for column in ("clean_query", "clean_product_document"):
            missing = F.col(column).isin(*PANDAS_MISSING_WORDS)
            df = df.withColumn(column, F.when(~missing, F.col(column)))
    return df


def write_processed(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Write the processed data set; the folder is created and no index column is added."""
    _check_format(fmt)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.parquet(path)
