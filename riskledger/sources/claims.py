"""Reading claim files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger import constants as K
from riskledger.functions import features as X


#: A quote inside a quoted field is written twice.
QUOTES = {"quote": '"', "escape": '"'}


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(header=True, inferSchema=False, **QUOTES).csv(path).columns


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A claim CSV with every column as text; the usual spellings of "missing" become null.

    Only the header line is looked at to name the columns, so no pass over the data is spent on
    guessing types.  ``multi_line`` reads quoted line breaks; such files cannot be split over tasks.
    """
    names = _header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).options(header=True, multiLine=multi_line, **QUOTES).csv(path)
    return raw.select(*[F.when(~F.col(n).isin(*K.MISSING_TOKENS), F.col(n)).alias(n) for n in names])


def as_typed(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Fixed types for the known columns; other columns stay as they are."""
    known = {n: X.numeric(n) for n in K.NUMERIC}
    known |= {n: X.flag(n, strict) for n in K.FLAGS}
    known[K.TARGET] = F.col(K.TARGET).try_cast("int")
    return raw.withColumns({n: c for n, c in known.items() if n in raw.columns})


def read_typed(spark: SparkSession, path: str, strict: bool = True, multi_line: bool = False) -> DataFrame:
    return as_typed(read_raw(spark, path, multi_line), strict)


def load_and_validate(
    spark: SparkSession,
    history_path: str,
    current_path: str,
    expected_history: int | None = K.EXPECTED_HISTORY_ROWS,
    expected_current: int | None = K.EXPECTED_CURRENT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Read both claim files as text and enforce the input contract."""
    from riskledger.operators.contract import check_inputs, enforce

    history, current = read_raw(spark, history_path), read_raw(spark, current_path)
    enforce(check_inputs(history, current, expected_history, expected_current))
    return history, current
