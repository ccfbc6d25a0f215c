"""Lines of a byte-split file, and their parsing as CSV."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.numbers import strict_double, strict_integer
from txspark.functions.sqltext import ident
from txspark.functions.text import NULL_TOKENS, null_if_token
from txspark.schema import RAW_SCHEMA, missing_columns
from txspark.sources import bytesplit
from txspark.sources.bytesplit import PATTERN, Part, end_offset, read_header, split_header


def register(spark: SparkSession) -> None:
    """Make `format("bytesplit")` known to a session."""
    cloudpickle.register_pickle_by_value(sys.modules[bytesplit.__name__])
    spark.dataSource.register(bytesplit.ByteSplitSource)


def read_lines(
    spark: SparkSession, path: str, pattern: str = PATTERN, **options: object
) -> DataFrame:
    """The data lines of the parts in `path` as `value`, header excluded by position."""
    register(spark)
    reader = spark.read.format("bytesplit").option("cores", spark.sparkContext.defaultParallelism)
    return reader.option("pattern", pattern).options(**options).load(path)


def stream_lines(
    spark: SparkSession, path: str, pattern: str = PATTERN, bounded: bool = False, **options: object
) -> DataFrame:
    """The same lines as a stream that follows new parts.

    bounded: the stream ends with the parts that are there now, however many batches
    `maxBytesPerTrigger` makes of them; later parts are for the next run on the same checkpoint.
    """
    register(spark)
    if bounded:
        options = options | {"until": end_offset(path, pattern, **options)}
    reader = spark.readStream.format("bytesplit")
    reader = reader.option("cores", spark.sparkContext.defaultParallelism)
    return reader.option("pattern", pattern).options(**options).load(path)


def header_of(
    path: str,
    pattern: str = PATTERN,
    expected: list[str] | None = None,
    parts: Sequence[Part] | None = None,
) -> list[str]:
    """Column names in file order. A missing contract column is an error before any job."""
    names = split_header(read_header(path, pattern, parts)[0])
    missing = missing_columns(names, expected)
    if missing:
        raise ValueError(f"Missing expected columns: {missing}")
    return names


def _typed(name: str, kind: T.DataType) -> str:
    text = ident(name)
    if isinstance(kind, T.LongType):
        return f"{strict_integer(text, name)} AS {text}"
    if isinstance(kind, T.DoubleType):
        return f"{strict_double(text, name)} AS {text}"
    return text


def parse_csv(
    lines: DataFrame,
    header: list[str],
    schema: T.StructType = RAW_SCHEMA,
    tokens: Iterable[str] = NULL_TOKENS,
    string_nulls: bool = False,
) -> DataFrame:
    """Typed columns from CSV lines, in header order.

    Columns are matched by name; those outside `schema` come out as text. A wrong number of
    fields or a malformed number fails the query. Tokens turn into NULL in numeric columns
    only, as text columns may hold them as words; `string_nulls` extends them to text.
    """
    tokens = list(tokens)
    kinds = {n: T.StringType() for n in header} | {f.name: f.dataType for f in schema}
    fields = T.StructType([T.StructField(n, T.StringType()) for n in header])
    options = {"mode": "FAILFAST", "escape": '"'}

    def text(name: str) -> str:
        field = ident(name)
        if string_nulls or not isinstance(kinds[name], T.StringType):
            return f"{null_if_token(field, tokens)} AS {ident(name)}"
        return f"coalesce({field}, '') AS {ident(name)}"  # the parser reads "" as NULL

    # A line is parsed once: no filter passes the one-row generator, to parse it again for itself.
    records = lines.select(F.inline(F.array(F.from_csv("value", fields.toDDL(), options))))
    texts = records.selectExpr(*[text(n) for n in header])
    return texts.selectExpr(*[_typed(n, kinds[n]) for n in header])


def read_transactions(
    spark: SparkSession, path: str, pattern: str = PATTERN, string_nulls: bool = False
) -> DataFrame:
    """The raw relation held by the parts in `path`."""
    header = header_of(path, pattern)
    return parse_csv(read_lines(spark, path, pattern), header, string_nulls=string_nulls)


def stream_transactions(
    spark: SparkSession, path: str, pattern: str = PATTERN, string_nulls: bool = False, **options
) -> DataFrame:
    """The raw relation as a stream; the first part must be there to give the header."""
    header = header_of(path, pattern)
    lines = stream_lines(spark, path, pattern, **options)
    return parse_csv(lines, header, string_nulls=string_nulls)
