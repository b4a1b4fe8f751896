"""Column catalogue: one row per column of a table, from schemas or from data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..joins import divisible_join
from .names import folded
from .store import Store, jdbc_read_options, read_table

CATALOGUE_DDL = (
    "table_name string, column_id int, column_name string, data_type string, char_length int, "
    "data_precision int, data_scale int, nullable boolean, comments string, data_default string, avg_col_len int"
)

# Names of Spark types in the vocabulary of the source catalogue.
_SOURCE_TYPE = {
    "string": "VARCHAR2",
    "tinyint": "NUMBER",
    "smallint": "NUMBER",
    "int": "NUMBER",
    "bigint": "NUMBER",
    "float": "BINARY_FLOAT",
    "double": "BINARY_DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP(6)",
    "timestamp_ntz": "TIMESTAMP(6)",
    "binary": "BLOB",
}
# Decimal digits that hold every value of an integer type.
_INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _described(table: str, position: int, column: T.StructField) -> tuple:
    ddl = column.dataType.simpleString()
    precision = scale = length = None
    if isinstance(column.dataType, T.DecimalType):
        name, precision, scale = "NUMBER", column.dataType.precision, column.dataType.scale
    elif isinstance(column.dataType, (T.VarcharType, T.CharType)):
        name = "CHAR" if isinstance(column.dataType, T.CharType) else "VARCHAR2"
        length = column.dataType.length
    else:
        name = _SOURCE_TYPE.get(ddl, ddl.upper())
        precision = _INTEGER_DIGITS.get(ddl)
        scale = 0 if precision else None
    return (table, position, column.name, name, length, precision, scale, column.nullable,
            column.metadata.get("comment"), column.metadata.get("CURRENT_DEFAULT"), None)


def catalogue_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalogue of DataFrames by name; statistics are null until measured."""
    rows = [_described(table, position, column)
            for table, df in tables.items()
            for position, column in enumerate(df.schema, start=1)]
    return spark.createDataFrame(rows, CATALOGUE_DDL)


def measured_catalogue(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalogue with longest text and average stored length read from the data.

    One pass per table whatever its number of columns. The result is one row per column.
    """
    measured = []
    for table, df in tables.items():
        scalars = [c for c in df.schema if not isinstance(c.dataType, (T.ArrayType, T.MapType, T.StructType))]
        if not scalars:
            continue
        stats = df.select(*[
            F.struct(
                F.max(F.length(F.col(f"`{c.name}`").cast("string"))).cast("int").alias("char_length")
                if isinstance(c.dataType, T.StringType) else F.lit(None).cast("int").alias("char_length"),
                F.ceil(F.avg(F.octet_length(F.col(f"`{c.name}`").cast("string")))).cast("int").alias("avg_col_len"),
            ).alias(f"s{i}")
            for i, c in enumerate(scalars)
        ])
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c.name).alias("column_name"), F.col(f"s{i}").alias("s")) for i, c in enumerate(scalars)
        ]))
        measured.append(stats.select(pairs.alias("m")).select(
            F.lit(table).alias("table_name"), "m.column_name", "m.s.char_length", "m.s.avg_col_len"))
    nothing = spark.createDataFrame([], "table_name string, column_name string, char_length int, avg_col_len int")
    found = reduce(DataFrame.unionByName, measured) if measured else nothing
    plain = catalogue_of(spark, tables).drop("char_length", "avg_col_len")
    order = [column.split()[0] for column in CATALOGUE_DDL.split(", ")]
    return plain.join(found, ["table_name", "column_name"], "left").select(*order)


def column_catalogue(spark: SparkSession, source: Store, names: Sequence[str],
                     dictionary: str | None = None) -> DataFrame:
    """Catalogue of tables in a store.

    A database that keeps its own catalogue is asked through ``dictionary``, a table or
    parenthesised query that yields the catalogue columns.
    """
    if source.kind == "jdbc" and dictionary:
        rows = spark.read.format("jdbc").options(**jdbc_read_options(source, dictionary)).load()
        wanted = [folded(F.lit(name)) for name in names]
        return rows.where(folded("table_name").isin(wanted))
    return catalogue_of(spark, {name: read_table(spark, source, name) for name in names})


def common_columns(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Rows of catalogue ``src`` whose table has a column of that name in ``tgt``.

    ``column_id`` keeps the order of the source.
    """
    have = tgt.select(folded("table_name").alias("_t"), folded("column_name").alias("_c")).distinct()
    names = [folded(src["table_name"]), folded(src["column_name"])]
    return divisible_join(src, have, names, [have["_t"], have["_c"]], "left_semi")
