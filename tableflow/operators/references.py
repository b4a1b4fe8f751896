"""Key, foreign key and identity definitions from catalogue tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import between, normalised
from ..joins import divisible_join
from ..sources.names import restrict_to_list
from .paging import number_rows

# Index type left out, and the trigger type that fills an identity column.
FUNCTION_INDEX = "FUNCTION-BASED NORMAL"
PLAIN_INDEX = "NORMAL"
ROW_TRIGGER = "BEFORE EACH ROW"


def ordered_list(df: DataFrame, group: Sequence[str], value: str, position: Sequence[str], sep: str = ",",
                 name: str = "value_list", chunk: Column | None = None) -> DataFrame:
    """Values of each group joined in order of ``position``, nulls left out.

    The result is one text per group, as long as the group. Where a group can be large,
    ``chunk`` (a column that grows with the position) lets many tasks join parts of it
    before the parts are put together.
    """
    order = ", ".join(f"`{p}`" for p in position)
    values = df.where(F.col(value).isNotNull()).withColumn("_value", F.col(value).cast("string"))
    joined = F.expr(f"listagg(_value, {_quoted(sep)}) WITHIN GROUP (ORDER BY {order})")
    if chunk is None:
        return values.groupBy(*group).agg(joined.alias(name))
    parts = values.groupBy(*group, chunk.alias("_chunk")).agg(joined.alias("_part"))
    whole = F.expr(f"listagg(_part, {_quoted(sep)}) WITHIN GROUP (ORDER BY _chunk)")
    return parts.groupBy(*group).agg(whole.alias(name))


def ordered_parts(df: DataFrame, group: Sequence[str], value: str, position: Sequence[str], part_rows: int = 100_000,
                  sep: str = ",", name: str = "value_list") -> DataFrame:
    """``ordered_list`` in parts: each group's columns, ``part`` (from 0), ``row_count`` and the part's text.

    Every part but a group's last joins ``part_rows`` values, so a group of any size is never in one task:
    rows are numbered by group and position over buckets cut at keys of the data, and a part is a range of
    those numbers. Joined by ``sep`` in order, the parts are the list. Equal positions are ordered by value;
    null values are left out, null groups are groups; no rows give none. Reads ``df`` several times.
    """
    names = {c: f"g{i}" for i, c in enumerate(group)} | {c: f"p{i}" for i, c in enumerate(position)}
    keys = [names[c] for c in group]
    values = df.where(F.col(f"`{value}`").isNotNull()).select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(f"`{value}`").alias("v"))
    numbered = number_rows(values, [*keys, *[names[c] for c in position], "v"], name="n")
    # A null group has to meet its start: each key goes with whether it is null.
    packed = [c for k in keys for c in (F.col(k).isNull().alias(f"{k}_null"), F.col(k))]
    starts = numbered.groupBy(*keys).agg(F.min("n").alias("first")).select(F.struct(*packed).alias("k"), "first")
    placed = numbered.withColumn("k", F.struct(*packed)).join(starts, "k")
    part = F.floor((F.col("n") - F.col("first")) / F.lit(part_rows)).cast("bigint")
    text = F.expr(f"listagg(CAST(v AS STRING), {_quoted(sep)}) WITHIN GROUP (ORDER BY n)")
    return (placed.groupBy("k", *keys, part.alias("part")).agg(F.count("*").alias("row_count"), text.alias(name))
            .select(*[F.col(names[c]).alias(c) for c in group], "part", "row_count", name))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def key_class() -> Column:
    """Class of a key from its constraint type, uniqueness and index type."""
    return (
        F.when(F.col("constraint_type") == "P", "PRIMARY KEY")
        .when(F.col("constraint_type") == "R", "FOREIGN KEY")
        .when(F.col("uniqueness") == "UNIQUE", "UNIQUE")
        .when(F.col("index_type") == PLAIN_INDEX, "PLAIN")
        .otherwise(F.col("index_type"))
    )


def key_columns(index_columns: DataFrame, indexes: DataFrame, constraints: DataFrame,
                tables: DataFrame | None = None) -> DataFrame:
    """Column list and class of every key; indexes on expressions are left out.

    Inputs: ``(table_name, index_name, column_name, column_position)``,
    ``(index_name, uniqueness, index_type)`` and ``(constraint_name, constraint_type)``.
    """
    plain = indexes.where(F.col("index_type") != FUNCTION_INDEX).select("index_name", "uniqueness", "index_type")
    kinds = constraints.select(F.col("constraint_name").alias("index_name"), "constraint_type")
    # Columns of left out indexes do not move on; the lists and all joins share one exchange by index.
    wanted = restrict_to_list(index_columns, "table_name", tables).join(plain, "index_name", "left_semi")
    columns = ordered_list(wanted, ["table_name", "index_name"], "column_name", ["column_position", "column_name"], name="columns")
    return (columns.join(plain, "index_name").join(kinds, "index_name", "left")
            .select("table_name", "index_name", "columns", key_class().alias("key_class")))


def foreign_keys(constraints: DataFrame, constraint_columns: DataFrame) -> DataFrame:
    """Child table and columns, parent table and columns of every foreign key.

    Inputs: ``(constraint_name, table_name, constraint_type, r_constraint_name)`` and
    ``(constraint_name, column_name, position)``. The lists are joined once per
    constraint and serve both sides.
    """
    lists = ordered_list(constraint_columns, ["constraint_name"], "column_name", ["position", "column_name"],
                         name="columns")
    parents = constraints.select(F.col("constraint_name").alias("r_constraint_name"),
                                 F.col("table_name").alias("parent_table"))
    child_lists = lists.withColumnRenamed("columns", "child_columns")
    parent_lists = lists.select(F.col("constraint_name").alias("_parent"), F.col("columns").alias("parent_columns"))
    named = (constraints.where("constraint_type = 'R'")
             .select("constraint_name", F.col("table_name").alias("child_table"), "r_constraint_name")
             .join(child_lists, "constraint_name", "left")
             .join(parents, "r_constraint_name", "left"))
    # Many foreign keys may refer to one parent.
    return (divisible_join(named, parent_lists, [named["r_constraint_name"]], [parent_lists["_parent"]], "left")
            .select("constraint_name", "child_table", "child_columns", "parent_table", "parent_columns"))


def _identity_triggers(triggers: DataFrame) -> DataFrame:
    body = normalised(F.col("trigger_body"))
    return (triggers.where(F.col("trigger_type") == ROW_TRIGGER).withColumn("trigger_body", body)
            .where(F.contains("trigger_body", F.lit("NEXTVAL"))))


def identity_columns(triggers: DataFrame) -> DataFrame:
    """``table_name, column_name`` of columns a row trigger fills from a sequence.

    Input: ``(table_name, trigger_type, trigger_body)``. The column stands between
    ``:NEW.`` and `` FROM DUAL;`` of a body that takes ``NEXTVAL`` into it.
    """
    column = between(F.col("trigger_body"), ":NEW.", " FROM DUAL;")
    return (_identity_triggers(triggers).where(F.contains("trigger_body", F.lit("INTO :")))
            .select("table_name", column.alias("column_name")).where("column_name IS NOT NULL").distinct())


def identity_count(triggers: DataFrame) -> DataFrame:
    """``identity_triggers``: how many row triggers take a sequence value."""
    body = F.upper("trigger_body")
    found = (F.col("trigger_type") == ROW_TRIGGER) & F.contains(body, F.lit("NEXTVAL"))
    return triggers.agg(F.count_if(found).alias("identity_triggers"))
