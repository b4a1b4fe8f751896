"""Schema mapping over a catalogue of any size: types, defaults, row width."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import types as rules
from ..joins import divisible_join
from ..sources.names import folded

ROW_WIDTH_LIMIT = 65_535
# Largest scale taken over, and the width given to a column without data.
LARGEST_SCALE = 30
EMPTY_WIDTH = 100


def normalise_stats(catalogue: DataFrame) -> DataFrame:
    """Missing precision, scale and average length become -1; scale above 30 is cut."""
    p, s = F.col("data_precision"), F.col("data_scale")
    capped = F.least(p, F.lit(LARGEST_SCALE)) - 1
    return catalogue.withColumns({
        "data_scale": F.when(s.isNull(), rules.NO_STATISTIC).when(s > LARGEST_SCALE, capped).otherwise(s),
        "data_precision": F.coalesce(p, F.lit(rules.NO_STATISTIC)),
        "avg_col_len": F.coalesce("avg_col_len", F.lit(rules.NO_STATISTIC)),
    })


def _with_default(catalogue: DataFrame, compat: bool) -> DataFrame:
    """Statistics normalised, with the kind of the source type and ``target_default``."""
    ready = normalise_stats(catalogue).withColumn("_kind", rules.source_kind())
    if compat:
        return ready.withColumn("target_default", rules.compat_default())
    # Separate steps, so that each pattern runs once per row.
    ready = ready.withColumn("_bare", rules.bare_default(F.col("data_default")))
    ready = ready.withColumn("_named", F.upper(F.replace("_bare", F.lit("()"), F.lit(""))))
    ready = ready.withColumn("target_default", rules.constant_default(F.col("_bare"), F.col("_named")))
    return ready.withColumn("target_default", F.nullif("target_default", F.lit(""))).drop("_bare", "_named")


def clean_defaults(catalogue: DataFrame, compat: bool = False) -> DataFrame:
    """Add ``target_default``."""
    return _with_default(catalogue, compat).drop("_kind")


def map_types(catalogue: DataFrame, compat: bool = False, profile: DataFrame | None = None) -> DataFrame:
    """Add ``target_type``, ``spark_type``, ``max_length``, ``target_default`` and ``rule``.

    ``profile`` holds ``table_name, column_name, min_value, max_value, max_scale`` read
    from the data. Under ``compat`` a number default without digits empties the whole
    table, and a number no rule covers has null types.
    """
    ready = _with_default(catalogue, compat)
    profiled = profile is not None and not compat
    if profiled:
        ready = ready.join(profile.select("table_name", "column_name", "min_value", "max_value", "max_scale"),
                           ["table_name", "column_name"], "left")
    mapped = ready.withColumn("rule", rules.type_rule(compat, profiled))
    mapped = mapped.withColumn("digits", rules.digits(compat, profiled)).withColumns({
        "target_type": rules.target_type(), "spark_type": rules.spark_type(), "max_length": rules.max_length(),
    }).drop("_kind", "digits", "min_value", "max_value", "max_scale")
    if not compat:
        return mapped
    lost_tables = (mapped.where(rules.breaks_table()).select(F.col("table_name").alias("_table")).distinct()
                   .withColumn("_lost", F.lit(True)))
    mapped = divisible_join(mapped, lost_tables, [mapped["table_name"]], [lost_tables["_table"]], "left").drop("_table")
    lost = F.coalesce("_lost", F.lit(False))
    for name in ("target_type", "spark_type", "max_length", "target_default"):
        mapped = mapped.withColumn(name, F.when(~lost, F.col(name)))
    return mapped.withColumn("rule", F.when(lost, "table_lost").otherwise(F.col("rule"))).drop("_lost")


def widened(longest: Column) -> Column:
    """Column width from the longest text found: half as much again, rounded half to even."""
    width = F.bround(longest.cast("decimal(20,0)") * F.lit("1.5").cast("decimal(2,1)"), 0).cast("int")
    return F.when(F.coalesce(longest, F.lit(0)) == 0, EMPTY_WIDTH).otherwise(width)


def fit_row_width(catalogue: DataFrame, widths: DataFrame, limit: int = ROW_WIDTH_LIMIT) -> DataFrame:
    """Narrow the text columns of tables whose declared row is too wide.

    ``widths`` holds ``table_name, column_name, width``. Adds ``fitted_length`` and
    ``narrowed``; a table within ``limit`` keeps its declared lengths.
    """
    text = F.col("data_type").isin(*rules.VARIABLE_TEXT)
    declared = F.coalesce("char_length", F.lit(0))
    wide = (catalogue.groupBy("table_name").agg(F.sum(declared.cast("bigint")).alias("_row"))
            .where(F.col("_row") > limit).select(F.col("table_name").alias("_table"), F.lit(True).alias("_wide")))
    found = widths.select("table_name", "column_name", F.col("width").alias("_width"))
    narrowed = F.coalesce("_wide", F.lit(False)) & text
    marked = divisible_join(catalogue, wide, [catalogue["table_name"]], [wide["_table"]], "left").drop("_table")
    return (marked.join(found, ["table_name", "column_name"], "left")
            .withColumns({"narrowed": narrowed,
                          "fitted_length": F.when(narrowed, F.coalesce("_width", F.lit(EMPTY_WIDTH)))
                          .otherwise(F.col("char_length"))})
            .drop("_wide", "_width"))


def fit_row_width_least(catalogue: DataFrame, widths: DataFrame, limit: int = ROW_WIDTH_LIMIT) -> DataFrame:
    """Narrow as few text columns as bring a table's declared row within ``limit``.

    Those that save most go first, equal ones in order of ``column_id``. Adds ``fitted_length``, ``narrowed``
    and ``fits``, which is false where all savings together do not suffice (every one is then made). A column
    without a width counts as empty; a width above the declared length saves nothing and is left alone. Only
    tables that are too wide are sorted, each by itself: a table's columns are few.
    """
    declared = F.coalesce("char_length", F.lit(0)).cast("bigint")
    sums = (catalogue.groupBy("table_name").agg(F.sum(declared).alias("_row")).where(F.col("_row") > limit)
            .select(F.col("table_name").alias("_table"), "_row"))
    marked = divisible_join(catalogue, sums, [catalogue["table_name"]], [sums["_table"]], "left")
    found = widths.select("table_name", "column_name", F.col("width").cast("int").alias("_width"))
    text = F.col("data_type").isin(*rules.VARIABLE_TEXT)
    wide = (marked.where("_row IS NOT NULL").join(found, ["table_name", "column_name"], "left")
            .withColumn("_width", F.coalesce("_width", F.lit(EMPTY_WIDTH)))
            .withColumn("_saved", F.when(text, F.greatest(declared - F.col("_width"), F.lit(0))).otherwise(0)))
    table = Window.partitionBy("table_name")
    before = (table.orderBy(F.desc("_saved"), "column_id", "column_name")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wide = wide.withColumns({"_before": F.sum("_saved").over(before) - F.col("_saved"), "_all": F.sum("_saved").over(table)})
    narrowed = (F.col("_saved") > 0) & (F.col("_row") - F.col("_before") > limit)
    done = wide.withColumns({"narrowed": narrowed, "fits": F.col("_row") - F.col("_all") <= limit,
                             "fitted_length": F.when(narrowed, F.col("_width")).otherwise(F.col("char_length"))})
    rest = marked.where("_row IS NULL").withColumns(
        {"narrowed": F.lit(False), "fits": F.lit(True), "fitted_length": F.col("char_length")})
    out = [*catalogue.columns, "fitted_length", "narrowed", "fits"]
    return rest.select(*out).unionByName(done.select(*out))


@dataclass(frozen=True)
class ColumnRule:
    """What one target column accepts."""

    name: str
    spark_type: str | None
    max_length: int | None = None
    nullable: bool = True
    comment: str | None = None
    default: str | None = None


def column_rules(mapped: DataFrame, table: str) -> list[ColumnRule]:
    """Rules of one table, in column order; as many as the table has columns."""
    rows = (mapped.where(folded("table_name") == folded(F.lit(table))).where("rule NOT IN ('dropped', 'table_lost')")
            .orderBy("column_id").collect())
    return [ColumnRule(r.column_name, r.spark_type, r.max_length, r.nullable, r.comments, r.target_default)
            for r in rows]


def exact_types(columns: Sequence[ColumnRule]) -> dict[str, str]:
    """Types to read a database table with, so that no value is rounded or cut on the way.

    Decimals and bytes are read as such; integers are left to the driver and checked later.
    """
    return {c.name: c.spark_type for c in columns if (c.spark_type or "").startswith(("decimal", "binary"))}


def schema_of(columns: Sequence[ColumnRule], source: T.StructType | None = None) -> T.StructType:
    """Target schema with nullability and comments.

    An unmapped column keeps its type in ``source``, or is text where that is not known.
    """
    known = {f.name.upper(): f.dataType for f in source or ()}

    def kind(c: ColumnRule) -> T.DataType:
        return T.DataType.fromDDL(c.spark_type) if c.spark_type else known.get(c.name.upper(), T.StringType())

    return T.StructType([
        T.StructField(c.name, kind(c), c.nullable, {"comment": c.comment.replace('"', "")} if c.comment else None)
        for c in columns
    ])
