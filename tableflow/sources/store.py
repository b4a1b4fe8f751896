"""Reading and writing tables by name in a store: files, a Spark database or JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system, materialise

MAX_CONNECTIONS = 64


@dataclass(frozen=True)
class Store:
    """A place that holds tables.

    ``kind`` is ``files`` (``location`` is a folder, ``fmt`` the file format), ``tables``
    (``location`` is a Spark database) or ``jdbc`` (``location`` is the URL).
    """

    kind: str
    location: str
    fmt: str = "parquet"
    suffix: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}{self.suffix}"

    def table(self, name: str) -> str:
        return f"{self.location}.{name}" if self.location else name


def parquet_store(folder: str, suffix: str = "") -> Store:
    return Store("files", folder, "parquet", suffix)


def jdbc_read_options(store: Store, table: str, types: Mapping[str, str] | None = None,
                      fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read.

    Wall-clock timestamps stay without a zone, and columns named in ``types`` are read
    with that type, so that an exact number never passes through a double and large
    objects arrive as text or bytes.
    """
    options = {
        "url": store.location,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
    }
    if types:
        options["customSchema"] = ", ".join(f"`{name}` {ddl}" for name, ddl in types.items())
    options.update(store.options)
    return options


def jdbc_write_options(store: Store, table: str, batch_rows: int = 10_000,
                       extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a JDBC write.

    At most ``MAX_CONNECTIONS`` tasks write at a time, however many partitions there are;
    ``numPartitions`` among the options of the store sets another limit. Rows are staged
    before, so the limit holds back none of the work that makes them.
    """
    options = {"url": store.location, "dbtable": table, "batchsize": str(batch_rows),
               "numPartitions": str(MAX_CONNECTIONS)}
    return options | dict(store.options) | dict(extra or {})


def _projected(df: DataFrame, columns: Sequence[str] | None, types: Mapping[str, str] | None) -> DataFrame:
    if types:
        df = df.withColumns({name: F.col(name).cast(ddl) for name, ddl in types.items()})
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, store: Store, name: str, columns: Sequence[str] | None = None,
               types: Mapping[str, str] | None = None) -> DataFrame:
    """The whole table, or only ``columns`` of it; ``types`` overrides column types."""
    if store.kind == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_read_options(store, name, types)).load()
        return _projected(df, columns, None)
    if store.kind == "tables":
        df = spark.read.table(store.table(name))
    else:
        system, at = file_system(spark, store.path(name))
        if not system.exists(at):  # a load that stopped between its two renames
            recover(spark, store, name)
        df = spark.read.format(store.fmt).options(**store.options).load(store.path(name))
    return _projected(df, columns, types)


def read_tables(spark: SparkSession, store: Store, names: Sequence[str]) -> dict[str, DataFrame | None]:
    """Each named table, or ``None`` for one that cannot be opened."""
    found: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            found[name] = read_table(spark, store, name)
        except (PySparkException, Py4JJavaError):
            found[name] = None
    return found


def key_cuts(df: DataFrame, key: str, parts: int, error: float = 0.001) -> list[float]:
    """Values that cut a numeric key into about equally filled ranges.

    Equal-width ranges leave most rows in a few of them when the key is unevenly spread.
    """
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.approxQuantile(key, shares, error))) if shares else []


def range_predicates(key: str, cuts: Sequence[object]) -> list[str]:
    """Disjoint predicates that together cover every row, one per range; nulls go first."""
    if not cuts:
        return ["1 = 1"]
    rendered = [str(int(cut)) if float(cut).is_integer() else repr(cut) for cut in cuts]
    first = f"{key} < {rendered[0]} OR {key} IS NULL"
    middle = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(rendered, rendered[1:])]
    return [first, *middle, f"{key} >= {rendered[-1]}"]


def tuple_cuts(df: DataFrame, keys: Sequence[str], parts: int, sample: int = 200) -> list[tuple[str | None, ...]]:
    """Keys of any comparable types, as SQL literals, that cut the rows into about ``parts`` equal ranges.

    They come from a sample of ``sample`` rows a range, the smallest of random numbers, which tasks
    find and merge without an exchange of the table. Nulls come first. No rows give no cuts.
    """
    def literal(name: str) -> Column:
        kind, text = df.schema[name].dataType, F.col(f"`{name}`").cast("string")
        if isinstance(kind, T.NumericType):
            return text
        quoted = F.concat(F.lit("'"), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
        return F.concat(F.lit("DATE " if isinstance(kind, T.DateType) else "TIMESTAMP "), quoted) if isinstance(
            kind, T.DatetimeType) else quoted

    drawn = df.select(*[F.col(f"`{k}`") for k in keys]).orderBy(F.rand(17)).limit(sample * parts)
    ordered = [tuple(r) for r in drawn.orderBy(*[F.col(f"`{k}`") for k in keys]).select(*[literal(k) for k in keys]).collect()]
    return list(dict.fromkeys(ordered[len(ordered) * i // parts] for i in range(1, parts))) if ordered else []


def tuple_predicates(keys: Sequence[str], cuts: Sequence[tuple[str | None, ...]]) -> list[str]:
    """Disjoint predicates on several keys in lexicographic order that together cover every row, nulls first.

    ``cuts`` are ascending tuples of SQL literals, ``None`` for null; each predicate is true or false, never null.
    """
    def below(cut: tuple[str | None, ...], names: Sequence[str]) -> str:
        if not names:
            return "1 = 0"
        key, rest = names[0], below(cut[1:], names[1:])
        if cut[0] is None:
            return f"({key} IS NULL AND {rest})"
        return f"({key} IS NULL OR {key} < {cut[0]} OR ({key} = {cut[0]} AND {rest}))"

    def from_cut(cut: tuple[str | None, ...], names: Sequence[str]) -> str:
        if not names:
            return "1 = 1"
        key, rest = names[0], from_cut(cut[1:], names[1:])
        if cut[0] is None:
            return f"({key} IS NOT NULL OR {rest})"
        return f"({key} IS NOT NULL AND ({key} > {cut[0]} OR ({key} = {cut[0]} AND {rest})))"

    if not cuts:
        return ["1 = 1"]
    middle = [f"{from_cut(low, keys)} AND {below(high, keys)}" for low, high in zip(cuts, cuts[1:])]
    return [below(cuts[0], keys), *middle, from_cut(cuts[-1], keys)]


def read_ranges(spark: SparkSession, store: Store, name: str, key: str, parts: int,
                balanced: bool = False, types: Mapping[str, str] | None = None) -> DataFrame:
    """Read a table as disjoint key ranges in parallel.

    Files are split by Spark itself, so this is a plain scan for them. A JDBC table is cut
    at equal steps between the smallest and largest key, or at quantiles of the key with
    ``balanced=True`` (one more read of the key column).
    """
    if store.kind != "jdbc":
        return read_table(spark, store, name, types=types)
    if balanced:
        keys = read_ranges(spark, store, f"(SELECT {key} FROM {name}) k", key, parts)
        return read_pages(spark, store, name, range_predicates(key, key_cuts(keys, key, parts)), types)
    bounds = spark.read.format("jdbc").options(**jdbc_read_options(
        store, f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {name}) b")).load().first()
    return spark.read.format("jdbc").options(**jdbc_range_options(store, name, key, parts, bounds, types)).load()


def jdbc_range_options(store: Store, name: str, key: str, parts: int, bounds: Sequence[object],
                       types: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a JDBC read in equal steps of ``key``; an empty table is read at once."""
    options = jdbc_read_options(store, name, types)
    if bounds[0] is not None:
        options |= {"partitionColumn": key, "numPartitions": str(parts),
                    "lowerBound": str(bounds[0]), "upperBound": str(bounds[1])}
    return options


def read_pages(spark: SparkSession, store: Store, name: str, predicates: Sequence[str],
               types: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a table by a list of disjoint predicates, one task each over JDBC."""
    if store.kind == "jdbc":
        properties = {k: v for k, v in jdbc_read_options(store, name, types).items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(store.location, name, predicates=list(predicates), properties=properties)
    return read_table(spark, store, name).where(" OR ".join(f"({p})" for p in predicates))


def _write(df: DataFrame, store: Store, name: str, mode: str, batch_rows: int,
           extra: Mapping[str, str] | None = None) -> None:
    """Rows are made whole before the target is touched: a failure on the way leaves it as it was."""
    if store.kind == "jdbc":
        staged = materialise(df, name)
        staged.write.format("jdbc").options(**jdbc_write_options(store, name, batch_rows, extra)).mode(mode).save()
    elif store.kind == "tables":
        keep = mode == "append" or (extra or {}).get("truncate") == "true"
        staged = materialise(df, name) if mode == "overwrite" else df
        if keep and df.sparkSession.catalog.tableExists(store.table(name)):
            staged.write.insertInto(store.table(name), overwrite=mode == "overwrite")
        else:
            staged.write.format(store.fmt).mode(mode).saveAsTable(store.table(name))
    elif mode == "append":
        recover(df.sparkSession, store, name)
        df.write.format(store.fmt).options(**store.options).mode(mode).save(store.path(name))
    else:
        # A leading underscore hides the folder from readers of the store.
        staged = f"{store.location.rstrip('/')}/_{name.replace('/', '_')}-{uuid.uuid4().hex}"
        df.write.format(store.fmt).options(**store.options).save(staged)
        recover(df.sparkSession, store, name)
        _swap(df.sparkSession, store, name, staged)


def _intent_path(store: Store, name: str) -> str:
    return f"{store.location.rstrip('/')}/_{name.replace('/', '_')}-intent"


def _keep_intent(spark: SparkSession, path: str, staged: str) -> None:
    """Write the record whole under another name first: a part of one is never found under its own."""
    system, new = file_system(spark, f"{staged}-intent")
    stream = system.create(new)
    stream.write(staged.rpartition("/")[2].encode())
    stream.close()
    at = file_system(spark, path)[1]
    system.delete(at, False)
    if not system.rename(new, at):
        raise OSError(f"{path} cannot be written")


def _read_intent(spark: SparkSession, store: Store, name: str) -> str | None:
    """The staged folder that a swap under way, or one that stopped, puts in the table's place."""
    system, at = file_system(spark, _intent_path(store, name))
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return f"{store.location.rstrip('/')}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def recover(spark: SparkSession, store: Store, name: str) -> str:
    """Finish a swap that stopped on its way: ``done``, ``undone`` or ``none`` where there is nothing to mend.

    The record of a swap is written after the new table is whole and before the old one moves. So a staged
    folder that is still there takes the table's place, and what was moved aside goes; without it,
    the old table comes back. Any number of calls, at any point, end in one whole table.
    """
    staged = _read_intent(spark, store, name) if store.kind == "files" else None
    if staged is None:
        return "none"
    target = store.path(name)
    system, new = file_system(spark, staged)
    at, old, record = (file_system(spark, x)[1] for x in (target, f"{staged}-old", _intent_path(store, name)))
    state = "none"
    if system.exists(new):
        if system.exists(at) and not system.exists(old):
            _moved(system, at, old, target)
        _moved(system, new, at, target)
        state = "done"
    elif not system.exists(at) and system.exists(old):
        _moved(system, old, at, target)
        state = "undone"
    system.delete(record, False)
    if system.exists(at):
        system.delete(old, True)
    spark.catalog.refreshByPath(target)
    return state


def _moved(system: JavaObject, source: JavaObject, target: JavaObject, name: str) -> None:
    """Rename a folder; one that another call has moved already is where it should be."""
    if not system.rename(source, target) and (system.exists(source) or not system.exists(target)):
        raise OSError(f"{source} cannot be moved to {target} ({name})")


def _swap(spark: SparkSession, store: Store, name: str, staged: str) -> None:
    """Put a written folder in the place of the table, which goes only when the new one is there.

    A record beside the table says so first. Whatever stops this, the next load or read finishes it.
    """
    _keep_intent(spark, _intent_path(store, name), staged)
    recover(spark, store, name)


def append(df: DataFrame, store: Store, name: str, batch_rows: int = 10_000) -> None:
    """Add rows to the table."""
    _write(df, store, name, "append", batch_rows)


def truncate_load(df: DataFrame, store: Store, name: str, batch_rows: int = 10_000) -> None:
    """Empty the table but keep its definition, then load the columns ``df`` has.

    Files get the columns and types they had, absent ones null; a column the table lacks is
    an error, as in a database.
    """
    schema = target_schema(df.sparkSession, store, name) if store.kind == "files" else None
    if schema is not None:
        have = {c.upper(): c for c in df.columns}
        if unknown := set(have) - {f.name.upper() for f in schema}:
            raise ValueError(f"{name} has no columns {', '.join(sorted(unknown))}")
        df = df.select(*[(F.col(f"`{have[f.name.upper()]}`") if f.name.upper() in have else F.lit(None))
                         .cast(f.dataType).alias(f.name) for f in schema])
    _write(df, store, name, "overwrite", batch_rows, {"truncate": "true"})


def replace(df: DataFrame, store: Store, name: str, batch_rows: int = 10_000,
            column_types: Mapping[str, str] | None = None) -> None:
    """Drop the table if it exists, create it again and load it."""
    extra = {}
    if column_types:
        extra["createTableColumnTypes"] = ", ".join(f"`{c}` {t}" for c, t in column_types.items())
    _write(df, store, name, "overwrite", batch_rows, extra)


def save_log(df: DataFrame, store: Store, name: str) -> None:
    """Add a compare result or a run log to its table in the target."""
    append(df, store, name)


def save_csv(df: DataFrame, path: str) -> None:
    """Record of a run as CSV with a header."""
    df.write.mode("append").option("header", "true").csv(path)


def target_schema(spark: SparkSession, store: Store, name: str) -> T.StructType | None:
    """Schema of a table in the store, or ``None`` where there is no such table."""
    df = read_tables(spark, store, [name])[name]
    return None if df is None else df.schema
