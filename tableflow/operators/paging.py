"""Numbering rows 1..n under a total order, and pages of a fixed number of rows.

A window without partition keys would bring every row to one task. Here the order is cut
into buckets of about equal size at keys taken from a sample:

1. the cuts are fixed once, so the bucket of a row depends on nothing but the row, and a
   task that runs again after a lost executor gives the same answer;
2. rows are counted per bucket (the key columns are all that is read);
3. each bucket is numbered on its own and starts where the one before it ended.

Keys need not be unique. Without ``unique=True`` the remaining columns break ties, so only
copies of a whole row are left in any order. Copies frequent enough to fill a bucket are
never sorted or held together: they are counted, and their numbers are generated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 50_000
BYTES_PER_BUCKET = 64 << 20
ROWS_PER_TASK = 1_000_000
MAX_BUCKETS = 16_384
SAMPLED_PER_BUCKET = 32
SAMPLE_BYTES = 128 << 20
NUMBERS_PER_BLOCK = 65_536

# Timestamps in cut points keep their microseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


@dataclass(frozen=True)
class _Layout:
    """Buckets of one DataFrame under one order."""

    keyed: DataFrame  # the rows with _bucket and _copy
    order: list[str]
    counts: dict[int, tuple[int, int]]  # bucket -> (rows, copies of its first key)
    key: Column | None = None  # what the cuts are compared with
    cuts: Sequence[str] = ()
    literal: Callable[[Sequence[str]], Column] | None = None
    parts: Sequence[str] = ()  # the key columns the cuts have

    def starts(self) -> list[int]:
        """Rows before each bucket."""
        rows = [self.counts.get(b, (0, 0))[0] for b in range(max(self.counts, default=0) + 1)]
        return [0, *accumulate(rows)][:-1]

    def between(self, low: int, high: int) -> Column:
        """Rows of buckets ``low..high`` as a range of keys, which a scan can use to skip data."""
        inside = F.lit(True)
        if self.cuts and low > 0:
            inside = inside & (self.key >= F.get(self.literal(self.cuts[low - 1:low]), F.lit(0)))
        if self.cuts and high < len(self.cuts):
            below = self.key < F.get(self.literal(self.cuts[high:high + 1]), F.lit(0))
            inside = inside & (below if low > 0 else below | self.key.isNull())
        return inside


def _add_bucket(df: DataFrame, key: Column, cuts: Sequence[str], literal: Callable[[Sequence[str]], Column]) -> DataFrame:
    """Add ``_bucket``, how many of the ascending ``cuts`` are at or below ``key``.

    The search halves the range once per projection, so it stays compiled, and a
    projection holds only the cuts its step can meet: every other one of those left.
    """
    df = df.withColumns({"_key": key, "_b0": F.lit(0)})
    bits = len(cuts).bit_length()
    for i in range(bits):
        step, found = 1 << (bits - 1 - i), F.col(f"_b{i}")
        met = F.get(literal(cuts[step - 1::2 * step]), F.shiftright(found, bits - i))
        df = df.withColumn(f"_b{i + 1}", F.when(met <= F.col("_key"), found + step).otherwise(found)).drop(f"_b{i}")
    return df.withColumnRenamed(f"_b{bits}", "_bucket").drop("_key")


def cut_key(df: DataFrame, parts: Sequence[str], scalar: bool) -> tuple[Column, Callable[[Sequence[str]], Column]]:
    """The columns that cuts are compared with, and what makes an array of cuts from their JSON."""
    whole = F.struct(*[F.col(f"`{c}`") for c in parts])
    kind = df.select(whole.alias("k")).schema["k"].dataType

    def literal(texts: Sequence[str]) -> Column:
        values = F.from_json(F.lit("[" + ",".join(texts) + "]"), T.ArrayType(kind), _JSON)
        return values[parts[0]] if scalar else values

    return F.col(f"`{parts[0]}`") if scalar else whole, literal


def _known_bytes(df: DataFrame) -> int:
    """Bytes of the rows as Spark estimates them from its sources, 0 where it does not know."""
    found = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return found if found < 1 << 60 else 0


def _layout(df: DataFrame, keys: Sequence[str], unique: bool, buckets: int | None) -> _Layout:
    rest = [] if unique else [c for c in df.columns if c not in set(keys)]
    lead, order, keyed = list(keys), [*keys, *rest], df
    if rest:
        keyed = keyed.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rest]))
        lead, order = [*keys, "_tie"], [*keys, "_tie", *rest]

    def size(c: str) -> Column:
        column, kind = F.col(f"`{c}`"), df.schema[c].dataType
        return F.octet_length(column if isinstance(kind, (T.StringType, T.BinaryType)) else F.to_json(F.struct(column)))

    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    known = df.agg(F.count("*").alias("rows"), *[F.avg(size(c)) for c in keys if isinstance(df.schema[c].dataType, wide)]).first()
    total = known["rows"]
    # The sample is sorted in one task and its cuts become part of the plan: both are bounded,
    # by number and for long keys by size. Fewer buckets are larger ones.
    key_bytes = 16 * len(lead) + sum(found or 0 for found in known[1:])
    wanted = buckets or min(MAX_BUCKETS, max(-(-total // ROWS_PER_BUCKET), -(-_known_bytes(df) // BYTES_PER_BUCKET)))
    sampled = min(SAMPLED_PER_BUCKET * wanted, int(SAMPLE_BYTES / key_bytes))
    wanted = min(wanted, max(2, sampled // 4))
    if wanted <= 1 or total == 0:
        keyed = keyed.withColumns({"_bucket": F.lit(0), "_copy": F.lit(False)})
        return _Layout(keyed, order, {0: (total, 0)} if total else {})

    def drawn(lead: list[str]) -> tuple[Column, dict[str, list[str]], dict[str, list[str]]]:
        """The key, its prefixes, and for each of them the cuts that a sample gives, as JSON."""
        full_key = F.struct(*[F.col(f"`{c}`") for c in lead])
        picked = keyed.select(full_key.alias("k"))
        if sampled < total:
            picked = picked.sample(sampled / total, seed=7)
        ordered = picked.agg(F.array_sort(F.collect_list("k")).alias("s"))
        cut = F.transform(
            F.sequence(F.lit(1).cast("bigint"), F.lit(wanted - 1).cast("bigint")),
            lambda i: F.get("s", F.floor(i * F.size("s") / wanted).cast("int")),
        )
        # Cuts are kept as JSON. They are what is left after writing and reading it, in order.
        array_type = T.ArrayType(picked.schema["k"].dataType)
        cuts = ordered.select(F.sort_array(F.from_json(F.to_json(cut, _JSON), array_type, _JSON)).alias("c"))
        prefixes = {f"p{n}": lead[:n] for n in range(1, len(lead) + 1)}

        def shortened(columns: list[str]) -> Column:
            some = F.filter("c", lambda x: x[columns[0]].isNotNull()) if len(columns) == 1 else F.col("c")
            return F.transform(some, lambda x: F.struct(*[x[c].alias(c) for c in columns]))

        def first_of_run(array: str) -> Column:
            return F.filter(array, lambda x, i: (i == 0) | (F.get(array, i - 1) != x))

        cuts = cuts.select(
            F.filter("c", lambda x, i: (i > 0) & (F.get("c", i - 1) == x)).alias("hot"),
            *[shortened(p).alias(name) for name, p in prefixes.items()])
        cuts = cuts.select(*[first_of_run(name).alias(name) for name in ("hot", *prefixes)])
        return full_key, prefixes, cuts.select(*[
            F.transform(name, lambda x: F.to_json(x, _JSON)).alias(name) for name in ("hot", *prefixes)]).first().asDict()

    full_key, prefixes, chosen = drawn(list(keys))
    if rest and chosen["hot"]:  # only where the keys repeat are the other columns read for it
        full_key, prefixes, chosen = drawn(lead)
    else:
        lead = list(keys)
    whole = f"p{len(lead)}"
    copied = not unique and len(chosen["hot"]) > 0
    # The fewest leading keys that tell the cuts apart as well as all of them do.
    best = whole if copied else next(name for name in prefixes if len(chosen[name]) == len(chosen[whole]))
    parts, cuts = prefixes[best], chosen[best]
    scalar = len(parts) == 1 and not copied

    key, literal = cut_key(keyed, parts, scalar)

    copy = F.lit(False)
    if copied:
        copy = full_key.isin(*[F.get(literal([text]), F.lit(0)) for text in chosen["hot"]])
    keyed = _add_bucket(keyed, key, cuts, literal).withColumn("_copy", copy)
    per_bucket = keyed.groupBy("_bucket").agg(
        F.count("*").alias("rows"), F.count_if("_copy").alias("copies")).collect()
    return _Layout(keyed, order, {r["_bucket"]: (r["rows"], r["copies"]) for r in per_bucket}, key, cuts,
                   literal, parts)


def expand_counts(df: DataFrame, count: str, number: str) -> DataFrame:
    """One row per number 1..``count`` for every input row.

    Long runs are generated in blocks spread over all tasks, not in the task of one row.
    """
    last = F.expr(f"(`{count}` - 1) div {NUMBERS_PER_BLOCK}")
    blocks = df.where(F.col(count) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("_block") * NUMBERS_PER_BLOCK + 1
    end = F.least(F.col(count), (F.col("_block") + 1) * NUMBERS_PER_BLOCK)
    return (blocks.repartition(*[F.col(f"`{c}`") for c in blocks.columns])
            .withColumn(number, F.explode(F.sequence(first, end)))
            .drop("_block"))


def _numbered(layout: _Layout, columns: list[str], name: str, low: int | None = None,
              high: int | None = None) -> DataFrame:
    """Rows with their number; buckets outside rows ``low..high`` are not sorted at all."""
    starts, counts, keyed = layout.starts(), layout.counts, layout.keyed
    live = [b for b, (rows, _) in counts.items()
            if (low is None or starts[b] + rows >= low) and (high is None or starts[b] < high)]
    if len(live) < len(counts):
        keyed = keyed.where(layout.between(min(live), max(live)) if live else F.lit(False))
    elif sum(rows for rows, _ in counts.values()) >= ROWS_PER_TASK * len(starts):
        # Buckets are large: one task each. By hash, some tasks would get several and run late;
        # smaller buckets are hashed, so that adaptive execution can put them together.
        keyed = keyed.repartitionById(len(starts), "_bucket")
    bucket = F.col("_bucket")
    offset = F.get(_bigints(starts), bucket)
    rows = [F.col(f"`{c}`") for c in columns]

    in_order = Window.partitionBy("_bucket").orderBy(*[F.col(f"`{c}`") for c in layout.order])
    row_no = offset + F.row_number().over(in_order).cast("bigint")
    if not any(counts[b][1] for b in live):
        return keyed.withColumn(name, row_no).select(*rows, name)

    copies = F.get(_bigints([counts.get(b, (0, 0))[1] for b in range(len(starts))]), bucket)
    plain = keyed.where("NOT _copy").withColumn(name, row_no + copies).select(*rows, name)
    # Copies collapse to one row and a count before any exchange, then get their numbers.
    # A bucket has one kind of them, or two where hashes collide.
    kinds = keyed.where("_copy").groupBy("_bucket", *rows).agg(F.count("*").alias("_n"))
    by_row = Window.partitionBy("_bucket").orderBy(*[F.col(f"`{c}`") for c in layout.order if c in columns])
    kinds = kinds.withColumn("_before", offset + F.sum("_n").over(by_row) - F.col("_n"))
    generated = expand_counts(kinds, "_n", "_i").withColumn(name, F.col("_before") + F.col("_i"))
    return plain.unionByName(generated.select(*rows, name))


def _bigints(values: Sequence[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")


def number_rows(df: DataFrame, keys: Sequence[str], unique: bool = False, name: str = "row_no",
                buckets: int | None = None) -> DataFrame:
    """Add the dense row number 1..n in the order of ``keys``.

    ``unique=True`` states that no two rows share their keys; the passes that lay out the
    buckets then read the key columns only.
    """
    return _numbered(_layout(df, keys, unique, buckets), df.columns, name)


def page_of(row_no: Column | str, page_size: int) -> Column:
    """Page that holds a row, pages counted from 1."""
    number = F.col(row_no) if isinstance(row_no, str) else row_no
    return F.floor((number - 1) / F.lit(page_size)).cast("bigint") + 1


def with_pages(df: DataFrame, keys: Sequence[str], page_size: int, unique: bool = False,
               buckets: int | None = None) -> DataFrame:
    """Add ``row_no`` and ``page_no``; every page but the last holds ``page_size`` rows."""
    return number_rows(df, keys, unique, "row_no", buckets).withColumn("page_no", page_of("row_no", page_size))


def page_slice(df: DataFrame, keys: Sequence[str], start: int, end: int, unique: bool = False,
               buckets: int | None = None) -> DataFrame:
    """Rows ``start..end`` (from 1, both included); only the buckets they lie in are sorted."""
    numbered = _numbered(_layout(df, keys, unique, buckets), df.columns, "row_no", start, end)
    return numbered.where(F.col("row_no").between(start, end))


def page_range(page: Column, size: Column) -> Column:
    """First and last row of a page.

    Text that is no number counts as 0, and page 0 is ``0 .. size - 1``.
    """
    number = F.coalesce(page.try_cast("bigint"), F.lit(0).cast("bigint"))
    rows = F.coalesce(size.try_cast("bigint"), F.lit(0).cast("bigint"))
    first = F.when(number > 0, (number - 1) * rows + 1).otherwise(number * rows)
    return F.struct(first.alias("start_row"), (first + rows - 1).alias("end_row"))


def page_count(rows: Column, page_size: int, compat: bool = False) -> Column:
    """Pages needed for ``rows``; ``compat`` rounds half to even, often to one page more."""
    if compat:
        return F.bround((rows + page_size - 1).cast("decimal(38,9)") / page_size, 0).cast("bigint")
    return F.ceil(rows.cast("decimal(38,0)") / page_size).cast("bigint")


def page_bounds(counts: DataFrame, page_size: int, compat: bool = False) -> DataFrame:
    """Page plan of tables given as ``(table_name, row_count)``: one row per page.

    The last page ends where a full page would, as a range of row numbers may.
    """
    pages = counts.select("table_name", page_count(F.col("row_count"), page_size, compat).alias("_pages"))
    planned = expand_counts(pages, "_pages", "page_no")
    bounds = page_range(F.col("page_no"), F.lit(page_size))
    return planned.select("table_name", "page_no", bounds["start_row"].alias("start_row"),
                          bounds["end_row"].alias("end_row"))
