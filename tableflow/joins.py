"""A join that stays divisible where one key holds much of the left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def divisible_join(left: DataFrame, right: DataFrame, left_keys: Sequence[Column], right_keys: Sequence[Column],
                   how: str) -> DataFrame:
    """Join with a right side that was grouped by its keys.

    Such a side already has the partitioning of the join. It then gets no exchange of its
    own, and adaptive execution does not split a skewed left side. Keys compared as one
    structure ask for that exchange again: a row per key, small beside the left side.
    Keys with a null part match nothing, as in any join on equality.
    """
    plain = reduce(and_, [a == b for a, b in zip(left_keys, right_keys, strict=True)])
    ours, theirs = ([kind for _, kind in df.select(*keys).dtypes] for df, keys in ((left, left_keys), (right, right_keys)))
    if ours != theirs:
        return left.join(right, plain, how)
    known = right.where(reduce(and_, [b.isNotNull() for b in right_keys]))

    def packed(keys: Sequence[Column]) -> Column:
        return F.struct(*[key.alias(f"k{i}") for i, key in enumerate(keys)])

    return left.join(known, packed(left_keys) == packed(right_keys), how)
