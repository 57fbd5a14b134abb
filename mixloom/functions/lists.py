"""Array helpers."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_items(items: Column | str, n: int) -> Column:
    """The last ``n`` elements; the whole array when it is shorter."""
    if n < 1:
        raise ValueError(f"n has to be positive: {n}")
    start = F.greatest(F.size(items) - F.lit(n - 1), F.lit(1))
    return F.slice(items, start, F.lit(n))


def ordered_values(value: str, order_by: Sequence[str], present: Column | None = None) -> Column:
    """Aggregate: the group's values as an array, ordered by ``order_by``.

    Null values are left out, unless ``present`` says which rows count. Each row enters the list
    once and the list is sorted once, in the final aggregation.
    """
    entry = F.struct(*[F.col(c) for c in order_by], F.col(value).alias("_value"))
    counts = F.col(value).isNotNull() if present is None else present
    gathered = F.collect_list(F.when(counts, entry))
    return F.transform(F.sort_array(gathered), lambda e: e["_value"])
