"""Sharding: documents cut into contiguous shards whose largest is as small as it can be.

Groups (equal texts) are never divided and stand in the order of their text's SHA-256, so a shard is a range of digests
and a document finds its shard by comparing its own digest with the cuts. The smallest feasible capacity is found by
binary search with a greedy check. The check works on totals of digest prefixes: where a greedy cut would
fall inside a prefix with several groups, an upper and a lower bound of the cut are carried on; prefixes between
the bounds are then divided by one more digit, until both agree. So the driver holds the totals of ``16 ** DIGITS``
prefixes plus those near the cuts, however many documents there are, and the result is exact.

Under that capacity cuts are moved towards equal sizes where the rest stays feasible.

A null text counts as an empty one (both are one group). Repeated rows are rows of their own, with slots of
their own. Without rows there are no shards. Fewer groups than shards leave shards empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import running_positions, stored, text_bytes

DIGITS = 4
ROW_BYTES = 16


class Blocks:
    """Totals of digest prefixes in order; ``ends`` are the sums up to and including each."""

    def __init__(self, rows: list[tuple[str, int, str, str]]):
        self.rows = sorted(rows)
        self.ends, self.open = [0], []
        for _, size, first, last in self.rows:
            self.ends.append(self.ends[-1] + size)
            self.open.append(first != last)
        self.total = self.ends[-1]

    def step(self, at: int, capacity: int) -> tuple[int, int]:
        """Least and greatest place where the last cut within the capacity may be."""
        k = bisect_right(self.ends, at + capacity) - 1
        least = self.ends[k]
        if k < len(self.rows) and self.open[k]:
            return least, min(at + capacity, self.ends[k + 1] - 1)
        return least, least

    def reaches(self, capacity: int, shards: int, at: int = 0, bound: int = 0) -> bool:
        """Whether the rest fits; ``bound`` 0 takes the least, so it is certain, 1 the greatest place of each cut."""
        for _ in range(shards):
            if at >= self.total:
                return True
            to = self.step(at, capacity)[bound]
            if to <= at:
                return False
            at = to
        return at >= self.total

    def smallest(self, shards: int, bound: int) -> int:
        low, high = max(1, -(-self.total // shards)), max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if self.reaches(middle, shards, bound=bound):
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, shards: int, low: int, high: int) -> list[str]:
        """Prefixes of several groups in which a cut may be, for capacities from ``low`` to ``high``."""
        least = most = 0
        found: set[int] = set()
        for _ in range(shards):
            least, most = self.step(least, low)[0], self.step(most, high)[1]
            for k in range(max(0, bisect_right(self.ends, least) - 1), min(len(self.rows), bisect_left(self.ends, most + 1))):
                if self.open[k]:
                    found.add(k)
        return [self.rows[k][0] for k in sorted(found)]

    def cuts(self, capacity: int, shards: int) -> list[str]:
        """The last digest of each shard but the last one."""
        at, out = 0, []
        for left in range(shards, 1, -1):
            far = bisect_right(self.ends, at + capacity) - 1
            even = bisect_left(self.ends, at + -(-(self.total - at) // left))
            if even < far and self.reaches(capacity, left - 1, self.ends[even]):
                far = even
            at = self.ends[far]
            out.append(self.rows[far - 1][3] if far else "")
        return out


def _totals(sized: DataFrame, digits: int, inside: list[str] | None = None) -> list[tuple[str, int, str, str]]:
    if inside is not None:
        wanted = sized.sparkSession.createDataFrame([(p,) for p in inside], "_in string")
        within = F.substring("digest", 1, digits - 1) == F.col("_in")
        sized = sized.join(wanted, within, "left_semi")
    prefix = F.substring("digest", 1, digits).alias("prefix")
    totals = sized.groupBy(prefix).agg(F.sum("size"), F.min("digest"), F.max("digest"))
    return [tuple(row) for row in totals.collect()]


def find_cuts(sized: DataFrame, shards: int, digits: int = DIGITS) -> tuple[int, list[str]]:
    """Smallest capacity and the cuts, of rows ``digest, size``."""
    blocks = Blocks(_totals(sized, digits))
    parts = {row[0]: row for row in blocks.rows}
    while True:
        low, high = blocks.smallest(shards, 1), blocks.smallest(shards, 0)
        if low == high or not (inside := [p for p in blocks.unsure(shards, low, high)]):
            return high, blocks.cuts(high, shards)
        for length in sorted({len(p) for p in inside}):
            own = [p for p in inside if len(p) == length]
            for p in own:
                del parts[p]
            parts |= {row[0]: row for row in _totals(sized, length + 1, own)}
        blocks = Blocks(list(parts.values()))


def _shard(cuts: list[str]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("digest") > F.lit(cut)).cast("int")
    return shard


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``doc_id, text``.

    Size: the text's bytes plus 16. Slots are gapless within a shard.
    """
    text = F.coalesce("text", F.lit(""))
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (text_bytes() + ROW_BYTES).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        ),
        "sized",
    )
    _, cuts = find_cuts(sized, shards)
    placed = sized.withColumn("shard", _shard(cuts))
    numbered = running_positions(placed, "shard", ["doc_id", "digest"], F.lit(1), "slot")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
