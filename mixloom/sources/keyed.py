"""A table of mixes by key, in versions.

Each commit is a folder of Parquet files, ``<path>/delta/version=<n>``, with the rows that were put and a mark for the keys
that were taken out; compaction writes the whole table as of a version to ``<path>/base/version=<n>``. Reading merges: of each key the last
version counts, so a late correction is one more commit and nothing that is stored is rewritten. Rows are in ``bucket``
folders by a hash of the key, in the order of the key, so that a few keys are read from few files.

A folder gets its name only when it is complete and checked: a lost job leaves a folder under ``<path>/_writing`` and no
version. One job writes at a time; any number may read.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_DELETED, _VERSION, _BUCKET = "_deleted", "version", "bucket"


class CommitError(Exception):
    """The rows cannot be a version; nothing was committed."""


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # Folders

    def _place(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._place().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, kind: str) -> list[int]:
        place, files = self._place(kind), self._files()
        if not files.exists(place):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in files.listStatus(place))

    def version(self) -> int:
        """The last version; 0 before the first commit."""
        return max([0, *self._versions("delta"), *self._versions("base")])

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, version: int) -> None:
        own, files = self._place("_writing", uuid4().hex), self._files()
        dealt = rows.withColumn(_BUCKET, self._bucket(F.col(self.key))).repartition(_BUCKET).sortWithinPartitions(_BUCKET, self.key)
        dealt.write.partitionBy(_BUCKET).parquet(own.toString())
        written = self.spark.read.schema(f"{self.key} {rows.schema[self.key].dataType.simpleString()}").parquet(own.toString())
        bad = written.groupBy(self.key).count().where(F.col(self.key).isNull() | (F.col("count") > 1)).first()
        if bad is not None:
            files.delete(own, True)
            raise CommitError(f"null or repeated {self.key}: {bad[self.key]}")
        to = self._place(kind, f"{_VERSION}={version}")
        files.mkdirs(to.getParent())
        if files.exists(to) or not files.rename(own, to):
            raise CommitError(f"version {version} was committed by another job")

    # Writing

    def commit(self, put: DataFrame | None = None, delete: DataFrame | None = None) -> int:
        """One version: rows ``put`` in place of those of their keys, the keys in ``delete`` taken out. Returns its number.

        A key comes once in a commit and is never null.
        """
        if put is None and delete is None:
            raise ValueError("nothing to commit")
        parts = []
        if put is not None:
            parts.append(put.withColumn(_DELETED, F.lit(False)))
        if delete is not None:
            parts.append(delete.select(self.key).withColumn(_DELETED, F.lit(True)))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        version = self.version() + 1
        self._write(rows, "delta", version)
        return version

    def compact(self) -> int:
        """Write the table as of the last version as one base, which later reads start from."""
        version = self.version()
        if version and version not in self._versions("base"):
            self._write(self.read(), "base", version)
        return version

    def expire(self) -> None:
        """Delete what the last base stands for; versions before it can no longer be read."""
        bases = self._versions("base")
        for kind in ("base", "delta"):
            for version in self._versions(kind):
                if bases and (version < bases[-1] or (kind == "delta" and version == bases[-1])):
                    self._files().delete(self._place(kind, f"{_VERSION}={version}"), True)

    # Reading

    def _deltas(self, since: int, until: int) -> DataFrame | None:
        """Of each key that versions after ``since`` up to ``until`` have, its last row."""
        versions = [v for v in self._versions("delta") if since < v <= until]
        if not versions:
            return None
        paths = [self._place("delta", f"{_VERSION}={v}").toString() for v in versions]
        rows = self.spark.read.option("basePath", self._place("delta").toString()).option("mergeSchema", "true").parquet(*paths)
        others = [c for c in rows.columns if c not in (self.key, _VERSION, _BUCKET)]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), F.col(_VERSION)).alias("_row"))
        return last.select(self.key, "_row.*")

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the last one by default.

        Commits are small beside the base: their last rows are gathered by key, and the base only loses the keys they have.
        """
        until = self.version() if version is None else version
        bases = [v for v in self._versions("base") if v <= until]
        first = bases[-1] if bases else 0
        if until < 1 or until > self.version() or not (bases or 1 in self._versions("delta")):
            raise ValueError(f"no version {until}")
        last = self._deltas(first, until)
        live = last.where(~F.col(_DELETED)).drop(_DELETED) if last is not None else None
        if not bases:
            return live
        base = self.spark.read.parquet(self._place("base", f"{_VERSION}={first}").toString()).drop(_BUCKET)
        if last is None:
            return base
        return base.join(last.select(self.key), self.key, "left_anti").unionByName(live, allowMissingColumns=True)

    def get(self, keys: Sequence) -> DataFrame:
        """Rows of a few keys, read from their buckets alone."""
        kind = dict(self.read().dtypes)[self.key]
        asked = [F.lit(k).cast(kind) for k in keys]
        buckets = self.spark.range(1).select(F.array(*[self._bucket(k) for k in asked])).first()[0]
        parts = []
        for of in ("base", "delta"):
            places = [self._place(of, f"{_VERSION}={v}", f"{_BUCKET}={b}") for v in self._versions(of) for b in set(buckets)]
            paths = [p.toString() for p in places if self._files().exists(p)]
            if paths:
                rows = self.spark.read.option("basePath", self._place(of).toString()).option("mergeSchema", "true").parquet(*paths)
                # A base as of a version says no more than the commits up to it.
                parts.append(rows if _DELETED in rows.columns else rows.withColumn(_DELETED, F.lit(False)))
        if not parts:
            return self.read().where(F.lit(False))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        rows = rows.where(F.col(self.key).isin(asked))
        others = [c for c in rows.columns if c not in (self.key, _VERSION, _BUCKET)]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), F.col(_VERSION)).alias("_row")).select(self.key, "_row.*")
        return last.where(~F.col(_DELETED)).drop(_DELETED)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """``key, change`` of the keys that versions after ``since`` touched: insert, update or delete, against the table as of ``since``.

        A key that came and went in between is left out.
        """
        until = self.version() if until is None else until
        last = self._deltas(since, until)
        if last is None:
            if until > since:
                raise ValueError(f"versions after {since} have expired")
            return self.read(until).select(self.key, F.lit("").alias("change")).where(F.lit(False))
        touched = last.select(self.key, _DELETED)
        if since:
            before = self.read(since).select(self.key, F.lit(True).alias("_before"))
            touched = touched.join(before, self.key, "left")
        else:
            touched = touched.withColumn("_before", F.lit(None).cast("boolean"))
        had = F.col("_before").isNotNull()
        change = F.when(had & F.col(_DELETED), "delete").when(had, "update").when(~F.col(_DELETED), "insert")
        return touched.select(self.key, change.alias("change")).where(F.col("change").isNotNull())
