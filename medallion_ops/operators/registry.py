"""An append-only registry of surrogate keys.

Every key value that was ever given a number stays registered with it, whether
or not a later load still holds it, so facts stored earlier keep pointing at
the same row and no number is issued twice. Two Parquet tables under one path:

* ``keys``: the key columns and their number, a folder per load, which counts
  once it is committed (so a frame made before a load never sees half of it,
  nor any of it);
* ``marks``: the range of numbers each load reserved. The highest one is the
  high-water mark.

A load reserves its numbers before it writes its keys. If it fails in between,
the numbers stay unused (a gap) and a rerun reserves new ones. Keys are matched
null-safely: a null is one more value. One load writes at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.operators.keys import dense_surrogate_key, match
from medallion_ops.operators.merge import assert_unique
from medallion_ops.session import materialize_counted


MARKS = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])


class KeyRegistry:
    """The registry at ``path`` for the key columns ``keys``, whose numbers are called ``name``."""

    def __init__(self, spark: SparkSession, path: str, keys, name: str = "sk"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self._schema: T.StructType | None = None         # of the keys, once known: no footers are read for it

    def _files(self, path: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _committed(self, path: str) -> bool:
        done, files = self._files(f"{path}/_SUCCESS")
        return files.exists(done)

    def high_water(self) -> int:
        """The highest number ever reserved; 0 before the first load."""
        path = f"{self.path}/marks"
        if not self._committed(path):
            return 0
        return self.spark.read.schema(MARKS).parquet(path).agg(F.max("last").alias("m")).collect()[0]["m"] or 0

    def issued(self) -> DataFrame | None:
        """The key columns and ``name`` of every key ever registered; None before the first load."""
        folder, files = self._files(f"{self.path}/keys")
        loads = sorted(str(x.getPath()) for x in files.listStatus(folder)) if files.exists(folder) else []
        loads = [x for x in loads if self._committed(x)]
        if not loads:
            return None
        read = self.spark.read if self._schema is None else self.spark.read.schema(self._schema)
        return read.parquet(*loads)

    def register(self, incoming: DataFrame) -> DataFrame:
        """Gives a number to every key of ``incoming`` that has none and returns all issued ones.

        New numbers follow the high-water mark densely in key order (nulls
        first). A load without new keys writes nothing.
        """
        keys, known = incoming.select(*self.keys).distinct(), self.issued()
        new = keys if known is None else match(keys, known.select(*self.keys), self.keys, "left_anti")
        new, n = materialize_counted(new, "registry_new")
        if n or known is None:
            start = self.high_water() + 1
            if n:
                self._reserve(start, start + n - 1)
            self._append(dense_surrogate_key(new, self.keys, name=self.name, start=start))
        return self.issued()

    def adopt(self, dimension: DataFrame) -> DataFrame:
        """Begins the registry with the numbers that a dimension built without one holds already."""
        if self.issued() is not None:
            raise ValueError(f"{self.path} holds keys already")
        highest = dimension.agg(F.max(self.name).alias("m")).collect()[0]["m"]
        if highest:
            self._reserve(1, highest)
        self._append(dimension.select(*self.keys, F.col(self.name).cast("bigint").alias(self.name)))
        return self.issued()

    def _reserve(self, first: int, last: int) -> None:
        self.spark.createDataFrame([(first, last)], MARKS).coalesce(1).write.mode("append").parquet(f"{self.path}/marks")

    def _append(self, numbered: DataFrame) -> None:
        rows = numbered.select(*self.keys, self.name)
        rows.write.parquet(f"{self.path}/keys/load=l{uuid.uuid4().hex[:12]}")
        self._schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with ``name`` first; null where the key was never registered."""
        return match(df, self.issued(), self.keys, "left").select(self.name, *df.columns)


def keyed_dimension(registry: KeyRegistry, incoming: DataFrame, previous: DataFrame | None = None,
                    check_unique: bool = True) -> DataFrame:
    """The next state of a dimension whose rows never lose their number.

    Registers the keys of ``incoming`` (one row per key, checked) and returns
    its rows with their numbers first, and the rows of ``previous``, the state
    before, whose keys ``incoming`` no longer holds, as they were.
    """
    if check_unique:
        assert_unique(incoming, registry.keys, "incoming")
    registry.register(incoming)
    rows = registry.attach(incoming)
    if previous is None:
        return rows
    gone = match(previous, incoming.select(*registry.keys), registry.keys, "left_anti")
    return rows.unionByName(gone.select(*rows.columns))
