"""A table with one row per key, kept as a bucketed base and bucketed deltas.

New rows are appended to the delta of the current generation, dealt to its buckets; the base is not
touched. A read folds the delta's copies of a key bucket by bucket and joins them to the base, without
a shuffle of either, and reads the base once. When the delta has outgrown the base, both are folded into
the base of the next generation. A generation counts once its marker is written, which is last, so a
fold that broke off leaves the one before in force. Appending a batch a second time after a failure adds
copies that the fold takes for one, as the rule that picks a key's row does not look at their number.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class KeyedTable:
    """``order`` says which of a key's rows stays: the greatest, or the smallest with ``first``; the rest
    of the row breaks ties. Fix ``buckets`` for the table's final size: a bucket is one task's work."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    order: tuple[str, ...]
    first: bool = False
    buckets: int = 16

    def _table(self, part: str, generation: int) -> str:
        """The name under which a part is known to this session; its files are found by their folder."""
        name = f"keyed_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{part}_{generation}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"create table if not exists {name} ({columns}) using parquet clustered by (`{self.key}`) sorted by (`{self.key}`)"
            f" into {self.buckets} buckets location '{self.path}/{part}-{generation}'"
        )
        self.spark.catalog.refreshTable(name)  # a streaming query writes in a session of its own
        return name

    def generation(self) -> int:
        """0 is the empty base that every table begins with."""
        try:
            found = self.spark.read.schema("generation int").parquet(f"{self.path}/_generations").agg(F.max("generation")).first()[0]
        except AnalysisException:
            return 0
        return found or 0

    def base(self) -> DataFrame:
        return self.spark.table(self._table("base", self.generation()))

    def delta(self) -> DataFrame:
        return self.spark.table(self._table("delta", self.generation()))

    def _one(self, rows: DataFrame) -> DataFrame:
        rest = [f.name for f in self.schema if f.name not in (self.key, *self.order)]
        pick = (F.min if self.first else F.max)(F.struct(*self.order, *rest))
        return rows.groupBy(self.key).agg(pick.alias("__row"))

    def append(self, rows: DataFrame) -> None:
        """Adds rows, copies of known keys among them. One row per key is kept of what is added."""
        names = [f.name for f in self.schema]
        columns = [F.col(c) if c == self.key else F.col(f"__row.{c}").alias(c) for c in names]
        one = self._one(rows).select(*columns)
        one.repartition(self.buckets, self.key).write.insertInto(self._table("delta", self.generation()))

    def read(self) -> DataFrame:
        """One row per key."""
        names = [f.name for f in self.schema if f.name != self.key]
        rest = [c for c in names if c not in self.order]
        base = self.base().select(self.key, F.struct(*self.order, *rest).alias("__base"))
        merged = base.join(self._one(self.delta()), self.key, "full")
        pick = (F.least if self.first else F.greatest)("__base", "__row")
        chosen = merged.select(self.key, F.coalesce(pick, "__base", "__row").alias("__r"))
        return chosen.select(*[F.col(f.name) if f.name == self.key else F.col(f"__r.{f.name}").alias(f.name) for f in self.schema])

    def fold(self, ratio: float = 1.0) -> bool:
        """A new base when the delta has at least ``ratio`` as many rows as the base; the row counts are
        read from the files' footers."""
        now = self.generation()
        new, old = self.delta().count(), self.base().count()
        if not new or new < ratio * old:
            return False
        # What an earlier fold left there before it broke off is written over.
        self.read().write.mode("overwrite").insertInto(self._table("base", now + 1))
        marker = self.spark.range(1).select(F.lit(now + 1).alias("generation"))
        marker.coalesce(1).write.mode("append").parquet(f"{self.path}/_generations")
        return True
