"""Keyed tables that grow by numbered deltas.

A save writes what changed and nothing else, so its cost follows the change and not the table. A read takes the
newest base and the deltas after it, and keeps the last row of each key. Compaction writes such a read as a new
base; nothing that readers use is replaced, so they go on beside it, and any number since the last ``forget`` can
still be read. A delta or base that was cut off has no ``_SUCCESS`` file and is not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.sources import table
from ferrylog.staging import children, delete, exists

GONE = "__gone"
_NUMBER = "__number"


@dataclass(frozen=True)
class DeltaTable:
    """A table of ``schema`` with one row per ``keys``, at the numbers 0, 1, 2, ...

    With ``compact_every`` a write that finds so many deltas since the last base first makes a base of them.
    Null keys are keys like others.
    """

    root: str
    schema: str
    keys: tuple[str, ...]
    compact_every: int | None = None

    def __post_init__(self):
        if self.compact_every is not None and self.compact_every < 1:
            raise ValueError("compact_every must be positive")

    def latest(self, spark: SparkSession) -> int:
        """The highest number that can be read, -1 when nothing is there."""
        return max(table.last_batch(spark, self._deltas), self._base(spark))

    def write(self, changes: DataFrame, number: int, *, order: str | Column | None = None, gone: Column | None = None) -> None:
        """Delta ``number``: new rows of their keys, or, where ``gone`` holds, the end of a key.

        Of several changes of a key the one with the highest ``order`` counts, else the one with the highest values.
        Writing a number again replaces it, as long as no base holds it.
        """
        spark = changes.sparkSession
        if number < 0:
            raise ValueError("numbers begin with 0")
        self._check(spark, number)
        if number <= self._base(spark):
            raise ValueError(f"delta {number} is part of a base and cannot be replaced")
        if self.compact_every and len(self._between(spark, self._base(spark, number - 1), number - 1)) >= self.compact_every:
            self.compact(spark, number - 1)
        row = F.struct(F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False), *self._values(spark))
        row = row.cast(self._row_type(spark))
        by = row if order is None else F.struct(F.col(order) if isinstance(order, str) else order, row)
        last = changes.groupBy(*self.keys).agg(F.max_by(row, by).alias("row"))
        table.write_batch(last.select(*self.keys, "row.*"), self._deltas, number)

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The table as it was after delta ``number``, the last one if none is named."""
        columns = spark.createDataFrame([], self.schema).columns
        number = self.latest(spark) if number is None else number
        self._check(spark, number)
        base = self._base(spark, number)
        paths = [table.batch_path(self._deltas, n) for n in self._between(spark, base, number)]
        stored = f"{self.schema}, {GONE} BOOLEAN"
        if base < 0 and not paths:
            return spark.createDataFrame([], self.schema)
        parts = []
        if base >= 0:
            old = spark.read.schema(self.schema).parquet(table.batch_path(self._bases, base))
            if not paths:
                return old
            parts.append(old.withColumns({GONE: F.lit(False), _NUMBER: F.lit(-1).cast("bigint")}))
        news = spark.read.schema(f"{stored}, batch_id BIGINT").option("basePath", self._deltas).parquet(*paths)
        parts.append(news.withColumnRenamed("batch_id", _NUMBER))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        row = F.struct(GONE, *self._values(spark))
        last = rows.groupBy(*self.keys).agg(F.max_by(row, _NUMBER).alias("row"))
        return last.where(~F.col(f"row.{GONE}")).select(*self.keys, "row.*").select(columns)

    def compact(self, spark: SparkSession, number: int | None = None) -> int:
        """Make a base of all that a read at ``number`` gives; return the number, -1 when there is nothing."""
        number = self.latest(spark) if number is None else number
        if number >= 0 and number > self._base(spark, number):
            table.write_batch(self.read(spark, number), self._bases, number)
        return number

    def forget(self, spark: SparkSession, before: int) -> int:
        """Delete what only reads of numbers before the last base up to ``before`` need; return the first number kept.

        That number is noted before anything is deleted: whoever asks for an older one gets an error, never a part.
        """
        floor = self._base(spark, before)
        if floor < 0:
            return 0
        note = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_kept_from/{floor}")
        note.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(note)
        for folder, upto in ((self._bases, floor - 1), (self._deltas, floor)):
            for n in self._numbers(spark, folder):
                if n <= upto:
                    delete(spark, table.batch_path(folder, n))
        return floor

    @property
    def _deltas(self) -> str:
        return f"{self.root}/deltas"

    @property
    def _bases(self) -> str:
        return f"{self.root}/bases"

    def _row_type(self, spark: SparkSession) -> str:
        fields = spark.createDataFrame([], self.schema).schema.fields
        values = [f"{f.name}: {f.dataType.simpleString()}" for f in fields if f.name not in self.keys]
        return f"struct<{', '.join([f'{GONE}: boolean', *values])}>"

    def _values(self, spark: SparkSession) -> list[str]:
        return [c for c in spark.createDataFrame([], self.schema).columns if c not in self.keys]

    def _numbers(self, spark: SparkSession, folder: str) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in children(spark, folder) if name.startswith("batch_id="))

    def _complete(self, spark: SparkSession, folder: str, n: int) -> bool:
        return exists(spark, f"{table.batch_path(folder, n)}/_SUCCESS")

    def _base(self, spark: SparkSession, upto: int | None = None) -> int:
        """The last complete base up to a number, -1 when there is none."""
        numbers = [n for n in self._numbers(spark, self._bases) if upto is None or n <= upto]
        return next((n for n in reversed(numbers) if self._complete(spark, self._bases, n)), -1)

    def _between(self, spark: SparkSession, base: int, upto: int) -> list[int]:
        """Complete deltas after a base."""
        return [n for n in self._numbers(spark, self._deltas) if base < n <= upto and self._complete(spark, self._deltas, n)]

    def _check(self, spark: SparkSession, number: int) -> None:
        floor = max(map(int, children(spark, f"{self.root}/_kept_from")), default=-1)
        if 0 <= number < floor:
            raise ValueError(f"number {number} is not kept any more; the first one is {floor}")
