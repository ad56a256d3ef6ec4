"""Column identity: files name their columns by number, a versioned map gives the numbers their names.

A rename changes the map only, a dropped name that is used again gets a new
number, so neither revives or loses old values and no file is rewritten. A
column that a file does not have is NULL; types are those of the map, and
no file footer is opened to find a schema.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import balanced_by

_MAP = "version int, position int, name string, number int, type string, following int"


@dataclass(frozen=True)
class Columns:
    """One version of a table's columns: (name, number, type) in order, and the next free number."""

    fields: tuple[tuple[str, int, str], ...]
    following: int

    @classmethod
    def of(cls, schema: T.StructType) -> Columns:
        return cls(tuple((f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(schema.fields)), len(schema.fields) + 1)

    def _at(self, name: str) -> int:
        for i, f in enumerate(self.fields):
            if f[0] == name:
                return i
        raise ValueError(f"no column {name!r}")

    def _free(self, name: str) -> None:
        if any(f[0].lower() == name.lower() for f in self.fields):
            raise ValueError(f"column {name!r} exists")

    def add(self, name: str, kind: str) -> Columns:
        self._free(name)
        return replace(self, fields=(*self.fields, (name, self.following, kind)), following=self.following + 1)

    def rename(self, old: str, new: str) -> Columns:
        i = self._at(old)
        if old.lower() != new.lower():
            self._free(new)
        return replace(self, fields=(*self.fields[:i], (new, *self.fields[i][1:]), *self.fields[i + 1:]))

    def drop(self, name: str) -> Columns:
        i = self._at(name)
        return replace(self, fields=self.fields[:i] + self.fields[i + 1:])

    def write(self, df: DataFrame, path: str, partition: str | None = None, mode: str = "append") -> None:
        """Appends rows with this version's columns, by the partition column if there is one."""
        out = df.select(*(F.col(n).cast(t).alias(f"c{k}") for n, k, t in self.fields))
        own = f"c{self.fields[self._at(partition)][1]}" if partition else None
        w = (balanced_by(out, own) if own else out).write.mode(mode)
        (w.partitionBy(own) if own else w).parquet(f"{path}/data")

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """All rows under this version's names; a filter on the partition column still prunes."""
        schema = ", ".join(f"c{k} {t}" for _, k, t in self.fields)
        return spark.read.schema(schema).parquet(f"{path}/data").select(*(F.col(f"c{k}").alias(n) for n, k, _ in self.fields))


def save(spark: SparkSession, path: str, versions: list[Columns]) -> None:
    """Writes the whole version history, a few rows per version, into a file of its own."""
    rows = [(v, i, n, k, t, c.following) for v, c in enumerate(versions) for i, (n, k, t) in enumerate(c.fields)]
    spark.createDataFrame(rows, _MAP).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


def load(spark: SparkSession, path: str) -> list[Columns]:
    """All versions, oldest first: the last one is the table's, an earlier one reads it as it was named then."""
    rows = spark.read.schema(_MAP).parquet(f"{path}/columns").orderBy("version", "position").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["version"], []).append(r)
    return [Columns(tuple((r["name"], r["number"], r["type"]) for r in v), v[0]["following"]) for v in out.values()]
