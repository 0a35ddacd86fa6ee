"""A keyed table fed by micro-batches that stays readable from a bounded number of folders."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from monthgrid.sinks.tables import VersionedTable, delete_folder

#: Batches that are kept apart before they are merged into the table's parts.
MERGE_EVERY = 8
_MANIFEST = "kind string, part string, path string, batch long"


class Entry(NamedTuple):
    """A folder of the table: a ``delta`` (one batch), a ``base`` part, a ``retired`` folder of the last merge, or the ``mark`` (last batch)."""

    kind: str
    part: str
    path: str
    batch: int


class KeyedTable:
    """A parquet table updated by key from micro-batches; the newest row of a key wins.

    Newest is the row with the largest ``order`` columns, of equals the one of the later batch, of equals the largest row. Without
    ``order`` the later batch wins.

    Each batch is written to a folder of its own and then listed in a manifest, which is swapped in one step; readers open what the
    manifest lists and nothing else. A batch repeated after a failure rewrites its own folder, and one that is already listed
    changes nothing. After ``merge_every`` batches their rows are merged into the parts of the table they touch (years of ``by``, or
    the whole table) and the batches' folders retire; they are deleted at the next merge, when no reader opens them any more. A
    read thus opens at most one folder per part and ``merge_every`` batches, however many batches have come.

    One table belongs to one stream checkpoint: batch numbers must never start again.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = (),
                 by: str | None = None, merge_every: int = MERGE_EVERY):
        if by is not None and (by not in keys or not isinstance(schema[by].dataType, (DateType, TimestampType, TimestampNTZType))):
            raise ValueError("parts go by a date among the keys, so that all rows of a key are in one part")
        self.spark, self.folder, self.schema, self.keys, self.order, self.by = spark, folder, schema, list(keys), list(order), by
        self.merge_every = merge_every
        self._log = StructType([*schema.fields, StructField("_batch", LongType())])
        self._manifest = VersionedTable(spark, f"{folder}/manifest")

    def entries(self) -> list[Entry]:
        """The folders of the table now; as many as parts and unmerged batches."""
        known = self._manifest.read()
        return [] if known is None else [Entry(*r) for r in known.select("kind", "part", "path", "batch").collect()]

    def _commit(self, entries: list[Entry]) -> None:
        self._manifest.swap(self.spark.createDataFrame([tuple(e) for e in entries], _MANIFEST).coalesce(1))
        self._manifest.prune(2)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch."""
        if batch_id > self.last_batch():
            path = f"{self.folder}/delta/batch={batch_id}"
            batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(path)
            self.adopt(path, batch_id)

    def last_batch(self) -> int:
        return max((e.batch for e in self.entries() if e.kind == "mark"), default=-1)

    def adopt(self, path: str | None, batch_id: int) -> None:
        """Add a folder of rows that a batch has already written; None for a batch without rows. The folder is the table's from now on."""
        entries = self.entries()
        if batch_id <= max((e.batch for e in entries if e.kind == "mark"), default=-1):
            return
        entries = [e for e in entries if e.kind != "mark"] + [Entry("mark", "", "", batch_id)]
        if path is not None:
            entries.append(Entry("delta", "", path, batch_id))
        if sum(e.kind == "delta" for e in entries) < self.merge_every:
            return self._commit(entries)
        old = [e.path for e in entries if e.kind == "retired"]
        self._commit(self._merged(entries))
        for folder in old:
            delete_folder(self.spark, folder)

    def _rows(self, entries: Sequence[Entry]) -> DataFrame:
        """All rows of some folders, with their batch."""
        out = self.spark.createDataFrame([], self._log)
        base = [e.path for e in entries if e.kind == "base"]
        if base:
            out = out.unionByName(self.spark.read.schema(self._log).parquet(*base))
        for e in entries:
            if e.kind == "delta":
                out = out.unionByName(self.spark.read.schema(self.schema).parquet(e.path).withColumn("_batch", F.lit(e.batch).cast("long")))
        return out

    def _newest(self, rows: DataFrame) -> DataFrame:
        row = F.struct(*[c for c in self.schema.fieldNames() if c not in self.keys], "_batch")
        newest = F.max_by(row, F.struct(*self.order, "_batch", row))
        return rows.groupBy(*self.keys).agg(newest.alias("_row")).select(
            *[F.col(c) if c in self.keys else F.col(f"_row.{c}") for c in self._log.fieldNames()])

    def _part(self):
        return F.lit("all") if self.by is None else F.coalesce(F.year(self.by).cast("string"), F.lit("none"))

    def _merged(self, entries: list[Entry]) -> list[Entry]:
        """The manifest after its deltas have been merged into the parts they touch; other parts are not read."""
        deltas = [e for e in entries if e.kind == "delta"]
        touched = {r[0] for r in self._rows(deltas).select(self._part()).distinct().collect()}  # years, so few
        joined = [e for e in entries if e.kind == "base" and e.part in touched]
        folder = f"{self.folder}/base/through={deltas[-1].batch}"
        merged = self._newest(self._rows([*joined, *deltas])).withColumn("_part", self._part())
        merged.repartition("_part", *self.keys).write.mode("overwrite").partitionBy("_part").parquet(folder)
        fresh = [Entry("base", part, f"{folder}/_part={part}", deltas[-1].batch) for part in sorted(touched)]
        kept = [e for e in entries if e.kind == "mark" or (e.kind == "base" and e.part not in touched)]
        return [*kept, *fresh, *[e._replace(kind="retired") for e in (*joined, *deltas)]]

    def read(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """The current rows; with ``by``, only the years from ``start`` to ``end``: other parts are not opened."""
        entries = [e for e in self.entries() if e.kind in ("base", "delta")]
        rows = self._rows([e for e in entries if e.kind == "delta" or self._wanted(e.part, start, end)])
        if self.by is not None and start is not None:
            rows = rows.filter(F.year(self.by) >= start)
        if self.by is not None and end is not None:
            rows = rows.filter(F.year(self.by) <= end)
        return self._newest(rows).drop("_batch")

    def _wanted(self, part: str, start: int | None, end: int | None) -> bool:
        if part == "all" or (start is None and end is None):
            return True
        return part != "none" and (start is None or int(part) >= start) and (end is None or int(part) <= end)
