"""Tables whose partitions are replaced by numbered batches.

A batch writes new versions of the partitions that it touches into a folder of its own number and
then one manifest, which names the version of every partition. Readers follow the newest
manifest, so they see a batch whole or not at all. What a reader may use is never overwritten: a
batch that failed before its manifest was written starts again from the manifest before it, and
one that comes again after that is already there (``applied``). What neither the new manifest nor
the one before it names is deleted after each batch, so folders do not pile up with the batches.

A manifest is a small file that the driver reads: a line for every partition. Partitions are spans
of days or hash buckets, so their number is that of the weeks or buckets, not of the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Column of a stored row that names its partition.
PART = "store_part"


@dataclass(frozen=True)
class Snapshot:
    """A store as one manifest names it; ``number`` is that of its batch."""

    store: Store
    number: int | None
    versions: dict[tuple[str, str], int]

    def parts(self, table: str) -> set[str]:
        return {p for t, p in self.versions if t == table}

    def read(self, table: str, schema: StructType, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of a table, of the given partitions only: nothing else is listed or scanned."""
        wanted = None if parts is None else set(parts)
        path, spark = f"{self.store.path}/{table}", self.store.spark
        paths = [f"{path}/store_batch={v}/{PART}={p}" for (t, p), v in sorted(self.versions.items())
                 if t == table and (wanted is None or p in wanted)]
        whole = StructType([f for f in schema.fields if f.name != PART]).add(PART, "string")
        if not paths:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("basePath", path).parquet(*paths).drop("store_batch")


class Store:
    """Named tables under ``path``; their rows carry the partition as the string column ``store_part``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    # --- reading

    def _manifests(self) -> list[int]:
        """Numbers of the batches whose manifests are kept."""
        path = self._hadoop(f"{self.path}/manifest")
        names = [n for n in self._names(path) if n.endswith(".json")] if self._system(path).exists(path) else []
        return sorted(int(n.removesuffix(".json")) for n in names)

    def _manifest(self, number: int) -> dict[tuple[str, str], int]:
        at = self._hadoop(f"{self.path}/manifest/{number}.json")
        source = self._system(at).open(at)
        try:
            rows = json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)))
        finally:
            source.close()
        return {(t, p): v for t, p, v in rows}

    def _write_manifest(self, number: int, versions: Mapping[tuple[str, str], int]) -> None:
        """Written under another name first: a manifest is there whole or not at all."""
        new, at = (self._hadoop(f"{self.path}/manifest/{n}") for n in (f"{number}.new", f"{number}.json"))
        system = self._system(at)
        out = system.create(new, True)
        try:
            out.write(bytearray(json.dumps([[t, p, v] for (t, p), v in sorted(versions.items())]).encode()))
        finally:
            out.close()
        system.delete(at, False)
        if not system.rename(new, at):
            raise OSError(f"cannot write {at}")

    def snapshot(self, before: int | None = None) -> Snapshot:
        """The store as of the last batch, or of the last one before a number."""
        seen = [b for b in self._manifests() if before is None or b < before]
        return Snapshot(self, seen[-1], self._manifest(seen[-1])) if seen else Snapshot(self, None, {})

    def applied(self, number: int) -> bool:
        return number in self._manifests()

    def read(self, table: str, schema: StructType, parts: Iterable[str] | None = None) -> DataFrame:
        return self.snapshot().read(table, schema, parts)

    # --- writing

    def commit(self, number: int, base: Snapshot, changes: Mapping[str, tuple[DataFrame, Iterable[str]]],
               notes: Mapping[tuple[str, str], int] | None = None, drop=lambda table, part: False) -> None:
        """Replace the named partitions of each table of ``base`` by the rows given; partitions without rows go.

        ``notes`` are kept in the manifest beside the versions, replacing earlier notes of their table;
        ``drop`` names partitions that are left out of the manifest from now on.
        """
        now = {k: v for k, v in base.versions.items() if k[0] not in {t for t, _ in notes or {}}}
        for table, (rows, parts) in changes.items():
            folder, parts = f"{self.path}/{table}/store_batch={number}", set(parts)
            # Partitions may differ much in size: large ones are split, small ones share a task.
            rows.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").parquet(folder)
            filled = {n.split("=", 1)[1] for n in self._names(self._hadoop(folder)) if n.startswith(f"{PART}=")}
            if filled - parts:
                raise ValueError(f"rows for partitions that are not replaced: {sorted(filled - parts)[:5]}")
            now = {k: v for k, v in now.items() if k[0] != table or k[1] not in parts} | {(table, p): number for p in filled}
        now = {k: v for k, v in (now | dict(notes or {})).items() if not drop(*k)}
        self._write_manifest(number, now)
        self._sweep({(t, v) for versions in (base.versions, now) for (t, _), v in versions.items()}, {base.number, number})

    # --- folders

    def _sweep(self, named: set[tuple[str, int]], kept: set[int | None]) -> None:
        """Delete all manifests but the new one and that before it, and the versions that neither names."""
        last = max(k for k in kept if k is not None)
        for number in self._manifests():
            if number not in kept and number < last:
                self._delete(f"{self.path}/manifest/{number}.json")
        for table in self._names(self._hadoop(self.path)):
            for name in self._names(self._hadoop(f"{self.path}/{table}")) if table != "manifest" else ():
                if (table, int(name.split("=")[1])) not in named and int(name.split("=")[1]) <= last:
                    self._delete(f"{self.path}/{table}/{name}")

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, path) -> list[str]:
        return [s.getPath().getName() for s in self._system(path).listStatus(path)]

    def _delete(self, path: str) -> None:
        at = self._hadoop(path)
        self._system(at).delete(at, True)
