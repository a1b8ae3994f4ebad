"""Tables kept in parts, with a ledger of the batches that made them.

A part holds the rows of one key, such as a month. A write puts new parts beside those in use, reads back what it wrote, and then switches a
small manifest that names the parts of every key and the batches loaded so far. The switch is the commit: rows and ledger change together, a
batch that is there adds nothing when it comes again, and a write that stops in between leaves the table as it was. Keys that a batch does
not touch keep their files.

The manifest has one entry for a part and one for a batch, so the driver handles numbers of months and of loads, never rows. One writer at a
time; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.schemas import Schema, read_schema

KEY = "part_key"


@dataclass(frozen=True)
class Part:
    key: int
    path: str
    rows: int
    batch: str


@dataclass(frozen=True)
class Batch:
    """One committed write: the version it made, its rows and the keys it changed."""

    batch: str
    version: int
    rows: int
    keys: list[int]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    last_id: int = 0
    parts: list[Part] = field(default_factory=list)
    batches: list[Batch] = field(default_factory=list)


class PartTable:
    """A table below ``root``. ``key`` gives a row's part as an integer; ``serial`` names its id column, if it has one."""

    def __init__(self, spark: SparkSession, root: str, schema: Schema, key: Column, serial: str | None = None, order: Sequence[str] = ()):
        self.spark, self.root, self.schema = spark, root, dict(schema)
        self.key, self.serial, self.order = key, serial, list(order)

    # --- Reading ------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def manifest(self) -> Manifest:
        """The one of the highest version; a manifest gets its name when it is complete."""
        files, folder = self._path("_manifest")
        if not files.exists(folder):
            return Manifest()
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not versions:
            return Manifest()
        text = self.spark.read.text(f"{self.root}/_manifest/{max(versions)}.json", wholetext=True).first()[0]
        known = json.loads(text)
        return Manifest(known["version"], known["last_id"], [Part(**p) for p in known["parts"]], [Batch(**b) for b in known["batches"]])

    def read(self, keys: Sequence[int] | None = None) -> DataFrame:
        """The committed rows, of some keys or of all; only the files of those keys are read."""
        wanted = None if keys is None else set(keys)
        paths = [p.path for p in self.manifest().parts if wanted is None or p.key in wanted]
        shape = read_schema(self.schema)
        return self.spark.read.schema(shape).parquet(*paths) if paths else self.spark.createDataFrame([], shape)

    def has(self, batch: str) -> bool:
        return any(b.batch == batch for b in self.manifest().batches)

    def ledger(self) -> DataFrame:
        """One row for each batch: its name, the version it made, its rows and how many keys it changed."""
        rows = [(b.batch, b.version, b.rows, len(b.keys)) for b in self.manifest().batches]
        return self.spark.createDataFrame(rows, "batch string, version long, records long, parts long")

    def changed_since(self, version: int) -> list[int]:
        """Keys that batches after a version changed."""
        return sorted({k for b in self.manifest().batches if b.version > version for k in b.keys})

    # --- Writing ------------------------------------------------------------------------------------------------

    def append(self, rows: DataFrame, batch: str) -> int:
        """Add the rows of a batch; 0 if the table has it. Returns the number of rows added."""
        return self._write(rows, batch, replaced=None)

    def replace(self, rows: DataFrame, keys: Sequence[int], batch: str) -> int:
        """Put ``rows`` in place of all rows of ``keys``; returns their number, 0 if the table has the batch."""
        return self._write(rows, batch, replaced=set(keys))

    def keys_of(self, rows: DataFrame) -> list[int]:
        """The keys that rows touch: as many as months or buckets."""
        return sorted(r[0] for r in rows.select(self.key.cast("int")).distinct().collect())

    def _write(self, rows: DataFrame, batch: str, replaced: set[int] | None) -> int:
        before = self.manifest()
        if any(b.batch == batch for b in before.batches):
            return 0
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        keyed = rows.select(*self.schema).withColumn(KEY, self.key.cast("int"))
        by = [KEY, *self.order]
        # Ranges over several columns, so a month with most of the rows is still cut up.
        keyed = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
        if self.serial:
            given = F.lit(before.last_id + 1) + F.monotonically_increasing_id()
            keyed = keyed.withColumn(self.serial, given if replaced is None else F.coalesce(F.col(self.serial), given))
        keyed.write.partitionBy(KEY).parquet(path)
        written = self.spark.read.schema(read_schema({**self.schema, KEY: "INT"})).parquet(path)
        highest = F.max(self.serial) if self.serial else F.lit(0)
        sums = written.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), highest.cast("long").alias("last")).collect()
        new = [Part(r[KEY], f"{path}/{KEY}={r[KEY]}", r["n"], batch) for r in sums]
        kept = [p for p in before.parts if replaced is None or p.key not in replaced]
        version, added = before.version + 1, sum(p.rows for p in new)
        keys = sorted({p.key for p in new} | (replaced or set()))
        last = max([before.last_id, *(r["last"] or 0 for r in sums)])
        self._commit(Manifest(version, last, [*kept, *new], [*before.batches, Batch(batch, version, added, keys)]))
        return added

    def compact(self, keys: Sequence[int] | None = None) -> int:
        """Bring the parts of each key together; rows, ids and the ledger's batches stay. Returns the number of keys rewritten."""
        parts = self.manifest().parts
        count: dict[int, int] = {}
        for p in parts:
            count[p.key] = count.get(p.key, 0) + 1
        several = [k for k, n in count.items() if n > 1 and (keys is None or k in keys)]
        if several:
            self.replace(self.read(several), several, f"compact-{uuid.uuid4().hex}")
        return len(several)

    def vacuum(self) -> int:
        """Remove data that no part of the current manifest names: what stopped writes and replaced parts left. Returns the folders removed."""
        files, folder = self._path("data")
        used = {p.path.split("/data/")[1] for p in self.manifest().parts}
        removed = 0
        for status in files.listStatus(folder) if files.exists(folder) else []:
            for part in files.listStatus(status.getPath()):
                name = f"{status.getPath().getName()}/{part.getPath().getName()}"
                if part.isDirectory() and name not in used:
                    removed += bool(files.delete(part.getPath(), True))
        return removed

    def _commit(self, manifest: Manifest) -> None:
        """Write the manifest beside the others and give it its name; a version can be committed once."""
        files, draft = self._path(f"_manifest/_draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        out.close()
        _, path = self._path(f"_manifest/{manifest.version}.json")
        if files.exists(path) or not files.rename(draft, path):
            raise RuntimeError(f"version {manifest.version} of {self.root} is there already: another writer was faster")
