"""Tables that live on between runs: immutable bucketed runs and a written manifest.

A store is a folder.  Every change writes new Parquet runs, bucketed and sorted
by the columns they will be joined on (one file a bucket), and then one new
manifest that names the runs of every table.  Readers take the manifest of the
highest version, so a change that fails before its manifest leaves the old
version readable.  A join with the bucketing columns reads a run without
shuffling it.  The catalog is used only while a run is written or opened.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class StaleStore(RuntimeError):
    """Another writer has put a newer manifest in place."""


class RunStore:
    """Named tables of runs under ``root``; ``buckets`` is fixed when the store is made."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(sc._jsc.hadoopConfiguration())
        self.manifest = self._read() or {
            "version": 0, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "done": [], "tables": {}}
        self.buckets = self.manifest["buckets"]

    # ------------------------------------------------------------------ manifest

    def _manifests(self) -> list[int]:
        folder = self._path(f"{self.root}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _read(self) -> dict | None:
        versions = self._manifests()
        if not versions:
            return None
        stream = self._fs.open(self._path(f"{self.root}/manifest/v{versions[-1]}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, tables: dict[str, list[dict]], done: str | None = None) -> None:
        """Swap to a version in which ``tables`` have these runs (others stay); ``done`` names the input that made it."""
        new = {**self.manifest, "version": self.manifest["version"] + 1, "tables": {**self.manifest["tables"], **tables},
               "done": self.manifest["done"] + ([done] if done is not None else [])}
        draft = self._path(f"{self.root}/manifest/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        final = self._path(f"{self.root}/manifest/v{new['version']}.json")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise StaleStore(f"{self.root} has version {new['version']} already")
        self.manifest = new

    def is_done(self, name: str) -> bool:
        return name in self.manifest["done"]

    # ------------------------------------------------------------------ runs

    def runs(self, table: str) -> list[dict]:
        return self.manifest["tables"].get(table, [])

    def write(self, df: DataFrame, table: str, keys: list[str], dealt: bool = False) -> dict:
        """A new run: one sorted file a bucket.  It belongs to no version until
        ``commit``.  ``dealt``: every partition of ``df`` holds one bucket already (a merge
        of runs), so nothing is shuffled."""
        path, name = f"{self.root}/{table}/{uuid.uuid4().hex}", f"run_{uuid.uuid4().hex}"
        df = df if dealt else self.dealt(df, keys)
        df.write.bucketBy(self.buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        rows = self.spark.read.schema(df.schema).parquet(path).count()  # from the footers
        return {"path": path, "keys": keys, "rows": rows, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)}

    def open(self, run: dict) -> DataFrame:
        """A run with its bucketing known to the planner."""
        name, keys = f"run_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in run["keys"])
        self.spark.sql(f"CREATE TABLE {name} ({run['schema']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{run['path']}'")
        df = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return df

    def dealt(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``df`` partitioned as the runs with these keys are."""
        return df.repartition(self.buckets, *keys)

    def vacuum(self) -> None:
        """Delete runs and manifests that the current version does not name (no reader may hold an older one)."""
        live = {r["path"].rsplit("/", 1)[1] for runs in self.manifest["tables"].values() for r in runs}
        for table in self._fs.listStatus(self._path(self.root)):
            for entry in self._fs.listStatus(table.getPath()):
                name = entry.getPath().getName()
                old = name != f"v{self.manifest['version']}.json" if table.getPath().getName() == "manifest" else name not in live
                if old:
                    self._fs.delete(entry.getPath(), True)
