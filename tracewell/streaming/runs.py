"""Tables of sorted runs under one manifest: what streams write their answers to.

    <path>/manifest/00000012.json    tables and their runs, the last batch taken in, notes
    <path>/<table>/batch-7           rows of batch 7, sorted by key
    <path>/<table>/merged-10         eight runs merged into one

A batch writes a run for each table it touches and then one manifest that names them all, by a rename. What a
manifest does not name does not exist, so a crash between any two steps loses nothing and shows nothing
half done; a batch that runs again overwrites its own runs, and one that is already in the manifest is skipped, so sums
stay right. Eight runs of one level are merged into one of the next, so a read touches a few runs for each
power of eight of the batches. One query writes to a store at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = "_seq"  # batch that a row came with
FAN = 8       # runs of one level that are merged into one of the next
KEPT = 8      # manifests whose runs stay readable

COMBINE: dict[str, Callable[[str], Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Table:
    """Rows with a key; ``how`` says for each value how rows of one key combine: sum, min or max. Without
    ``how`` the newest row of a key counts whole."""

    name: str
    keys: tuple[str, ...]
    how: dict[str, str] = field(default_factory=dict)

    def combined(self, rows: DataFrame) -> DataFrame:
        """One row for each key."""
        grouped = rows.groupBy(*self.keys)
        if self.how:
            values = [COMBINE[kind](c).alias(c) for c, kind in self.how.items()]
            return grouped.agg(*values, F.max(SEQ).alias(SEQ))
        values = [c for c in rows.columns if c not in self.keys]
        return grouped.agg(F.max_by(F.struct(*values), SEQ).alias("v")).select(*self.keys, "v.*")


class RunStore:
    """Tables below ``path``, in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, fan: int = FAN):
        self.spark, self.path, self.fan = spark, path.rstrip("/"), fan

    # --- files ---------------------------------------------------------------------------

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        files, folder = self._files(), self._at("manifest")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest(self, version: int) -> dict:
        stream = self._files().open(self._at("manifest", f"{version:08}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, version: int, manifest: dict) -> None:
        files, name = self._files(), f"{version:08}.json"
        draft, final = self._at("manifest", f"_draft-{name}"), self._at("manifest", name)
        out = files.create(draft, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"{name} in {self.path} was written by another query")

    # --- reading -------------------------------------------------------------------------

    def manifest(self) -> dict:
        """The newest manifest: ``version``, ``batch`` (last one taken in), ``notes``, ``tables``."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "batch": -1, "notes": {}, "tables": {}}
        return {**self._manifest(versions[-1]), "version": versions[-1]}

    def runs(self, name: str) -> list[str]:
        return [r["name"] for r in self.manifest()["tables"].get(name, {}).get("runs", [])]

    def rows(self, name: str, schema: str | None = None) -> DataFrame:
        """All rows of a table with ``_seq``; a key may come several times. ``schema`` is for a table that has no run yet."""
        table = self.manifest()["tables"].get(name)
        if table is None:
            if schema is None:
                raise ValueError(f"no table {name} in {self.path}")
            return self.spark.createDataFrame([], f"{schema}, {SEQ} BIGINT")
        return self._read(table["schema"], name, [r["name"] for r in table["runs"]])

    def read(self, table: Table) -> DataFrame:
        """One row for each key."""
        return table.combined(self.rows(table.name)).drop(SEQ)

    def _read(self, schema: str, name: str, runs: list[str]) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/{name}/{r}" for r in runs])

    # --- writing -------------------------------------------------------------------------

    def write_run(self, table: Table, batch: int, rows: DataFrame) -> DataFrame:
        """The run of a batch, sorted by key and read again; it does not count before ``commit``."""
        rows = rows.withColumn(SEQ, F.lit(batch).cast("long"))
        return self._sorted(table, f"batch-{batch}", rows)

    def _sorted(self, table: Table, run: str, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{table.name}/{run}"
        rows.repartitionByRange(*table.keys).sortWithinPartitions(*table.keys).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, batch: int, written: list[tuple[Table, DataFrame]], **notes) -> None:
        """Take the runs of a batch in, all at once."""
        now = self.manifest()
        tables = {n: {**t, "runs": list(t["runs"])} for n, t in now["tables"].items()}
        for table, run in written:
            known = tables.setdefault(table.name, {"schema": run.schema.json(), "runs": []})
            known["runs"].append({"name": f"batch-{batch}", "level": 0})
        self._swap(now["version"] + 1, {"batch": batch, "notes": {**now["notes"], **notes}, "tables": tables})
        for table, _ in written:
            self._compact(table)
        self._forget()

    def _compact(self, table: Table) -> None:
        """Merge the runs of a level into one as long as there are ``fan`` of them."""
        while True:
            now = self.manifest()
            own = now["tables"][table.name]
            levels = [r["level"] for r in own["runs"]]
            full = next((level for level in sorted(set(levels)) if levels.count(level) >= self.fan), None)
            if full is None:
                return
            merged = [r for r in own["runs"] if r["level"] == full]
            name = f"merged-{now['version'] + 1}"
            rows = self._read(own["schema"], table.name, [r["name"] for r in merged])
            columns = [f["name"] for f in json.loads(own["schema"])["fields"]]
            self._sorted(table, name, table.combined(rows).select(*columns))
            rest = [r for r in own["runs"] if r not in merged]
            at = sum(r["level"] > full for r in rest)  # older runs have higher levels and stand first
            rest.insert(at, {"name": name, "level": full + 1})
            tables = {**now["tables"], table.name: {**own, "runs": rest}}
            self._swap(now["version"] + 1, {"batch": now["batch"], "notes": now["notes"], "tables": tables})

    def _forget(self) -> None:
        """Delete manifests before the last ``KEPT`` and the runs that only those name."""
        versions, files = self._versions(), self._files()
        old, kept = versions[:-KEPT], versions[-KEPT:]
        if not old:
            return

        def named(version: int) -> set[tuple[str, str]]:
            return {(n, r["name"]) for n, t in self._manifest(version)["tables"].items() for r in t["runs"]}

        still = set().union(*map(named, kept))
        for version in old:
            for table, run in named(version) - still:
                files.delete(self._at(table, run), True)
            files.delete(self._at("manifest", f"{version:08}.json"), False)

    def each_batch(self, take: Callable[[DataFrame, int, dict], None]) -> Callable[[DataFrame, int], None]:
        """``take(batch, batch_id, manifest)`` for batches that the store does not hold yet; for ``foreachBatch``."""

        def run(batch: DataFrame, batch_id: int) -> None:
            now = self.manifest()
            if batch_id > now["batch"]:
                take(batch, batch_id, now)

        return run


def start(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Give every micro-batch of what has landed so far to ``take``."""
    return (
        stream.writeStream.outputMode(mode).foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

