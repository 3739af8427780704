"""Last write wins, step by step: a keyed table that takes upserts as deltas by
bucket, so that an upsert reads nothing and a merge reads only its buckets.

`path/v=<n>/bucket=<k>` holds what version n wrote of bucket k; `path/manifest/<n>.json`
lists the versions that make up every bucket. A version counts from the moment its
manifest has its name: what a failed or repeated job left behind is never read. One
writer at a time."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.tables import latest_by_key, merge_schemas
from pagemill.sources.warc import _open_fs, full_path


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    buckets: int = 0
    parts: dict[int, list[int]] = field(default_factory=dict)  # bucket: versions, oldest first


@dataclass(frozen=True)
class VersionedTable:
    """Rows by `key`; of a key the row with the largest `newest` stays, on a tie the
    one of the later upsert. Upserts may have different columns: absent ones are null."""

    spark: SparkSession
    path: str
    key: str = "row_key"
    newest: str = "fetch_time"
    buckets: int = 64

    def manifest(self) -> Manifest:
        fs, root = _open_fs(self._root())
        found = fs.get_file_info(pafs.FileSelector(f"{root}/manifest", allow_not_found=True))
        names = [f.path for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("_")]
        if not names:
            return Manifest(buckets=self.buckets)
        with fs.open_input_stream(max(names)) as f:
            held = json.loads(f.read())
        return Manifest(held["version"], held["buckets"], {int(b): v for b, v in held["parts"].items()})

    def _root(self) -> str:
        return full_path(self.spark, self.path).rstrip("/")

    def _commit(self, new: Manifest) -> None:
        fs, root = _open_fs(self._root())
        fs.create_dir(f"{root}/manifest", recursive=True)
        name = f"{new.version:012d}.json"
        with fs.open_output_stream(f"{root}/manifest/_{name}") as out:
            out.write(json.dumps({"version": new.version, "buckets": new.buckets, "parts": new.parts}).encode())
        fs.move(f"{root}/manifest/_{name}", f"{root}/manifest/{name}")

    def _write(self, rows: DataFrame, version: int, buckets: int) -> list[int]:
        """The buckets that the version has. A rebalance splits a hot bucket."""
        at = F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")
        folder = f"{self.path}/v={version}"
        rows.withColumn("bucket", at).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return sorted(r["bucket"] for r in self.spark.read.parquet(folder).select("bucket").distinct().collect())

    def upsert(self, rows: DataFrame) -> list[int]:
        """Add rows; returns the buckets they touch. Nothing that is stored is read."""
        now = self.manifest()
        version = now.version + 1
        if rows.isEmpty():
            return []
        touched = self._write(latest_by_key(rows, self.key, F.col(self.newest)), version, now.buckets)
        parts = {**now.parts, **{b: [*now.parts.get(b, []), version] for b in touched}}
        self._commit(Manifest(version, now.buckets, parts))
        return touched

    def _stored(self, now: Manifest, wanted: set[int]) -> DataFrame | None:
        """All stored rows of some buckets, with `_version`."""
        versions = sorted({v for b in wanted for v in now.parts.get(b, [])})
        if not versions:
            return None
        tables = []
        for v in versions:
            folder = f"{self.path}/v={v}"
            paths = [f"{folder}/bucket={b}" for b in sorted(wanted) if v in now.parts.get(b, [])]
            tables.append(self.spark.read.option("basePath", folder).parquet(*paths).drop("bucket").withColumn("_version", F.lit(v)))
        return merge_schemas(*tables)

    def _merged(self, now: Manifest, wanted: set[int]) -> DataFrame | None:
        stored = self._stored(now, wanted)
        return stored if stored is None else latest_by_key(stored, self.key, F.struct(self.newest, "_version")).drop("_version")

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows, of all or of some buckets; None without any."""
        now = self.manifest()
        return self._merged(now, set(now.parts if buckets is None else buckets))

    def compact(self, most: int = 4) -> list[int]:
        """Merge the buckets that more than `most` versions make up; returns them. Other
        buckets are not read. Files of merged versions stay until `vacuum`."""
        now = self.manifest()
        wanted = {b for b, versions in now.parts.items() if len(versions) > most}
        if not wanted:
            return []
        version = now.version + 1
        self._write(self._merged(now, wanted), version, now.buckets)
        self._commit(Manifest(version, now.buckets, {**now.parts, **{b: [version] for b in wanted}}))
        return sorted(wanted)

    def vacuum(self) -> None:
        """Delete folders and manifests that the current manifest does not need."""
        now = self.manifest()
        fs, root = _open_fs(self._root())
        used = {(v, b) for b, versions in now.parts.items() for v in versions}
        for folder in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            parts = folder.path[len(root):].strip("/").split("/")
            if folder.type == pafs.FileType.Directory and len(parts) == 2 and parts[1].startswith("bucket="):
                if (int(parts[0][2:]), int(parts[1][7:])) not in used:
                    fs.delete_dir(folder.path)
            elif parts[0] == "manifest" and len(parts) == 2 and parts[1] != f"{now.version:012d}.json":
                fs.delete_file(folder.path)
