"""A keyed table that outlives its process: rows in buckets of their key, sets of changes, and manifests that say which of them hold.

Every commit writes one set of whole rows, only those that are new or changed, dealt by bucket, and then a manifest with the next version number.
A manifest's name can be taken once, so of two processes that start from one version the second gets a Conflict, and takes up the first one's
version. Reading lays the newest row of each key over the base; both sides of an update read only the buckets that its keys
fall into. When FOLD sets have come together, the buckets that they touch, and no others, are written anew as base.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frontier import first_of, update

#: Buckets of a new table, and sets of changes that are laid over the base at most.
BUCKETS, FOLD = 64, 8
#: How often a commit is tried from the newest version on.
TRIES = 10


class Conflict(Exception):
    """Another process has committed the version."""


@dataclass
class Store:
    """A table of `schema` under the folder root, one row for each `key`. A new Store on a root that exists goes on with its newest version."""

    spark: SparkSession
    root: str
    schema: str
    key: str = "url_hash"
    buckets: int = BUCKETS
    fold_at: int = FOLD
    manifest: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.refresh()

    # ---- files --------------------------------------------------------------------------------------------------------
    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root.rstrip("/"), *names)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that have a manifest, the newest last."""
        at, fs = self._path("manifests"), self._fs()
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def _told(self, version: int) -> dict:
        return json.loads(self.spark.read.text(self._path("manifests", f"{version:012d}.json").toString(), wholetext=True).first()[0])

    def refresh(self) -> int:
        """Take up the newest version; its number, 0 before the first commit."""
        known = self.versions()
        if not known:
            self.manifest = {"version": 0, "buckets": self.buckets, "base": {}, "sets": []}
        elif known[-1] != self.manifest.get("version"):
            self.manifest = self._told(known[-1])
            self.buckets = self.manifest["buckets"]
        return self.version

    @property
    def version(self) -> int:
        return self.manifest["version"]

    def _commit(self, manifest: dict) -> None:
        """The manifest under its version's name, whole or not at all; Conflict if the name is taken."""
        jvm, fs = self.spark._jvm, self._fs()
        fs.mkdirs(self._path("manifests"))
        draft, name = self._path("manifests", f".{uuid.uuid4().hex}"), self._path("manifests", f"{manifest['version']:012d}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(draft, name, self.spark.sparkContext._gateway.new_array(rename, 0))  # never onto a file that is there
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(name):
                raise Conflict(f"version {manifest['version']} of {self.root}") from error
            raise
        self.manifest = manifest

    # ---- rows ---------------------------------------------------------------------------------------------------------
    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of rows fall into; no more than there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(F.col(self.key))).distinct().collect())

    def _sets(self, paths: list[str]) -> DataFrame:
        whole = f"{self.schema}, set string, bucket int"
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", self._path("data").toString()).parquet(*paths)

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of the version that was taken up; only those of some buckets, if given, whose folders alone are read."""
        wanted = None if buckets is None else set(buckets)
        base = [self._path("data", f"set={s}", f"bucket={b}").toString() for b, s in self.manifest["base"].items() if wanted is None or int(b) in wanted]
        columns = [c.split()[0] for c in self.schema.split(", ")]
        rows, sets = self._sets(base), self.manifest["sets"]
        if not sets:
            return rows.select(columns)
        over = self._sets([self._path("data", f"set={s}").toString() for s in sets])
        if wanted is not None:
            over = over.filter(F.col("bucket").isin(sorted(wanted)) if wanted else F.lit(False))
        newest = first_of(over.select(*columns, F.array_position(F.array(*map(F.lit, sets)), F.col("set")).alias("turn_")), [self.key], -F.col("turn_")).select(columns)
        return rows.select(columns).join(newest.select(self.key), self.key, "left_anti").select(columns).unionByName(newest)

    def _write(self, rows: DataFrame) -> str | None:
        """A new set of rows, one file a bucket; None if there are no rows."""
        columns = [f.split() for f in self.schema.split(", ")]
        full = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns])
        name = uuid.uuid4().hex
        full.withColumn("bucket", self.bucket(F.col(self.key))).repartition("bucket").write.partitionBy("bucket").parquet(self._path("data", f"set={name}").toString())
        return name if self._held(name) else None

    def _held(self, name: str) -> list[int]:
        folders = [s.getPath().getName() for s in self._fs().listStatus(self._path("data", f"set={name}"))]
        return sorted(int(f[7:]) for f in folders if f.startswith("bucket="))

    def transact(self, rows: Callable[[Store], DataFrame]) -> int:
        """Commit what rows(self) gives: whole rows, one a key, new or in place of those with their key. If another process was faster, rows() is asked
        again on its version. The number of the version; no rows make none."""
        for _ in range(TRIES):
            self.refresh()
            name = self._write(rows(self))
            if name is None:
                return self.version
            try:
                self._commit({**self.manifest, "version": self.version + 1, "sets": [*self.manifest["sets"], name]})
            except Conflict:
                self._fs().delete(self._path("data", f"set={name}"), True)
                continue
            if len(self.manifest["sets"]) >= self.fold_at:
                self.fold()
            return self.version
        raise Conflict(f"{TRIES} times in {self.root}")

    def insert(self, new: DataFrame) -> int:
        """Rows of new, one a key, whose key the table lacks."""
        return self.transact(lambda s: first_of(new, [s.key], *([-F.col("priority_score"), F.col("source")] if {"priority_score", "source"} <= set(new.columns) else [F.xxhash64(*new.columns)])).join(s.read(s.touched(new)).select(s.key), s.key, "left_anti"))

    def merge(self, changes: DataFrame, columns: list[str]) -> int:
        """Values of changes in place of those of the rows with their key, as frontier.update() has it; keys that the table lacks are passed over."""

        def rows(s: Store) -> DataFrame:
            held = s.read(s.touched(changes)).join(changes.select(s.key), s.key, "left_semi")
            return update(held.withColumnRenamed(s.key, "url_hash"), changes.withColumnRenamed(s.key, "url_hash"), columns).withColumnRenamed("url_hash", s.key)

        return self.transact(rows)

    def retain(self, stay: Column) -> int:
        """Delete rows for which `stay` is not true; only the buckets that hold such rows are written anew."""
        self.refresh()
        return self.fold(self.touched(self.read().filter(~F.coalesce(stay, F.lit(False)))), stay)

    def fold(self, buckets: Iterable[int] = (), stay: Column | None = None) -> int:
        """Write anew, as base, the buckets that sets of changes touch, and those given. Conflicts leave the work to another time."""
        anew = sorted({*buckets, *(b for s in self.manifest["sets"] for b in self._held(s))})
        if not anew:
            return self.version
        rows = self.read(anew)
        name = self._write(rows if stay is None else rows.filter(stay))
        held = self._held(name) if name else []
        base = {b: s for b, s in self.manifest["base"].items() if int(b) not in anew} | {str(b): name for b in held}
        try:
            self._commit({**self.manifest, "version": self.version + 1, "base": base, "sets": []})
        except Conflict:
            if name:
                self._fs().delete(self._path("data", f"set={name}"), True)
            if stay is not None:
                raise
            self.refresh()
        return self.version

    def vacuum(self, keep: int = 2) -> int:
        """Delete sets and manifests that only versions before the `keep` newest need; how many sets. Readers of those versions lose them, and so does
        a commit that is under way elsewhere: it fails, and is tried anew."""
        known = self.versions()
        fs, data = self._fs(), self._path("data")
        if not known or not fs.exists(data):
            return 0
        used = {s for v in known[-keep:] for m in [self._told(v)] for s in (*m["base"].values(), *m["sets"])}
        gone = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName()[4:] not in used]
        for path in gone:
            fs.delete(path, True)
        for v in known[:-keep]:
            fs.delete(self._path("manifests", f"{v:012d}.json"), False)
        return len(gone)
