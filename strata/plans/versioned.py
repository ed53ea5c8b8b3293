"""Bucketed tables that change by new files and a marker, never in place.

A store is a folder of one or more tables whose rows are dealt to key-hash
buckets.  A commit writes the touched buckets of every table to a folder of
its own, and last a *manifest*: for every table, which commit holds each
bucket's rows.  Readers follow the newest complete manifest, so they see all
of a commit or nothing of it, and a commit that failed half-way is only files
that no manifest names (the next commit uses another folder).

A manifest is one small file, put in its place by a rename that refuses to
replace another.  A writer numbers its manifest after the one it has read, so
of two writers that began from the same version one gets `CommitConflict` and
must begin again; neither can undo the other's rows.

The number of buckets is stored in the manifest: it is chosen when the store
is made and the same key always finds its bucket again.  Manifests also hold
each table's schema, so a table without rows can be read.  Every `EXPIRE_EVERY`
commits the files of all but the last `KEEP` versions are deleted.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions import hashing
from strata.session import CODEC, release

BUCKET = "_bucket"
DEFAULT_BUCKETS = 16
KEEP, EXPIRE_EVERY = 8, 8


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the store."""


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


class Manifests:
    """Numbered manifests of a folder; one counts when its writing has ended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: dict | None = None
        self._number: int | None = None

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _complete(self) -> list[int]:
        """Numbers of the manifests, oldest first."""
        return sorted(int(n[:-5]) for n in self._children(f"{self.path}/manifests") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict | None:
        """The newest manifest, or None for a folder without one.

        It is read once; an object sees other writers' later commits only
        after one of its own.
        """
        if self._number is None:
            done = self._complete()
            self._number = done[-1] if done else -1
            self._known = self._load(done[-1]) if done else None
        return self._known

    def _load(self, number: int) -> dict:
        fs, p = self._fs(f"{self.path}/manifests/{number}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _next(self) -> int:
        self.manifest()
        return self._number + 1

    def _mark(self, manifest: dict, number: int) -> None:
        """The last step of a commit: its manifest appears under its number."""
        sc = self.spark.sparkContext
        fs, place = self._fs(f"{self.path}/manifests/{number}.json")
        draft = self._fs(f"{self.path}/manifests/.{uuid.uuid4().hex}")[1]
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        hadoop = sc._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(place), sc._gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if fs.exists(place):
                raise CommitConflict(f"{self.path}: version {number} was committed by another writer") from e
            raise
        self._known = self._number = None
        if number % EXPIRE_EVERY == EXPIRE_EVERY - 1:
            self.vacuum(KEEP)

    def _folders(self, manifest: dict) -> set[str]:
        """Data folders that a manifest names."""
        raise NotImplementedError

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete commits that none of the last `keep` manifests names.

        Folders with a later number than the oldest of these manifests may
        belong to a commit under way and stay.
        """
        done = self._complete()
        kept = done[-keep:]
        named = set().union(*(self._folders(self._load(n)) for n in kept))
        gone = [c for c in self._children(f"{self.path}/data") if c not in named and int(c[:8]) <= kept[0]] if kept else []
        for path in [f"{self.path}/data/{c}" for c in gone] + [f"{self.path}/manifests/{n}.json" for n in done[:-keep]]:
            fs, p = self._fs(path)
            fs.delete(p, True)
        return gone


class VersionedTable(Manifests):
    """One table that is replaced as a whole: new files, then the manifest."""

    def replace(self, write: Callable[[str], None]) -> None:
        """`write` fills the folder it is given."""
        number = self._next()
        folder = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        write(f"{self.path}/data/{folder}")
        self._mark({"folder": folder}, number)

    def _folders(self, manifest: dict) -> set[str]:
        return {manifest["folder"]}

    def folder(self) -> str | None:
        """Folder of the current version, or None before the first."""
        m = self.manifest()
        return f"{self.path}/data/{m['folder']}" if m else None


class BucketStore(Manifests):
    """Versioned tables under one folder, keyed by the same columns.

    `n_buckets` counts only when the store is made; later it is read from the
    manifest.  It should put a few hundred MB of rows in each bucket.  Tables
    named in `buckets` are dealt by that whole-number expression instead (a
    fact by its months, say), whose values must be few enough to list.
    Hashes in ``derived`` (table -> column -> what it follows from) are stored
    only where they differ from that (``hashing.without``).
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], n_buckets: int = DEFAULT_BUCKETS,
                 buckets: dict[str, Column] | None = None, derived: dict[str, dict[str, hashing.Derived]] | None = None):
        super().__init__(spark, path)
        self.keys, self._wanted, self._buckets, self.derived = list(keys), n_buckets, buckets or {}, derived or {}

    @property
    def n_buckets(self) -> int:
        m = self.manifest()
        return m["n_buckets"] if m else self._wanted

    # -- reading

    def bucket(self, table: str | None = None) -> Column:
        return self._buckets.get(table, bucket_of(self.keys, self.n_buckets))

    def touched(self, batch: DataFrame, table: str | None = None) -> list[int]:
        """Buckets of a batch's keys: at most `n_buckets` small numbers."""
        return sorted(r[0] for r in batch.select(self.bucket(table)).distinct().collect())

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of a table (of some buckets only), or None if there never was one.

        Only the named buckets' folders are listed and scanned.  With a bucket
        expression of the table's own, the bucket is a column of the result.
        """
        m = self.manifest() or {"tables": {}}
        if table not in m["tables"]:
            return None
        held = m["tables"][table]
        if buckets is not None:
            held = {b: c for b, c in held.items() if int(b) in set(buckets)}
        schema = StructType.fromJson(json.loads(m["schemas"][table]))
        parts = [f"{self.path}/data/{commit}/{table}/{BUCKET}={b}" for b, commit in sorted(held.items())]
        df = self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)
        df = hashing.restored(df, self.derived.get(table, {}))
        return df.withColumn(BUCKET, self.bucket(table)) if table in self._buckets else df

    def as_stored(self) -> BucketStore:
        """The store for readers that leave derived hashes out as the files do."""
        bare = copy.copy(self)
        bare.derived = {}
        return bare

    def fresh(self, table: str) -> list[int]:
        """Buckets with rows that the last commit wrote."""
        m = self.manifest() or {"tables": {}}
        return sorted(int(b) for b, c in m["tables"].get(table, {}).items() if int(c[:8]) == self._number)

    # -- writing

    def commit(self, tables: dict[str, DataFrame], touched: Sequence[int] | dict[str, Sequence[int]],
               batch_id: int | None = None, as_stored: Sequence[str] = ()) -> None:
        """Replace the touched buckets (of each table) by the rows given.

        A bucket with a hot key is split over several tasks and files (the
        rebalance hint cuts partitions that are too large).  A touched bucket
        without rows becomes empty.  Without a batch id the store keeps the
        last one.  Tables in ``as_stored`` come without derived hashes.
        """
        number = self._next()
        old = self.manifest() or {"n_buckets": self._wanted, "tables": {}, "schemas": {}, "batch_id": None}
        commit = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        placed, schemas = {}, {}
        for name, df in tables.items():
            if name not in as_stored:
                df = hashing.without(df, self.derived.get(name, {}))
            out = f"{self.path}/data/{commit}/{name}"
            dealt = hashing.packed_during(df.withColumn(BUCKET, self.bucket(name)), lambda d: d.hint("rebalance", BUCKET))
            dealt.write.partitionBy(BUCKET).parquet(out, compression=CODEC)
            written = {n.split("=")[1] for n in self._children(out) if n.startswith(f"{BUCKET}=")}
            gone = set(touched[name] if isinstance(touched, dict) else touched)
            held = {b: c for b, c in old["tables"].get(name, {}).items() if int(b) not in gone}
            placed[name] = held | {b: commit for b in written}
            schemas[name] = df.drop(BUCKET).schema.json()
            release(self.spark)
        self._mark({"n_buckets": old["n_buckets"], "batch_id": old["batch_id"] if batch_id is None else batch_id,
                    "tables": {**old["tables"], **placed}, "schemas": {**old["schemas"], **schemas}}, number)

    def _folders(self, manifest: dict) -> set[str]:
        return {c for held in manifest["tables"].values() for c in held.values()}

    def has_applied(self, batch_id: int) -> bool:
        """Whether a batch with this or a later number is in the store."""
        m = self.manifest()
        return bool(m) and m.get("batch_id") is not None and m["batch_id"] >= batch_id
