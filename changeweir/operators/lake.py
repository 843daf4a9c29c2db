"""Versioned Parquet tables: one commit per batch, merged on read.

Where an Iceberg catalog exists, use its tables (``iceberg_merge_sql``). This is
the plain-Parquet stand-in: a folder of layers and a folder of commit files, read
and written by Spark only.

* A commit writes the batch as one new *delta* layer and then publishes a commit
  file that lists all layers in force. Its cost follows the batch, not the table.
* A read lays the deltas over the *base* layer.
* Small deltas are folded into larger ones as they add up, and into a new base once they
  are a quarter of it (``compact``): a row is rewritten a number of times that grows with
  the logarithm of the table, never once per batch. Old layers stay for time travel.

The base is laid out in hash buckets of the key (``_bucket`` folders). A lookup
opens the buckets its keys fall into and no others.

A batch id commits once: a replay finds its commit file and does nothing. One
writer per table is assumed, as a streaming query gives.

With a ``retention``, a compaction leaves out tombstones that much older than the newest change
and notes the horizon. From then on a change from before the horizon whose key has no row can't be told
from one that comes after its row's delete: it takes no effect and ``undecided`` returns it. A change whose
key has a row, or a kept tombstone, is decided by versions as ever.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeweir.operators.apply import META, latest_per_key, live

#: Keys of deltas up to this many bytes on disk are broadcast; beyond it the
#: sides are shuffled by key.
BROADCAST_BYTES = 32 * 1024 * 1024
#: Lookup keys are broadcast up to this many (counted first), else shuffled.
BROADCAST_KEYS = 500_000
#: Batch ids a commit file remembers. A stream repeats its last batch only.
REMEMBERED = 200
#: Where the number of the newest stream batch is kept among the ids.
HIGHEST = "highest batch"
BUCKET = "_bucket"
BEFORE = "_before"
_BASE, _DELTA = "base", "delta"


def _batch_number(batch_id: str) -> int | None:
    """N of ``batch-N``, the ids of one stream; a stream that starts anew needs tables or ids of its own."""
    number = batch_id.removeprefix("batch-")
    return int(number) if number != batch_id and number.isdigit() else None


@dataclass(frozen=True)
class Probe:
    """Distinct lookup keys with their number per bucket, counted once for several lookups."""

    keys: DataFrame
    buckets: int
    per_bucket: dict[int, int]


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: str
    operation: str
    layers: list[dict]
    counts: dict[str, int]
    recent: dict[str, int]
    newest: str | None = None  # commit time of the newest change so far
    horizon: str | None = None  # deletes from before it may have been forgotten


class _Folder:
    """The few file operations commits need, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))

    def bytes_of(self, folder: str) -> int:
        return int(self.fs.getContentSummary(self.path(folder)).getLength())

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def publish(self, name: str, text: str) -> None:
        """Write aside, then rename: readers see all of the file or none."""
        aside = f"{name}.{uuid.uuid4().hex}.part"
        self.write(aside, text)
        if self.exists(name) or not self.fs.rename(self.path(aside), self.path(name)):
            self.fs.delete(self.path(aside), False)
            raise RuntimeError(f"{self.root}/{name} was committed by another writer")


class LakeTable:
    """A keyed table of the kind ``rows`` (newest change wins), ``sums`` (deltas add up) or ``log`` (append only).

    ``columns`` are the stored columns without bookkeeping. ``bucket_by`` defaults
    to the key; a table looked up by a part of its key is bucketed by that part.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: Sequence[str] = (),
        kind: str = "rows",
        bucket_by: Sequence[str] | None = None,
        buckets: int = 8,
        max_deltas: int = 20,
        retention: str | None = None,
    ):
        if kind not in ("rows", "sums", "log"):
            raise ValueError(f"unknown kind {kind}")
        self.spark, self.root, self.schema, self.kind = spark, root.rstrip("/"), schema, kind
        self.key = list(key)
        self.bucket_by = list(bucket_by or key)
        self.buckets = buckets
        self.max_deltas = max_deltas
        self.retention = retention  # an interval as SQL spells it, such as "30 days"; None keeps every tombstone
        self.folder = _Folder(spark, root)

    # -- stored form ---------------------------------------------------------------

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored(self) -> T.StructType:
        """Columns of a layer: the row, and for ``rows`` the change that wrote it and the row it replaced."""
        fields = list(self.schema.fields)
        if self.kind == "rows":
            fields += [
                T.StructField("_op", T.StringType()),
                T.StructField("_commit_ts", T.TimestampNTZType()),
                T.StructField("_seq", T.LongType()),
            ]
        return T.StructType(fields)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.stored)

    # -- commits ---------------------------------------------------------------------

    @staticmethod
    def _file(version: int) -> str:
        return f"_commits/{version:012d}.json"

    def _latest_version(self) -> int | None:
        """From the hint file on, whatever has been committed since; a listing only without a hint."""
        try:
            version = int(self.folder.read("_commits/hint")) if self.folder.exists("_commits/hint") else None
        except ValueError:  # caught while being rewritten
            version = None
        if version is None:
            numbers = [int(n[:12]) for n in self.folder.names("_commits") if n.endswith(".json")]
            return max(numbers, default=None)
        while self.folder.exists(self._file(version + 1)):
            version += 1
        return version

    def latest(self) -> Commit | None:
        version = self._latest_version()
        return None if version is None else self.at(version)

    def at(self, version: int | None) -> Commit | None:
        if version is None:
            return self.latest()
        if not self.folder.exists(self._file(version)):
            raise ValueError(f"{self.root} has no version {version}")
        raw = json.loads(self.folder.read(self._file(version)))
        names = ("version", "batch_id", "operation", "layers", "counts", "recent")
        return Commit(*[raw[n] for n in names], raw.get("newest"), raw.get("horizon"))

    def committed(self, batch_id: str) -> Commit | None:
        """The commit of a recent batch, if it was made."""
        newest = self.latest()
        version = newest.recent.get(batch_id) if newest else None
        if version is None and newest and (number := _batch_number(batch_id)) is not None:
            # Batches of one stream come in order: all up to the highest are in, however long ago.
            version = newest.version if number <= newest.recent.get(HIGHEST, -1) else None
        return None if version is None else self.at(version)

    def create(self) -> LakeTable:
        """Version 0, empty, unless the table exists."""
        if self.latest() is None:
            self._publish(None, "create", "create", [], {})
        return self

    def _publish(
        self,
        parent: Commit | None,
        batch_id: str,
        operation: str,
        layers: list[dict],
        counts: dict[str, int],
        newest: str | None = None,
        horizon: str | None = None,
    ) -> Commit:
        newest = newest or (parent.newest if parent else None)
        horizon = horizon or (parent.horizon if parent else None)
        version = 0 if parent is None else parent.version + 1
        known = {} if parent is None else parent.recent
        # Snapshots and the highest batch number are never forgotten; of other ids the newest are kept.
        lasting = {k: v for k, v in known.items() if k == HIGHEST or k.startswith("snapshot-")}
        recent = list({k: v for k, v in known.items() if k not in lasting}.items())[1 - REMEMBERED :]
        number = _batch_number(batch_id)
        if number is not None:
            lasting[HIGHEST] = max(number, lasting.get(HIGHEST, -1))
        body = {
            "version": version,
            "parent": None if parent is None else parent.version,
            "batch_id": batch_id,
            "operation": operation,
            "committed_at": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"),
            "layers": layers,
            "counts": counts,
            "newest": newest,
            "horizon": horizon,
            "recent": lasting | dict([*recent, (batch_id, version)]),
        }
        self.folder.publish(self._file(version), json.dumps(body))
        self.folder.write("_commits/hint", str(version))
        return Commit(version, batch_id, operation, layers, counts, body["recent"], newest, horizon)

    def _write(self, df: DataFrame, kind: str, rebalance: bool = True) -> dict:
        name = f"data/{kind}-{uuid.uuid4().hex}"
        if kind == _BASE:
            # Dealt by bucket; AQE cuts what is large into tasks of its advisory size, whatever the number of buckets.
            df.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(
                f"{self.root}/{name}"
            )
        else:
            # AQE sizes the files: one for a small batch, however many partitions it came in.
            # The output of a join or aggregate is coalesced by AQE anyway.
            (df.hint("rebalance") if rebalance else df).write.parquet(f"{self.root}/{name}")
        return {"path": name, "kind": kind, "bytes": self.folder.bytes_of(name)}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    # -- writes ----------------------------------------------------------------------

    def append(self, rows: DataFrame, batch_id: str, whole: bool = False) -> Commit:
        """Add a batch of rows (``log``) or of signed sums (``sums``); ``whole`` as for ``put``."""
        done = self.committed(batch_id)
        if done:
            return done
        parent = self.create().latest()
        kind = _BASE if whole and self.kind != "log" and not parent.layers else _DELTA
        layer = self._write(rows.select(*self.columns), kind, rebalance=self.kind == "log")
        return self._after(self._publish(parent, batch_id, "append", parent.layers + [layer], {}))

    def merge(self, changes: DataFrame, batch_id: str) -> Commit:
        """Upsert and delete by key: stored-form ``changes``, any order, repeats allowed.

        Only what is newer than the stored row takes effect, and nothing that is ``undecided``. The new
        layer keeps the replaced row beside each new one (``_before``).
        """
        done = self.committed(batch_id)
        if done:
            return done
        parent = self.create().latest()
        # Used by the lookup and by the write; lost blocks are computed again.
        incoming = latest_per_key(changes.select(*self.stored.fieldNames()), self.key).persist()
        try:
            # It comes out of a shuffle by key, which AQE has sized.
            layer = self._write(self._effective(incoming, parent), _DELTA, rebalance=False)
        finally:
            incoming.unpersist()
        counts, newest = self._tally(layer, parent)
        return self._after(self._publish(parent, batch_id, "merge", parent.layers + [layer], counts, newest))

    def _effective(self, incoming: DataFrame, parent: Commit) -> DataFrame:
        """The incoming rows that are newer than what is stored, each beside the row it replaces."""
        if not parent.layers:
            return incoming.withColumn(BEFORE, F.lit(None).cast(self.schema))
        old = self.lookup(incoming.select(*self.key), parent.version)
        renamed = old.select(
            *[F.col(k).alias(f"_old_{k}") for k in self.key],
            F.struct(F.col("_commit_ts"), F.col("_seq")).alias("_old_version"),
            F.when(F.col("_op") != "DELETE", F.struct(*self.columns)).alias(BEFORE),
        )
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in self.key])
        newer = F.col("_old_version").isNull() | (F.struct("_commit_ts", "_seq") > F.col("_old_version"))
        if parent.horizon:
            newer = newer & (F.col("_old_version").isNotNull() | ~self._before_horizon(parent))
        return incoming.join(renamed, same, "left").filter(newer).select(*self.stored.fieldNames(), BEFORE)

    @staticmethod
    def _before_horizon(commit: Commit) -> Column:
        return F.coalesce(F.col("_commit_ts") < F.lit(commit.horizon).cast("timestamp_ntz"), F.lit(True))

    def undecided(self, changes: DataFrame, batch_id: str) -> DataFrame:
        """Stored-form ``changes`` (the newest of each key) that ``merge`` under this id leaves out, or left out.

        They are from before the horizon and their key has neither row nor tombstone. Judged by the
        version that the batch finds, so a replay names the same rows. Only changes that old are looked up.
        """
        done = self.committed(batch_id)
        if done and done.batch_id != batch_id:  # long ago: what it left out was noted then
            return self._empty()
        parent = self.at(max(0, done.version - 1)) if done else self.create().latest()
        if not parent.horizon:
            return self._empty()
        old = latest_per_key(changes.select(*self.stored.fieldNames()), self.key).filter(self._before_horizon(parent))
        found = self.lookup(old.select(*self.key), parent.version)
        found = found.select(*[F.col(k).alias(f"_old_{k}") for k in self.key])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in self.key])
        return old.join(found, same, "left_anti")

    def mark(self, batch_id: str) -> Commit:
        """A commit without rows: the id is all that it notes."""
        parent = self.create().latest()
        return parent if parent.batch_id == batch_id else self._publish(parent, batch_id, "mark", parent.layers, {})

    def put(self, rows: DataFrame, batch_id: str, seq: int, whole: bool = False) -> Commit:
        """Replace rows by key without comparing: for tables this program computes itself.

        ``rows`` carries ``_op``. ``seq`` must grow with each put. ``whole`` says that each key comes once: if the table
        is empty, the rows then are its base, and no compaction has to write them again.
        """
        done = self.committed(batch_id)
        if done:
            return done
        parent = self.create().latest()
        stamped = rows.withColumns(
            {"_commit_ts": F.lit(None).cast("timestamp_ntz"), "_seq": F.lit(seq).cast("bigint")}
        ).select(*self.stored.fieldNames())
        layer = self._write(stamped, _BASE if whole and not parent.layers else _DELTA, rebalance=False)
        return self._after(self._publish(parent, batch_id, "put", parent.layers + [layer], {}))

    def _tally(self, layer: dict, parent: Commit) -> tuple[dict[str, int], str | None]:
        """What a merge did, and the newest commit time so far."""
        had, gone = F.col(BEFORE).isNotNull(), F.col("_op") == "DELETE"
        row = self._read_layer(layer, with_before=True).agg(
            F.count_if(~had & ~gone).alias("inserted"),
            F.count_if(had & ~gone).alias("updated"),
            F.count_if(had & gone).alias("deleted"),
            F.count(F.lit(1)).alias("rows"),
            F.greatest(F.max("_commit_ts"), F.lit(parent.newest).cast("timestamp_ntz")).cast("string").alias("newest"),
        ).head()
        counts = row.asDict()
        return counts, counts.pop("newest")

    def _after(self, commit: Commit) -> Commit:
        """Upkeep when there are many deltas; the commit itself is done."""
        deltas = [x for x in commit.layers if x["kind"] == _DELTA]
        if len(deltas) <= self.max_deltas:
            return commit
        # The newest deltas, and older ones while these are not much larger.
        run, size = [], 0
        for layer in reversed(deltas):
            if len(run) >= 2 and layer["bytes"] > 2 * size:
                break
            run.append(layer)
            size += layer["bytes"]
        base_bytes = sum(x["bytes"] for x in commit.layers if x["kind"] == _BASE)
        if len(run) == len(deltas) and self.kind != "log" and 4 * size >= base_bytes:
            self.compact()
        else:
            self._fold(commit, run)
        return commit

    def _fold(self, parent: Commit, run: list[dict]) -> Commit:
        """Several deltas as one."""
        paths = [x["path"] for x in run]
        rows = self.spark.read.schema(self.stored).parquet(*[f"{self.root}/{p}" for p in paths])
        if self.kind == "rows":
            rows = latest_per_key(rows, self.key)
        elif self.kind == "sums":
            rows = self._summed(rows)
        layer = self._write(rows, _DELTA)
        layers = [x for x in parent.layers if x["path"] not in paths] + [layer]
        return self._publish(parent, f"fold-{parent.version}", "fold", layers, {})

    def compact(self) -> Commit | None:
        """Fold all layers into a new base, without tombstones past their retention. Nothing a reader sees changes."""
        parent = self.latest()
        if parent is None or not parent.layers or self.kind == "log":
            return parent
        rows, horizon = self.resolved(parent.version), self._horizon(parent)
        if horizon:
            rows = rows.filter((F.col("_op") != "DELETE") | (F.col("_commit_ts") >= F.lit(horizon).cast("timestamp_ntz")))
        layer = self._write(rows, _BASE)
        return self._publish(parent, f"compact-{parent.version}", "compact", [layer], {}, horizon=horizon)

    def _horizon(self, commit: Commit) -> str | None:
        """The newest change's commit time less the retention; it never goes back."""
        if self.kind != "rows" or self.retention is None or commit.newest is None:
            return None
        at = lambda text: F.lit(text).cast("timestamp_ntz")
        wanted = at(commit.newest) - F.expr(f"INTERVAL {self.retention}")
        return self.spark.range(1).select(F.greatest(wanted, at(commit.horizon)).cast("string")).head()[0]

    # -- reads -----------------------------------------------------------------------

    def _read_layer(self, layer: dict, with_before: bool = False) -> DataFrame:
        schema = self.stored
        if layer["kind"] == _BASE:
            schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        elif with_before:
            schema = T.StructType([*schema.fields, T.StructField(BEFORE, self.schema)])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{layer['path']}")

    def _layers(self, version: int | None) -> tuple[DataFrame | None, DataFrame | None, int]:
        """Base (with ``_bucket``), deltas together, and the deltas' bytes."""
        commit = self.at(version)
        layers = commit.layers if commit else []
        bases = [x for x in layers if x["kind"] == _BASE]
        deltas = [x for x in layers if x["kind"] == _DELTA]
        base = self._read_layer(bases[0]) if bases else None
        delta = None
        if deltas:
            delta = self.spark.read.schema(self.stored).parquet(*[f"{self.root}/{x['path']}" for x in deltas])
        return base, delta, sum(x["bytes"] for x in deltas)

    def resolved(self, version: int | None = None) -> DataFrame:
        """The table in stored form, tombstones (``rows``) or zero sums (``sums``) included."""
        base, delta, delta_bytes = self._layers(version)
        if delta is None:
            return self._empty() if base is None else base.drop(BUCKET)
        if self.kind == "log":
            return delta
        if self.kind == "sums":
            rows = delta if base is None else base.drop(BUCKET).unionByName(delta)
            return self._summed(rows)
        newest = latest_per_key(delta, self.key)
        if base is None:
            return newest
        base = base.drop(BUCKET)
        if delta_bytes > BROADCAST_BYTES:
            return latest_per_key(base.unionByName(delta), self.key)
        # A delta row always supersedes the base (merge dropped stale ones), so the
        # base is filtered in place, without a shuffle.
        touched = F.broadcast(delta.select(*[F.col(k).alias(f"_d_{k}") for k in self.key]).distinct())
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in self.key])
        return base.join(touched, same, "left_anti").unionByName(newest)

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.key).agg(
            *[F.sum(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name not in self.key]
        )

    def probe(self, keys: DataFrame) -> Probe:
        """Keys (the ``bucket_by`` columns, in order) for lookups here and in tables bucketed alike."""
        wanted = keys.select(*[F.col(a).alias(b) for a, b in zip(keys.columns, self.bucket_by)]).distinct()
        # One row per touched bucket to the driver: which folders to open, and how many keys.
        counted = wanted.groupBy(self._bucket()).count().collect()
        return Probe(wanted, self.buckets, {r[0]: r[1] for r in counted})

    def lookup(self, keys: DataFrame | Probe, version: int | None = None) -> DataFrame:
        """Stored rows of the given keys (the ``bucket_by`` columns, in order; repeats allowed)."""
        base, delta, _ = self._layers(version)
        if base is None and delta is None:
            return self._empty()
        probe = keys if isinstance(keys, Probe) else self.probe(keys)
        per_bucket, wanted = probe.per_bucket, probe.keys
        wanted = wanted.select(*[F.col(a).alias(f"_w_{b}") for a, b in zip(wanted.columns, self.bucket_by)])
        if sum(per_bucket.values()) <= BROADCAST_KEYS:
            wanted = F.broadcast(wanted)
        found = []
        if base is not None:
            if len(per_bucket) < self.buckets and probe.buckets == self.buckets:
                base = base.filter(F.col(BUCKET).isin(*per_bucket) if per_bucket else F.lit(False))
            found.append(self._matching(base.drop(BUCKET), wanted))
        if delta is not None:
            found.append(self._matching(delta, wanted))
        rows = reduce(DataFrame.unionByName, found)
        return self._summed(rows) if self.kind == "sums" else latest_per_key(rows, self.key)

    def _matching(self, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in self.bucket_by])
        return rows.join(wanted, same, "left_semi")

    def read(self, version: int | None = None) -> DataFrame:
        """The table as a reader sees it, now or as of a version."""
        rows = self.resolved(version)
        return live(rows) if self.kind == "rows" else rows

    def changes(self, version: int) -> DataFrame:
        """What one merge did: stored rows with ``_before``. Empty for other commits."""
        commit = self.at(version)
        if commit.operation != "merge":
            return self._empty().withColumn(BEFORE, F.lit(None).cast(self.schema))
        return self._read_layer(commit.layers[-1], with_before=True)

    def snapshots(self) -> DataFrame:
        """One row per version."""
        fields = (
            "version BIGINT, parent BIGINT, batch_id STRING, operation STRING, committed_at STRING, "
            "counts MAP<STRING, BIGINT>, layers ARRAY<STRUCT<path STRING, kind STRING, bytes BIGINT>>"
        )
        raw = self.spark.read.schema(fields).json(f"{self.root}/_commits/*.json")
        return raw.select(
            "version",
            "parent",
            "batch_id",
            "operation",
            F.col("committed_at").try_cast("timestamp_ntz").alias("committed_at"),
            F.size("layers").alias("layers"),
            F.aggregate("layers", F.lit(0).cast("bigint"), lambda s, x: s + x["bytes"]).alias("bytes"),
            *[F.coalesce(F.col("counts")[n], F.lit(0)).alias(n) for n in ("inserted", "updated", "deleted")],
        )

    def snapshot_summary(self) -> DataFrame:
        return self.snapshots().orderBy(F.desc("version")).limit(1)

    def files(self, version: int | None = None) -> DataFrame:
        """One row per data file in force, with its rows and bytes."""
        commit = self.at(version)
        parts = [
            self._read_layer(x)
            .select(F.lit(x["kind"]).alias("layer"), "_metadata.file_path", "_metadata.file_size")
            .groupBy("layer", "file_path", "file_size")
            .agg(F.count(F.lit(1)).alias("rows"))
            for x in (commit.layers if commit else [])
        ]
        if not parts:
            return self.spark.createDataFrame([], "layer STRING, file_path STRING, file_size BIGINT, rows BIGINT")
        return reduce(DataFrame.unionByName, parts)


def tables_for(spark: SparkSession, root: str, specs, **options) -> dict[str, LakeTable]:
    """A ``rows`` table per declared table under ``root``."""
    return {
        name: LakeTable(spark, f"{root}/{name}", spec.schema, spec.key, **options).create()
        for name, spec in specs.items()
    }


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Data files named by a path pattern, as they are, with the declared columns."""
    return spark.read.schema(schema).parquet(pattern)


def iceberg_merge_sql(target: str, source: str, key: Sequence[str], columns: Sequence[str]) -> str:
    """The same upsert as one MERGE, for an Iceberg table; ``source`` is newest-per-key with ``_op, _commit_ts, _seq``.

    The target keeps those columns too, deleted rows as tombstones, so a late change is held against the version that is
    stored and neither overwrites a newer row nor revives a deleted one. Needs a session with an Iceberg catalog; none is at hand here, so it is not run in tests.
    """
    on = " AND ".join(f"t.{k} = s.{k}" for k in key)
    stored = [*columns, *META]
    sets = ", ".join(f"t.{c} = s.{c}" for c in stored if c not in key)
    names, values = ", ".join(stored), ", ".join(f"s.{c}" for c in stored)
    newer = "(s._commit_ts > t._commit_ts OR (s._commit_ts = t._commit_ts AND s._seq > t._seq))"
    return (
        f"MERGE INTO {target} t USING {source} s ON {on}\n"
        f"WHEN MATCHED AND {newer} THEN UPDATE SET {sets}\n"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


__all__ = ["BEFORE", "Commit", "LakeTable", "META", "iceberg_merge_sql", "read_glob", "tables_for"]
