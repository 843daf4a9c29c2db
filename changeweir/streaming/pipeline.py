"""Change stream in, tables and marts out, one commit per micro-batch and table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeweir.operators.apply import with_meta
from changeweir.operators.decode import accepted, decode_all, rejected, snapshot_as_changes
from changeweir.operators.lake import Commit, LakeTable, tables_for
from changeweir.operators.quality import latency_ms, latency_summary
from changeweir.plans.models import Thresholds
from changeweir.schemas import SALES, TableSpec
from changeweir.session import prepare
from changeweir.streaming.jobs import together
from changeweir.streaming.views import MaintainedMarts

QUARANTINE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("commit_ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("sink_ts", T.TimestampNTZType()),
        T.StructField("n", T.LongType()),
        T.StructField("avg_ms", T.DoubleType()),
        T.StructField("p50_ms", T.LongType()),
        T.StructField("p95_ms", T.LongType()),
        T.StructField("p99_ms", T.LongType()),
        T.StructField("max_ms", T.LongType()),
    ]
)

#: Why a change from before a table's horizon is set aside.
TOO_LATE = "older than the deletes that are kept"


class ChangePipeline:
    """Applies batches of change records to the tables of ``specs`` under ``root``.

    Rejected records go to a quarantine table with their reason; nothing is dropped. So do, with a ``retention`` among
    the table options, changes too late to be told from ones that a forgotten delete has overtaken.
    ``marts`` are kept current when the tables are the sales ones. With ``metrics``,
    each batch notes its latency from source commit to table commit.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: Mapping[str, TableSpec] = SALES,
        marts: bool = False,
        thresholds: Thresholds = Thresholds(),
        metrics: bool = False,
        **table_options,
    ):
        self.spark, self.specs = prepare(spark), dict(specs)
        self.tables = tables_for(spark, f"{root}/tables", specs, **table_options)
        self.quarantine = LakeTable(spark, f"{root}/quarantine", QUARANTINE, kind="log").create()
        self.metrics = LakeTable(spark, f"{root}/metrics", METRICS, kind="log").create() if metrics else None
        self.marts = None
        if marts:
            self.marts = MaintainedMarts(
                spark, f"{root}/marts", self.tables["customers"], self.tables["orders"], thresholds, **table_options
            )

    def process(self, batch: DataFrame, batch_id: int | str) -> dict[str, Commit]:
        """One batch. Every commit carries the batch id, so a repeated batch changes nothing."""
        name = f"batch-{batch_id}"
        if self.marts is not None:
            self.marts.catch_up()  # before this batch is merged: marts may be new, or behind
        # Read from the source once and parsed once; lost blocks are made again from it.
        batch = batch.persist()
        decoded = {t: rows.persist() for t, rows in decode_all(batch, self.specs).items()}
        try:
            changes = {t: with_meta(accepted(rows, self.specs[t]), self.specs[t]) for t, rows in decoded.items()}
            # Named before the merges move the tables on.
            aside = reduce(DataFrame.unionByName, self._too_late(changes, name), rejected(batch, decoded))
            merges = [lambda t=t, rows=rows: self.tables[t].merge(rows, name) for t, rows in changes.items()]
            done = together(self.spark, *merges, lambda: self.quarantine.append(aside, name))
            commits = dict(zip(decoded, done))
        finally:
            for rows in decoded.values():
                rows.unpersist()
            batch.unpersist()
        if self.metrics is not None:
            self._note_latency(commits, name)
        if self.marts is not None:
            self.marts.refresh(commits["orders"].version, commits["customers"].version)
        return commits

    def _too_late(self, changes: Mapping[str, DataFrame], name: str) -> list[DataFrame]:
        """Per table, in the quarantine's columns, what ``LakeTable.undecided`` names; nothing without a retention."""
        return [
            self.tables[t].undecided(rows, name).select(
                F.lit(t).alias("table_name"),
                F.lit(TOO_LATE).alias("reason"),
                F.to_json(F.struct(*self.specs[t].columns)).alias("data"),
                F.col("_commit_ts").alias("commit_ts"),
                F.col("_seq").alias("seq"),
            )
            for t, rows in changes.items()
            if self.tables[t].latest().horizon
        ]

    def _note_latency(self, commits: Mapping[str, Commit], name: str) -> None:
        now = F.current_timestamp().cast("timestamp_ntz")
        applied = [
            self.tables[t].changes(c.version).select(F.lit(t).alias("table_name"), "_commit_ts", now.alias("sink_ts"))
            for t, c in commits.items()
        ]
        rows = reduce(DataFrame.unionByName, applied)
        rows = rows.withColumn("latency_ms", latency_ms("_commit_ts", "sink_ts"))
        summary = latency_summary(rows, ["table_name", "sink_ts"]).withColumn("batch", F.lit(name))
        self.metrics.append(summary, name)

    def snapshot(self, tables: Mapping[str, DataFrame], commit_ts: Column) -> list[str]:
        """Load whole tables, in the order given, before the stream starts.

        A table whose snapshot was committed before is skipped, whatever the stream has
        written; the tables loaded now are returned. Snapshot rows lose to any change after
        ``commit_ts``, so the stream may start earlier than the snapshot was taken.
        """
        loaded = []
        for name, rows in tables.items():
            if self.tables[name].committed(f"snapshot-{name}"):
                continue
            changes = with_meta(snapshot_as_changes(rows, name, commit_ts), self.specs[name])
            for late in self._too_late({name: changes}, f"snapshot-{name}"):
                self.quarantine.append(late, f"snapshot-{name}")
            self.tables[name].merge(changes, f"snapshot-{name}")
            loaded.append(name)
        if self.marts is not None:
            self.marts.catch_up()
        return loaded

    def start(
        self,
        records: DataFrame,
        checkpoint: str,
        interval: str | None = "1 second",
        query_name: str | None = None,
    ) -> StreamingQuery:
        """Run on a stream of change records; ``interval=None`` takes what is there and stops."""
        writer = (
            records.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**({"availableNow": True} if interval is None else {"processingTime": interval}))
        )
        if query_name:
            writer = writer.queryName(query_name)
        return writer.start()


def append_sink(stream: DataFrame, table: LakeTable, checkpoint: str, interval: str | None = "1 second") -> StreamingQuery:
    """Append every micro-batch to a ``log`` table, each once."""
    return (
        stream.writeStream.foreachBatch(lambda df, batch_id: table.append(df, f"batch-{batch_id}") and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if interval is None else {"processingTime": interval}))
        .start()
    )


def without_repeats_within(stream: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """Each message once, where repeats come within ``delay`` of the time ``at``: state is kept for that long, and no longer.

    What comes later than that is dropped as late, so ``delay`` is chosen from how long a source may deliver anew.
    """
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(key).drop("_at")


def tumbling_daily_stream(orders: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily windows over an insert-only stream of orders, each emitted once it is complete."""
    return (
        orders.withColumn("_at", F.col("created_at").cast("timestamp"))
        .withWatermark("_at", lateness)
        .groupBy(F.window("_at", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("amount").cast("decimal(20,2)").alias("daily_revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "total_orders",
            "daily_revenue",
        )
    )
