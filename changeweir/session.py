"""Session settings, size estimates and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What one task may hold when a whole frame has to meet in one place (bytes on
#: disk, so a few times that in memory; the sort below a window spills).
ONE_TASK_BYTES = 64 * 1024 * 1024

DEFAULTS = {
    # All times are zone-free; UTC keeps the few zoned intermediates equal to them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: the sorted side of a skewed partition is split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # AQE also coalesces what is cached: a small batch does not keep hundreds of partitions.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    app_name: str = "changeweir",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with this library's defaults.

    ``shuffle_partitions`` is an upper bound that AQE coalesces from: about the
    number of cores locally, two to three times the cluster's cores at scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results (the zone) and small batches (coalesced caches) depend on in a caller's session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"):
        spark.conf.set(key, DEFAULTS[key])
    return spark


def plan_bytes(df: DataFrame) -> int:
    """An estimate of ``df``'s size from its plan; no job runs.

    Catalyst multiplies the sides of a join, so its estimate is capped at four times
    the bytes scanned: ample for joins to one row per key, aggregates and a few
    events per row, which is all it is asked for here.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    scanned = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(int(str(plan.stats().sizeInBytes())), 4 * scanned)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediates.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``;
    only where that is unset (tests on one machine) a local folder is made.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    if shared:
        return f"{shared.rstrip('/')}/changeweir/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{tempfile.mkdtemp(prefix='changeweir-')}/{name}"
