"""Session settings the loads are written for."""

from __future__ import annotations

import threading
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

ACCURATE_SKEW = "spark.shuffle.accurateBlockSkewedFactor"

SETTINGS = {
    # Instants are stored and compared in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Instants as 64-bit integers: files then carry their bounds and null counts.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Above 2,000 shuffle partitions only average block sizes are kept, but for blocks this
    # many times the median: without it a hot key cannot be seen, nor split.
    ACCURATE_SKEW: "5",
}


def build_session(app: str = "tidemark", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Casting text to an instant and taking its month both depend on the session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC for loads (it is {zone})")


_MB = 1024 * 1024
SHUFFLE_PARTITION_BYTES = 128 * _MB
MAX_SHUFFLE_PARTITIONS = 65_536
SCAN_SPLIT_BYTES = (128 * _MB, 1024 * _MB)
SCAN_TASKS = 100_000
# Blocks of one shuffle, map times reduce tasks, that the driver is to keep track of.
SHUFFLE_BLOCKS = 1_000_000_000
# Beyond so many partitions Spark compresses block sizes to an average.
EXACT_PARTITIONS = 2_000


def settings_for(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Shuffle partitions and scan splits for a job that reads ``input_bytes``.

    Adaptive execution merges partitions that turn out small, so the number to
    start from may be generous, never below the session's own. It is bounded,
    as is the number of scan tasks, because the driver tracks their product.
    """
    smallest, largest = SCAN_SPLIT_BYTES
    split = min(max(input_bytes // SCAN_TASKS, smallest), largest)
    tracked = SHUFFLE_BLOCKS // max(1, input_bytes // split)
    wanted = min(input_bytes // SHUFFLE_PARTITION_BYTES, MAX_SHUFFLE_PARTITIONS, tracked)
    partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if partitions > EXACT_PARTITIONS and not spark.conf.get(ACCURATE_SKEW, None):
        warnings.warn(f"set {ACCURATE_SKEW}, or hot keys stay unsplit", stacklevel=2)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


# By session: the settings in force, oldest first, and the session's own, for loads side by side.
_SIZED: WeakKeyDictionary[SparkSession, tuple[list[dict[str, str]], dict[str, str | None]]] = WeakKeyDictionary()
_SIZING = threading.Lock()


def _apply(spark: SparkSession, settings: dict[str, str | None]) -> None:
    for key, value in settings.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Run jobs under ``settings_for``; the session's own settings come back after.

    Of several in one session, nested or in threads, the last one entered holds; the session's
    own settings come back with the end of all, in whatever order they end.
    """
    settings = settings_for(spark, input_bytes)
    with _SIZING:
        if spark not in _SIZED:
            _SIZED[spark] = [], {key: spark.conf.get(key, None) for key in settings}
        active, own = _SIZED[spark]
        active.append(settings)
        _apply(spark, settings)
    try:
        yield
    finally:
        with _SIZING:
            active[:] = [other for other in active if other is not settings]
            if not active:
                del _SIZED[spark]
            _apply(spark, active[-1] if active else own)
