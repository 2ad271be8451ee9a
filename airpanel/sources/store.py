"""Keyed, versioned feature tables with a commit log, and the model registry, as plain Parquet folders.

A feature group is ``<root>/<name>_v<version>/epoch=<e>/batch=<n>/month=<yyyy-MM>/``. Each delivery writes only its own
batch folder, so a batch that is run again after a lost executor or driver replaces itself and nothing else; the
newest batch of a key wins on read. That gives in-place updates without rewriting stored rows.

Beside it, ``<name>_v<version>_log`` holds what a read needs to know before it opens anything: per batch, series and month
the newest time (``zones``), and the current epoch (``epochs``). A batch exists once its zones are written, which happens
last. Reads pick their folders from the log: a tail of some series opens the months that these series need and no
others, and a station that fell silent long ago adds its own last month only.

Compaction merges the batches up to a number into one of a new epoch, without tombstones, and carries the later ones over by
their log rows. The epoch's row is written last: before, nothing has changed; after, reads see the new epoch, while those
that are at work keep their files, because nothing is removed. One writer at a time; readers at any time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airpanel.operators.dedupe import keep_by_order
from airpanel.operators.quality import require_plain_name
from airpanel.operators.relational import tail_window
from airpanel.schemas import HOUR, SERIES

_ZONES = f"{SERIES} STRING, month STRING, newest TIMESTAMP, n_rows BIGINT, data_epoch INT, batch INT"
_EPOCHS = "epoch INT, upto INT"


def group_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{require_plain_name(name)}_v{int(version)}"


class _Epoch(NamedTuple):
    """The current layout of a group: its number and the last batch that compaction has merged."""

    number: int
    upto: int


def _current(spark: SparkSession, root: str, name: str, version: int) -> _Epoch:
    epochs = _read(spark, f"{group_path(root, name, version)}_log/epochs", _EPOCHS)
    return _Epoch(0, -1) if epochs is None else _Epoch(*max(tuple(r) for r in epochs.collect()))


def _zones_path(root: str, name: str, version: int, epoch: int) -> str:
    return f"{group_path(root, name, version)}_log/zones/epoch={epoch}"


def _batch_path(root: str, name: str, version: int, epoch: int, batch: int) -> str:
    return f"{group_path(root, name, version)}/epoch={epoch}/batch={int(batch)}"


def _zones_of(spark: SparkSession, path: str, epoch: int, batch: int, event_time: str) -> DataFrame:
    """Zone rows of one written batch folder, from its two narrow columns."""
    kind = f"{SERIES} STRING, `{event_time}` TIMESTAMP, month STRING"
    return (spark.read.schema(kind).parquet(path).groupBy(SERIES, "month")
            .agg(F.max(event_time).alias("newest"), F.count("*").alias("n_rows"))
            .select(SERIES, "month", "newest", "n_rows", F.lit(epoch).alias("data_epoch"), F.lit(int(batch)).alias("batch")))


def _write_data(df: DataFrame, path: str, event_time: str, mode: str) -> None:
    (df.withColumn("month", F.date_format(event_time, "yyyy-MM"))
     .write.mode(mode).partitionBy("month").parquet(path))


def write_feature_group(
    df: DataFrame,
    root: str,
    name: str,
    version: int,
    batch: int,
    event_time: str = "ts",
    mode: str = "overwrite",
) -> None:
    """Insert or update rows under one batch number (higher numbers win).

    Rows with a true ``_deleted`` are tombstones: reads hide their key. A batch that compaction has merged already was
    complete before, so writing it again does nothing.
    """
    spark = df.sparkSession
    epoch = _current(spark, root, name, version)
    if batch <= epoch.upto:
        return
    if "_deleted" not in df.columns:
        df = df.withColumn("_deleted", F.lit(False))
    path = _batch_path(root, name, version, epoch.number, batch)
    _write_data(df, path, event_time, mode)
    (_zones_of(spark, path, epoch.number, batch, event_time).drop("batch")
     .write.mode("overwrite").parquet(f"{_zones_path(root, name, version, epoch.number)}/batch={int(batch)}"))


def _zones(spark: SparkSession, root: str, name: str, version: int, epoch: _Epoch) -> DataFrame | None:
    return _read(spark, _zones_path(root, name, version, epoch.number), _ZONES)


def read_batch(
    spark: SparkSession, root: str, name: str, version: int, batch: int, schema: StructType
) -> DataFrame:
    """The rows of one delivery, which may be none."""
    epoch = _current(spark, root, name, version)
    return spark.read.schema(schema).parquet(_batch_path(root, name, version, epoch.number, batch))


def read_feature_group(
    spark: SparkSession,
    root: str,
    name: str,
    version: int,
    pk: tuple[str, ...] = (SERIES, HOUR),
    tail_days: int | None = None,
    event_time: str = "ts",
    before_batch: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame | None:
    """Current rows, or None for a group that has none yet; keys with a tombstone are left out.

    ``only`` names the series that are wanted; with ``tail_days``, rows of each series from that many days before its newest
    one. Both choose the folders by the log alone, whose rows are one per series, month and batch since the last compaction.

    ``before_batch`` leaves out that batch and later ones, so a batch that runs a
    second time sees the same store as the first time.
    """
    epoch = _current(spark, root, name, version)
    zones = _zones(spark, root, name, version, epoch)
    if zones is None:
        return None
    if before_batch is not None:
        zones = zones.filter(F.col("batch") < before_batch)
    wanted = zones
    if only is not None:
        wanted = wanted.join(only.select(SERIES).distinct(), SERIES, "left_semi")
    if tail_days is not None:
        # A window holds the log rows of one series since the last compaction.
        newest = F.max("newest").over(Window.partitionBy(SERIES))
        first = F.date_format(newest - F.make_dt_interval(days=F.lit(tail_days)), "yyyy-MM")
        wanted = wanted.withColumn("_first", first).filter(F.col("month") >= F.col("_first"))
    where = ["data_epoch", "batch"] if only is None and tail_days is None else ["data_epoch", "batch", "month"]
    folders = sorted(tuple(r) for r in wanted.select(*where).distinct().collect())
    if not folders:
        # None of the wanted series is stored: the same columns without rows, if there is any batch.
        some = zones.select("data_epoch", "batch").first()
        if some is None:
            return None
        return _data(spark, root, name, version, [tuple(some)]).limit(0).drop("batch", "_deleted")
    df = _data(spark, root, name, version, folders)
    if only is not None:
        df = df.join(only.select(SERIES).distinct(), SERIES, "left_semi")
    current = keep_by_order(df, list(pk), F.col("batch")).drop("batch")
    current = current.filter(~F.col("_deleted")).drop("_deleted")
    return current if tail_days is None else tail_window(current, tail_days, event_time)


def _data(spark: SparkSession, root: str, name: str, version: int, folders: list[tuple]) -> DataFrame:
    """The rows of some batches or of some of their months, with ``batch``."""
    paths = [_batch_path(root, name, version, f[0], f[1]) + (f"/month={f[2]}" if len(f) > 2 else "") for f in folders]
    return (spark.read.option("basePath", group_path(root, name, version)).parquet(*paths).drop("epoch", "month"))


def pending_batches(spark: SparkSession, root: str, name: str, version: int) -> int:
    """Batches that the next compaction could merge."""
    epoch = _current(spark, root, name, version)
    zones = _zones(spark, root, name, version, epoch)
    return 0 if zones is None else zones.select("batch").filter(F.col("batch") > epoch.upto).distinct().count()


def compact_feature_group(
    spark: SparkSession, root: str, name: str, version: int, upto: int | None = None,
    pk: tuple[str, ...] = (SERIES, HOUR), event_time: str = "ts",
) -> int | None:
    """Merge the batches up to ``upto`` (all by default) into one, without tombstones; returns the new epoch.

    The merged batch keeps the number ``upto``, so later batches still win over it. A batch that may have to be run again
    must stay out, since a read before it could not leave it out any more. Folders of earlier epochs are no longer
    read and may be removed once no reader uses them.
    """
    epoch = _current(spark, root, name, version)
    zones = _zones(spark, root, name, version, epoch)
    last = None if zones is None else zones.agg(F.max("batch")).first()[0]
    if last is None:
        return None
    upto = last if upto is None else min(int(upto), last)
    if upto <= epoch.upto:
        return None
    current = read_feature_group(spark, root, name, version, pk, before_batch=upto + 1)
    if current is None:
        return None
    new = epoch.number + 1
    path = _batch_path(root, name, version, new, upto)
    _write_data(current.withColumn("_deleted", F.lit(False)), path, event_time, "overwrite")
    carried = zones.filter(F.col("batch") > upto)
    (_zones_of(spark, path, new, upto, event_time).unionByName(carried)
     .write.mode("overwrite").partitionBy("batch").parquet(_zones_path(root, name, version, new)))
    # The switch.
    (spark.createDataFrame([(new, upto)], _EPOCHS).coalesce(1)
     .write.mode("append").parquet(f"{group_path(root, name, version)}_log/epochs"))
    return new


def register_models(models: DataFrame, metrics: DataFrame, root: str, name: str = "aqi_hourly_h") -> int:
    """Store all models of a run as one new version of the registry, and return its number.

    One entry per series and horizon: model kind, parameters (trees included) and the metrics that are neither NULL nor
    NaN. Entries go to a folder of their own; the version exists from the moment its row is in the log, so a
    registration that died half way is never read, and its number is taken again. Versions are never changed.
    One writer at a time.
    """
    spark = models.sparkSession
    names = [c for c in ("rmse", "mae", "r2") if c in metrics.columns]
    as_map = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names]))
    kept = F.map_filter(as_map, lambda _, v: v.isNotNull() & ~F.isnan(v))
    best = metrics.select(SERIES, "horizon", kept.alias("metrics"))
    entries = (models.join(best, [SERIES, "horizon"], "left")
               .withColumn("name", F.concat(F.lit(name), "horizon"))
               .withColumn("target", F.lit("delta")))
    version = max((r.version for r in registered_versions(spark, root).collect()), default=0) + 1
    entries.write.mode("overwrite").parquet(_entries(root, version))
    n = spark.read.parquet(_entries(root, version)).count()
    # The pointer moves last.
    (spark.createDataFrame([(version, n)], _VERSIONS).coalesce(1).withColumn("registered_at", F.current_timestamp())
     .write.mode("append").parquet(f"{root.rstrip('/')}/model_registry/log"))
    return version


_VERSIONS = "version INT, n_models BIGINT"


def _entries(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/model_registry/entries/version={int(version)}"


def registered_versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, n_models, registered_at) of every complete registration; one row each."""
    kind = f"{_VERSIONS}, registered_at TIMESTAMP"
    log = _read(spark, f"{root.rstrip('/')}/model_registry/log", kind)
    return spark.createDataFrame([], kind) if log is None else log


def read_registry(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The entries of a version with its number, the newest by default; None for an empty registry."""
    known = sorted(r.version for r in registered_versions(spark, root).collect())
    if not known:
        return None
    wanted = known[-1] if version is None else int(version)
    if wanted not in known:
        raise ValueError(f"version {wanted} is not in the registry, which has {known}")
    return spark.read.parquet(_entries(root, wanted)).withColumn("version", F.lit(wanted))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
