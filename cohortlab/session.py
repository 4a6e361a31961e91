"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that make results deterministic and plans adaptive.  They are
# runtime SQL settings, so they may be applied to a session someone else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cohortlab", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster leave ``master`` as None and size ``shuffle_partitions`` to
    the data (roughly input bytes / 128 MB); AQE coalesces small partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The checkpoint directory is read from the session.  Only when none is set
    (local tests) is one created, so executors on a real cluster never write to
    a machine-local folder.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            base = None
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end every folder that :func:`shared_dir` named within.

    For whoever consumes a result: a DataFrame of this library is lazy and
    reads its written intermediates until it has been written or collected, so
    that must happen inside.  Scopes may be nested; an inner one deletes only
    its own folders.

        with scratch(spark):
            persona(edges).write.parquet(target)
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever the path's scheme says it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
