"""Session helpers: a tuned SparkSession for tests/bench and a shared scratch folder.

On a cluster the session is built by the platform; library code only *reads*
settings from it.  ``scratch_dir`` honours ``spark.checkpoint.dir`` (a shared,
fault-tolerant folder) and only invents a local one when the session has none,
which is the situation in unit tests and the local bench.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale; safe defaults for local runs too.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "terrane",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Only a session on the local machine (tests, the bench) may do without one and gets
    a private folder; on a cluster each executor would write to a disk of its own, so a
    missing ``spark.checkpoint.dir`` is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): use the conf only
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return conf_dir
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        current = tempfile.mkdtemp(prefix="terrane-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    for scope in _SCOPES:
        scope.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Remove the scratch folders made inside the block when it ends, but those taken out of the list it gives.

    For a writer that has read all it needs from them, e.g. a stage whose result is
    written.  One thread at a time.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove_scratch(path)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[int, list] = {}  # by session: writers at work, the session's own value
_freeing_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside the block are deleted when that write ends.

    Else Spark keeps them until the driver happens to collect its garbage, so that a query of many
    written steps holds the shuffles of all of them on disk.  Not for plans that run again: those
    would have to shuffle anew.  The session's own value comes back.
    """
    with _freeing_lock:
        held = _freeing.setdefault(id(spark), [0, spark.conf.get(FREED, None)])
        held[0] += 1
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            held[0] -= 1
            if not held[0]:
                del _freeing[id(spark)]
                if held[1] is None:
                    spark.conf.unset(FREED)
                else:
                    spark.conf.set(FREED, held[1])


def remove_scratch(path: str) -> None:
    """Delete a scratch folder that nothing reads any more, if it is there."""
    from pyarrow import fs as pafs

    from .sources.archive import _fs
    fs, local = _fs(path)
    if fs.get_file_info(local).type == pafs.FileType.Directory:
        fs.delete_dir(local)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can open local paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def setting(spark: SparkSession, name: str, default: int) -> int:
    """Integer knob ``terrane.<name>`` from the session conf, else ``default``.

    Knobs: ``hotKeyRows`` (rows above which a lot key is split), ``hotKeyList`` (keys that
    are split at most), ``broadcastRows`` (largest seed or calendar broadcast after a size check),
    ``groupRows`` (rows above which a group's values are ordered in ranges), ``taskRows`` (rows that a
    task sorts or groups).
    """
    value = spark.conf.get(f"terrane.{name}", None)
    return int(value) if value not in (None, "") else default


TASK_ROWS = 300_000


def task_count(spark: SparkSession, n_rows: int) -> list[int]:
    """The number of tasks for ``repartition`` if ``n_rows`` need more than the session's shuffle partitions, else nothing."""
    wanted = -(-n_rows // max(1, setting(spark, "taskRows", TASK_ROWS)))
    return [wanted] if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
