"""SparkSession helpers.

The library never creates a session implicitly; callers (tests, bench, the
driver) pass one in.  ``local_session`` is the test/bench builder: AQE on, UI
off, UTC, small shuffle partition count for local mode.  On a cluster the
same operators run unchanged under the cluster's own session settings.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict = {"depth": 0}
_releasing_lock = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gtfsforge") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a folder that all executors
    share; without it there is none, which is an error.  Only a local session
    (one machine) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="gtfsforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the session's checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside leave no shuffle files behind: they are read back, not made again.  Without
    this the files stay until the driver collects its garbage, which a large heap puts off.  May be
    nested and entered by several threads; the setting of the first one's session is restored by the last to leave."""
    with _releasing_lock:
        if not _releasing["depth"]:
            _releasing.update(conf=spark.conf, before=spark.conf.get(RELEASE, "false"))
            spark.conf.set(RELEASE, "true")
        _releasing["depth"] += 1
    try:
        yield
    finally:
        with _releasing_lock:
            _releasing["depth"] -= 1
            if not _releasing["depth"]:
                _releasing["conf"].set(RELEASE, _releasing["before"])


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where only the driver's path names it; on a
    cluster the package is shipped with the job (``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])
