"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(app: str = "callops", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` overrides them.

    Shuffle partitions are left to the caller or the cluster: adaptive execution merges small
    ones, so a large initial number is safe.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # joins whose smaller side turns out to fit in memory per partition need no sort of the wide side
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site lookup per column
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Settings of a running session that wide rows need; results do not depend on them.

    The JVM does not compile methods beyond 8000 bytes of bytecode. Whole-stage code for rows of 50
    and more computed columns exceeds that and would be interpreted, so let Spark use its split
    projections there instead.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``. Only where that is
    unset (tests, a laptop) is a temporary folder made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "callops-" + uuid.uuid4().hex)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Shuffle files of an action are removed when it ends, not when the driver next collects its garbage. For writes
#: whose frames are not run again: those would have to be shuffled anew.
RELEASING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Two sides that were dealt alike by some of a join's keys are joined as they lie.
AS_DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the actions made inside; they change no results."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def remove(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no later step reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
