"""What the operators need from the session: a shared scratch folder and UTC."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def use_utc(spark: SparkSession) -> SparkSession:
    """Windows, suffixes and calendar months are all counted in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session whose executors are threads of the driver may leave it unset;
    it gets a folder of its own, once.  On a cluster such a folder would be lost
    with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {_CHECKPOINT_CONF} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        root = context.getCheckpointDir()
    return root


def with_package(spark: SparkSession) -> SparkSession:
    """Sees to it that Python workers can import this package, wherever they run."""
    context = spark.sparkContext
    if not getattr(context, "_has_millrace", False):
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='millrace-')}/millrace", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        context._has_millrace = True
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session with another value of a setting, for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to a table in the shared folder and read back.

    Every later read sees the same rows, also after an executor is lost, reads
    only the columns it uses, and has its true size known to the planner, which
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and not above.
    """
    return settled_at(df, scratch_path(df.sparkSession, "settled"))


def settled_at(df: DataFrame, path: str) -> DataFrame:
    """As ``settled``, at a path.

    What the write has shuffled is deleted as soon as the table is there, and not when
    the driver next collects garbage; so a job of many steps has the disk of one.
    """
    spark = df.sparkSession
    with setting(spark, _CLEANUP_CONF, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
