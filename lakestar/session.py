"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Runtime SQL settings the operators count on. All can be set on a live session.
SQL_CONF = {
    # Dates and epoch differences must not move with the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A fact table may have one key that holds a third of its rows: let the join split that partition even where
    # a later operator then needs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Session setting that names the folder of the scratch scope in use.
_SCOPE = "lakestar.scratch.scope"

# Scratch folder of local sessions that name no shared one, by application.
_local_scratch: dict[str, str] = {}


def apply_sql_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that somebody else built."""
    for name, value in SQL_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "lakestar", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session. Store credentials and endpoints come from the caller's ``conf`` or spark-defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return apply_sql_conf(builder.getOrCreate())


def side_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for jobs that are observed: a session that has observed one
    cannot ship models to its executors any more that were fitted in it."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name) and other.conf.get(name, None) != value:
            other.conf.set(name, value)
    return other


def together(*jobs: Callable[[], T], parallel: int = 4) -> list[T]:
    """Start independent Spark jobs a few at a time, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Job groups and local properties of the caller hold for the jobs as well.
        return [job.result() for job in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a fresh temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = spark.sparkContext.applicationId
        shared = _local_scratch.get(app) or tempfile.mkdtemp(prefix="run-")
        _local_scratch[app] = shared
    return f"{shared.rstrip('/')}/lakestar-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call gets."""
    scope = spark.conf.get(_SCOPE, "")
    return "/".join(part for part in (scratch_root(spark), scope, f"{label}-{uuid.uuid4().hex}") if part)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it once the results built on them are written."""
    _delete(spark, scratch_root(spark))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside get a folder of their own, which is deleted at the end, also after a failure.
    Those made before or by others stay."""
    before, scope = spark.conf.get(_SCOPE, ""), f"scope-{uuid.uuid4().hex}"
    spark.conf.set(_SCOPE, scope)
    try:
        yield
    finally:
        spark.conf.set(_SCOPE, before)
        _delete(spark, f"{scratch_root(spark)}/{scope}")
