"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Settings the toolkit is tuned for. A cluster's own settings win where a
#: session already exists; nothing in the library changes a running session for good.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    STATE_PROVIDER: ROCKSDB,
}


def get_session(
    app: str = "chainlake", master: str | None = None, **conf: str
) -> SparkSession:
    """Build (or get) a session with :data:`DEFAULTS`; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_starting = threading.Lock()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for stream queries that are started inside, in any session.

    Stateful processors run on no other store. A query copies the session's settings when it
    starts and notes them in its checkpoint, so the session gets its own one back at once.
    """
    with _starting:
        before = spark.conf.get(STATE_PROVIDER, None)
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(STATE_PROVIDER)
            else:
                spark.conf.set(STATE_PROVIDER, before)


def listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one that lists folders and files by a task for each core.

    Spark takes a task for each folder or file, up to thousands. A stream lists the files of
    each batch anew, in the session that it was read with.
    """
    own, cores = spark.newSession(), max(spark.sparkContext.defaultParallelism, 1)
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(LISTING_TASKS, str(min(cores, int(spark.conf.get(LISTING_TASKS)))))
    return own


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="chainlake-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for stream checkpoints and intermediate tables.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a
    local master may go without that setting; a cluster without it is an error,
    because a machine-local folder is lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
