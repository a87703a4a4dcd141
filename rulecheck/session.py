"""Session-level helpers: where staged rule output lives, and the SQL mode
rule text is analysed under."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_ANSI_KEY = "spark.sql.ansi.enabled"
_ansi_lock = threading.Lock()
# Per session (its JVM identity): analyses under way, and the mode before the first of them.
_ansi_users: dict[int, tuple[int, str | None]] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Reads the SparkContext's checkpoint directory, then ``spark.checkpoint.dir``.
    Raises when neither is set: staged rule output must live on storage every
    executor and the driver can reach, never on a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    raise ValueError(
        "No checkpoint directory: set spark.checkpoint.dir (or SparkContext.setCheckpointDir) "
        "to a folder shared by the driver and all executors."
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a session on one machine
    (master ``local...``: driver and executors are one process) gets a folder of its
    own; on a cluster this raises."""
    try:
        return checkpoint_root(spark)
    except ValueError:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rulecheck-local-"))
        return checkpoint_root(spark)


def new_staging_dir(spark: SparkSession, execution_id: str) -> str:
    """A fresh folder for one run's staged rule output, under the checkpoint root."""
    safe = "".join(ch if ch.isalnum() or ch in "-_" else "_" for ch in execution_id)
    return f"{checkpoint_root(spark)}/rulecheck-staging/{safe}-{uuid.uuid4().hex[:12]}"


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder through the file system that holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


@contextmanager
def non_ansi(spark: SparkSession):
    """Analyse rule text with ``spark.sql.ansi.enabled`` off.

    A plan keeps the mode it was analysed under, so rule text analysed inside
    this block keeps non-ANSI semantics (``1/0`` and bad casts give NULL) even
    when it runs later. Concurrent rules share the block: the first to enter
    switches the mode off, the last to leave restores it, nobody waits.
    """
    session = id(spark)
    with _ansi_lock:
        users, before = _ansi_users.get(session, (0, None))
        if users == 0:
            before = spark.conf.get(_ANSI_KEY, None)
            spark.conf.set(_ANSI_KEY, "false")
        _ansi_users[session] = (users + 1, before)
    try:
        yield
    finally:
        with _ansi_lock:
            users, before = _ansi_users[session]
            _ansi_users[session] = (users - 1, before)
            if users == 1:
                del _ansi_users[session]
                if before is None:
                    spark.conf.unset(_ANSI_KEY)
                else:
                    spark.conf.set(_ANSI_KEY, before)
