"""Spark session settings and the shared folder for written state.

Nothing here changes query semantics; it only sets the execution knobs the
operators were designed around (UTC, AQE with skew handling, no UI).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

STRATA_SUBDIR = "strata"


def get_session(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured for the operators.

    Under a launcher (``spark-submit``, a notebook, a session already running)
    master and driver memory are the launcher's; else ``master`` defaults to
    ``local[$BENCH_CPUS or *]``.
    """
    builder = SparkSession.builder.appName(app)
    launched = _launched()
    if master is None and not launched:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # No broadcast from compile-time size estimates: AQE's runtime switch
        # uses the measured size of a finished shuffle stage.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if not launched:
        conf["spark.driver.memory"] = os.environ.get("STRATA_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _launched() -> bool:
    """Whether something else than this process chose master and driver memory."""
    submitted = any(k in os.environ for k in ("PYSPARK_GATEWAY_PORT", "SPARK_MASTER", "SPARK_REMOTE"))
    arguments = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    return submitted or "--master" in arguments or "spark.master" in arguments or SparkSession.getActiveSession() is not None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written state tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the context). Only when none is configured and the master
    is ``local``, as in tests, a private temporary folder is created and
    registered; on a cluster, where executors would not share it, that is an
    error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - sessions without a local SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf lookup varies by deployment
            configured = None
    if not configured:
        master = sc.master if sc is not None else "remote"
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set: name a folder that the driver and all executors share (master {master})"
            )
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def state_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """Path for a written state table under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{root}/{STRATA_SUBDIR}/{leaf}"
