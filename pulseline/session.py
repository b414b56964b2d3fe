"""Session settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Windows align to the epoch in UTC, so the session has to run in UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}

# Settings that have to be there when the session starts.
START_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.python.unix.domain.socket.enabled": "true",
    # Call sites of column expressions are only needed for debugging and make plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "pulseline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` keys are written with `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = START_SETTINGS | RUNTIME_SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> None:
    """Bring a session made elsewhere to the settings the results depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    A local session without the setting gets a new temporary folder; a cluster session has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pulseline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and go on from there; survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
