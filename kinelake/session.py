"""Session factory and the shared folder that long plans are cut at."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, SparkSession] = {}


def build_session(app: str = "kinelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators expect: UTC, AQE and Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Only a local session that names none gets a temporary folder of its own; on a cluster a missing setting
    is an error, since a machine-local folder would lose data with its machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = sc.getCheckpointDir() or None
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        named = _LOCAL.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="kinelake-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut, lost executors cost nothing.

    The files are removed by ``discard``, at the latest when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._kinelake_path = path
    return out


def discard(*steps: DataFrame) -> None:
    """Remove the files of steps that nothing reads any more."""
    _remove([p for p in (getattr(s, "_kinelake_path", None) for s in steps) if p in _WRITTEN])


def drop_materialized() -> None:
    """Remove what ``materialize`` wrote."""
    _remove(list(_WRITTEN))


def _remove(paths: list[str]) -> None:
    for path in paths:
        spark = _WRITTEN[path]
        try:
            jvm, sc = spark._jvm, spark.sparkContext._jsc
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            pass
        _WRITTEN.pop(path, None)


atexit.register(drop_materialized)
