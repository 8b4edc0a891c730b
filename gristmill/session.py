"""Session construction and the shared scratch folder.

Nothing here assumes that the driver and the executors share a local disk: scratch data goes
below ``spark.checkpoint.dir`` when the session has one, and a private folder is made only when
it is unset (tests on one machine).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "gristmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators were written against.

    ``conf`` overrides any of them; an already running session is returned as it is.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that the driver and every executor can reach."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="gristmill-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{top.rstrip('/')}/gristmill-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
