"""Session factory and the few settings the engine relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "harrier", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with UTC timestamps and adaptive execution on; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share. Only a local session may do without: it gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="harrier-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one job in the shared folder. They cut the lineage and are compressed, so smaller than checkpoints."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/harrier-{uuid.uuid4().hex}"
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.made = 0

    def write(self, df: DataFrame) -> DataFrame:
        path, self.made = f"{self.folder}/{self.made}", self.made + 1
        df.write.option("compression", "zstd").parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(found)] = (found, path)
        return found

    def empty(self, *frames: DataFrame | None) -> None:
        """Give the disk of tables back that nothing reads any more: an empty table takes their place."""
        for df in frames:
            if df is not None and id(df) in self.paths:
                self.spark.range(0).write.mode("overwrite").parquet(self.paths.pop(id(df))[1])

    def leave(self, *results: DataFrame) -> None:
        """Empty all tables but those of the results."""
        kept = {id(df) for df in results}
        self.empty(*[df for df, _ in list(self.paths.values()) if id(df) not in kept])
