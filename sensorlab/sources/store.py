"""Models as versioned tables.

A version is a folder of Parquet tables and gets a line in the manifest when all of them are written, so a version that
was written in part is never read. Saving again adds a version; loading takes the last one.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "saved long, version string, tables array<string>, info string"


def save(path: str, tables: dict[str, DataFrame], info: dict = None) -> str:
    """Write the tables as a new version; ``info`` is kept with it as JSON. Returns the version's name."""
    if not tables:
        raise ValueError("nothing to save")
    spark = next(iter(tables.values())).sparkSession
    version = f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    for name, table in tables.items():
        table.write.parquet(f"{path}/{version}/{name}")
    line = [(time.time_ns(), version, sorted(tables), json.dumps(info or {}))]
    spark.createDataFrame(line, MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return version


def versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions, the oldest first."""
    return [r["version"] for r in spark.read.schema(MANIFEST).json(f"{path}/manifest").orderBy("saved", "version").collect()]


def load(spark: SparkSession, path: str, version: str = None) -> tuple[dict[str, DataFrame], dict]:
    """The tables and the info of the last version, or of the one named."""
    lines = spark.read.schema(MANIFEST).json(f"{path}/manifest")
    if version is not None:
        lines = lines.filter(F.col("version") == version)
    line = lines.orderBy(F.desc("saved"), F.desc("version")).first()
    if line is None:
        raise FileNotFoundError(f"no complete version in {path}")
    return {name: spark.read.parquet(f"{path}/{line['version']}/{name}") for name in line["tables"]}, json.loads(line["info"])
