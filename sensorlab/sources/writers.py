"""Writing tables and metrics."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.schema import KEYS, TIME


#: Tasks that the days of one folder are dealt to, before adaptive execution.
PIECES = 16


def write_table(df: DataFrame, path: str, format: str = "csv", partition_by=("zone",), sort=(*KEYS, TIME)) -> None:
    """One folder per partition value, each file sorted by series and time."""
    order = [c for c in sort if c in df.columns]
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        # A large zone is written by many tasks from the start, and adaptive execution splits what is still large.
        days = F.pmod(F.xxhash64(F.to_date(TIME)), F.lit(PIECES)) if TIME in df.columns else F.lit(0)
        df = df.withColumn("_piece", days).hint("rebalance", *[F.col(c) for c in parts], F.col("_piece")).drop("_piece")
    writer = df.sortWithinPartitions(*[*parts, *[c for c in order if c not in parts]]).write.mode("overwrite")
    writer = writer.partitionBy(*parts) if parts else writer
    if format == "csv":
        writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    else:
        writer.format(format).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines; a metrics table has a row per method, measure and metric."""
    df.write.mode("overwrite").json(path)


def write_if_clean(df: DataFrame, scored: DataFrame, path: str, flag: str = "predicted", **options) -> bool:
    """Write the table only if no row of ``scored`` is flagged; says whether it was written."""
    if not scored.filter(F.col(flag) == 1).isEmpty():
        return False
    write_table(df, path, **options)
    return True
