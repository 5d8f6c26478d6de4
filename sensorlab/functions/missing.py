"""The two encodings of a missing measure (null and the -1 sentinel), checks and counts."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlab.schema import KEYS, MEASURES, SENTINEL


def is_valid(c, sentinel: float = SENTINEL) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(sentinel))


def is_missing(c, sentinel: float = SENTINEL) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (c == F.lit(sentinel))


def sentinel_to_null(df: DataFrame, cols=MEASURES, sentinel: float = SENTINEL, all_columns: bool = False) -> DataFrame:
    """Turn the sentinel into null. ``all_columns`` also treats every other numeric column."""
    if all_columns:
        cols = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel).cast(df.schema[c].dataType)) for c in cols})


def null_to_sentinel(df: DataFrame, cols=MEASURES, sentinel: float = SENTINEL) -> DataFrame:
    return df.na.fill(sentinel, list(cols))


def clamp(c, low: float = 0.0, high: float = 100.0) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def validate(df: DataFrame, cols) -> bool:
    """Required columns are present, numeric and finite; raises otherwise."""
    absent = sorted(set(cols) - set(df.columns))
    if absent:
        raise ValueError(f"the table lacks {absent}")
    for c in cols:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise ValueError(f"{c} holds {df.schema[c].dataType.simpleString()}, not numbers")
    infinite = reduce(lambda a, b: a | b, [F.abs(F.col(c)) == F.lit(float("inf")) for c in cols])
    if not df.filter(infinite).isEmpty():
        raise ValueError(f"an infinite value in one of {list(cols)}")
    return True


def require_no_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Raise if any of the columns holds a null, else return the frame unchanged."""
    cols = list(cols or df.columns)
    if not df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])).isEmpty():
        raise ValueError(f"a null is left in one of {cols}")
    return df


def null_audit(df: DataFrame, cols, by=()) -> DataFrame:
    """One row per column: rows and nulls."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([*by, "rows"], list(cols), "feature", "nulls")


def missing_percentages(df: DataFrame, by=(), cols=MEASURES) -> DataFrame:
    """Rows and the share of each measure that is null or the sentinel, in percent."""
    share = [
        F.try_divide(100.0 * F.count_if(is_missing(c)), F.count(F.lit(1))).alias(f"{c}_missing_percentage")
        for c in cols
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), *share)


def data_statistics(df: DataFrame, by=("zone",), cols=MEASURES) -> DataFrame:
    """Rows, null counts and sentinel counts."""
    counts = [F.count(F.lit(1)).alias("total_rows")]
    for c in cols:
        counts.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
        counts.append(F.count_if(F.col(c) == F.lit(SENTINEL)).alias(f"{c}_sentinel"))
    return df.groupBy(*by).agg(*counts)


def missing_patterns(df: DataFrame, bucket: Column, by=("zone",), cols=MEASURES) -> DataFrame:
    """Rows per time bucket and combination of missing measures."""
    flags = [is_missing(c).cast("int").alias(f"{c}_missing") for c in cols]
    return (
        df.select(*by, bucket.alias("bucket"), *flags)
        .groupBy(*by, "bucket", *[f"{c}_missing" for c in cols])
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def distinct_series(df: DataFrame, keys=KEYS) -> DataFrame:
    return df.select(*keys).distinct()
