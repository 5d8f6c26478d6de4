"""From raw feeds and weather to the aligned table and its gap report."""

from pyspark.sql import DataFrame

from sensorlab.functions.missing import data_statistics, missing_percentages
from sensorlab.operators.align import asof_join, measure_merge, weather_join, zone_sync
from sensorlab.operators.gaps import gap_intervals, gap_summary
from sensorlab.operators.ordered import densify, upsample
from sensorlab.session import stage
from sensorlab.sources import writers


def build_readings(humidity: DataFrame, temperature: DataFrame, step: str = "1 minute", order: str = "event_id") -> DataFrame:
    """Merge the two feeds and put every series on its regular grid."""
    return densify(measure_merge(humidity, temperature, order=order), step)


def align_readings(readings: DataFrame, weather: DataFrame, coarse: bool, zones=("Zone 1", "Zone 2"), step: str = "1 minute",
                   tolerance: str = "1 minute", on=("time",), order=("device_id", "house")) -> DataFrame:
    """Repair the zones from each other and add the weather.

    Coarse weather is first repeated on the finer grid and then joined as of each reading.
    """
    synced = zone_sync(readings, zones, on, order)
    if coarse:
        return asof_join(synced, upsample(weather, step), tolerance)
    return weather_join(synced, weather)


def ingest(humidity: DataFrame, temperature: DataFrame, weather: DataFrame, coarse: bool = True, step: str = "1 minute",
           interval: str = "15 minutes", path: str = None, **options) -> dict:
    """The whole flow; every entry is a frame. The merged and the aligned table are staged, as each is read several times.

    With ``path`` the tables (CSV) and the reports (JSON lines) are written below it.
    """
    merged = stage(build_readings(humidity, temperature, step))
    aligned = stage(align_readings(merged, weather, coarse, step=step, **options))
    gaps = gap_intervals(aligned, interval)
    out = {
        "merged": merged,
        "aligned": aligned,
        "missing_before": missing_percentages(merged, ["zone"]),
        "missing_after": missing_percentages(aligned, ["zone"]),
        "gaps": gaps,
        "gap_summary": gap_summary(gaps),
        "statistics": data_statistics(aligned),
    }
    if path is not None:
        for name in ("merged", "aligned", "gaps"):
            writers.write_table(out[name], f"{path}/{name}")
        for name in ("missing_before", "missing_after", "gap_summary", "statistics"):
            writers.write_metrics(out[name], f"{path}/{name}")
    return out
