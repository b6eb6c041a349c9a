"""The enriched daily table W."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.functions import measures as m
from pedalgrid.schemas import STAGE_TABLES


def with_statistics(t2: DataFrame, t3a: DataFrame, t3b: DataFrame, t3c: DataFrame) -> DataFrame:
    """T2 with the statistics of its borough; boroughs missing from a table keep nulls.

    Totals that are not numbers drop the row, such permit counts become 0.
    """
    typed = t2.withColumns(
        {
            "total_rides": F.col("total_rides").try_cast("bigint"),
            "event_count": F.coalesce(F.col("event_count").try_cast("bigint"), F.lit(0)),
        }
    ).filter(F.col("total_rides").isNotNull())
    return typed.join(t3a, "borough", "left").join(t3b, "borough", "left").join(t3c, "borough", "left")


def enrich(t2: DataFrame, t3a: DataFrame, t3b: DataFrame, t3c: DataFrame) -> DataFrame:
    """Table W: forecast, permit intensity, anomaly flag and demand band per date and borough."""
    c = F.col
    rows = with_statistics(t2, t3a, t3b, t3c).withColumns(
        {
            "expected_rides": m.expected_rides(
                c("beta0"), c("beta1_temp"), c("beta2_precip"), c("beta3_snow"), c("temp"), c("precip"), c("snow")
            ),
            "event_intensity": m.event_intensity(c("event_count"), c("p33"), c("p66")),
            "anomaly": m.is_anomaly(c("total_rides"), c("mean"), c("stddev")),
            "demand_level": m.demand_level(c("total_rides"), c("q20"), c("q40"), c("q60"), c("q80")),
        }
    )
    return rows.select(*STAGE_TABLES["W"].names)
