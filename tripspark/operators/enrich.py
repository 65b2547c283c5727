"""Trips enriched with pickup and dropoff zone attributes.

Two LEFT equi-joins against the zone dimension. The dimension is broadcast
only after its size has been checked (it is a lookup of a few hundred ids;
``check_zones`` also proves the ids unique, so a join can never fan trips
out). Beyond the limit the join falls back to a regular shuffle join chosen by
Spark; the trip side is never shuffled for the broadcast case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.schemas import ENRICHED_COLUMNS
from tripspark.sources.readers import check_zones

# Largest zone table we broadcast (rows). Four short strings per row: at this
# bound the broadcast is a few MB per executor.
BROADCAST_ZONE_ROWS = 100_000


def zone_side(zones: DataFrame, prefix: str, zone_rows: int | None = None,
              broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """Zone attributes renamed for one side of a trip (``pickup``/``dropoff``)."""
    side = zones.select(
        F.col("LocationID").alias(f"{prefix}_location_id"),
        F.col("Borough").alias(f"{prefix}_borough"),
        F.col("Zone").alias(f"{prefix}_zone"),
        F.col("service_zone").alias(f"{prefix}_service_zone"),
    )
    if zone_rows is None:
        zone_rows = check_zones(zones)
    return F.broadcast(side) if zone_rows <= broadcast_limit else side


def join_zone_names(df: DataFrame, zones: DataFrame, zone_rows: int | None = None,
                    broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """Left-join pickup_* and dropoff_* zone attributes onto ``df`` by id."""
    if zone_rows is None:
        zone_rows = check_zones(zones)
    pu = zone_side(zones, "pickup", zone_rows, broadcast_limit)
    do = zone_side(zones, "dropoff", zone_rows, broadcast_limit)
    return (df.join(pu, F.col("PULocationID") == F.col("pickup_location_id"), "left")
            .join(do, F.col("DOLocationID") == F.col("dropoff_location_id"), "left")
            .drop("pickup_location_id", "dropoff_location_id"))


def enrich(trips: DataFrame, zones: DataFrame, zone_rows: int | None = None,
           broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """J1 + P2: the 20 enriched columns (unmatched or NULL ids keep the trip)."""
    return join_zone_names(trips, zones, zone_rows, broadcast_limit).select(*ENRICHED_COLUMNS)
