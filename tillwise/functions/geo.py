"""State coordinates as a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State -> (latitude, longitude).
STATE_COORDINATES = {
    "AC": (-9.0, -70.5), "AL": (-9.5, -36.5), "AP": (0.5, -52.0), "AM": (-3.5, -65.0),
    "BA": (-12.5, -41.5), "CE": (-5.5, -39.5), "DF": (-15.8, -47.9), "ES": (-19.2, -40.3),
    "GO": (-15.8, -49.8), "MA": (-4.8, -45.2), "MT": (-12.6, -56.0), "MS": (-20.8, -54.5),
    "MG": (-18.5, -44.5), "PA": (-4.0, -53.0), "PB": (-7.2, -36.8), "PR": (-25.0, -51.0),
    "PE": (-8.8, -37.0), "PI": (-7.5, -42.5), "RJ": (-22.2, -42.5), "RN": (-5.5, -36.0),
    "RS": (-30.0, -53.5), "RO": (-11.0, -62.5), "RR": (2.0, -61.0), "SC": (-27.2, -50.0),
    "SP": (-22.2, -48.8), "SE": (-10.5, -37.2), "TO": (-10.2, -48.2),
}


def coordinates(spark: SparkSession, places: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    rows = [(s, lat, lon) for s, (lat, lon) in (places or STATE_COORDINATES).items()]
    return spark.createDataFrame(rows, "state string, lat double, lon double")


def with_coordinates(states: DataFrame, places: DataFrame) -> DataFrame:
    """Adds lat/lon; unknown states get 0. `places` has one row per state."""
    return states.join(places, "state", "left").withColumns(
        {c: F.coalesce(c, F.lit(0.0)) for c in ("lat", "lon")}
    )
