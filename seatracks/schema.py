"""Column lists that operators share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PING = "mmsi long, time timestamp, message_id int, navigational_status int, sog double, cog double, heading double, latitude double, longitude double"
PING_COLUMNS = [c.split()[0] for c in PING.split(", ")]
#: The order of a vessel's reports.
VESSEL_ORDER = ("time", "message_id", "latitude", "longitude", "cog", "sog", "heading")


def as_pings(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in PING.split(", ")], *more)
