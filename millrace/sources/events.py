"""Event sources and the device registry's source configuration."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATES = {"kafka": ("maxOffsetsPerTrigger", "1000000"), "text": ("maxFilesPerTrigger", "1000")}


def read_events(
    spark: SparkSession, fmt: str = "text", options: dict[str, str] | None = None, streaming: bool = False
) -> DataFrame:
    """Events with the JSON text in ``body``.

    "kafka": all topics in one query, from the earliest offset unless told otherwise;
    "text": JSON lines in files under ``options["path"]``. A stream takes at most ``RATES`` per micro-batch unless told
    otherwise, so that a start from the earliest event is many batches, not one.
    """
    settings = dict(options or {})
    if fmt == "kafka":
        settings.setdefault("startingOffsets", "earliest")
    if streaming and fmt in RATES and not set(settings) & {"maxOffsetsPerTrigger", "maxFilesPerTrigger", "maxBytesPerTrigger"}:
        settings.setdefault(*RATES[fmt])
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**settings)
    return reader.load().select(F.col("value").cast("string").alias("body"))


def active_sources(
    devices: DataFrame,
    required: tuple[str, ...] = ("eventhub_connection_string", "eventhub_consumer_group"),
    keep: tuple[str, ...] = ("id_misuratore", "name"),
) -> DataFrame:
    """Devices whose connection columns are all filled; the secrets themselves are not returned."""
    for c in required:
        devices = devices.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return devices.select(*keep)
