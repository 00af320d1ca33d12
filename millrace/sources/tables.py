"""Table scans."""

from pyspark.sql import DataFrame, SparkSession

from millrace.sinks.store import Store, is_store
from millrace.sinks.tables import open_table


def read_table(spark: SparkSession, name: str, source: str | dict) -> DataFrame:
    """A table under the folder ``source``, or of a live database.

    Under ``source`` the tables may share a log of commits, be versioned on their own, or be plain Parquet.

    For a database ``source`` holds the JDBC options; give partitionColumn, lowerBound, upperBound
    and numPartitions to read in parallel. Filters and columns are pushed into the database.
    """
    if isinstance(source, str):
        if is_store(spark, source):
            shared = Store(spark, source).snapshot()
            if shared.has(name):
                return shared.read(name)
        return open_table(spark, f"{source.rstrip('/')}/{name}")
    return spark.read.format("jdbc").options(**{"dbtable": name, **source}).load()
