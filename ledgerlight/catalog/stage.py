"""Where derived tables are kept while an application runs.

The marts are read by nearly every indicator, so they are written once, the
facts partitioned by month, to the shared folder that the session names in
``spark.checkpoint.dir``. A written table needs no lineage: a lost executor
costs nothing but its own tasks. A cluster must name such a folder; only on a
local master, as in tests, a temporary one serves.
"""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import MONTH_PARTITION
from ..sinks.shuffles import cleaned_shuffles
from ..sinks.tables import with_month

_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for derived tables, which driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if named:
        return f"{named.rstrip('/')}/ledgerlight/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="ledgerlight-")
    return _local_folder[app]


_staged: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, source: str, name: str, df: DataFrame, date_column: str | None = None, even: bool = True) -> DataFrame:
    """``df`` written and read back, by month of a date; once per application and state of the source.

    ``even`` gathers each month into few files, which shuffles all rows. A large fact is written from where its last join
    leaves it: every task writes a file for each month, large enough as they are.

    Being plain files, the tables have true sizes: Spark broadcasts a dimension in
    a join when its files are small and shuffles it when they are not.
    """
    folder = shared_folder(spark)
    key = (spark.sparkContext.applicationId, source, name)
    schema = df.schema
    if date_column:
        schema = StructType([*schema.fields, StructField(MONTH_PARTITION, StringType())])
    if key not in _staged:
        digest = hashlib.sha256(source.encode()).hexdigest()[:12]
        path = f"{folder}/{digest}/{name}"
        if date_column:
            rows = with_month(df, date_column)
            writer = (rows.hint("rebalance", F.col(MONTH_PARTITION)) if even else rows).write.partitionBy(MONTH_PARTITION)
        else:
            writer = df.write
        with cleaned_shuffles(spark):
            writer.mode("overwrite").parquet(path)
        _staged[key] = path
    return spark.read.schema(schema).parquet(_staged[key])
