"""Key-value tables: (PartitionKey, RowKey, text properties) as partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import partition_key, row_key
from tallyloom.operators.columns import ref
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec
from tallyloom.sinks.stats import LoadStats

KEYS = ("PartitionKey", "RowKey")
# Bookkeeping columns of the store that readers drop.
STORE_COLUMNS = ("odata.etag", "Timestamp", "etag")


def to_entities(df: DataFrame, partition_col: str, row_cols: Sequence[str]) -> DataFrame:
    """Keys from columns; nested values as JSON, times as ISO text, all else as text."""
    cols = []
    for field in df.schema.fields:
        c = ref(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        cols.append(c.cast("string").alias(field.name))
    # A row without any key part gets the hash of all its columns; equal rows are then one entity.
    whole = F.md5(F.to_json(F.struct(*map(ref, df.columns))).cast("binary"))
    keys = [partition_key(ref(partition_col)).alias("PartitionKey"), row_key(*[ref(c).cast("string") for c in row_cols], row=whole).alias("RowKey")]
    return df.select(*keys, *cols)


class KeyValueTable:
    """Entities under a path, one folder per partition key."""

    def __init__(self, spark: SparkSession, path: str, properties: Sequence[str]):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*KEYS, *properties)])
        self.table = SnapshotTable(spark, path, schema, partition_by="PartitionKey")

    def read(self, condition: str | None = None, select: Sequence[str] | None = None) -> DataFrame:
        """Filter expression and column list; a filter on PartitionKey reads its folders only."""
        df = self.table.read()
        if condition:
            df = df.filter(condition)
        names = [c for c in (select or df.columns) if c not in STORE_COLUMNS]
        return df.select(*map(ref, names))

    def write(self, entities: DataFrame, batch_id: str, mode: str = "append") -> LoadStats:
        """``append`` upserts on the keys, ``replace`` swaps all rows, ``fail`` needs an empty table."""
        if mode == "fail" and self.table.read().limit(1).count():
            raise ValueError(f"{self.table.path} is not empty")
        spec = LoadSpec(self.table.path, KEYS, "replace" if mode == "replace" else "upsert", partition_by="PartitionKey")
        return self.table.load(entities, spec, batch_id)

    def count(self, partition: str) -> DataFrame:
        """A18."""
        return self.read().filter(ref("PartitionKey") == F.lit(partition)).agg(F.count(F.lit(1)).alias("rows"))

    def delete_partition(self, partition: str, batch_id: str) -> None:
        """K13."""
        self.table.drop_partitions([partition], batch_id)
