"""Tables stored by a hash of their key (Spark's bucketed tables).

Files of such a table hold the rows of one bucket, so W1, a MERGE and a fold by the key find
equal keys where they are: rows are written once, compressed by columns, instead of being
shuffled for every operator that groups them. A bucket is read by one task. Shuffles shrink a
hot key in every map task, a bucket cannot: ``crowded`` tells from the row counts in the file
footers, and a crowded table is read as plain files, whose operators shuffle as ever.

The tables are external. A name is in the catalog of the application while its rows are read:
that of a query's table stays there, as its files stay in the scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows by columns under Zstandard take three quarters of Snappy's bytes.
CODEC = "zstd"
#: A bucket of fewer rows is no trouble for one task, whatever the others hold.
CROWDED_ROWS = 4_000_000
#: Number of a bucket in the name of its file.
BUCKET_FILE = r"_(\d{5})\.c\d{3}[^/]*$"


def bucket_id(key: str, buckets: int):
    """The bucket that Spark's writer gives a row."""
    return F.pmod(F.hash(key), F.lit(buckets))


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write(df: DataFrame, path: str, key: str, buckets: int, partition_by: str | None = None) -> None:
    """Replaces ``path`` by the rows of ``df`` in buckets."""
    name = f"tamper_{uuid.uuid4().hex}"
    w = (df.write.format("parquet").mode("overwrite").option("compression", CODEC).option("path", path)
         .option("partitionOverwriteMode", "static").bucketBy(buckets, key))
    (w.partitionBy(partition_by) if partition_by else w).saveAsTable(name)
    drop(df.sparkSession, [name])


def open_table(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int,
               partition_by: str | None = None, names: list[str] | None = None) -> DataFrame:
    """Files in buckets that ``write`` left at ``path``, or a move of its folders. ``names``
    collects the name of the table, for callers that ``drop`` it after their last job."""
    name = f"tamper_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
              + (f"PARTITIONED BY (`{partition_by}`) " if partition_by else "")
              + f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    if names is not None:
        names.append(name)
    return spark.table(name).select(*schema.names)


def drop(spark: SparkSession, names: list[str]) -> None:
    """Names of tables leave the catalog; the files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def crowded(df: DataFrame, buckets: int) -> bool:
    """Whether a bucket of files that ``df`` reads holds far more rows than the others."""
    bucket = F.regexp_extract(df.metadataColumn("_metadata")["file_name"], BUCKET_FILE, 1)
    rows = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return (rows[0] or 0) > max(CROWDED_ROWS, 4 * (rows[1] or 0) / buckets)


def stored(df: DataFrame, path: str, key: str, partition_by: str | None = None,
           buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets and read again: by buckets, or as plain files if one is crowded."""
    spark = df.sparkSession
    buckets = buckets or default_buckets(spark)
    write(df, path, key, buckets, partition_by)
    plain = spark.read.schema(df.schema).parquet(path)
    return (plain if crowded(plain, buckets)
            else open_table(spark, path, df.schema, key, buckets, partition_by)).select(*df.columns)
