"""Spark-side helpers of this subpackage: reading tables, shared scratch tables,
bounded bitmaps and distributed connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.session import scratch_path

__all__ = ["table", "written", "arrow_batches", "row_bitmap", "bitmap_filter", "components",
           "with_copy", "boxed", "unboxed"]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and read again: cuts
    the lineage, is computed once, and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bounds what one Python worker holds at a time: rows and bytes of an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def row_bitmap(df: DataFrame, index: Column) -> DataFrame:
    """(word, bits): a bitmap of the non-negative values of ``index``. Its size is bounded
    by the range of the index alone (range / 64 rows), however many rows ``df`` has."""
    return (df.select(index.alias("i")).where("i is not null")
            .groupBy(F.shiftright("i", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("bits")))


def bitmap_filter(df: DataFrame, bitmap: DataFrame, index: Column, keep: bool = True) -> DataFrame:
    """The rows of ``df`` whose index is in the bitmap (``keep``) or is not. The bitmap is
    broadcast; its size is bounded by its index range."""
    names = df.columns
    looked = (df.withColumn("__i", index).withColumn("__word", F.shiftright("__i", 6))
              .join(F.broadcast(bitmap.select(F.col("word").alias("__word"),
                                              F.col("bits").alias("__bits"))), "__word", "left"))
    hit = F.expr("coalesce(shiftright(__bits, cast(__i & 63 as int)) & 1L, 0L) = 1L")
    return looked.where(hit if keep else ~hit).select(*[F.col(f"`{n}`") for n in names])


def boxed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): all other columns in one struct, so that none of their names
    can clash with an operator's own."""
    other = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("__"), *other).alias("rest"))


def unboxed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents that were boxed, in their order."""
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c)
                       for c in columns])


def with_copy(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``copy``: 0, or where rows share an id, the ordinal of
    the row among them by a hash of the text. Ids are usually unique, which one narrow
    count shows; only rows with a shared id are numbered. Null ids are left at 0."""
    shared = docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("n")).where("n > 1").select("doc_id")
    if shared.isEmpty():
        return docs.select("*", F.lit(0).cast("long").alias("copy"))
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    some = docs.join(shared, "doc_id", "left_semi").withColumn(
        "copy", (F.row_number().over(order) - 1).cast("long"))
    return docs.join(shared, "doc_id", "left_anti").withColumn(
        "copy", F.lit(0).cast("long")).unionByName(some)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each step is a
    groupBy-min and a join on the node, so a hub is reduced map-side and split by AQE.
    Every round is written to the shared folder; the driver sees one count and one
    checksum a round. Self-loops and repeated edges are allowed; no edges, no rows."""
    cur = written(edges.select("a", "b").where("a <> b").distinct(), f"{name}-0")

    def state(df):
        r = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    seen = state(cur)
    step = 0
    while seen[0]:
        step += 1
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("a"),
                                                           F.col("m").alias("b"))
                 .where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").where("v <> m")
                 .select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        cur = written(small, f"{name}-{step}")
        now = state(cur)
        if now == seen:
            break
        seen = now
    return (cur.groupBy("a").agg(F.min("b").alias("root"))
            .select(F.col("a").alias("node"), "root")
            .union(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
