"""Operator 7: benchmark decontamination over a distributed positional inverted index.

DataFrame and SQL functions only. ``build_index`` stores a posting (term, key, pos) for
every occurrence of a test term in the corpus as a table in the shared folder. The
collection frequency of each term comes from the index. Each window of ``window``
consecutive item words is looked up from its rarest terms: the postings of its rarest
term, less the term's offset in the item, give the alignments (document, item, diagonal);
these are intersected with the offset-adjusted postings of the second and third rarest.
The alignments that remain are compared with the document's words, so matches are exact.
``phrase_matches`` returns them; ``proximity_matches`` returns the documents where all
terms of a phrase lie within ``slop`` words of their place.

Skew: a frequent term or passage is never gathered under one key: postings are joined on
(key, term, pos), and only the lists of the rarest terms of some window are read. A common
passage costs as many rows as it has occurrences. The vocabulary of the test items is
broadcast only below a counted size.

Defined cases: null text has no words and is clean; an item with null or wordless text
has no windows; a null item_id is the empty string; items that share an id are one item;
repeated documents get one result row each, also with repeated or null ids; empty tables
give zero hits or no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.llm._spark import bitmap_filter, boxed, row_bitmap, table, unboxed, written

WINDOW = 13
# word characters of the contract, capital letters included
PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_TERMS = 500_000
BITMAP_BITS = 23
RANKS = 3


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def lower_ascii(word: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER))


def items_of(benchmark: DataFrame) -> DataFrame:
    """(row, item, iw): each distinct test item with its words."""
    item = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.transform(raw_words(F.col("text")), lower_ascii).alias("iw"))
    return (item.where("size(iw) > 0").distinct()
            .withColumn("row", F.xxhash64("item", "iw")))


def with_key(docs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rows with equal id and text share a key; matches are verified against the text, so
    a collision of keys costs a comparison and changes no result."""
    more = [c for c in extra or () if c != "text"]
    return docs.select("doc_id", "text", *more).withColumn(
        "key", F.xxhash64(F.col("doc_id").cast("string"), "text"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only below a counted number of (narrow) rows; else a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def build_index(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, key, pos) of the words in ``terms`` (word), stored; term is the
    word's 64-bit hash."""
    vocabulary = written(terms.select("word").distinct()
                         .withColumn("term", F.xxhash64("word")), "decontam-terms")
    tokens = keyed.select("key", F.posexplode(raw_words(F.col("text"))).alias("pos", "w"))
    hits = tokens.select("key", "pos", lower_ascii(F.col("w")).alias("word")).join(
        _small(vocabulary, BROADCAST_TERMS), "word")
    return written(hits.select("term", "key", "pos"), "decontam-index", compression="zstd")


def windows_of(items: DataFrame, frequency: DataFrame, window: int, ranks: int) -> DataFrame:
    """(row, p1, t1, p2, t2, ...): for each window whose terms all occur in the corpus, the
    item positions and terms of its ``ranks`` rarest words; short windows repeat the last."""
    size = f"least(size(iw), {int(window)})"
    spots = (items.select("row", "iw", F.explode(F.expr(
                 f"sequence(0, size(iw) - {size})")).alias("s"), F.expr(size).alias("len"))
             .select("row", "s", "len", F.posexplode(F.expr("slice(iw, s + 1, len)")).alias("o", "word"))
             .select("row", "s", "len", (F.col("s") + F.col("o")).alias("p"),
                     F.xxhash64("word").alias("term")))
    counted = spots.join(frequency, "term")
    best = counted.groupBy("row", "s", "len").agg(
        F.count("*").alias("have"),
        F.slice(F.array_sort(F.collect_list(F.struct("cf", "p", "term"))), 1, ranks).alias("r"))
    best = best.where("have = len")
    cols = [F.expr(f"r[least({k}, size(r) - 1)].{f}").alias(f"{a}{k + 1}")
            for k in range(ranks) for f, a in (("p", "p"), ("term", "t"))]
    return best.select("row", *cols).distinct()


def alignments(index: DataFrame, windows: DataFrame, ranks: int) -> DataFrame:
    """(key, row, diag): where the ``ranks`` rarest terms of some window all stand at their
    offsets. Lists are intersected from the rarest on."""
    cur = None
    for k in range(1, ranks + 1):
        step = windows.select("row", *[f"p{i}" for i in range(1, k + 1)], f"t{k}").distinct()
        if cur is None:
            lists = step.join(index, F.col("t1") == F.col("term"))
            cur = lists.select("key", "row", "p1", (F.col("pos") - F.col("p1")).alias("diag"))
        else:
            ahead = [f"p{i}" for i in range(1, k)]
            wanted = cur.join(step, ["row", *ahead]).withColumn("at", F.col("diag") + F.col(f"p{k}"))
            used = step.select(F.col(f"t{k}").alias("term")).distinct()
            lists = index.join(_small(used, BROADCAST_TERMS), "term", "left_semi")
            cur = (wanted.join(lists.withColumnRenamed("key", "k2"),
                               (F.col("key") == F.col("k2")) & (F.col(f"t{k}") == F.col("term"))
                               & (F.col("at") == F.col("pos")))
                   .select("key", "row", *ahead, f"p{k}", "diag"))
        cur = cur.distinct()
    return cur.select("key", "row", "diag").distinct()


def phrase_matches(keyed: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, cands): for each document with an alignment, its (item, diag, iw) to verify."""
    items = written(items_of(benchmark), "decontam-items")
    terms = items.select(F.explode("iw").alias("word"))
    index = build_index(keyed, terms)
    frequency = written(index.groupBy("term").agg(F.count("*").alias("cf")), "decontam-cf")
    windows = written(windows_of(items, frequency, window, RANKS), "decontam-windows")
    at = alignments(index, windows, RANKS)
    return at.join(items, "row").groupBy("key").agg(
        F.collect_set(F.struct("item", "diag", "iw")).alias("cands"))


def proximity_matches(index: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(key, row): documents where every word of a phrase (row, iw) stands within ``slop``
    words of its offset from the phrase's rarest word."""
    frequency = index.groupBy("term").agg(F.count("*").alias("cf"))
    words = phrases.select("row", F.size("iw").alias("len"), F.posexplode("iw").alias("p", "word"))
    words = words.select("row", "len", "p", F.xxhash64("word").alias("term")).join(frequency, "term")
    words = words.withColumn("rank", F.row_number().over(
        Window.partitionBy("row").orderBy("cf", "p")))
    cur = (words.where("rank = 1").join(index, "term")
           .select("key", "row", "len", (F.col("pos") - F.col("p")).alias("diag")))
    near = words.where("rank > 1").select("row", "p", "term")
    got = (cur.join(near, "row").join(index.withColumnRenamed("key", "k2"), "term")
           .where(f"key = k2 and abs(pos - p - diag) <= {int(slop)}")
           .groupBy("key", "row", "len", "diag").agg(F.count_distinct("p").alias("n"))
           .where("n = len - 1").select("key", "row"))
    return got.union(cur.where("len = 1").select("key", "row")).distinct()


def _verified(window: int) -> tuple[Column, Column]:
    """Columns of a row with dw (document words) and cands: the occurrences as structs
    (item, positions)."""
    size = f"least(size(c.iw), {int(window)})"
    found = (f"transform(cands, c -> struct(c.item as item, flatten(transform("
             f"filter(sequence(0, size(c.iw) - {size}), s -> c.diag + s >= 0 and "
             f"slice(dw, greatest(c.diag + s, 0) + 1, {size}) = slice(c.iw, s + 1, {size})), "
             f"s -> sequence(c.diag + s, c.diag + s + {size} - 1))) as spots))")
    return F.expr(f"filter({found}, x -> size(x.spots) > 0)")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, extra: list[str]) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, items and the columns ``extra`` of it."""
    keyed = with_key(docs, extra)
    cands = written(phrase_matches(keyed, benchmark, window), "decontam-cands")
    index = F.expr(f"key & {(1 << BITMAP_BITS) - 1}L")
    bitmap = row_bitmap(cands, index)
    out = ["doc_id", *extra, "n_words", "n_hit", "items"]
    clean_rows = (bitmap_filter(keyed, bitmap, index, keep=False)
                  .withColumn("n_words", F.size(raw_words(F.col("text"))).cast("long"))
                  .withColumn("n_hit", F.lit(0).cast("long"))
                  .withColumn("items", F.array().cast("array<string>")).select(*out))
    hit = (bitmap_filter(keyed, bitmap, index).join(cands, "key", "left")
           .withColumn("cands", F.expr("coalesce(cands, array())"))
           .withColumn("dw", F.transform(raw_words(F.col("text")), lower_ascii))
           .withColumn("found", _verified(window))
           .withColumn("n_words", F.size("dw").cast("long"))
           .withColumn("n_hit", F.expr("cast(size(array_distinct(flatten(found.spots))) as long)"))
           .withColumn("items", F.expr("array_sort(array_distinct(found.item))")).select(*out))
    return hit.unionByName(clean_rows).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (distinct item ids as strings, sorted) and
    ``contaminated`` (n_hit > 0 and 20 * n_hit >= n_words) of every row of ``docs``."""
    return _judged(docs, benchmark, window, []).withColumn(
        "n_items", F.size("items").cast("long"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    judged = _judged(boxed(docs), benchmark, window, ["text", "rest"])
    return unboxed(judged.where("not contaminated"), docs.columns)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")
