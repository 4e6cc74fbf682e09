"""Operator 10: approximate nearest neighbours in a hash-prefix forest.

Every vector has one hash string in each of ``TREES`` trees: ``SYMBOLS`` symbols of 7 bits,
each the (signed) one of 64 random directions nearest to the vector. A tree is a table
(tree, code) range-sorted by code, so vectors with a common prefix are neighbours. A query
descends to the longest prefix it shares with entries and ascends all trees together, one
symbol at a time, until the prefixes hold ``FIRST`` entries. The score of the last
neighbour found there bounds the angle of every true neighbour; with Gaussian directions
the chance that a vector at that angle shares a prefix with the query depends on the angle
alone, not on the table, and is measured once (``collisions``). A query whose prefixes hold
a true neighbour with a chance under ``TARGET`` goes on to the longest prefixes that reach
it, there with the ``PROBES`` likeliest prefixes of each tree. At length 0 one tree holds
every vector. The vectors under the chosen prefixes are scored exactly, in double
precision on the original vectors, where they meet the query.

Inner products are reduced to angles by one more component, sqrt(M^2 - |x|^2), for indexed
vectors (0 for queries). Equal vectors are one class with its 21 smallest ids, so a vector
that a third of all rows share is indexed once, and all its queries share one descent. A
prefix with many vectors is split over salts, each with its own copy of the queries.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null
or non-finite components, and rows with a null id, take no part; repeated rows count once;
ties go to the smaller vec_id; fewer candidates than 20 are all returned; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamper.llm._spark import arrow_batches, table, written

TREES, SYMBOLS, DIRECTIONS, SYMBOL_BITS = 48, 5, 64, 7
FIRST, PROBES, CHOICES, TARGET = 1000, 16, 8, 0.95
ANGLES, TRIALS = 100, 4000
NEIGHBOURS, QUERY_EVERY = 20, 20
CELL_ROWS = 20_000
CELL_VALUES = 1 << 24


def _valid_batches(dim: int, kind: str):
    """(vec_id, v): usable vectors as bytes of the table's type."""
    def run(batches):
        for batch in batches:
            values = batch.column("embedding")
            ok = np.array([False if v is None or len(v) != dim else True for v in values.to_pylist()], bool)
            ids = batch.column("vec_id").filter(pa.array(ok, pa.bool_()))
            kept = values.filter(pa.array(ok, pa.bool_()))
            if len(kept):
                x = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) + 0.0
            else:
                x = np.zeros((0, dim))
            use = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(use)), pa.array([r.tobytes() for r in x[use].astype(kind)], pa.binary())],
                names=["vec_id", "v"])
    return run


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), -1).astype(np.float64)


@lru_cache(maxsize=1)
def directions(dim: int, symbols: int) -> np.ndarray:
    """(trees, symbols, dim + 1, directions); the first symbols are the same for any
    number of symbols."""
    out = np.empty((TREES, symbols, dim + 1, DIRECTIONS), np.float32)
    for t in range(TREES):
        for s in range(symbols):
            out[t, s] = np.random.default_rng([17, t, s]).standard_normal((dim + 1, DIRECTIONS))
    return out


def prefixes(x: np.ndarray, largest: float, symbols: int, query: bool) -> np.ndarray:
    """First ``symbols`` symbols of the hash strings (n, trees)."""
    norm = np.linalg.norm(x, axis=1)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(largest ** 2 - norm ** 2, 0))
    full = np.column_stack([x, extra]).astype(np.float32)
    out = np.zeros((len(x), TREES), np.int64)
    table_ = directions(x.shape[1], symbols)
    for t in range(TREES):
        for s in range(symbols):
            p = full @ table_[t, s]
            best = np.argmax(np.abs(p), axis=1)
            sign = p[np.arange(len(p)), best] > 0
            out[:, t] = out[:, t] << SYMBOL_BITS | best << 1 | sign
    return out


def probes(p: np.ndarray, keep: int) -> np.ndarray:
    """(n, keep or fewer): the likeliest codes of queries with the projections ``p``
    (n, symbols, directions), by the sum of the gaps to the nearest directions."""
    size = np.abs(p)
    code, gap = np.zeros((len(p), 1), np.int64), np.zeros((len(p), 1))
    for s in range(p.shape[1]):
        top = np.argsort(-size[:, s], axis=1, kind="stable")[:, :CHOICES]
        near = np.take_along_axis(size[:, s], top, axis=1)
        symbol = top << 1 | (np.take_along_axis(p[:, s], top, axis=1) > 0)
        gap = (gap[:, :, None] + (near[:, :1] - near)[:, None]).reshape(len(p), -1)
        code = (code[:, :, None] << SYMBOL_BITS | symbol[:, None]).reshape(len(p), -1)
        best = np.argsort(gap, axis=1, kind="stable")[:, :keep]
        gap, code = np.take_along_axis(gap, best, axis=1), np.take_along_axis(code, best, axis=1)
    return code


def probed(level: int) -> int:
    """Prefixes of a tree that a query of the second round looks at."""
    return PROBES if level > 1 else 1


@lru_cache(maxsize=1)
def collisions() -> np.ndarray:
    """(probed or not, level, angle): the least chance that one of the trees has a vector,
    whose cosine with the query is at least angle / ANGLES, under the prefixes looked at.
    Projections on Gaussian directions of two vectors are normal with their cosine as
    correlation, so this holds for any table; two standard errors are taken off."""
    rng = np.random.default_rng(23)
    out = np.zeros((2, SYMBOLS + 1, ANGLES + 1))
    out[:, 0] = 1
    p, noise = rng.standard_normal((2, TRIALS, SYMBOLS, DIRECTIONS))
    looked = [[probes(p[:, :level], k) for level in range(1, SYMBOLS + 1)] for k in (1, PROBES)]
    for angle in range(ANGLES + 1):
        c = angle / ANGLES
        near = c * p + (1 - c * c) ** 0.5 * noise
        best = np.argmax(np.abs(near), axis=2)
        symbol = best << 1 | (np.take_along_axis(near, best[..., None], axis=2)[..., 0] > 0)
        own = np.zeros((TRIALS, 1), np.int64)
        for s in range(SYMBOLS):
            own = own << SYMBOL_BITS | symbol[:, s:s + 1]
        for level in range(1, SYMBOLS + 1):
            for k in (0, 1):
                codes = looked[k][level - 1][:, :1 if not k else probed(level)]
                hit = (codes == own >> (SYMBOLS - level) * SYMBOL_BITS).any(axis=1).mean()
                hit = max(0.0, hit - 2 * (hit * (1 - hit) / TRIALS) ** 0.5)
                out[k, level, angle] = 1 - (1 - hit) ** TREES
    return out


def needed_level(chance: np.ndarray, cosine: float, level: int) -> int | None:
    """The longest prefixes that hold a vector of this cosine or more with a chance of
    ``TARGET``; None if those of ``level`` in the first round do."""
    angle = int(min(max(cosine, 0.0), 1.0) * ANGLES)
    if chance[0, level, angle] >= TARGET:
        return None
    return max(n for n in range(SYMBOLS + 1) if chance[1, n, angle] >= TARGET)


def _code_batches(largest: float, symbols: int, query: bool, kind: str, whole: bool):
    """(cid, tree, code[, least, vector]) for every vector and tree."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                codes = prefixes(_matrix(part.column("v"), kind) / largest, 1.0, symbols, query)
                every = pa.array(np.repeat(np.arange(part.num_rows), TREES))
                cols = [part.column("cid").take(every),
                        pa.array(np.tile(np.arange(TREES, dtype=np.int32), part.num_rows)),
                        pa.array(codes.reshape(-1))]
                names = ["cid", "tree", "code"]
                if whole:
                    cols += [part.column("least").take(every), part.column("v").take(every)]
                    names += ["least", "v"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _ask_batches(largest: float, second: bool, kind: str):
    """(cid, v, tree, level, prefix): the prefixes that each query looks at."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                x = _matrix(part.column("v"), kind) / largest
                levels = part.column("level").to_numpy()
                found = [(np.flatnonzero(levels == 0), 0, 0, np.zeros((int((levels == 0).sum()), 1), np.int64))]
                table_ = directions(x.shape[1], SYMBOLS)
                for level in sorted(set(levels.tolist()) - {0}):
                    pick = np.flatnonzero(levels == level)
                    full = np.column_stack([x[pick], np.zeros(len(pick))]).astype(np.float32)
                    for t in range(TREES):
                        p = np.stack([full @ table_[t, s] for s in range(level)], axis=1)
                        found.append((pick, t, level, probes(p, probed(level) if second else 1)))
                row = np.concatenate([np.repeat(pick, c.shape[1]) for pick, _, _, c in found])
                whole = lambda i, f=found: np.concatenate(
                    [np.full(c[3].size, c[i], np.int32) for c in f])
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid").take(pa.array(row)), part.column("v").take(pa.array(row)),
                     pa.array(whole(1)), pa.array(whole(2)),
                     pa.array(np.concatenate([c.reshape(-1) for *_, c in found]))],
                    names=["cid", "v", "tree", "level", "prefix"])
    return run


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, the same for a pair of rows wherever they meet."""
    return (x * y).sum(axis=1)


def _cell_group(keep: int, kind: str):
    """One cell: its vectors and its queries -> the ``keep`` best vectors of each query.
    A fast product picks all vectors that rounding may have kept from the best; those are
    scored row by row, and ties go to the smaller id."""
    def run(group: pa.Table) -> pa.Table:
        ask = group.column("ask").to_numpy().astype(bool)
        cid = group.column("cid").to_numpy()
        x = _matrix(group.column("v"), kind)
        index, ids = x[~ask], cid[~ask]
        least = group.column("least").to_numpy()[~ask]
        longest = np.linalg.norm(index, axis=1).max(initial=0.0)
        rounding = 4 * x.shape[1] * np.finfo(np.float64).eps * longest
        out = [[], [], [], []]
        queries = np.flatnonzero(ask)
        step = max(1, CELL_VALUES // max(1, index.size))
        k = min(keep, len(ids))
        for lo in range(0, len(queries) if len(ids) else 0, step):
            q = queries[lo:lo + step]
            s = x[q] @ index.T
            last = np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k]
            row, col = np.nonzero(s >= (last - rounding * np.linalg.norm(x[q], axis=1))[:, None])
            score = exact_scores(x[q][row], index[col])
            order = np.lexsort((least[col], -score, row))
            row, col, score = row[order], col[order], score[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            for v, part in zip(out, (cid[q][row], ids[col], least[col], score), strict=True):
                v.append(part[best])
        join = lambda v, kind: np.concatenate(v) if v else np.zeros(0, kind)
        return pa.table({"query": join(out[0], np.int64), "cid": join(out[1], np.int64),
                         "least": join(out[2], np.int64), "score": join(out[3], np.float64)})
    return run


def _prefix(level: str) -> str:
    return f"shiftright(code, cast(({SYMBOLS} - {level}) * {SYMBOL_BITS} as int))"


def chosen_levels(forest: DataFrame, asked: DataFrame, least: int):
    """(query, level): the longest common prefix length at which all trees together hold
    ``FIRST`` entries and one tree alone holds ``least`` different ones; 0 if none does. And
    the counts (tree, level, prefix, n)."""
    levels = F.explode(F.sequence(F.lit(1), F.lit(SYMBOLS))).alias("level")
    counts = (forest.select("tree", "code", levels)
              .groupBy("tree", "level", F.expr(_prefix("level")).alias("prefix"))
              .agg(F.count("*").alias("n")))
    counts = written(counts, "ann-counts")
    own = asked.select(F.col("cid").alias("query"), "tree", "code", levels).withColumn(
        "prefix", F.expr(_prefix("level")))
    reach = (own.join(counts, ["tree", "level", "prefix"])
             .groupBy("query", "level").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
             .where((F.col("n") >= FIRST) & (F.col("most") >= least))
             .groupBy("query").agg(F.max("level").alias("level")))
    all_queries = asked.select(F.col("cid").alias("query")).distinct()
    return all_queries.join(reach, "query", "left").select(
        "query", F.coalesce("level", F.lit(0)).alias("level")), counts


def search(vectors: DataFrame, every: int = QUERY_EVERY, neighbours: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``,
    its ``neighbours`` nearest rows found, by inner product."""
    spark = vectors.sparkSession
    arrow_batches(spark)
    vectors = vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null")
    usual = (vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
             .where("dim > 0").orderBy(F.desc("n"), F.desc("dim")).first())
    empty = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return spark.createDataFrame([], empty)
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "f4" if element == "float" else "f8"
    rows = written(vectors.mapInArrow(_valid_batches(usual["dim"], kind), "vec_id long, v binary"), "ann-rows")
    # equal vectors: one class, its neighbours + 1 smallest ids; the limit runs map-side too
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("r", rank).where(F.col("r") <= neighbours + 1)
    classes = written(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
                      .withColumn("least", F.col("members")[0])
                      .withColumn("cid", F.monotonically_increasing_id()), "ann-classes")
    total = classes.count()
    if not total:
        return spark.createDataFrame([], empty)
    norm = F.max("norm")
    largest = classes.mapInArrow(_norm_batches(kind), "norm double").agg(norm.alias("m")).first()["m"]

    queries = written(rows.where(F.col("vec_id") % every == 0).distinct()
                      .join(classes.select("v", "cid"), "v")
                      .select(F.col("vec_id").alias("query_id"), F.col("cid").alias("query")), "ann-queries")
    asked = written(classes.join(queries.select(F.col("query").alias("cid")).distinct(), "cid", "left_semi")
                    .select("cid", "v"), "ann-asked")
    forest = written(classes.select("cid", "v").mapInArrow(
        _code_batches(largest, SYMBOLS, False, kind, False), "cid long, tree int, code long")
        .repartitionByRange("tree", "code").sortWithinPartitions("tree", "code"), "ann-forest")
    own = written(asked.mapInArrow(_code_batches(largest, SYMBOLS, True, kind, False),
                                   "cid long, tree int, code long"), "ann-own")
    level, counts = chosen_levels(forest, own, neighbours + 1)
    level = written(level, "ann-levels")
    sizes = counts.union(spark.createDataFrame([(0, 0, 0, total)], counts.schema))

    def looked_at(level: DataFrame, second: bool, name: str) -> DataFrame:
        """(query, cid, least, score): the best classes under the prefixes of the queries."""
        used = sorted(r["level"] for r in level.select("level").distinct().collect())  # at most SYMBOLS + 1
        cell = ["tree", "level", "prefix"]
        asks = asked.join(level.withColumnRenamed("query", "cid"), "cid").mapInArrow(
            _ask_batches(largest, second, kind), "cid long, v binary, tree int, level int, prefix long")
        cells = written(asks.select(*cell).distinct().join(sizes, cell).select(
            *cell, F.ceil(F.col("n") / CELL_ROWS).alias("salts")), f"ann-cells-{name}")
        deepest = max([*used, 1])
        entries = classes.select("cid", "least", "v").mapInArrow(
            _code_batches(largest, deepest, False, kind, True),
            "cid long, tree int, code long, least long, v binary")
        entries = (entries.withColumn("level", F.explode(F.array(*[F.lit(x) for x in used])))
                   .where("level > 0 or tree = 0")
                   .withColumn("prefix", F.expr(
                       f"shiftright(code, cast(({deepest} - level) * {SYMBOL_BITS} as int))")))
        dealt = (entries.join(cells, cell)
                 .select("cid", "least", "v", *cell, F.pmod(F.xxhash64("cid"), F.col("salts")).alias("salt"),
                         F.lit(False).alias("ask")))
        asks = (asks.join(cells, cell)
                .select("cid", F.lit(0).cast("long").alias("least"), "v", *cell,
                        F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"), F.lit(True).alias("ask")))
        found = dealt.unionByName(asks).groupBy(*cell, "salt").applyInArrow(
            _cell_group(neighbours + 1, kind), "query long, cid long, least long, score double")
        best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least"))
        return written(found.distinct().withColumn("r", best).where(F.col("r") <= neighbours + 1).drop("r"),
                       f"ann-found-{name}")

    order = [F.desc("score"), F.asc("vec_id")]

    def best_members(found: DataFrame) -> DataFrame:
        flat = found.join(classes.select("cid", "members"), "cid").select(
            "query", "score", F.explode("members").alias("vec_id"))
        return flat.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(
            F.col("r") <= neighbours + 1)

    found = looked_at(level, False, "1")
    last = best_members(found).where(F.col("r") == neighbours + 1).select("query", F.col("score").alias("last"))
    again = (level.where("level > 0").join(last, "query", "left")
             .join(asked.withColumnRenamed("cid", "query"), "query")
             .select("query", "level", "last", "v")
             .mapInArrow(_again_batches(largest, kind), "query long, level int"))
    again = written(again, "ann-again")
    if not again.isEmpty():
        found = found.unionByName(looked_at(again, True, "2")).distinct()
    top = best_members(found)
    mine = queries.join(top.drop("r"), "query").where("vec_id <> query_id")
    return (mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
            .where(F.col("rank") <= neighbours)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _again_batches(largest: float, kind: str):
    """(query, level) of the second round, for queries that need one: by the cosine that
    no true neighbour is under."""
    chance = collisions()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            norm = np.linalg.norm(_matrix(batch.column("v"), kind), axis=1)
            level = [0 if last is None else needed_level(chance, last / (n * largest), was) for last, n, was in zip(
                batch.column("last").to_pylist(), norm.tolist(), batch.column("level").to_pylist(), strict=True)]
            need = pa.array([x is not None for x in level], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("query").filter(need),
                                              pa.array(level, pa.int32()).filter(need)], names=["query", "level"])
    return run


def _norm_batches(kind: str):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                longest = np.linalg.norm(_matrix(batch.column("v"), kind), axis=1).max()
                yield pa.RecordBatch.from_arrays([pa.array([float(longest)])], names=["norm"])
    return run


def op10_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
