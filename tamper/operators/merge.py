"""Keyed upsert with partial-column update (M1-M6).

Plain Parquet has no row-level MERGE, so the merge is expressed two ways:

* ``upsert`` (U1) - one MERGE step as a full outer join of target and source
  on the key. Matched rows take the *update* columns from the source (even a
  NULL: a nulled date must overwrite) and keep every other column; unmatched
  source rows are inserted. Presence is tracked with explicit flags, never by
  ``coalesce`` on values.
* ``fold`` (U2) - the state after any sequence of MERGE steps, computed in one
  aggregation over per-batch rows: update columns from the newest batch that
  holds the key, all other columns from the oldest. It is associative and
  idempotent and is aggregated map-side first, so a hot key costs one partial
  row per map task, not one row per occurrence.

Neither form ever deletes a row; there is no "not matched by source" branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Sources (or key sets) up to this many serialized bytes are broadcast; the
# size is measured on the data, not estimated from plan statistics.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame, cols: list[str] | None = None) -> tuple[int, int]:
    """(rows, bytes) of ``df`` as JSON text: an exact, cheap-to-aggregate upper
    bound of what a broadcast would ship. One partial-aggregated pass."""
    cols = cols or df.columns
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in cols])))).alias("b")
               ).first()
    return int(r["n"] or 0), int(r["b"] or 0)


def upsert(target: DataFrame, source: DataFrame, key: str, update_cols: list[str],
           insert_cols: list[str], columns: list[str] | None = None,
           broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One MERGE step. ``source`` must be unique per key (use
    ``latest_per_key`` or ``fold`` first). Columns outside ``insert_cols`` are
    NULL on insert.

    When the source's measured size is at most ``broadcast_bytes``, the source
    is broadcast and the target is only scanned (no shuffle of the target);
    otherwise both sides shuffle on the key for a full outer join. Pass
    ``broadcast_bytes=None`` to always use the shuffle form."""
    columns = columns or target.columns
    shipped = [key] + [c for c in columns if c in update_cols and c in source.columns and c != key]
    if broadcast_bytes is not None and fits_broadcast(source.select(*shipped), broadcast_bytes):
        return _upsert_broadcast(target, source, key, update_cols, insert_cols, columns)
    return _upsert_shuffle(target, source, key, update_cols, insert_cols, columns)


def fits_broadcast(df: DataFrame, limit: int) -> bool:
    """Proof that ``df`` serializes to at most ``limit`` bytes: one aggregation with
    partial sums in every task."""
    return measured_bytes(df)[1] <= limit


def _upsert_shuffle(target, source, key, update_cols, insert_cols, columns) -> DataFrame:
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in columns], F.lit(True).alias("t__present"))
    s_cols = [c for c in columns if c in source.columns]
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in s_cols], F.lit(True).alias("s__present"))
    j = t.join(s, F.col(f"t__{key}") == F.col(f"s__{key}"), "full_outer")
    tp = F.col("t__present").isNotNull()
    sp = F.col("s__present").isNotNull()
    out = []
    for c in columns:
        src = F.col(f"s__{c}") if c in s_cols and c in insert_cols else F.lit(None)
        if c == key:
            expr = F.when(tp, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}"))
        elif c in update_cols and c in s_cols:
            expr = (F.when(tp & sp, F.col(f"s__{c}")).when(tp, F.col(f"t__{c}"))
                    .otherwise(src))
        else:
            expr = F.when(tp, F.col(f"t__{c}")).otherwise(src)
        out.append(expr.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def _upsert_broadcast(target, source, key, update_cols, insert_cols, columns) -> DataFrame:
    """Small source: target LEFT JOIN broadcast(source key + update columns)
    applies the updates; source keys not found in the target (found via a
    semi-join against the broadcast key set, itself no larger than the source)
    are inserted from the source directly, so only the key and the update
    columns are ever broadcast."""
    s_cols = [c for c in columns if c in source.columns]
    shipped = [key] + [c for c in s_cols if c in update_cols and c != key]
    s = F.broadcast(source.select(*[F.col(c).alias(f"s__{c}") for c in shipped],
                                  F.lit(True).alias("s__present")))
    j = target.select(*columns).join(s, F.col(key) == F.col(f"s__{key}"), "left")
    sp = F.col("s__present").isNotNull()
    updated = j.select(*[
        (F.when(sp, F.col(f"s__{c}")).otherwise(F.col(c))
         if (c in shipped and c != key) else F.col(c))
        .cast(target.schema[c].dataType).alias(c) for c in columns])
    keys = F.broadcast(source.select(F.col(key).alias("__k")))
    matched = target.select(F.col(key).alias("__m")).join(keys, F.col("__m") == F.col("__k"),
                                                          "left_semi").distinct()
    new = source.join(F.broadcast(matched), F.col(key) == F.col("__m"), "left_anti")
    inserts = new.select(*[
        (F.col(c) if (c in s_cols and (c in insert_cols or c == key)) else F.lit(None))
        .cast(target.schema[c].dataType).alias(c) for c in columns])
    return updated.unionByName(inserts)


def fold(batches: DataFrame, key: str, update_cols: list[str], insert_cols: list[str],
         columns: list[str], batch_col: str = "BATCH_ID", first_col: str | None = None,
         bounds: bool = False, order_by: list[str] | None = None, by_column: bool = False) -> DataFrame:
    """U2. ``batches`` holds per-batch winners (unique per key and batch);
    batch ids order the merges. Equal to applying ``upsert`` batch by batch.

    With ``order_by`` a batch may hold several rows of a key: its winner (W1, the last row
    by these columns) is found by the same aggregation, so the rows shuffle once. Rows
    without a batch id take no part in either form, but for their key.

    ``batch_col`` orders the update columns (newest wins) and ``first_col``
    (default: the same column) the insert-only columns (oldest wins). With
    ``bounds`` the result carries FIRST_BATCH / LAST_BATCH, so it can itself be
    folded again later (snapshot + newer batches).

    The columns of a row travel in one struct, which is shuffled whole whatever is read of
    the result. ``by_column`` aggregates every column by itself, so that Spark leaves out
    those that are not read: for readers of a few columns."""
    first_col = first_col or batch_col
    upd = [c for c in columns if c in update_cols and c != key]
    keep = [c for c in columns if c not in upd and c != key]
    newest, oldest, last, first = F.col(batch_col), F.col(first_col), F.max_by, F.min_by
    if order_by:
        newest = F.when(newest.isNotNull(), F.struct(newest, *order_by))
        oldest, first = F.when(oldest.isNotNull(), F.struct((-oldest).alias("__nb"), *order_by)), F.max_by
    aggs = []
    if by_column:
        aggs += [last(F.col(c), newest).alias(f"__new.{c}") for c in upd]
        aggs += [first(F.col(c), oldest).alias(f"__old.{c}") for c in keep]
    else:
        if upd:
            aggs.append(last(F.struct(*[F.col(c) for c in upd]), newest).alias("__new"))
        if keep:
            aggs.append(first(F.struct(*[F.col(c) for c in keep]), oldest).alias("__old"))
    if bounds:
        aggs += [F.min(first_col).alias("__first"), F.max(batch_col).alias("__last")]
    agg = batches.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)

    def of(name: str):
        return F.col(f"`{name}`" if by_column else name)

    out = []
    for c in columns:
        if c == key:
            out.append(F.col(key))
        elif c in upd:
            out.append(of(f"__new.{c}").alias(c))
        elif c in insert_cols:
            out.append(of(f"__old.{c}").alias(c))
        else:
            out.append(F.lit(None).cast(batches.schema[c].dataType).alias(c))
    if bounds:
        out += [F.col("__first").alias("FIRST_BATCH"), F.col("__last").alias("LAST_BATCH")]
    return agg.select(*out)


def fold_latest(rows: DataFrame, key: str, update_cols: list[str], insert_cols: list[str],
                columns: list[str], batch_col: str, order_by: list[str]) -> DataFrame:
    """W1 inside every batch followed by U2 across batches, in ONE aggregation
    (one shuffle on the key instead of two).

    Update columns come from the greatest ``(batch, order_by...)`` row: the
    latest row of the newest batch. Insert-only columns come from the greatest
    ``(-batch, order_by...)`` row: the latest row of the oldest batch. Struct
    ordering puts NULLs first, which matches "descending, NULLs last". Both
    ``max_by`` are partial aggregates, so a hot key shrinks map-side."""
    upd = [c for c in columns if c in update_cols and c != key]
    keep = [c for c in columns if c not in upd and c != key]
    newest = F.struct(F.col(batch_col), *[F.col(c) for c in order_by])
    oldest = F.struct((-F.col(batch_col)).alias("__nb"), *[F.col(c) for c in order_by])
    aggs = []
    if upd:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in upd]), newest).alias("__new"))
    if keep:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in keep]), oldest).alias("__old"))
    agg = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    out = []
    for c in columns:
        if c == key:
            out.append(F.col(key))
        elif c in upd:
            out.append(F.col(f"__new.{c}").alias(c))
        elif c in insert_cols:
            out.append(F.col(f"__old.{c}").alias(c))
        else:
            out.append(F.lit(None).cast(rows.schema[c].dataType).alias(c))
    return agg.select(*out)


def fold_log(rows: DataFrame, key: str, update_cols: list[str], insert_cols: list[str],
             columns: list[str], bounds: bool = False, within: tuple[str, ...] = ()) -> DataFrame:
    """U2 over a layer's log, whose rows carry where they come from: FIRST_BATCH /
    LAST_BATCH and the place of the row inside that RAW batch, FIRST_POS / LAST_POS
    (ingest time and row position). Update columns come from the latest row of the newest
    batch, insert-only columns from the latest row of the oldest batch. The order is total
    over (batch, place), so it does not matter how a RAW batch was cut into micro-batches,
    nor how often the rows were folded before. ``within``: columns that the key decides, kept
    in the result; rows that are distributed by them are folded where they are."""
    newest = F.struct("LAST_BATCH", "LAST_POS")
    oldest = F.struct((-F.col("FIRST_BATCH")).alias("nb"), "FIRST_POS")
    upd = [c for c in columns if c in update_cols and c != key]
    keep = [c for c in columns if c not in upd and c != key]
    agg = rows.where(F.col(key).isNotNull()).groupBy(*within, key).agg(
        F.max_by(F.struct(F.lit(0).alias("__"), *[F.col(c) for c in upd]), newest).alias("__new"),
        F.max_by(F.struct("FIRST_BATCH", "FIRST_POS", *[F.col(c) for c in keep]), oldest).alias("__old"),
        F.max(newest).alias("__last"))
    out = []
    for c in columns:
        if c == key:
            out.append(F.col(key))
        elif c in upd:
            out.append(F.col(f"__new.{c}").alias(c))
        elif c in insert_cols:
            out.append(F.col(f"__old.{c}").alias(c))
        else:
            out.append(F.lit(None).cast(rows.schema[c].dataType).alias(c))
    if bounds:
        out += [F.col("__old.FIRST_BATCH"), F.col("__last.LAST_BATCH"),
                F.col("__old.FIRST_POS"), F.col("__last.LAST_POS")]
    return agg.select(*out, *within)


def changed_rows(state: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Post-images of the rows a batch touched: what a change feed on the
    merged table emits for that batch (a left-semi join, no columns from the
    batch)."""
    return state.join(batch.select(key).distinct(), key, "left_semi")


def post_images(target: DataFrame, source: DataFrame, key: str, update_cols: list[str],
                insert_cols: list[str], columns: list[str]) -> DataFrame:
    """The rows that a MERGE of ``source`` (unique per key) into ``target`` touches, as they
    are after it: ``changed_rows`` of the merged table, without merging the others. A left
    join from the source; its rows stay distributed by the key."""
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in columns])
    t = target.where(F.col(key).isNotNull()).select(
        F.col(key).alias("t__key"), *[F.col(c).alias(f"t__{c}") for c in columns if c not in update_cols and c != key])
    j = s.where(F.col(f"s__{key}").isNotNull()).join(t, F.col(f"s__{key}") == F.col("t__key"), "left")
    met = F.col("t__key").isNotNull()

    def image(c: str):
        if c == key or (c in update_cols and c in insert_cols):
            return F.col(f"s__{c}")
        if c in update_cols:
            return F.when(met, F.col(f"s__{c}"))
        return F.when(met, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}") if c in insert_cols else F.lit(None))
    return j.select(*[image(c).cast(target.schema[c].dataType).alias(c) for c in columns])
