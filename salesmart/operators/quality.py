"""Data-quality rules of the five base tables.

Each table runs its rules in a fixed order, and the order is part of the
result:

1. **missing** -- drop rows with a NULL in a required column;
2. **duplicate** -- drop *every* copy of a key that occurs more than once
   (not keep-first), counted on what survived step 1;
3. **invalid** -- (products, transactions) drop rows whose value columns do
   not fit their typed column whole or are negative, and (transactions) rows whose dimension keys
   are missing from the cleansed dimensions.

Because step 3 runs after step 2, an invalid copy still takes its valid
twin down with it; because step 1 runs first, a NULL-bearing copy does not.

Physical shape (transactions).  A naive plan would shuffle the full fact
once for the duplicate rule and once more per dimension semi join.  Here the
fact is read three times, and whole rows move at most once:

1. ``faulty_keys``: every complete row counts its five keys (its id and one per
   dimension) in one aggregation, pre-aggregated on the map side.  Ids counted
   twice and keys that their dimension lacks remain, usually few.
2. ``rejected_marks``: every row is marked with what is wrong with it, one
   skinny mark per fault.  The copies of a repeated id are known from its count.
   Keys that a dimension lacks are looked up in broadcast sets as long as their
   counted number allows it; those of the other dimensions in a single shuffle
   join.  The staged marks are the classification of the fact: the cleansing,
   the orphan report and the rejects report all read them instead of the fact.
3. The ids that the marks remove leave in one anti join, the only place where
   whole fact rows are shuffled -- or none at all when the staged set's
   measured size allows a broadcast.  A hot id on the fact side is split by
   AQE's skew-join handling.

This is equivalent to the row-by-row rules: after the duplicate rule each
surviving id names exactly one row, and the value checks are row-local.
The ``stage`` hook lets a caller materialise an intermediate set (and
decide on broadcasting from its measured size); by default it is lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null, to_money, to_timestamp_ntz, valid_money, valid_timestamp
from ..schemas import KEYS, REQUIRED, TYPED_OVERRIDES, typed

Stage = Callable[[DataFrame, str], DataFrame]


#: Whether a set of so many keys may be broadcast.
Fits = Callable[[int], bool]
#: Copies of a repeated id that are marked from one array.
COPIES_PER_BLOCK = 4096


def lazy_stage(df: DataFrame, name: str) -> DataFrame:
    return df


def never_fits(rows: int) -> bool:
    return False


# Dimension key column of the fact for each dimension table.
FACT_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "employees": "employee_id",
    "payments": "payment_id",
}


# --------------------------------------------------------------------------
# rule 1: missing values


def missing(table: str):
    return any_null(REQUIRED[table])


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows with no NULL in ``cols`` (pushed to the scan as IsNotNull)."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


# --------------------------------------------------------------------------
# rule 2: duplicate keys, every copy removed


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (NULL keys are never removed later)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
            .where(F.col("_copies") > 1).select(*keys))


def drop_all_duplicates(df: DataFrame, keys: list[str],
                        stage: Stage = lazy_stage) -> DataFrame:
    """Remove every row whose key occurs more than once.

    ``key IN (keys with a second copy)``: a NULL key never compares TRUE,
    so NULL-key rows stay -- the equi anti join gives the same.
    """
    return df.join(stage(duplicate_keys(df, keys), "duplicate_keys"), keys, "left_anti")


# --------------------------------------------------------------------------
# rule 3: invalid values and orphan references


def invalid_values(table: str):
    """Row-local invalid-value condition, or None when the table has none."""
    if table == "products":
        return ~valid_money("unit_price")
    if table == "transactions":
        return ~(valid_timestamp("timestamp") & valid_money("total_amount"))
    return None


def drop_invalid(df: DataFrame, table: str) -> DataFrame:
    cond = invalid_values(table)
    # cond is never UNKNOWN
    return df if cond is None else df.where(~cond)


#: Tags of marks besides the dimensions' names; the fact's name marks a repeated id.
FACT, MISSING, INVALID = "transactions", "missing", "invalid"


def _key_marks() -> list:
    """(tag, key) of a fact row: its id and its key into each dimension."""
    keys = {FACT: KEYS[FACT], **FACT_KEYS}
    return [F.struct(F.lit(tag).alias("tag"), F.col(c).cast("long").alias("key")) for tag, c in keys.items()]


def faulty_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``(tag, key, copies)``: ids that complete rows hold twice, and keys absent from
    their dimension, with the number of complete rows that hold them.

    ``key NOT IN (SELECT key FROM dim)`` per dimension: the dimensions must
    already be cleansed (keys non-NULL), so it agrees with the outer join's
    misses.  One pass over the fact counts all keys at once; the join moves
    one row per key, not per transaction.
    """
    passed = drop_missing(fact, REQUIRED[FACT])
    counted = (passed.select(F.explode(F.array(*_key_marks())).alias("mark"))
               .groupBy(F.col("mark.tag").alias("tag"), F.col("mark.key").alias("key"))
               .agg(F.count(F.lit(1)).alias("copies")))
    known = reduce(DataFrame.unionByName, [
        dims[table].select(F.lit(table).alias("tag"), F.col(key).cast("long").alias("key"), F.lit(True).alias("known"))
        for table, key in FACT_KEYS.items()])
    faulty = F.when(F.col("tag") == FACT, F.col("copies") > 1).otherwise(F.col("known").isNull())
    return counted.join(known, ["tag", "key"], "left").where(faulty).select("tag", "key", "copies")


def _copies(faulty: DataFrame) -> DataFrame:
    """``(transaction_id, tag, key)``: one mark per copy of a repeated id, in blocks so that no array grows with a hot id."""
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_BLOCK).cast("long")))
    blocks = faulty.where(F.col("tag") == FACT).select("tag", "key", "copies", begin.alias("begin"))
    held = F.least(F.col("copies") - F.col("begin"), F.lit(COPIES_PER_BLOCK)).cast("int")
    each = F.explode(F.array_repeat(F.col("key"), held))
    return blocks.select("tag", each.alias("key")).select(F.col("key").alias(KEYS[FACT]), "tag", "key")


def rejected_marks(fact: DataFrame, dims: dict[str, DataFrame], stage: Stage = lazy_stage,
                   fits: Fits = never_fits) -> DataFrame:
    """``(transaction_id, tag, key)``: what is wrong with which row, one row per fault.

    Tags: ``missing`` (then nothing else is looked at), the fact's name for
    every copy of a repeated id, ``invalid`` values, and a dimension's name for
    a key that it lacks.  With ``fits`` the faulty keys of each dimension are
    counted, and looked up by a broadcast if it says so.
    """
    id_col = KEYS[FACT]
    faulty = stage(faulty_keys(fact, dims), "missing_keys")
    counts = {} if fits is never_fits else {
        r["tag"]: r["count"] for r in faulty.where(F.col("tag") != FACT).groupBy("tag").count().collect()}
    looked_up = [t for t in FACT_KEYS if fits is not never_fits and fits(counts.get(t, 0))]
    rows = fact
    for t in looked_up:
        if counts.get(t):
            lacking = faulty.where(F.col("tag") == t).select(F.col("key").alias(f"_{t}"))
            rows = rows.join(F.broadcast(lacking), F.col(FACT_KEYS[t]).cast("long") == F.col(f"_{t}"), "left")
    mark = lambda tag, key, wrong: F.struct(
        F.lit(tag).alias("tag"), key.cast("long").alias("key"), wrong.cast("boolean").alias("wrong"))
    nothing, complete = F.lit(None), ~missing(FACT)
    marks = [mark(MISSING, nothing, missing(FACT)), mark(INVALID, nothing, complete & invalid_values(FACT))]
    marks += [mark(t, F.col(FACT_KEYS[t]), complete & F.col(f"_{t}").isNotNull()) for t in looked_up if counts.get(t)]
    # keys that are not looked up row by row: NULL until they are joined
    rest = [t for t in FACT_KEYS if t not in looked_up]
    marks += [mark(t, F.col(FACT_KEYS[t]), F.when(missing(FACT), F.lit(False))) for t in rest]
    found = (rows.select(F.col(id_col), F.explode(F.array(*marks)).alias("mark"))
             .select(id_col, "mark.tag", "mark.key", "mark.wrong").where("wrong IS NULL OR wrong"))
    if rest:
        joined = faulty.where(F.col("tag").isin(rest)).select("tag", "key", F.lit(True).alias("faulty"))
        found = found.join(joined, ["tag", "key"], "left").where(F.col("wrong") | F.col("faulty"))
    return stage(found.select(id_col, "tag", "key").unionByName(_copies(faulty)), "rejected_marks")


# --------------------------------------------------------------------------
# typed projections


def to_typed(df: DataFrame, table: str) -> DataFrame:
    """Cast the raw value columns; everything else keeps its landing type."""
    raw = TYPED_OVERRIDES.get(table, {})
    conv = {"timestamp": to_timestamp_ntz, "total_amount": to_money, "unit_price": to_money}
    return df.select([(conv[f.name](f.name) if f.name in raw
                       else F.col(f.name).cast(f.dataType)).alias(f.name)
                      for f in typed(table).fields])


# --------------------------------------------------------------------------
# per-table pipelines


def cleanse_dimension(df: DataFrame, table: str, stage: Stage = lazy_stage) -> DataFrame:
    """Missing -> duplicate -> (products) invalid; typed result."""
    kept = drop_missing(df, REQUIRED[table])
    kept = drop_all_duplicates(kept, [KEYS[table]], stage)
    kept = drop_invalid(kept, table)
    return to_typed(kept, table)


def transaction_removals(marks: DataFrame) -> DataFrame:
    """Ids the duplicate and referential rules remove (after the NULL rule)."""
    # a hot id collapses map-side; once staged, the anti join's build side is
    # a plain shuffle and AQE can split the hot id on the fact side
    return marks.where(~F.col("tag").isin(MISSING, INVALID)).select(KEYS[FACT]).distinct()


def cleanse_transactions(fact: DataFrame, dims: dict[str, DataFrame], stage: Stage = lazy_stage,
                         marks: DataFrame | None = None, fits: Fits = never_fits) -> DataFrame:
    """Cleansed, typed fact.  ``dims`` must be the cleansed dimensions; ``marks``
    are those of ``rejected_marks``, if they are at hand."""
    marks = rejected_marks(fact, dims, stage, fits) if marks is None else marks
    removed = stage(transaction_removals(marks), "removed_ids")
    passed = drop_missing(fact, REQUIRED[FACT])
    # typed rows are narrower than landed ones: they cross the exchange
    kept = to_typed(drop_invalid(passed, FACT), FACT)
    return kept.join(removed, KEYS[FACT], "left_anti").select(*kept.columns)


# --------------------------------------------------------------------------
# reports


def _spoiled(marks: DataFrame, *tags: str) -> DataFrame:
    return marks.where(F.col("tag").isin(*tags)).select(KEYS[FACT]).distinct()


def referential_orphans(fact: DataFrame, dims: dict[str, DataFrame], stage: Stage = lazy_stage,
                        marks: DataFrame | None = None) -> DataFrame:
    """Orphan report: rows that reach the referential check and fail it.

    One row per (transaction, failing dimension); a row can fail several.
    """
    key = KEYS[FACT]
    marks = rejected_marks(fact, dims, stage) if marks is None else marks
    spoiled = stage(_spoiled(marks, FACT, INVALID), "spoiled_ids")
    return (marks.where(F.col("tag").isin(*FACT_KEYS)).join(spoiled, key, "left_anti")
            .select(key, F.col("tag").alias("dimension"), F.col("key").alias("key_value")))


def transaction_reasons(marks: DataFrame, stage: Stage = lazy_stage) -> DataFrame:
    """``(transaction_id, reason)`` of every removed fact row, from the marks alone."""
    key = KEYS[FACT]
    reason = lambda df, text: df.select(key, F.lit(text).alias("reason"))
    repeated = stage(_spoiled(marks, FACT), "repeated_ids")
    spoiled = stage(_spoiled(marks, FACT, INVALID), "spoiled_ids")
    orphans = marks.where(F.col("tag").isin(*FACT_KEYS)).select(key).distinct()
    return reduce(DataFrame.unionByName, [
        reason(marks.where(F.col("tag") == MISSING), "missing"),
        reason(marks.where(F.col("tag") == FACT), "duplicate"),
        reason(marks.where(F.col("tag") == INVALID).join(repeated, key, "left_anti"), "invalid"),
        reason(orphans.join(spoiled, key, "left_anti"), "orphan")])


def reject_reasons(df: DataFrame, table: str, dims: dict[str, DataFrame] | None = None,
                   stage: Stage = lazy_stage, marks: DataFrame | None = None) -> DataFrame:
    """``(table_name, <key>, reason)`` for every removed row.

    The reason is the first rule that removes the row: ``missing``,
    ``duplicate``, ``invalid`` (value) or ``orphan`` (reference).  The fact's
    come from its marks.  A dimension is classified in one pass: its complete
    rows are left-joined to the (staged) duplicate-key set, so it is shuffled
    at most once, not at all when that set is small enough to broadcast.
    """
    key = KEYS[table]
    if table == FACT:
        out = transaction_reasons(rejected_marks(df, dims, stage) if marks is None else marks, stage)
        return out.select(F.lit(table).alias("table_name"), key, "reason")
    miss = df.where(missing(table)).select(key, F.lit("missing").alias("reason"))
    passed = drop_missing(df, REQUIRED[table])
    dups = stage(duplicate_keys(passed, [key]), f"{table}_duplicate_keys")
    flagged = passed.join(dups.withColumn("_dup", F.lit(True)), key, "left")
    reason = F.when(F.col("_dup"), F.lit("duplicate"))
    cond = invalid_values(table)
    if cond is not None:
        reason = reason.when(cond, F.lit("invalid"))
    removed = flagged.select(key, reason.alias("reason")).where(F.col("reason").isNotNull())
    return miss.unionByName(removed).select(F.lit(table).alias("table_name"), key, "reason")


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("rejected_rows"))
