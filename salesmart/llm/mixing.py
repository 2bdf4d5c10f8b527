"""Mixing sources to target weights (operator 2): a time-varying curriculum.

A source's schedule is a piecewise-linear rate over training time 0..1.  Its
integral is the source's demand of words up to a time; the integral over the
whole run is the source's target.  Documents of a source are queued in the
order of a seeded hash of their id, pass after pass.  A document that starts
after ``c`` words of its source's queue is trained at the time at which the
source's cumulative demand reaches ``c``: the inverse of the integral.  The
result is range-sorted by that position.

Targets: the sources share ``share`` of all words by weight, none takes more
than ``repeats`` times its own words, and the excess goes to the others by
weight (water-filling, solved by two windows over one row per source).

Scale: the queue positions are prefix sums over (source, first three hash
digits), so a source that holds a third of all rows is spread over 4,096
groups; no window ever covers a source.  The last document that a source's
target reaches is taken in part: ``taken`` then counts its first words, so
each source's total is its target rounded down.

Edge cases: null text has size 0; null source is a source of its own, last in
order; documents of size 0 take 0 words and have no position
(``repeat_passes`` can keep them once, first); repeated ids are
queued one after the other; an empty table gives an empty result.  Columns of
``df`` are kept; a result column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, column, fresh, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
SEED = "mix"
#: Per weight: knots (time, rate).  Heavy sources lead, light ones come late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def integral(knots: Sequence[tuple[float, float]]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def time_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of the schedule reaches ``share`` of its whole."""
    area = share * F.lit(integral(knots))
    out, before = F.lit(knots[-1][0]), [0.0]
    for a, b in zip(knots, knots[1:]):
        before.append(before[-1] + integral([a, b]))
    for ((t0, w0), (t1, w1)), low, high in reversed(list(zip(zip(knots, knots[1:]), before, before[1:]))):
        rest, slope = area - F.lit(low), (w1 - w0) / (t1 - t0)
        inside = rest / F.lit(w0) if slope == 0 else (
            (F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest) - F.lit(w0)) / F.lit(slope))
        out = F.when(area < F.lit(high), F.lit(t0) + inside).otherwise(out)
    return out


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size), one row per source, plus weight class and target."""
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("class", (F.row_number().over(order) - 1) % len(weights))
    ranked = ranked.select(
        "*", F.element_at(F.array(*map(F.lit, weights)), F.col("class") + 1).alias("weight"),
        (F.lit(float(repeats)) * F.col("source_size")).alias("cap"))
    ranked = ranked.withColumn("level", F.col("cap") / F.col("weight"))
    before = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = ranked.withColumn(
        "shared",
        (F.lit(share) * F.sum("source_size").over(every)
         - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    water = F.min(F.when(F.col("level") >= F.col("shared"),
                         F.struct("level", F.col("source").isNull(), "source", "shared"))).over(every)
    return ranked.select(
        "source", "source_size", "class",
        F.least("cap", F.coalesce(F.col("weight") * water["shared"], F.col("cap"))).alias("target"))


def mix(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
        repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """``df`` with size, source_size, target, taken, passes and position, range-sorted.

    ``passes`` holds, for each pass that takes words of the document, (position,
    taken); ``position`` is that of the first.
    """
    made = ("size", "source_size", "target", "taken", "passes", "position")
    keep = [column(df, c) for c in df.columns if c.lower() not in made]
    key, mark, part, klass = (fresh(df, c) for c in ("mix_source", "mix_hash", "mix_part", "mix_class"))
    rows = df.select(
        *keep, size.cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("s"), column(df, source_col)), F.lit("n")).alias(key),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column(df, id_col).cast("string"),
                                                     F.lit("null"))).cast("binary")).alias(mark))
    rows = rows.withColumn(part, F.substring(mark, 1, 3))

    groups = stage(rows.groupBy(key, part).agg(F.sum("size").alias("words")))
    plan = targets(groups.groupBy(key).agg(F.sum("words").alias("source_size"))
                   .withColumn("source", F.when(F.col(key) != "n", F.substring(key, 2, 1 << 30))),
                   weights, share, repeats)
    plan = plan.withColumn(key, F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    ahead = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offset, queued = fresh(df, "mix_offset"), fresh(df, "mix_queued")
    offsets = stage(
        groups.withColumn(offset, F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(plan.drop("source"), key)
        .select(key, part, offset, "source_size", "target", F.col("class").alias(klass)))

    queue = Window.partitionBy(key, part).orderBy(mark, "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn(queued, F.coalesce(F.sum("size").over(queue), F.lit(0)))
    rows = rows.join(offsets, [key, part])
    start = F.col(offset) + F.col(queued)

    def one(turn: int) -> Column:
        begin = start + F.lit(turn) * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - begin))
        time = F.lit(None)
        for k, knots in enumerate(schedules):
            time = F.when(F.col(klass) == k, time_of(F.try_divide(begin, F.col("target")), knots)).otherwise(time)
        return F.struct(time.cast("double").alias("position"), words.cast("long").alias("taken"))

    rows = rows.withColumn("passes", F.filter(F.array(*map(one, range(repeats))),
                                              lambda p: p["taken"] > 0))
    rows = rows.withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"),
                                                lambda total, p: total + p["taken"]))
    rows = rows.withColumn("position", F.get("passes", F.lit(0))["position"])
    names = [c for c in df.columns if c.lower() not in made]
    return (rows.repartitionByRange("position", mark).sortWithinPartitions("position", mark)
            .select(*(column(rows, c) for c in names), *made))


def repeat_passes(mixed: DataFrame, columns: Sequence[str], wordless: bool = False) -> DataFrame:
    """One row per pass of a mixed document, whole texts, sorted by position.

    A document of which a pass takes only some words is trained whole: a
    source overshoots its target by less than one document.  A document with
    words whose source reaches its target before its turn has no row.  A
    document without words (null, empty or blank text) takes nothing of any
    target and has no pass: with ``wordless`` it stays, once, and comes first.
    """
    turn, passes = fresh(mixed, "mix_pass"), F.col("passes")
    if wordless:
        none = F.array(F.lit(None).cast(mixed.schema["passes"].dataType.elementType))
        passes = F.when(F.col("size") == 0, none).otherwise(passes)
    rows = mixed.withColumn(turn, F.explode(passes))
    order = [F.col(turn)["position"]]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *(column(rows, c) for c in columns))
