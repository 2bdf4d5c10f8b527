"""Exact dedup (operator 4): heavy-hitter split, DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z; the digest is
the SHA-256 of that text.  The digests of all rows are staged as a skinny
table, so the text is read once.

1. Misra-Gries counters (``freqItems``; one merge of at most ``1/support``
   entries per task) name every digest held by more than ``support`` of the
   rows, and perhaps some others.
2. One aggregation counts these candidates exactly.  The verified ones, at
   most ``1/support`` rows, are broadcast with their winner, and their rows
   are settled map-side: a text that a third of all rows share is never moved.
3. All other digests take the ordinary route: partial aggregation, shuffle,
   join.  No group there is larger than ``support`` of the rows.

Edge cases: a null text counts as empty.  Null ids rank below all others.
Rows that repeat both id and text are copies of each other; one of them stays
(the one with the largest row number of the staged table).  An empty table
gives an empty result.  Extra columns of any name are ignored by ``annotate``
and returned unchanged by ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, column, fresh, stage

#: Share of the rows above which a digest is frequent; 1/SUPPORT bounds the broadcast.
SUPPORT = 1e-3


def text_digest(text) -> F.Column:
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             support: float = SUPPORT) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays.
    """
    keyed = stage(df.select(column(df, id_col).alias("doc_id"),
                            text_digest(column(df, text_col)).alias("digest"),
                            F.monotonically_increasing_id().alias("row")))
    total = keyed.count()
    group = [F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")]

    candidates = (keyed.stat.freqItems(["digest"], support)
                  .select(F.explode("digest_freqItems").alias("digest")))
    winners = stage(keyed.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*group)
                    .filter(F.col("group_size") > support * total))
    frequent = keyed.join(F.broadcast(winners), "digest")
    others = keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    settled = others.join(others.groupBy("digest").agg(*group), "digest")

    return frequent.unionByName(settled).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    support: float = SUPPORT) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    marks = stage(annotate(df, id_col, text_col, support))
    digest, key = fresh(df, "digest"), fresh(df, "key")
    body = df.withColumn(digest, text_digest(column(df, text_col)))
    kept = marks.filter("kept").select(F.col("doc_id").alias(key),
                                       F.col("text_sha256").alias(digest + "_kept"))
    out = body.join(kept, column(body, id_col).eqNullSafe(kept[key])
                    & (body[digest] == kept[digest + "_kept"]), "left_semi")
    if marks.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).head(1):
        out = out.dropDuplicates([id_col, digest])
    return out.drop(digest)
