"""Document fingerprints (operator 6): SimHash and permuted block tables.

Terms are the words and word pairs of the lower-cased text, hashed to BITS
bits and weighted by the square root of their count.  Each term votes on every
bit, for or against; the fingerprint holds the signs.  The share of equal bits
estimates the angle between the weighted term vectors.

``edited_pairs`` also fingerprints, for each document, its text with the last
third replaced by the start of the next document in descending order of ids.
Documents are dealt to ranges of ids, sorted, and walked through; the first
document of each range is also sent to the range before it, so every text
moves once and no range depends on another.

``matches`` finds all pairs of a query fingerprint and an index fingerprint
within a Hamming radius, and ``neighbours`` counts them.  The bits are cut into
``blocks`` blocks; two fingerprints within the radius differ by at most
``radius // blocks`` bits in at least one of them.  There is one table per
block, keyed by its bits; a query looks up its own block and every block that
differs by so many bits, and what it meets is verified.  A pair counts in the
first table in which it agrees.  Fewer blocks mean longer keys (fewer chance
meetings, for larger tables) and more lookups of each query.

Edge cases: null and empty texts have no terms and the fingerprint zero; equal
texts have equal fingerprints; repeated ids are ordered by a hash of the text;
null ids come last; a table of one document is its own next; empty tables give
empty results.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ship, stage

BITS, RADIUS, BLOCKS = 128, 14, 8
WORDS = re.compile(r"\w+")
#: Odd constants that turn a word's 64 bits into those of a pair and of the second half.
LEFT, HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Fingerprinter:
    def __init__(self):
        self.known: dict[str, int] = {}
        #: Row b: the eight bits of byte b as votes -1 and 1, first bit first.
        self.votes = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1

    def _word(self, word: str) -> int:
        h = self.known.get(word)
        if h is None:
            if len(self.known) > 500_000:
                self.known.clear()
            h = self.known[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return h

    def __call__(self, text: str) -> bytes:
        words = WORDS.findall(text.lower())
        if not words:
            return bytes(BITS // 8)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        terms, counts = np.unique(np.concatenate([h, _mixed(h[:-1] * LEFT + h[1:])]), return_counts=True)
        weights = np.sqrt(counts)
        raw = np.stack([_mixed(terms), _mixed(terms ^ HALF)], 1).view(np.uint8)
        sums = np.concatenate([np.bincount(raw[:, i], weights, 256) @ self.votes for i in range(raw.shape[1])])
        return np.packbits(sums > 0).tobytes()


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints in hex."""
    apart = sum((F.bit_count(F.conv(F.substring(a, i, 8), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring(b, i, 8), 16, 10).cast("long"))) for i in range(1, BITS // 4, 8)), F.lit(0))
    return 1 - apart / F.lit(float(BITS))


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (hex) of every row."""
    ship(df.sparkSession)

    def run(batches):
        make = Fingerprinter()
        for batch in batches:
            made = [make(t or "").hex() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return df.select(column(df, id_col).cast("long").alias("doc_id"),
                     column(df, text_col).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    """doc_id, tie, text, part, spill: rows dealt to ranges of ids, ascending parts for descending ids.

    ``spill`` marks the copy of a range's first row that closes the range before.
    The driver holds two numbers per range, the tasks search them by bisection.
    """
    rows = df.withColumn("tie", F.xxhash64("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5],
                                        max(10_000, 10 * parts))).first()[0]
    edges = np.unique(np.array(cuts or [], np.int64))

    def part_of(ids: pa.Array) -> np.ndarray:
        """The largest ids are in part 0, null ids in the last part."""
        at = len(edges) - np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(edges), at)

    def heads(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part_of(b.column(0)))], names=["doc_id", "tie", "part"])

    first = rows.select("doc_id", "tie").mapInArrow(heads, "doc_id long, tie long, part long").groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), (-F.col("doc_id")).alias("rank"), "tie")).alias("head"))
    order = sorted((r["part"], None if r["head"]["no_id"] else -r["head"]["rank"], r["head"]["tie"])
                   for r in first.collect())  # one row per range
    before = {after[1:]: here[0] for here, after in zip(order[-1:] + order[:-1], order)}

    def deal(batches):
        for b in batches:
            part = part_of(b.column(0))
            close = [(i, before[k]) for i, k in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
                     if k in before]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part), pa.array(np.zeros(len(part), bool))],
                                             names=["doc_id", "tie", "text", "part", "spill"])
            if close:
                copy = b.take(pa.array([i for i, _ in close]))
                yield pa.RecordBatch.from_arrays(
                    [*copy.columns, pa.array([p for _, p in close], pa.int64()), pa.array([True] * len(close))],
                    names=["doc_id", "tie", "text", "part", "spill"])

    return rows.select("doc_id", "tie", "text").mapInArrow(
        deal, "doc_id long, tie long, text string, part long, spill boolean")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``following``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def edited_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, next_fingerprint per row."""
    spark = df.sparkSession
    ship(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _dealt(df.select(column(df, id_col).cast("long").alias("doc_id"),
                            F.coalesce(column(df, text_col), F.lit("")).alias("text")), parts or 4 * tasks)
    rows = rows.repartition(tasks, "part").sortWithinPartitions(
        "part", "spill", F.col("doc_id").desc_nulls_last(), "tie")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("next_fingerprint", pa.string())])

    def run(batches):
        make, before, made, size = Fingerprinter(), None, [], 0
        for batch in batches:
            for key, text, part, spill in zip(*(c.to_pylist() for c in batch.columns)):
                own = make(text).hex()
                if before is not None and before[0] == part:
                    _, last, old, mark = before
                    new = edited(old, text)
                    made.append({"doc_id": last, "n_chars": len(old), "edited_text": new, "fingerprint": mark,
                                 "edited_fingerprint": make(new).hex(), "next_fingerprint": own})
                    size += len(new)
                before = None if spill else (part, key, text, own)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, size = [], 0
        yield pa.RecordBatch.from_pylist(made, schema)

    return rows.select("doc_id", "text", "part", "spill").mapInArrow(
        run, "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
             "next_fingerprint string")


def matches(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """fingerprint (of ``queries``), near (of ``index``), distance, n_rows: all pairs within ``radius``.

    Both have a column fingerprint (hex); equal ones are taken together first,
    n_rows says how many rows of the index have the fingerprint ``near``.  A
    join of either table with the result on its fingerprint names the documents.
    """
    if blocks not in (4, 8, 16, 32) or not 0 <= radius < BITS:
        raise ValueError("4, 8, 16 or 32 blocks and a radius below the number of bits")
    width, per, most = BITS // blocks, blocks // 4, radius // blocks
    flips = [sum(1 << i for i in c) for k in range(min(most, width) + 1) for c in combinations(range(width), k)]

    def words(df: DataFrame) -> DataFrame:
        return df.select(*(F.conv(F.substring("mark", 8 * i + 1, 8), 16, 10).cast("long").alias(f"w{i}") for i in range(4)),
                         *(c for c in df.columns if c != "mark"))

    def block(word: Column, i: int) -> Column:
        return F.shiftright(word, width * (i % per)).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("t", F.explode(F.array(*(F.struct(F.lit(i).alias("table"), block(F.col(f"w{i // per}"), i).alias("key"))
                                                      for i in range(blocks))))).select("*", "t.*").drop("t")

    def mark(side: str) -> Column:
        return F.lower(F.concat(*(F.lpad(F.hex(F.col(f"{side}.w{i}")), 8, "0") for i in range(4))))

    wanted = words(queries.select(F.col("fingerprint").alias("mark")).distinct())
    there = words(index.groupBy(F.col("fingerprint").alias("mark")).agg(F.count(F.lit(1)).alias("n_rows")))
    asked = keyed(wanted).withColumn("flip", F.explode(F.array(*(F.lit(f).cast("long") for f in flips))))
    q = asked.withColumn("key", F.col("key").bitwiseXOR(F.col("flip"))).drop("flip").alias("q")
    r = keyed(there).alias("r")
    apart = [F.col(f"q.w{i}").bitwiseXOR(F.col(f"r.w{i}")) for i in range(4)]
    distance = sum((F.bit_count(x) for x in apart[1:]), F.bit_count(apart[0]))
    first = F.lit(blocks)
    for i in reversed(range(blocks)):
        first = F.when(F.bit_count(block(apart[i // per], i)) <= most, i).otherwise(first)
    pairs = q.join(r, (F.col("q.table") == F.col("r.table")) & (F.col("q.key") == F.col("r.key"))
                   & (distance <= radius) & (first == F.col("q.table")))
    return pairs.select(mark("q").alias("fingerprint"), mark("r").alias("near"), distance.alias("distance"), "r.n_rows")


def neighbours(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Of each distinct fingerprint of ``queries``: how many rows of ``index`` lie within ``radius``.

    Result: fingerprint, n_near (rows of the index, itself included if it is one).
    """
    return matches(queries, index, radius, blocks).groupBy("fingerprint").agg(F.sum("n_rows").alias("n_near"))
