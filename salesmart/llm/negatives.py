"""Hard-negative mining (operator 11): Hilbert-ordered blocks, zone maps and interval bounds.

Vectors are quantised to integers; a row's score for an anchor is their inner
product.  An anchor's positives are the best other rows of its label; its hard
negatives for a positive of score p are the best rows of other labels whose
score lies in the window from LOW to HIGH percent of p.

1. Rows are range-sorted along a Hilbert curve through their cells and cut into
   Parquet rows of at most BLOCK vectors each, one array per block, with a zone
   map: the least and largest value of each dimension, and the labels.
2. The anchors of neighbouring blocks make chunks.  An anchor first scores its
   own block; the last of its best rows there is a floor for its positives.
3. Interval arithmetic over the zone maps (the sum of the lesser, or of the
   larger, of the products with a dimension's ends) bounds the scores in a
   block.  A block is read for an anchor's positives if it may hold its label
   and reaches the floor, for its negatives if it meets one of its windows.
4. Chosen blocks meet the chunks that asked for them, one block and one chunk
   at a time.  Some chunks read a lane of blocks one after the other and keep
   their best rows so far; a ranking of the lanes' rows keeps the best of all.

The bounds are exact, so nothing is lost, whatever the data; where vectors lie
without order in many dimensions every block meets some window and is read.

Edge cases: rows with a null label, a null vector, or a null or non-finite
component take no part, as anchors neither.  A shorter vector counts as if
padded with zeros; quantised components saturate at 32 bits.  Null ids come last
among ties and are no anchors.  Repeated rows are rows of their own: each
repeat of an anchor is an anchor, and a row never is its own positive.  An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, ship, stage

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Vectors of a block, anchors of a chunk, blocks of a page of zone maps.
BLOCK, CHUNK, PAGE = 1024, 128, 1024
#: Chunks that share one sending of a block, and blocks whose best rows are merged before they are ranked.
SHARE, LANE = 16, 64
#: Dimensions and bits of each that the curve runs through.
CURVE_DIMS, CURVE_BITS = 64, 2
LIMIT32 = (1 << 31) - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve of rows of cell numbers below ``1 << bits``, as big-endian bytes.

    The cell numbers become the transposed index by undoing the curve's
    rotations from the highest bit on, followed by a Gray code.
    """
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, p = 1 << bit, (1 << bit) - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    index = np.stack([((c ^ turn) >> bit) & 1 for bit in range(bits - 1, -1, -1) for c in x], 1)
    return [row.tobytes() for row in np.packbits(index.astype(np.uint8), axis=1)]


class Space:
    """Number of dimensions and range of the quantised components of a table."""

    def __init__(self, dims: int, low: int, high: int):
        self.dims, self.low, self.high = dims, low, high
        most = max(abs(low), abs(high))
        self.kind = "<i2" if most < 1 << 15 else "<i4"
        self.exact = most * most * dims < 1 << 53  # then sums of products are exact as doubles

    def matrix(self, packed: bytes) -> np.ndarray:
        values = np.frombuffer(packed, self.kind).reshape(-1, self.dims)
        return values.astype(np.float64 if self.exact else np.int64)

    def pack(self, matrix: np.ndarray) -> bytes:
        return matrix.astype(self.kind).tobytes()

    def curve(self, matrix: np.ndarray) -> list[bytes]:
        span = max(self.high - self.low + 1, 1)
        cells = ((matrix[:, :CURVE_DIMS].astype(np.int64) - self.low) << CURVE_BITS) // span
        return hilbert_keys(cells, CURVE_BITS)


def quantise(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * scale), -LIMIT32, LIMIT32).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """The k best of the chosen rows: higher scores first, then smaller ids."""
    if len(chosen) > k:
        floor = np.partition(scores[chosen], len(chosen) - k)[len(chosen) - k]
        chosen = chosen[scores[chosen] >= floor]
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def _ids(values: pa.Array) -> np.ndarray:
    """Ids as numbers, null above all."""
    return values.fill_null((1 << 63) - 1).to_numpy()


def _quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column, scale: int):
    vector = column(df, vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(column(df, id_col).cast("long").alias("id"), column(df, label_col).cast("long").alias("label"),
                     F.coalesce(anchors, F.lit(False)).alias("anchor"), vector.cast("array<double>").alias("vector"))
    rows = rows.filter(column(df, label_col).isNotNull() & vector.isNotNull() & finite)
    found = rows.agg(F.max(F.size("vector")).alias("dims"), F.min(F.array_min("vector")).alias("low"),
                     F.max(F.array_max("vector")).alias("high")).first()
    ends = quantise(np.array([found["low"] or 0.0, found["high"] or 0.0]), scale).tolist()
    space = Space(max(found["dims"] or 0, 1), min(ends[0], 0), max(ends[1], 0))

    def run(batches):
        for batch in batches:
            values = batch.column(3)
            sizes = values.value_lengths().to_numpy()
            matrix = np.zeros((len(sizes), space.dims), np.int64)
            matrix[np.arange(space.dims) < sizes[:, None]] = quantise(values.flatten().to_numpy(), scale)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([space.pack(v) for v in matrix], pa.binary()), pa.array(space.curve(matrix), pa.binary())],
                names=["id", "label", "anchor", "vector", "curve"])

    out = rows.mapInArrow(run, "id long, label long, anchor boolean, vector binary, curve binary")
    return stage(out.withColumn("row", F.monotonically_increasing_id())), space


BLOCKS = ("block long, ids array<long>, labels array<long>, rows array<long>, anchors array<boolean>, vectors binary, "
          "low binary, high binary, zone array<long>")


def _blocks(quantised: DataFrame, space: Space) -> DataFrame:
    """Blocks along the curve with their zone maps; equal places are told apart by row, so they may be split."""
    def run(batches):
        held, n, number = [], 0, 0

        def flush(rows):
            nonlocal number
            number += 1
            block = pa.Table.from_batches(rows)
            vectors = b"".join(block.column("vector").to_pylist())
            matrix = np.frombuffer(vectors, space.kind).reshape(block.num_rows, space.dims)
            part = block.column("part")[0].as_py()
            lists = [[block.column(c).to_pylist()] for c in ("id", "label", "row", "anchor")]
            zone = sorted(set(lists[1][0]))
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), *(pa.array(x, pa.list_(t)) for x, t in zip(lists, (pa.int64(),) * 3 + (pa.bool_(),))),
                 pa.array([vectors], pa.binary()), pa.array([space.pack(matrix.min(0))], pa.binary()),
                 pa.array([space.pack(matrix.max(0))], pa.binary()), pa.array([zone], pa.list_(pa.int64()))],
                names=["block", "ids", "labels", "rows", "anchors", "vectors", "low", "high", "zone"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK - n)
                held.append(piece)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == BLOCK:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    ordered = quantised.repartitionByRange("curve", "row").sortWithinPartitions("curve", "row")
    return stage(ordered.select("id", "label", "anchor", "vector", "row", F.spark_partition_id().cast("long").alias("part"))
                 .mapInArrow(run, BLOCKS))


def _chunks(blocks: DataFrame, space: Space, positives: int) -> DataFrame:
    """Anchors of neighbouring blocks: chunk, ids, labels, rows, vectors, floors (null: its block has too few of its label)."""
    names = ["chunk", "ids", "labels", "rows", "vectors", "floors"]

    def run(batches):
        held, chunk = [], None

        def flush(rows):
            ids, labels, numbers, vectors, floors = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), *(pa.array([list(x)], pa.list_(pa.int64())) for x in (ids, labels, numbers)),
                 pa.array([b"".join(vectors)], pa.binary()), pa.array([list(floors)], pa.list_(pa.int64()))], names=names)

        for batch in batches:
            for block in batch.to_pylist():
                marked = np.flatnonzero(block["anchors"])
                if not len(marked):
                    continue
                matrix, labels = space.matrix(block["vectors"]), np.array(block["labels"])
                for i in marked.tolist():
                    scores = matrix @ matrix[i]
                    like = np.flatnonzero(labels == labels[i])
                    like = like[like != i]
                    floor = int(np.partition(scores[like], len(like) - positives)[len(like) - positives]) if len(like) >= positives else None
                    if not held:
                        chunk = (block["block"] << 10) + i  # at most one chunk begins at an anchor
                    held.append((block["ids"][i], block["labels"][i], block["rows"][i], space.pack(matrix[i]), floor))
                    if len(held) == CHUNK:
                        yield flush(held)
                        held = []
        if held:
            yield flush(held)

    return stage(blocks.select("block", "ids", "labels", "rows", "anchors", "vectors").mapInArrow(
        run, "chunk long, ids array<long>, labels array<long>, rows array<long>, vectors binary, floors array<long>"))


def _pages(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Zone maps of about PAGE blocks in each row: page, blocks, low, high, zones."""
    zones = blocks.select("block", "low", "high", "zone")
    n = max(1, -(-zones.count() // PAGE))

    def run(batches):
        held, page = [], None

        def flush():
            numbers, low, high, zone = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array([page]), pa.array([list(numbers)], pa.list_(pa.int64())), pa.array([b"".join(low)], pa.binary()),
                 pa.array([b"".join(high)], pa.binary()), pa.array([list(zone)], pa.list_(pa.list_(pa.int64())))],
                names=["page", "blocks", "low", "high", "zones"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["page"] != page:
                    yield flush()
                    held = []
                page = row["page"]
                held.append((row["block"], row["low"], row["high"], row["zone"]))
        if held:
            yield flush()

    paged = zones.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(n))).repartition("page").sortWithinPartitions("page", "block")
    return stage(paged.mapInArrow(run, "page long, blocks array<long>, low binary, high binary, zones array<array<long>>")), n


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each vector with any point of each box."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def windows_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _chosen(chunks: DataFrame, pages: DataFrame, n_pages: int, space: Space, share: tuple[int, int] | None) -> DataFrame:
    """(chunk, block, members): the anchors of a chunk that must read a block.

    Each chunk meets each page of zone maps.  Without ``share`` for positives,
    else for the windows of the scores in column ``positives``.
    """
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                vectors = space.matrix(row["vectors"])
                least, most = bounds(vectors, space.matrix(row["low"]), space.matrix(row["high"]))
                need = np.zeros(least.shape, bool)
                if share is None:
                    for i, (label, floor) in enumerate(zip(row["labels"], row["floors"])):
                        has = np.array([label in z for z in row["zones"]], bool)
                        need[i] = has & (most[i] >= floor if floor is not None else True)
                else:
                    for p in row["positives"]:
                        a, b = windows_of(p["score"], *share)
                        need[p["member"]] |= (a <= b) & (most[p["member"]] >= a) & (least[p["member"]] <= b)
                for j in np.flatnonzero(need.any(0)).tolist():
                    out.append((row["chunk"], row["blocks"][j], np.flatnonzero(need[:, j]).tolist()))
            if out:
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int32()))],
                                                 names=["chunk", "block", "members"])

    asked = chunks.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pages - 1).cast("long"))))
    joined = asked.join(pages.select("page", "blocks", "low", "high", "zones"), "page")
    return joined.mapInArrow(run, "chunk long, block long, members array<int>")


def _read(chosen: DataFrame, chunks: DataFrame, blocks: DataFrame, space: Space, pick, k: int, ddl: str) -> DataFrame:
    """Brings the chosen blocks and their chunks together and applies ``pick(block, chunk, members, scores)``.

    It gives rows (key ..., id, row, score), of which the k best of each key in a lane are returned.

    Rows of a block come sorted: first its vectors, then the chunks that asked
    for it.  Only SHARE chunks or so share one sending of a block, so neither a
    block nor a chunk that many ask for gathers in one task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = blocks.sparkSession
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    n_blocks, tasks = blocks.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("chunk"), F.lit(max(1, -(-chunks.count() // SHARE)))).alias("share")
    lane = F.pmod(F.xxhash64("block"), F.lit(max(-(-n_blocks // LANE), min(n_blocks, tasks), 1))).alias("lane")
    fields, asked = ["ids", "labels", "rows", "vectors"], "array<struct<member:int,place:int,score:bigint>>"
    scores_asked = F.col("positives") if "positives" in chunks.columns else F.lit(None).cast(asked).alias("positives")
    chunk_rows = chosen.join(chunks, "chunk").select(
        lane, share, "block", F.lit(1).alias("kind"), "chunk", "members", *fields, scores_asked)
    sent = chosen.select("block", share).distinct()
    block_rows = sent.join(blocks.select("block", *fields), "block").select(
        lane, "share", "block", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("chunk"),
        F.lit(None).cast("array<int>").alias("members"), *fields, F.lit(None).cast(asked).alias("positives"))

    def run(batches):
        block, group, found = None, None, {}

        def least(rows):
            return sorted(rows, key=lambda r: (-r[-1], r[-3], r[-2]))[:k]

        def flush():
            rows = [row for rows in found.values() for row in least(rows)]
            for i in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows[i:i + 50_000]), schema)], schema=schema)

        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                get = lambda name: batch.column(at[name])[r]
                here = get("lane").as_py(), get("share").as_py()
                if here != group:
                    yield from flush()
                    group, found = here, {}
                own = {"ids": _ids(get("ids").values), "labels": get("labels").values.to_numpy(),
                       "rows": get("rows").values.to_numpy(), "matrix": space.matrix(get("vectors").as_py())}
                if get("kind").as_py() == 0:
                    block = own
                    continue
                members = get("members").as_py()
                scores = (own["matrix"][members] @ block["matrix"].T).astype(np.int64)
                chunk = own | {"chunk": get("chunk").as_py(), "positives": get("positives").as_py()}
                for row in pick(block, chunk, members, scores):
                    rows = found.setdefault(row[:-3], [])
                    rows.append(row)
                    if len(rows) >= 4 * k:
                        found[row[:-3]] = least(rows)
        yield from flush()

    ready = block_rows.unionByName(chunk_rows).repartition("lane", "share")
    return ready.sortWithinPartitions("lane", "share", "block", "kind", "chunk").mapInArrow(run, ddl)


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the anchors' hard negatives."""
    ship(df.sparkSession)
    quantised, space = _quantised(df, id_col, vector_col, label_col, anchors & column(df, id_col).isNotNull(), scale)
    blocks = _blocks(quantised, space)
    chunks = _chunks(blocks, space, positives)
    pages, n_pages = _pages(blocks)

    def like(block, chunk, members, scores):
        for m, s in zip(members, scores):
            mine_ = np.flatnonzero((block["labels"] == chunk["labels"][m]) & (block["rows"] != chunk["rows"][m]))
            for j in best(s, block["ids"], mine_, positives).tolist():
                yield chunk["chunk"], m, int(block["ids"][j]), int(block["rows"][j]), int(s[j])

    found = _read(_chosen(chunks, pages, n_pages, space, None), chunks, blocks, space, like, positives,
                  "chunk long, member int, id long, row long, score long")
    order = Window.partitionBy("chunk", "member").orderBy(F.desc("score"), "id", "row")
    ranked = stage(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives))

    asked = ranked.groupBy("chunk").agg(F.collect_list(F.struct("member", "place", "score")).alias("positives"))
    windowed = stage(chunks.join(asked, "chunk"))

    def unlike(block, chunk, members, scores):
        of = {}
        for p in chunk["positives"]:
            of.setdefault(p["member"], []).append(p)
        for m, s in zip(members, scores):
            other = block["labels"] != chunk["labels"][m]
            for p in of.get(m, ()):
                a, b = windows_of(p["score"], low, high)
                for j in best(s, block["ids"], np.flatnonzero(other & (s >= a) & (s <= b)), negatives).tolist():
                    yield chunk["chunk"], m, p["place"], int(block["ids"][j]), int(block["rows"][j]), int(s[j])

    hits = _read(_chosen(windowed, pages, n_pages, space, (low, high)), windowed, blocks, space, unlike, negatives,
                 "chunk long, member int, place int, negative long, row long, negative_score long")
    order = Window.partitionBy("chunk", "member", "place").orderBy(F.desc("negative_score"), "negative", "row")
    hits = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    names = chunks.select("chunk", F.posexplode("ids").alias("member", "anchor_id"))
    known = ranked.select("chunk", "member", "place", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    null_id = lambda c: F.when(F.col(c) < (1 << 63) - 1, F.col(c))
    return hits.join(known, ["chunk", "member", "place"]).join(names, ["chunk", "member"]).select(
        "anchor_id", null_id("positive").alias("positive_id"), "rank", null_id("negative").alias("negative_id"),
        "positive_score", "negative_score")
