"""N-gram Jaccard join by several global token orders (operator 10).

A document's tokens are its distinct word shingles.  Two documents link when
``100 * intersection >= percent * union``.  Then, under any order of all
tokens, their first ``n - ceil(percent * n / 100) + 1`` tokens (their prefixes)
share a token.  So a candidate must share prefix tokens under each of ORDERS
different orders.  All orders put tokens that are frequent in the corpus last,
each breaks ties by its own hash.

1. Frequent tokens: every task keeps Misra-Gries counters, their sums name the
   HOT most frequent ones.  They only shape the orders; any choice is exact.
2. Documents with equal token sets become one node.
3. Nodes that share a prefix token of the first order come together in that
   token's posting; postings of one node vanish.  Postings of frequent tokens
   are summed up before they are joined, the others are small.
4. Stars: each posting's nodes are paired with its smallest and its largest
   one only, so a group of near copies costs two pairs per member.
5. Then all pairs of nodes that share a posting but not yet a component.  This
   is the exact remainder: a link between two components is always among them.
   In a posting whose nodes are mostly in components of their own, nodes are
   paired; in one of large components, the components first.
6. Pairs are filtered by size and by sketches of the whole sets: 1,024 bits (256
   within postings), each the parity of the tokens that fall on it.  A token in
   one set only turns one bit, so sets that link differ in
   ``(100 - percent) * (a + b) / (100 + percent)`` bits at most.  Then texts move, for the pairs that are left: they are filtered
   by the prefixes of the other orders (they must meet in each), and verified on
   the whole sets.

Tokens are 64-bit hashes of shingles.

Links are joined to components by label propagation along hash joins, staged
after each round.

Edge cases: null text is empty; empty documents have no tokens, no links, and
are their own component; with fewer words than a shingle the whole sequence is
one token; repeated ids with different texts are different nodes; a component's
id is its smallest id, null if all its ids are null.  Empty tables give empty
results.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, fresh, pieces, release, ship, stage, tidy

#: Bound of the table of frequent tokens that every task holds, and of a task's counters.
HOT, COUNTERS = 100_000, 400_000
ORDERS = 3
#: Multipliers of the hashes that break ties, one per order (odd, so each is a permutation).
TWIST = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Partners that are sent along with one document to be verified.
CHUNK = 64
#: Columns of a sketch, 64 bits each, and how many a folded one has.
SKETCH, FOLDED = [f"s{i}" for i in range(16)], 4


class Hasher:
    """Sorted 64-bit hashes of the shingles of a text in UTF-8.

    ``bytes.lower`` lowers A-Z only and ``bytes.split`` cuts at the six ASCII
    blanks only, as the definition of words asks.
    """

    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        width = min(self.width, len(h))
        if not width:
            return h
        out = np.full(len(h) - width + 1, len(h) if len(h) < self.width else 0, np.uint64)
        for i in range(width):
            out ^= h[i:len(h) - width + 1 + i]
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(29)
        out.sort()
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def is_common(tokens: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which tokens are among the sorted frequent ones."""
    if not len(hot):
        return np.zeros(len(tokens), bool)
    return hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens


def prefix(tokens: np.ndarray, common: np.ndarray, percent: int, order: int) -> np.ndarray:
    """Places of the first tokens under an order: frequent tokens last, ties by the order's hash."""
    n = prefix_length(len(tokens), percent)
    if n >= len(tokens):
        return np.arange(len(tokens))
    mixed = tokens * TWIST[order]
    rank = (mixed ^ (mixed >> np.uint64(32))) >> np.uint64(1)
    rank[common] |= np.uint64(1 << 63)
    return np.argpartition(rank, n - 1)[:n]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """For each bit, whether an odd number of tokens falls on it; as 64-bit numbers."""
    place = ((tokens * TWIST[0]) >> np.uint64(32)) % np.uint64(64 * len(SKETCH))
    odd = np.bincount(place.astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if not len(a) or not len(b):
        return 0
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def texts_of(batch: pa.RecordBatch, place: int):
    """Values of a column, of which a part is held as Python values at a time."""
    for part in pieces(batch, place):
        yield from part.column(place).to_pylist()


def frequent_tokens(df: DataFrame, width: int) -> np.ndarray:
    """At most HOT tokens, the ones with the largest Misra-Gries counts, sorted."""
    ship(df.sparkSession)

    def run(batches):
        make, keys, counts, held, size = Hasher(width), np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def merge():
            every = np.concatenate(held)
            every.sort()
            edges = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            n = np.diff(np.append(edges, len(every)))
            found = every[edges][n > 1]  # a decrement by one for what a step sees once
            merged, place = np.unique(np.concatenate([keys, found]), return_inverse=True)
            total = np.bincount(place, np.concatenate([counts, n[n > 1]]), len(merged)).astype(np.int64)
            if len(merged) > COUNTERS:
                total -= np.partition(total, len(total) - COUNTERS)[len(total) - COUNTERS]
            return merged[total > 0], total[total > 0]

        for batch in batches:
            for text in texts_of(batch, 0):
                held.append(make(text))
                size += len(held[-1])
                if size > 1 << 22:
                    keys, counts = merge()
                    held, size = [], 0
        if held:
            keys, counts = merge()
        if len(keys) > HOT:
            top = np.argpartition(-counts, HOT)[:HOT]
            keys, counts = keys[top], counts[top]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["token", "n"])

    rows = df.select(F.col("text").cast("binary").alias("text")).mapInArrow(tidy(run), "token long, n long")
    rows = rows.groupBy("token").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "token").limit(HOT).select("token").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def documents_table(df: DataFrame, width: int, percent: int) -> DataFrame:
    """Staged: row, doc_id, same (hash of the text), n, digest and sketch of the token set, and the prefix of
    the first order, its frequent tokens (``often``) apart from the others (``seldom``)."""
    hot, spark = frequent_tokens(df.select("text"), width), df.sparkSession
    sent = spark.sparkContext.broadcast(hot)  # HOT numbers of 8 bytes at most

    def run(batches):
        make = Hasher(width)
        for batch in batches:
            n, digests, seldom, often, drawn = [], [], [], [], [np.zeros((0, len(SKETCH)), np.int64)]
            for text in texts_of(batch, 2):
                tokens = make(text)
                n.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                drawn.append(sketch(tokens)[None])
                common = is_common(tokens, sent.value)
                first = prefix(tokens, common, percent, 0)
                seldom.append(tokens[first[~common[first]]].view(np.int64))
                often.append(tokens[first[common[first]]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(seldom, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64())),
                 *map(pa.array, np.concatenate(drawn).T)],
                names=["doc_id", "same", "n", "digest", "seldom", "often", *SKETCH])

    rows = df.select("doc_id", F.xxhash64("text").alias("same"), F.col("text").cast("binary").alias("text")).mapInArrow(
        tidy(run), "doc_id long, same long, n long, digest binary, seldom array<long>, often array<long>, "
             + ", ".join(f"{c} long" for c in SKETCH))
    return stage(rows.withColumn("row", F.monotonically_increasing_id())), sent


def _share(a: Column, b: Column, percent: int) -> Column:
    """Sizes a and b allow a link."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def folded() -> list[Column]:
    """The columns of a sketch laid over each other: one of 64 * FOLDED bits."""
    return [reduce(Column.bitwiseXOR, map(F.col, SKETCH[i::FOLDED])).alias(SKETCH[i]) for i in range(FOLDED)]


def _alike(a: str, b: str, percent: int, width: int) -> Column:
    """Sizes and sketches of a and b (structs with n and the ``width`` columns of a sketch) allow a link."""
    differ = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SKETCH[:width])
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return _share(F.col(f"{a}.n"), F.col(f"{b}.n"), percent) & ((100 + percent) * differ <= (100 - percent) * both)


def apart(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a token but no component, and may link.

    ``placed``: token, node, comp, set (n and the folded sketch).  Nodes that share
    a posting are only made rows if they may link.
    """
    groups = stage(placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("members")))
    sizes = stage(groups.groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.sum("members").alias("nodes"))
                  .filter("comps > 1").select("token", F.expr("nodes <= 2 * comps").alias("single")))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("token", F.col("comp").alias("c" + name), F.col("node").alias(name), F.col("set").alias("set_" + name))

    nodes = placed.join(sizes.filter("single").select("token"), "token")
    left, right = side(nodes, "a"), side(nodes, "b")
    near = left.join(right, (left["token"] == right["token"]) & (F.col("ca") < F.col("cb")) & _alike("set_a", "set_b", percent, FOLDED))

    few = groups.join(sizes.filter("not single").select("token"), "token")
    pairs = few.select("token", F.col("comp").alias("ca")).join(few.select("token", F.col("comp").alias("cb")), "token").filter("ca < cb")
    far = stage(pairs).join(side(placed, "a"), ["token", "ca"])
    right = side(placed, "b").withColumnsRenamed({"token": "token_b", "cb": "c"})
    far = far.join(right, (F.col("token") == F.col("token_b")) & (F.col("cb") == F.col("c")) & _alike("set_a", "set_b", percent, FOLDED))
    return near.select("a", "b").unionByName(far.select("a", "b")).distinct()


def packed(texts: DataFrame) -> DataFrame:
    """Column ``text``, the last one, as zstd frames: it is moved three times, each smaller than as text."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            frames = pa.array([squeeze.compress(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], frames], names=batch.schema.names)

    rows = texts.withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(tidy(run), rows.schema)


def _verify(pairs: DataFrame, texts: DataFrame, sent, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link.  ``texts``: node, text in zstd frames.

    A document is sent once per CHUNK partners, so one with many partners is
    spread over many groups of a bounded size.
    """
    numbered = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.greatest(F.ceil(F.col("partners") / CHUNK), F.lit(1))))
    members = numbered.select("a", "chunk", F.col("b").alias("node")).unionByName(
        numbered.select("a", "chunk", F.col("a").alias("node")).distinct())
    rows = members.join(texts, "node")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "a", "chunk").sortWithinPartitions("a", "chunk", (F.col("a") != F.col("node")))

    def prepared(make: Hasher, frame: bytes):
        tokens = make(zstandard.decompress(frame))
        common = is_common(tokens, sent.value)
        return tokens, [np.sort(tokens[prefix(tokens, common, percent, k)]) for k in range(1, ORDERS)]

    def run(batches):
        make, at = Hasher(width), None
        for batch in batches:
            out = []
            for a, chunk, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (a, chunk):
                    if node != a:
                        raise ValueError("the first document of a group is missing")
                    at, (own, firsts) = (a, chunk), prepared(make, text)
                elif node != a:
                    other, seconds = prepared(make, text)
                    if all(overlap(p, q) for p, q in zip(firsts, seconds)):
                        both = overlap(own, other)
                        if 100 * both >= percent * (len(own) + len(other) - both):
                            out.append({"a": a, "b": node})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return stage(rows.select("a", "chunk", "node", "text").mapInArrow(tidy(run), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """node, comp (smallest node reachable) of every node on an edge (a, b).

    Each round hooks every node to the smallest label around it and then
    follows the labels' labels; a path of any length takes logarithmically
    many rounds.  A node with very many edges is only ever pre-aggregated or
    met by staged sides, which Spark can split.
    """
    spark = edges.sparkSession
    edges = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    done = None
    while True:
        # large star: link what lies above a node to the smallest around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = stage(both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct())
        # small star: link what lies below a node, and the node, to the smallest of it
        least = stage(large.groupBy("b").agg(F.min("a").alias("m")))
        small = large.join(least, "b").select("m", F.explode(F.array("a", "b")).alias("b")).filter("m <> b")
        small = stage(small.select(F.col("m").alias("a"), "b").distinct())
        size = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == done:
            break
        done, edges = size, small
    return stage(edges.select(F.col("b").alias("node"), F.col("a").alias("comp")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()))


def join(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, and row_id, representative.

    ``representative`` holds for one row of each component, one with the
    smallest id, and for every empty document.
    """
    docs = df.select(column(df, id_col).cast("long").alias("doc_id"), F.coalesce(column(df, text_col), F.lit("")).alias("text"))
    ship(df.sparkSession)
    table, sent = documents_table(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "same", "row"))
    nodes = stage(table.filter("n > 0").groupBy("digest").agg(first.alias("first"), F.max("n").alias("n")).select(
        "digest", F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"),
        F.col("first.same").alias("same"), "n"))

    own = table.join(nodes.select(F.col("node").alias("row")), "row")
    summary = [F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("low"),
               F.max(F.struct("node", "n")).alias("high")]

    def postings(name: str) -> DataFrame:
        return own.select(F.col("row").alias("node"), "n", F.explode(name).alias("token"))

    # a posting of a token that is not frequent is small: one shuffle serves its summary and the join
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seldom = postings("seldom").repartition(tasks, "token")
    seldom = seldom.join(seldom.groupBy("token").agg(*summary).filter("size > 1"), "token")
    # a frequent token may be in a third of all nodes: partial sums, at most HOT rows, sent to its nodes
    often = postings("often")
    often = often.join(F.broadcast(stage(often.groupBy("token").agg(*summary).filter("size > 1"))), "token")
    posted = stage(seldom.unionByName(often))
    release(df.sparkSession)

    again = bool(table.groupBy("doc_id", "same").count().filter("count > 1").head(1))

    def verified(pairs: DataFrame) -> DataFrame:
        """pairs: a, b, none twice."""
        sets = table.select(F.col("row").alias("node"), F.struct("n", *SKETCH).alias("set"))
        for name in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(name), F.col("set").alias("set_" + name)), name)
        pairs = stage(pairs.filter(_alike("set_a", "set_b", percent, len(SKETCH))).select("a", "b"))
        release(df.sparkSession)
        involved = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select(
            "node", "doc_id", "same"))
        key = packed(docs.select(F.col("doc_id").alias("id_"), F.xxhash64("text").alias("same_"), "text"))
        texts = key.join(involved, F.col("id_").eqNullSafe(F.col("doc_id")) & (F.col("same_") == F.col("same")))
        texts = texts.select("node", "text")
        if again:
            texts = texts.dropDuplicates(["node"])
        texts = stage(texts)
        release(df.sparkSession)
        partners = stage(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners")))
        links = _verify(pairs.join(partners, "a"), texts, sent, width, percent)
        release(df.sparkSession)
        return links

    # stars around the smallest and the largest node of each posting
    star = posted.select("node", "n", F.explode(F.array("low", "high")).alias("centre"))
    star = stage(star.filter((F.col("node") != F.col("centre.node")) & _share(F.col("n"), F.col("centre.n"), percent))
                 .select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct())
    links = verified(star)
    found = components(links)
    release(df.sparkSession)

    # the rest: nodes that share a posting but no component
    sets = table.select(F.col("row").alias("node"), F.struct("n", *folded()).alias("set"))
    placed = stage(posted.select("token", "node").join(sets, "node").join(found, "node", "left").select(
        "token", "node", F.coalesce("comp", "node").alias("comp"), "set"))
    rest = stage(apart(placed, percent))
    release(df.sparkSession)
    if rest.head(1):
        links = links.unionByName(verified(rest))
        found = components(links)

    member = stage(nodes.join(found, "node", "left").select(
        "digest", F.coalesce("comp", "node").alias("comp"), "node", "doc_id"))
    whole = stage(member.groupBy("comp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("head")))
    member = stage(member.join(whole, "comp").select(
        "digest", F.col("head.doc_id").alias("component_id"), F.col("head.node").alias("head")))
    out = table.filter("n > 0").join(member, "digest").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("head")).alias("representative"), "same")
    empty = table.filter("n = 0").select("row", "doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                         F.col("doc_id").alias("component_id"), F.lit(True).alias("representative"), "same")
    return out.unionByName(empty)


def keep_one(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each component one with the smallest id, and all empty documents."""
    marks = stage(join(df, width, percent, id_col, text_col))
    key, same = fresh(df, "key"), fresh(df, "same")
    kept = marks.filter("representative").select(F.col("doc_id").alias(key), F.col("same").alias(same + "_kept"))
    body = df.withColumn(same, F.xxhash64(F.coalesce(column(df, text_col), F.lit(""))))
    out = body.join(kept, column(body, id_col).cast("long").eqNullSafe(kept[key])
                    & (body[same] == kept[same + "_kept"]), "left_semi")
    if marks.filter("n_shingles > 0").groupBy("doc_id", "same").count().filter("count > 1").head(1):
        blank = F.trim(column(out, text_col), F.lit(" \t\n\x0b\x0c\r")) == ""
        empty = F.coalesce(blank, F.lit(True))
        out = out.filter(empty).unionByName(out.filter(~empty).dropDuplicates([id_col, same]))
    return out.drop(same)
