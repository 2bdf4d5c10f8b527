"""Suffix-array dedup (operator 12): bytes covered by repeated byte strings leave.

A window is a string of ``width`` bytes of a text in UTF-8.  A window that also
starts earlier, in a smaller document or in the same one, is a repeat, and the
bytes that repeats cover leave.  Windows are judged on the input alone.

1. Fragments.  A window belongs to the smallest hash among its GRAM-byte
   strings (its key), so equal windows have equal keys wherever they are.  A
   fragment is a run of neighbouring windows with one key.
2. Only keys that come twice can hold repeats: keys are counted, and the
   fragments of the others are not looked at again.
3. Fragments that are equal as a whole are added up before anything is sorted;
   all but the first of them are repeats throughout.
4. The different fragments of a key are written one after the other, and a
   suffix array (``suffixes``, linear grouping) sorts their suffixes.  Windows
   that are neighbours there and agree in ``width`` bytes are a class; all
   but its earliest are repeats.  Keys are sorted side by side, in as many steps
   as the longest needs, so keys with as many fragments stand together.
5. A key with more than PART different fragments, say at the edges of a
   passage that many documents quote, is dealt over parts of about PART.  Each
   part sorts its own and names the earliest window of each class; these
   meet by a 128-bit digest, which leaves the earliest of all parts.

Edge cases: a null text counts as empty; a text shorter than ``width`` loses
nothing.  Null ids rank last.  Rows with one id and different texts are
documents of their own, ordered by a hash of the text; rows with one id and one
text are the same document and get the same result.  What is left of a text
may cut a character, so it is binary.  Empty tables give empty results; extra
columns of any name are ignored by ``spans`` and returned by ``remove``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, fresh, ship, stage
from .suffixes import ranges, suffix_arrays

WIDTH, GRAM = 100, 24
#: Positions of a block in which fragments are found; their number fits the low bits of a hash.
BLOCK_BITS = 18
#: Different fragments of a key that are sorted together, and bytes that are sorted side by side.
PART, SIDE_BY_SIDE = 64, 1 << 20
DOC = ["none", "id", "same"]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of the strings of ``gram`` bytes, by doubling."""
    one = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    have, out = 1, one
    while have < gram:
        step = min(have, gram - have)
        twist = np.uint64(0x9E3779B97F4A7C15 + 2 * have)
        out = out[:len(out) - step] * twist ^ (out[step:] >> np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)
        have += step
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _block(data: np.ndarray, text: np.ndarray, width: int, gram: int):
    """Fragments of one block: begin, windows, key, whether a window may repeat within."""
    hashes = _gram_hashes(data, gram)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, have = width - gram + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    place = (least & low).astype(np.int64)
    key = hashes[place]
    whole = text[:len(key)] == text[width - 1:width - 1 + len(key)]
    change = np.ones(len(key), bool)
    change[1:] = (key[1:] != key[:-1]) | (text[1:len(key)] != text[:len(key) - 1]) | (whole[1:] != whole[:-1])
    begin = np.flatnonzero(change)
    stop = np.append(begin[1:], len(key))
    begin, stop = begin[whole[begin]], stop[whole[begin]]
    return begin, stop - begin, key[begin], place[begin] != place[stop - 1]


def fragments(texts: list[bytes], width: int = WIDTH, gram: int = GRAM):
    """Fragments of some texts: text number, begin in the text, number of windows, key, may repeat within."""
    size, held, n = 1 << BLOCK_BITS, [], 0
    found = [[] for _ in range(5)]

    def work():
        lengths = np.array([len(part) for _, _, part in held])
        if lengths.sum() < width:
            return
        data = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
        piece = np.repeat(np.arange(len(held)), lengths)
        begin, windows, key, again = _block(data, piece, width, gram)
        owner = piece[begin]
        offset = np.array([at for _, at, _ in held]) - (np.cumsum(lengths) - lengths)
        for column_, values in zip(found, (np.array([t for t, _, _ in held])[owner], begin + offset[owner], windows, key, again)):
            column_.append(values)

    for number, text in enumerate(texts):
        # a long text is cut into blocks that share width - 1 bytes, so each window is in one of them
        for at in range(0, max(len(text) - width + 1, 1), size - width + 1):
            part = text[at:at + size]
            if n + len(part) > size:
                work()
                held, n = [], 0
            held.append((number, at, part))
            n += len(part)
    work()
    kinds = (np.int64, np.int64, np.int64, np.uint64, bool)
    return [np.concatenate(c).astype(k) if c else np.empty(0, k) for c, k in zip(found, kinds)]


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """none, id, same: which document; text in UTF-8."""
    id_, text = column(df, id_col), F.coalesce(column(df, text_col), F.lit(""))
    return df.select(id_.isNull().alias("none"), F.coalesce(id_.cast("long"), F.lit(0)).alias("id"),
                     F.xxhash64(text).alias("same"), text.cast("binary").alias("text"))


def _keys_twice(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            _, _, _, key, again = fragments(batch.column(0).to_pylist(), width, gram)
            keys, back = np.unique(key, return_inverse=True)
            n = np.bincount(back, 1 + again.astype(np.int64), len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    return (docs.select("text").mapInArrow(run, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"))


def _fragment_rows(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column(3).to_pylist()
            owner, begin, windows, key, again = fragments(texts, width, gram)
            stop = begin + windows + (width - 1)
            digest = np.fromiter((xxhash.xxh3_64_intdigest(texts[t][a:b]) for t, a, b in
                                  zip(owner.tolist(), begin.tolist(), stop.tolist())), np.uint64, len(owner))
            documents = [batch.column(i).take(pa.array(owner)) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*documents, pa.array(begin), pa.array(windows), pa.array(key.view(np.int64)),
                 pa.array(digest.view(np.int64)), pa.array(again)],
                names=[*DOC, "begin", "windows", "key", "digest", "again"])

    return docs.mapInArrow(run, "none boolean, id long, same long, begin long, windows long, key long, "
                                "digest long, again boolean")


def _cut(chosen: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The bytes of chosen fragments: key, different, part, parts, document, begin, windows, bytes."""
    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            frames = pa.array([squeeze.compress(t) for t in batch.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], frames], names=batch.schema.names)

    def run(batches):
        grow = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, bytes_ = [], []
            for i, (frame, wanted) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                text = grow.decompress(frame)
                for w in wanted:
                    rows.append((i, w["key"], w["different"], w["part"], w["parts"], w["begin"], w["windows"]))
                    bytes_.append(text[w["begin"]:w["begin"] + w["windows"] + width - 1])
            which, *rest = (np.array(rows, np.int64).reshape(-1, 7).T)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(which)) for i in range(3)), *map(pa.array, rest), pa.array(bytes_, pa.binary())],
                names=[*DOC, "key", "different", "part", "parts", "begin", "windows", "bytes"])

    wanted = chosen.groupBy(*DOC).agg(F.collect_list(F.struct("key", "different", "part", "parts", "begin", "windows")).alias("wanted"))
    # repeated rows of one document are one: their text is taken once, map-side first
    texts = docs.mapInArrow(pack, docs.schema).groupBy(*DOC).agg(F.first("text").alias("text"))
    return texts.join(wanted, DOC).mapInArrow(
        run, "none boolean, id long, same long, key long, different long, part long, parts long, begin long, windows long, "
             "bytes binary")


def _classes(fragments_: dict, width: int):
    """Repeated and, in keys of several parts, remaining windows of some keys, all their fragments given.

    Returns (fragment, first window, number of windows) of the repeats and (fragment, window) of the rest.
    """
    bytes_, windows = fragments_["bytes"], fragments_["windows"]
    group = fragments_["group"]
    sizes = windows + width  # one byte more, which ends the fragment
    first_of_group = np.flatnonzero(np.diff(group, prepend=-1))
    # a text per group: its fragments, each followed by a byte 1, and 0 at the end; others are above
    tail = np.zeros(len(sizes), np.int64)
    tail[np.append(first_of_group[1:], len(group)) - 1] = 1
    starts = np.cumsum(sizes + tail) - (sizes + tail)
    total = int((sizes + tail).sum())
    data = np.zeros(total + width, np.uint8)
    body, owner = ranges(starts, sizes - 1)
    data[body] = np.frombuffer(b"".join(bytes_), np.uint8)
    symbols = np.zeros(total, np.int64)
    symbols[body] = data[body].astype(np.int64) + 2
    symbols[starts + sizes - 1] = 1
    order = suffix_arrays(symbols, starts[first_of_group])

    fragment, window = np.full(total, -1, np.int64), np.zeros(total, np.int64)
    places, owner = ranges(starts, windows)
    fragment[places], window[places] = owner, places - starts[owner]
    order = order[fragment[order] >= 0]
    eight = np.ndarray((total + width - 8,), "<u8", data, strides=(1,))
    a, b = order[:-1], order[1:]
    alike = np.flatnonzero(group[fragment[a]] == group[fragment[b]])
    for at in [*range(0, width - 8, 8), width - 8]:
        alike = alike[eight[a[alike] + at] == eight[b[alike] + at]]
    new = np.ones(len(order), bool)
    new[alike + 1] = False
    begins = np.flatnonzero(new)
    # earliest of a class: smallest document, then smallest position
    when = (fragments_["rank"][fragment[order]] << np.int64(40)) + fragments_["begin"][fragment[order]] + window[order]
    least = np.repeat(np.minimum.reduceat(when, begins), np.diff(np.append(begins, len(order)))) if len(order) else when
    repeat = np.zeros(total, bool)
    repeat[order] = when != least

    gone = np.sort(order[repeat[order]])
    cut = np.ones(len(gone), bool)
    cut[1:] = (np.diff(gone) != 1) | (fragment[gone[1:]] != fragment[gone[:-1]])
    run = np.flatnonzero(cut)
    removed = (fragment[gone[run]], window[gone[run]], np.diff(np.append(run, len(gone))))
    shared = np.zeros(total, bool)
    shared[order] = (fragments_["parts"][fragment[order]] > 1) & ~repeat[order]
    rest = np.flatnonzero(shared)
    return removed, (fragment[rest], window[rest])


def _lined_up(cut: DataFrame) -> DataFrame:
    """The fragments of each key and part one after the other, keys with fewer different fragments first."""
    return cut.repartition("key", "part").sortWithinPartitions("different", "key", "part", *DOC, "begin")


def _sorted_parts(cut: DataFrame, width: int) -> DataFrame:
    """document, begin, stop of repeats (high, low null), and of the remaining windows of split keys with their digest."""
    def flush(held):
        rows = pa.Table.from_batches(held)
        get = lambda name: rows.column(name).to_numpy()
        document = np.stack([get("none").astype(np.int64), get("id"), get("same")])
        _, rank = np.unique(document, axis=1, return_inverse=True)
        key, part = get("key"), get("part")
        changed = (np.diff(key, prepend=key[:1]) != 0) | (np.diff(part, prepend=part[:1]) != 0)
        parts = {"bytes": rows.column("bytes").to_pylist(), "windows": get("windows"), "group": np.cumsum(changed),
                 "begin": get("begin"), "rank": rank.reshape(-1).astype(np.int64), "parts": get("parts")}
        (f, w, n), (rf, rw) = _classes(parts, width)
        digests = [xxhash.xxh3_128_intdigest(parts["bytes"][i][j:j + width]) for i, j in zip(rf.tolist(), rw.tolist())]
        half = (1 << 64) - 1
        sign = lambda values: pa.array(np.array(values, np.uint64).view(np.int64))
        blank = pa.nulls(len(f), pa.int64())
        which = np.concatenate([f, rf])
        begin = parts["begin"][which] + np.concatenate([w, rw])
        stop = begin + np.concatenate([n, np.ones(len(rf), np.int64)]) + (width - 1)
        high = pa.concat_arrays([blank, sign([d >> 64 for d in digests])])
        low = pa.concat_arrays([blank, sign([d & half for d in digests])])
        names = [*DOC, "begin", "stop", "high", "low"]
        taken = [rows.column(c).combine_chunks().take(pa.array(which)) for c in DOC]
        yield from pa.table([*taken, pa.array(begin), pa.array(stop), high, low], names=names).to_batches(100_000)

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            # batches are cut where a group ends, so that a group is sorted whole
            key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1
            lengths = np.cumsum(batch.column("windows").to_numpy() + width)
            begin = 0
            if last is not None and last != (key[0], part[0]) and size >= SIDE_BY_SIDE:
                yield from flush(held)
                held, size = [], 0
            for edge in edges.tolist():
                if size + lengths[edge - 1] - (lengths[begin - 1] if begin else 0) >= SIDE_BY_SIDE:
                    yield from flush([*held, batch.slice(begin, edge - begin)])
                    held, size, begin = [], 0, edge
            held.append(batch.slice(begin))
            size += int(lengths[-1] - (lengths[begin - 1] if begin else 0))
            last = (key[-1], part[-1])
        if held:
            yield from flush(held)

    return _lined_up(cut).mapInArrow(run, "none boolean, id long, same long, begin long, stop long, high long, low long")


def _position() -> Column:
    return F.struct(*DOC, "begin")


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Documents (none, id, same) with repeats and ``gone``: begin and stop of the windows' runs, unmerged."""
    if width < 16:
        raise ValueError("a window has 16 bytes at least")
    gram = min(GRAM, width // 2)
    ship(df.sparkSession)
    docs = _documents(df, id_col, text_col)
    twice = stage(_keys_twice(docs, width, gram))
    rows = stage(_fragment_rows(docs, width, gram).join(twice, "key"))

    same = rows.groupBy("key", "digest").agg(F.min(_position()).alias("first"), F.max("windows").alias("windows"),
                                             F.max("again").alias("again"), F.count(F.lit(1)).alias("n"))
    same = stage(same)
    copies = (rows.select("key", "digest", *DOC, "begin", "windows")
              .join(same.filter("n > 1").select("key", "digest", "first"), ["key", "digest"])
              .filter(_position() != F.col("first"))
              .select(*DOC, "begin", (F.col("begin") + F.col("windows") + (width - 1)).alias("stop")))

    several = stage(same.groupBy("key").agg(F.count(F.lit(1)).alias("different"), F.max("again").alias("again"))
                    .filter("different > 1 or again").select("key", "different", F.ceil(F.col("different") / PART).alias("parts")))
    chosen = (same.join(several, "key")
              .select("key", "different", "first.*", "windows", "parts", F.pmod("digest", F.col("parts")).alias("part")))
    judged = stage(_sorted_parts(_cut(chosen, docs, width), width))

    left = judged.filter("low is not null")
    winners = stage(left.groupBy("high", "low").agg(F.min(_position()).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    beaten = left.join(winners, ["high", "low"]).filter(_position() != F.col("first"))
    parts = [copies, judged.filter("low is null").select(*DOC, "begin", "stop"), beaten.select(*DOC, "begin", "stop")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stage(every.groupBy(*DOC).agg(F.collect_list(F.struct("begin", "stop")).alias("gone")))


def merged(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that overlap or touch become one."""
    if not len(begin):
        return begin, stop
    by = np.argsort(begin, kind="stable")
    begin, reach = begin[by], np.maximum.accumulate(stop[by])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return begin[first], reach[np.append(first[1:], len(begin)) - 1]


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans and, in place of the text, kept (binary: what is left of it)."""
    found = spans(df, id_col, text_col, width)
    names = {c: fresh(df, c) for c in [*DOC, "gone", "n_bytes", "n_removed", "n_spans", "kept"]}
    id_, text = column(df, id_col), F.coalesce(column(df, text_col), F.lit(""))
    own = [c for c in df.columns if c != text_col]
    keyed = df.select(*(column(df, c) for c in own), text.cast("binary").alias(names["kept"]),
                      id_.isNull().alias(names["none"]), F.coalesce(id_.cast("long"), F.lit(0)).alias(names["id"]),
                      F.xxhash64(text).alias(names["same"]))
    joined = keyed.join(found.select(*(F.col(c).alias(names[c]) for c in [*DOC, "gone"])), [names[c] for c in DOC], "left")
    counts = [names[c] for c in ("n_bytes", "n_removed", "n_spans")]
    out = joined.select(*(column(joined, c) for c in own), *(F.lit(0).cast("long").alias(c) for c in counts), names["kept"]).schema

    def run(batches):
        for batch in batches:
            texts, gone = batch.column(len(own)).to_pylist(), batch.column(len(own) + 1)
            flat = gone.flatten()
            begins, stops = flat.field("begin").to_numpy(), flat.field("stop").to_numpy()
            ends = np.cumsum(gone.value_lengths().fill_null(0).to_numpy())
            kept, removed, runs = [], [], []
            for text_, a, b in zip(texts, [0, *ends[:-1].tolist()], ends.tolist()):
                begin, stop = merged(begins[a:b], stops[a:b])
                edges = [0, *np.stack([begin, stop], 1).ravel().tolist(), len(text_)]
                kept.append(b"".join(text_[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)) if a < b else text_)
                removed.append(len(text_) - len(kept[-1]))
                runs.append(len(begin))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(own)], pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=out.names)

    return joined.select(*(column(joined, c) for c in own), names["kept"], names["gone"]).mapInArrow(run, out)
