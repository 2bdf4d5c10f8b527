"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from salesmart.llm import negatives, registry, repair, repeats  # noqa: E402
from salesmart.llm.suffixes import suffix_arrays  # noqa: E402

# ---------------------------------------------------------------- suffix arrays (12)


def test_suffix_arrays_equal_sorted_suffixes():
    rng = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k, n = rng.choice([1, 2, 3, 200]), rng.randint(0, 50)
            period = [rng.randint(1, k) for _ in range(rng.randint(1, 4))]
            body = (period * 50)[:n] if rng.random() < 0.4 else [rng.randint(1, k) for _ in range(n)]
            texts.append(body + [0])
        begins = np.cumsum([0, *map(len, texts)])[:-1]
        want = [b + i for b, t in zip(begins.tolist(), texts) for i in sorted(range(len(t)), key=lambda i, t=t: t[i:])]
        assert suffix_arrays(np.array(sum(texts, [])), begins).tolist() == want


def repeats_by_hand(rows, width, hashes):
    """(id, text) -> (n_bytes, n_removed, n_spans, what is left); ids in order, nulls last, then by hash of the text."""
    seen, out = set(), {}
    for id_, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1] or ""])):
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - width + 1):
            if body[i:i + width] in seen:
                gone[i:i + width] = True
            seen.add(body[i:i + width])
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]])))
        out[id_, text] = len(body), int(gone.sum()), spans, bytes(b for b, g in zip(body, gone) if not g)
    return out


def passages(rng, n, words=40):
    return [" ".join(rng.choice(["the", "of", "and", "ab", "é", "river", "stone", "q"]) + str(rng.randint(0, 9)) * rng.randint(0, 2)
                     for _ in range(words)) for _ in range(n)]


@pytest.mark.parametrize("part", [2, 64])
def test_repeats_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "SIDE_BY_SIDE", 3000)
    rng = random.Random(part)
    stock = passages(rng, 12)
    texts = [" ".join(rng.choice(stock) if rng.random() < 0.5 else passages(rng, 1, 20)[0] for _ in range(rng.randint(1, 4)))
             for _ in range(40)]
    hot = stock[0] + " " + stock[1]
    texts += [passages(rng, 1, 15)[0] + hot + passages(rng, 1, 15)[0] for _ in range(12)]
    texts += [None, "", " ", "short", "x" * 700, "ab" * 300, texts[0], texts[0], "é" * 300, "é" * 299]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 3 + [(5, "other " + texts[5])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows],
                               "doc_id long, text string, kept int, same string, n_bytes string")
    hashes = {(r["text"] or ""): r["h"] for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    want = repeats_by_hand(rows, 100, hashes)
    out = repeats.remove(df.repartition(5))
    assert out.columns == ["doc_id", "kept", "same", "n_bytes", "n_bytes_", "n_removed", "n_spans", "kept_"]
    got = sorted(((r["doc_id"], r["n_bytes_"], r["n_removed"], r["n_spans"], bytes(r["kept_"])) for r in out.collect()), key=str)
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=str)


def test_fragments_cover_every_window_of_long_texts(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BITS", 10)
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 99, 100, 1023, 1024, 1025, 5000)]
    owner, begin, windows, _, _ = repeats.fragments(texts)
    for number, text in enumerate(texts):
        at = [i for o, b, w in zip(owner, begin, windows) if o == number for i in range(b, b + w)]
        assert sorted(at) == list(range(max(len(text) - 99, 0)))


def test_fragments_of_keys_of_one_size_stand_together(spark):
    rows = [(False, d, 0, key, n, part, 1 + n // 9, 0, 50, b"x") for key in range(40) for n in [2 + key * 7 % 11]
            for part in range(1 + n // 9) for d in range(n)]
    cut = spark.createDataFrame(rows, "none boolean, id long, same long, key long, different long, part long, parts long, "
                                      "begin long, windows long, bytes binary")
    lined = repeats._lined_up(cut.repartition(7)).select(F.spark_partition_id().alias("task"), "different", "key", "part").collect()
    for task in {r["task"] for r in lined}:
        own = [r[1:] for r in lined if r["task"] == task]
        assert [r[0] for r in own] == sorted(r[0] for r in own)
        groups = [g for g, before in zip(own, [None, *own]) if g != before]
        assert len(groups) == len(set(groups))  # each whole
    assert sorted(r[1:] for r in lined) == sorted((n, key, part) for _, _, _, key, n, part, *_ in rows)


def test_repeats_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = repeats_by_hand(rows, 100, {t or "": 0 for _, t in rows})
    got = registry.op12_suffix_dedup(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted((i, a, b, c, hashlib.sha256(k).hexdigest()) for (i, t), (a, b, c, k) in
                                             ((r, want[r]) for r in rows))


def test_repeats_of_an_empty_table(spark):
    assert repeats.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- hard negatives (11)


def negatives_by_hand(rows):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)
    kept = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], label) for i, v, label in rows
            if label is not None and usable(v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for k, (anchor, a, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), last(i), i, other == label) for j, (i, v, other) in enumerate(kept) if j != k]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[3]][:5]:
            inside = [s for s in scored if not s[3] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]]
            out += [(anchor, p[2], rank + 1, s[2], -p[0], -s[0]) for rank, s in enumerate(inside[:10])]
    return sorted(out, key=str)


def vectors(rng, n, dims):
    return [[float(x) for x in rng.normal(size=dims) / dims ** 0.5] for _ in range(n)]


@pytest.mark.parametrize("block", [7, 1024])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "CHUNK", 3)
    monkeypatch.setattr(negatives, "PAGE", 4)
    monkeypatch.setattr(negatives, "LANE", 2)
    rng = np.random.default_rng(block)
    rows = [(25 * i, v, int(rng.integers(3))) for i, v in enumerate(vectors(rng, 120, 9))]
    rows += [(7000 + i, rows[4][1], i % 3) for i in range(40)]  # one vector many times, ties
    rows += [(100, rows[4][1], 1), (100, rows[4][1], 1), (None, rows[0][1], 0), (None, rows[0][1], 2)]
    rows += [(300, None, 1), (400, rows[0][1], None), (500, [None] * 9, 1), (600, [float("nan")] * 9, 1),
             (700, [float("inf")] * 9, 2), (800, [0.5, 0.25], 2), (900, [], 0), (1000, [0.0] * 9, -4)]
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, curve string, block int")
    got = negatives.mine(df.repartition(3), F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == negatives_by_hand(rows)


def test_negatives_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(100, [1.0], 1)], [(100, [1.0], 1), (101, [0.5], 2)], [(100, None, 1)], [(100, [], 1), (1, [], 1), (2, [], 2)]):
        got = negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0)
        assert sorted(map(tuple, got.collect())) == negatives_by_hand(rows)


def test_hilbert_curve_visits_neighbours():
    bits, side = 3, 8
    cells = np.array([(x, y) for x in range(side) for y in range(side)])
    path = cells[sorted(range(len(cells)), key=lambda i: negatives.hilbert_keys(cells, bits)[i])]
    assert np.abs(np.diff(path, axis=0)).sum(1).tolist() == [1] * (side * side - 1)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    near = rng.normal(size=(20, 6)) * 0.01 + np.eye(6)[0]
    least, most = negatives.bounds(rng.normal(size=(5, 6)), near.min(0)[None], near.max(0)[None])
    assert (least <= most).all()
    away = negatives.bounds(-np.eye(6)[:1], near.min(0)[None], near.max(0)[None])
    assert away[1][0, 0] < 0


# ---------------------------------------------------------------- conversations (13)


def test_tables_equal_exhaustive_search():
    tables, rng = repair.tables(), random.Random(5)

    def by_hand(codes):
        @lru_cache(None)
        def best(i, state, inserted):
            found = [(0, "")] if i == len(codes) and state in (repair.START, repair.ASSISTANT) else []
            if i < len(codes):
                kind = {0: "", 1: "s", 2: "s", 3: "u", 4: "u", 5: "a", 6: "a", 7: "x", 8: "x"}[codes[i]]
                late = 3 if codes[i] and codes[i] % 2 == 0 else 0
                to = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
                go = {"s": 1, "u": 2, "a": 3}
                steps = [("D", 4, state)]
                if kind:
                    steps += [("R", 3 + late, go[to[-1]])] + [("K", late, go.get(kind))] * (kind in to)
                found += [(c + best(i + 1, s, 0)[0], x + best(i + 1, s, 0)[1]) for x, c, s in steps]
            if inserted < 3:
                cost, letters = best(i, {0: 2, 1: 2, 2: 3, 3: 2}[state], inserted + 1)
                found.append((cost + 3, "I" + letters))
            return min(found, default=(10 ** 6, ""))
        return best(0, 0, 0)

    for _ in range(800):
        codes = tuple(rng.randrange(9) for _ in range(rng.randrange(13)))
        digits = np.array(codes, np.uint8)
        letters, _ = tables.repair(digits)
        assert (tables.read(digits)[1], letters) == (repair.edits_cost(letters, digits), letters) == by_hand(codes)


def test_pieces_give_what_the_whole_gives(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(c, rng.choice([None, rng.randrange(40)]) if rng.random() < 0.1 else t, rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "yes", "", " \t", None, "What?", "Go on!", f"n{t % 7}.", "é "])) for c in (1, 2, None) for t in range(90)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, at string, cost int")
    results = []
    for size, parts in ((4096, 1), (5, 1), (16, 6)):
        monkeypatch.setattr(repair, "PIECE", size)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = repair.pieces(df)
        assert (found.filter("whole").count() == 0) if size == 5 else found.count() >= 3
        results.append(sorted(map(tuple, repair.conversations(found, df).collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(results[0]) == 3 and results[0] == results[1] == results[2]


def test_conversation_edge_cases(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."),           # fine
            (2, 0, "user", "Hi"), (2, 0, "user", "Hi"),                       # truncated, its repeat
            (3, 5, "assistant", "Yes."), (3, 9, "system", "Rules."),
            (4, None, None, None),                                            # one space each
            (None, 1, "user", "Q?"), (None, 2, "assistant", "A."),
            (6, 2, "system", "S."), (6, 4, "user", "Q?"), (6, 5, "assistant", "A!")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, gaps int")
    extra = spark.createDataFrame([(7,)], "conv_id long")
    got = {r["conv_id"]: r for r in repair.conversations(repair.pieces(df), df.select("conv_id").union(extra)).collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert (got[1]["audit"], got[1]["cost"], got[1]["repaired_sha256"]) == ("KK", 0, digest("user:Hi.\nassistant:Hello."))
    assert (got[2]["truncated"], got[2]["duplicate"], got[2]["audit"], got[2]["cost"]) == (1, 1, "DD", 8)
    assert (got[3]["gaps"], got[3]["illegal"]) == (3, 1)
    assert (got[4]["blank"], got[4]["gaps"], got[4]["audit"], got[4]["repaired_sha256"]) == (1, 0, "D", digest(""))
    assert got[None]["audit"] == "KK" and got[6]["audit"] == "KKK" and got[6]["gaps"] == 1
    assert tuple(got[7]) == (7, 0, 0, 0, 0, 0, 0, "", digest(""))
    assert repair.conversations(repair.pieces(df.limit(0)), df.limit(0)).count() == 0


def test_damage_is_by_checksum(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t, r, x in [(0, "user", "A. B!"), (1, None, None), (None, "assistant", "C?")]]
    rows += [(c, 3, "system", "D.!?") for c in range(60)]
    got = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        want += [(c, t, "user" if fault == 4 else r, x)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(tuple, repair.damage(got).drop("copy").collect()), key=str) == sorted(want, key=str)
