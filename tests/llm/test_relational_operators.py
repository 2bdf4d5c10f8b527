"""Edge cases and brute-force versions of the operators that join, and the pipeline."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from salesmart.llm import dedup, jaccard, mixing, registry, simhash, tools  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, size string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "a", "b", "c") for i, t, s in rows], SCHEMA)


def oracle(sf, name, columns):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.sql(f"SELECT {', '.join(columns)} FROM ({registry.SQL[name]})").fetchall()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_sql(spark, sf_small, name):
    df = registry.queries()[name](spark, sf_small)
    columns = sorted(df.columns)
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert order(map(tuple, df.select(columns).collect())) == order(oracle(sf_small, name, columns))


def test_native_queries_run_no_python(spark, sf_small):
    for name in ("op4_exact_dedup", "op9_tool_links"):
        plan = registry.queries()[name](spark, sf_small)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)


ROWS = [(1, "Same Text", "a"), (2, "same text", "a"), (9, "SAME TEXT", None), (3, None, "b"), (4, "", "b"), (None, "", "c"),
        (5, "É", "c"), (6, "é", "c"), (7, "alone", "c"), (7, "alone", "c"), (7, "other", "c")]


@pytest.mark.parametrize("support", [1e-3, 0.15])
def test_exact_dedup_edge_cases(spark, support):
    df = documents(spark, ROWS)
    got = dedup.annotate(df, support=support).collect()
    assert len(got) == len(ROWS)
    kept = sorted((r["doc_id"], r["group_size"]) for r in got if r["kept"])
    assert kept == [(4, 3), (5, 1), (6, 1), (7, 1), (7, 2), (9, 3)]
    assert all(r["keep_id"] == 9 for r in got if r["group_size"] == 3 and r["doc_id"] in (1, 2, 9))
    out = dedup.drop_duplicates(df, support=support)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [
        (4, ""), (5, "É"), (6, "é"), (7, "alone"), (7, "other"), (9, "SAME TEXT")]
    assert dedup.annotate(df.limit(0)).count() == dedup.drop_duplicates(df.limit(0)).count() == 0


def test_exact_dedup_hot_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 700}", "s") for i in range(3000)]
    got = dedup.annotate(documents(spark, rows)).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t].append(i)
    by_id = {r["doc_id"]: r for r in got}
    for ids in groups.values():
        assert {(by_id[i]["keep_id"], by_id[i]["group_size"]) for i in ids} == {(max(ids), len(ids))}
        assert [i for i in ids if by_id[i]["kept"]] == [max(ids)]


def test_mixing_meets_targets_and_schedules(spark):
    random.seed(4)
    rows = [(i, "w " * random.randrange(0, 40), random.choice(["a", "a", "a", "b", "c", None])) for i in range(2000)]
    rows += [(5, "w w", "a"), (None, None, "b"), (None, "w", None)]
    df = documents(spark, rows)
    mixed = mixing.mix(df, mixing.word_count(F.col("text")))
    got = mixed.collect()
    assert len(got) == len(rows) and set(df.columns) <= set(mixed.columns)
    total = sum(r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["size"] == len((r["text"] or "").split())
    assert sum(by[s][0]["target"] for s in by) == pytest.approx(1.5 * total)
    for s in by:
        assert by[s][0]["source_size"] == sum(r["size"] for r in by[s])
        assert sum(r["taken"] for r in by[s]) == int(by[s][0]["target"] + 1e-9)
        assert by[s][0]["target"] <= 2 * by[s][0]["source_size"]
    places = [p["position"] for r in got for p in r["passes"]]
    assert all(0 <= p < 1 for p in places)
    first = [r["position"] for r in got if r["position"] is not None]
    assert first == sorted(first)
    early = sum(p["taken"] for r in by["a"] for p in r["passes"] if p["position"] < 0.5)
    assert early / by["a"][0]["target"] == pytest.approx(0.625, abs=0.02)  # rates 1.5 to 0.5
    again = mixing.mix(df.repartition(5), mixing.word_count(F.col("text"))).collect()
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"], r["position"] or -1)
    assert sorted(map(key, got)) == sorted(map(key, again))
    repeated = mixing.repeat_passes(mixed, df.columns)
    assert repeated.count() == len(places) and repeated.columns == df.columns
    assert mixing.mix(df.limit(0), mixing.word_count(F.col("text"))).count() == 0
    assert {r["taken"] for r in mixing.mix(documents(spark, [(1, None, None)]), mixing.word_count(F.col("text"))).collect()} == {0}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows, width, percent):
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[find(i)].append(k)
    return [(k, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (k, _) in enumerate(rows)]


def near_copies(seed, groups=12, members=14):
    random.seed(seed)
    rows = []
    passage = [f"p{i}" for i in range(25)]
    for g in range(groups):
        base = [f"w{random.randrange(300)}" for _ in range(random.randrange(5, 90))] + passage * (g % 3 == 0)
        for _ in range(members):
            own = list(base)
            for _ in range(random.randrange(0, 4)):
                own[random.randrange(len(own))] = f"w{random.randrange(300)}"
            rows.append(" ".join(own))
    rows += [None, "", " \t", "one", "ONE", "two words", rows[0], rows[0], "É x y z", "é x y z", "a b c d e"]
    ids = random.sample(range(1000), len(rows))
    return [(None if i % 40 == 7 else k, t) for i, (k, t) in enumerate(zip(ids, rows))]


@pytest.mark.parametrize("width,percent,seed", [(4, 85, 1), (5, 80, 2), (1, 60, 3)])
def test_jaccard_join_equals_brute_force(spark, width, percent, seed):
    rows = near_copies(seed)
    df = documents(spark, [(k, t, "s") for k, t in rows])
    got = [tuple(r) for r in jaccard.join(df, width, percent).select("doc_id", "n_shingles", "component_id").collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(brute_components(rows, width, percent))
    if seed == 2:
        kept = jaccard.keep_one(df, width, percent)
        assert kept.columns == df.columns
        want = {c for k, n, c in got if n and c is not None}
        assert want <= {r["doc_id"] for r in kept.collect()}
        empty = sum(n == 0 for _, n, _ in got)
        assert kept.count() >= len(want) + empty


def test_jaccard_join_passage_in_a_third_of_all(spark):
    """A passage fills the prefixes of a third of the documents, which rarely link; others link in chains."""
    random.seed(3)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(100):
        rows.append(" ".join(passage + [f"x{i}_{k}" for k in range(random.choice([0, 1, 3, 5, 9, 14]))]))
    for i in range(60):  # neighbours in the chain link, far ones do not
        rows.append(" ".join(f"c{k}" for k in range(i, i + 60)))
    for i in range(140):
        rows.append(" ".join(f"w{random.randrange(5000)}" for _ in range(30)))
    rows = list(enumerate(random.sample(rows, len(rows))))
    df = documents(spark, [(k, t, "s") for k, t in rows])
    got = [tuple(r) for r in jaccard.join(df, 4, 85).select("doc_id", "n_shingles", "component_id").collect()]
    want = brute_components(rows, 4, 85)
    assert sorted(got) == sorted(want)
    assert len({c for _, _, c in want}) > 150


def test_jaccard_sketches_keep_links_and_spare_far_pairs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for node in range(60):  # sets that share a token, some nearly equal, each in a component of its own
        own = rng.integers(1, 1 << 64, 200, np.uint64) if node % 3 == 0 else np.append(own[1:], rng.integers(1, 1 << 64, 1, np.uint64))
        tokens = np.unique(own)
        rows.append((node, tokens))
    links = set()
    for a, x in rows:
        for b, y in rows:
            both = len(np.intersect1d(x, y))
            differ = sum(int(p ^ q).bit_count() for p, q in zip(jaccard.sketch(x).view(np.uint64).tolist(), jaccard.sketch(y).view(np.uint64).tolist()))
            assert differ <= len(x) + len(y) - 2 * both
            if a < b and 100 * both >= 85 * (len(x) + len(y) - both):
                links.add((a, b))
    assert len(links) == 60
    for comps in (1, 30):  # each node a component, or two large ones
        placed = spark.createDataFrame(
            [(7, node, node % 2 if comps == 30 else node, len(t), *jaccard.sketch(t).tolist()) for node, t in rows],
            "token long, node long, comp long, n long, " + ", ".join(f"{c} long" for c in jaccard.SKETCH))
        placed = placed.select("token", "node", "comp", F.struct("n", *jaccard.folded()).alias("set"))
        got = {(min(r), max(r)) for r in map(tuple, jaccard.apart(placed, 85).collect())}
        want = {(a, b) for a, b in links if comps == 1 or a % 2 != b % 2}
        assert want <= got and len(got) <= len(want) + 5  # of 1,770 and 900 pairs


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = spark.createDataFrame(path + star + [(5000, 5000)], "a long, b long")
    got = {r["node"]: r["comp"] for r in jaccard.components(edges).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1300)} == {1000}
    assert jaccard.components(edges.limit(0)).count() == 0


def test_simhash_edges_and_neighbours(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, "x" * 3000), (4, "y z"), (None, "last one here"), (7, "A b C d e f g"), (8, "a b c d e f")]
    df = documents(spark, [(k, t, "s") for k, t in rows])
    for parts in (1, 3, 50):
        got = sorted(simhash.edited_pairs(df, parts=parts).collect(), key=str)
        want = sorted(rows[:4] + rows[4:], key=lambda r: -(r[0] if r[0] is not None else -1))
        texts = sorted((r["n_chars"], r["edited_text"]) for r in got)
        ties = [i for i, r in enumerate(want) if r[0] == 4]
        options = []
        for swap in (False, True):
            order = list(want)
            if swap:
                order[ties[0]], order[ties[1]] = order[ties[1]], order[ties[0]]
            order = [t or "" for _, t in order]
            options.append(sorted((len(t), simhash.edited(t, order[(i + 1) % len(order)])) for i, t in enumerate(order)))
        assert texts in options
    marks = simhash.fingerprint(df).collect()
    assert {r["fingerprint"] for r in marks if r["doc_id"] in (2, 3)} == {"0" * 32}
    assert simhash.edited_pairs(df.limit(0)).count() == 0
    only = simhash.edited_pairs(df.filter("doc_id = 8")).first()
    assert only["edited_text"] == simhash.edited("a b c d e f", "a b c d e f")

    random.seed(6)
    base = [random.getrandbits(128) for _ in range(30)]
    near = [b ^ sum(1 << i for i in random.sample(range(128), random.randrange(0, 7))) for b in base for _ in range(8)]
    index = spark.createDataFrame([(f"{v:032x}",) for v in near], "fingerprint string")
    got = {r["fingerprint"]: r["n_near"] for r in simhash.neighbours(index, index).collect()}
    assert got == {f"{v:032x}": sum((v ^ w).bit_count() <= simhash.RADIUS for w in near) for v in near}


def test_simhash_query_equals_brute_force(spark, sf_small):
    got = {r["doc_id"]: r for r in registry.op6_simhash(spark, sf_small).collect()}
    docs = sorted(((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()), reverse=True)
    mark = {k: int(r["fingerprint"], 16) for k, r in got.items()}
    for i, (k, text) in enumerate(docs):
        after, following = docs[(i + 1) % len(docs)]
        cut = len(text) // 3
        edit = text[:len(text) - cut] + following[:cut]
        assert (got[k]["n_chars"], got[k]["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert got[k]["near_next"] == pytest.approx(1 - (mark[k] ^ mark[after]).bit_count() / 128)
        if k % 100 == 0:
            assert got[k]["n_near"] == sum((mark[k] ^ v).bit_count() <= simhash.RADIUS for v in mark.values())


def test_simhash_names_near_copies(spark, sf_small):
    random.seed(7)
    base = [random.getrandbits(128) for _ in range(20)]
    marks = [b ^ sum(1 << i for i in random.sample(range(128), random.randrange(0, 20))) for b in base for _ in range(6)]
    index = spark.createDataFrame([(f"{v:032x}",) for v in marks + marks[:3]], "fingerprint string")
    for radius, blocks in ((simhash.RADIUS, simhash.BLOCKS), (4, 8), (9, 4), (0, 4), (20, 16)):
        got = {(r["fingerprint"], r["near"]): (r["distance"], r["n_rows"])
               for r in simhash.matches(index.limit(40), index, radius, blocks).collect()}
        asked = {int(r["fingerprint"], 16) for r in index.limit(40).collect()}
        assert got == {(f"{v:032x}", f"{w:032x}"): ((v ^ w).bit_count(), marks.count(w) + marks[:3].count(w))
                       for v in asked for w in set(marks) if (v ^ w).bit_count() <= radius}
    text = " ".join(f"word{random.randrange(500)}" for _ in range(300)).split()
    rows = [(100, " ".join(text), "s"), (101, " ".join(text[:150] + ["new", "ones"] + text[153:]), "s"), (102, "another", "s")]
    mark = {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprint(documents(spark, rows)).collect()}
    made = simhash.fingerprint(documents(spark, rows))
    assert {r["near"] for r in simhash.matches(made.filter("doc_id = 100"), made).collect()} == {mark[100], mark[101]}
    rows = registry.op6_simhash(spark, sf_small).collect()
    assert all((r["near"] is None) == (r["n_near"] is None) for r in rows)
    count = lambda mark: sum(r["fingerprint"] == mark for r in rows)
    assert all(sum(count(x["near"]) for x in r["near"]) == r["n_near"] for r in rows if r["near"])


SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}}


def test_tool_links(spark):
    calls = spark.createDataFrame([
        (1, "c1", "add", '{"b": 1.5, "a": 1}', None, 1), (1, "c2", "add", '{"a": "x", "z": 1}', "r1", 2),
        (1, "c3", "add", "no json", "c2", 3), (1, "c4", "sub", "{}", "c4", 4), (1, "c5", "add", '{"a":1,"b":2}', "c4", 5),
        (1, "c1", "add", "{}", None, 9), (2, None, "add", None, None, 1)],
        "conv_id long, call_id string, name string, arguments string, needs string, seq long")
    results = spark.createDataFrame([(1, "r1", "c1", 'say "ü"\n'), (1, "r9", "c9", "lost")],
                                    "conv_id long, result_id string, call_id string, content string")
    rows = tools.link(calls, results, SCHEMAS).collect()
    got = {(r["call_id"], r["kind"]): r for r in rows}
    assert len(rows) == len(got) == 8
    depth = {k: r["depth"] for (k, kind), r in got.items() if kind == "call"}
    assert depth == {"c1": 0, "c2": 1, "c3": 2, "c4": None, "c5": None, None: None}  # c4 waits for itself
    assert got["c1", "call"]["canonical"] == '{"arguments":{"a":1,"b":1.5},"id":"c1","name":"add","result":"say \\"ü\\"\\n"}'
    assert got["c2", "call"]["errors"] == ["a is no integer", "missing b", "unknown z"]
    assert got["c3", "call"]["errors"] == ["arguments are no JSON object"]
    assert got["c4", "call"]["errors"] == ["unknown tool sub"]
    assert got["c5", "call"]["valid"] and got["c1", "duplicate"]["result_id"] is None
    assert got["c9", "orphan"]["result_id"] == "r9"
    twice = results.unionByName(results.limit(1)).withColumn("row", F.lit(1)).withColumn("depth", F.lit(2))
    clash = calls.withColumn("row", F.lit(1)).withColumn("depth", F.lit(2)).withColumn("kind", F.lit(3))
    again = tools.link(clash, twice, SCHEMAS).collect()
    assert len(again) == len(rows) + 1
    assert tools.link(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def test_tool_links_long_chain(spark):
    turns = spark.range(3000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.lit("t").alias("text"))
    rows = tools.link(*tools.conversation_calls(turns), tools.REPLY).select("depth").collect()
    assert sorted(r["depth"] for r in rows) == list(range(1500))


def tiktoken_coder():
    import base64

    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def replayed_passes(docs):
    """Rows that the mixing stage gives each document: water-filled targets, queues by the hash of the id."""
    queues = defaultdict(list)
    for k, source, n in docs:
        mark = hashlib.md5(f"{mixing.SEED}:{k}".encode()).hexdigest()
        queues[source].append((mark, n, k))
    names = sorted(queues, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    own = {s: sum(n for _, n, _ in queues[s]) for s in names}
    target, left, open_ones = {}, mixing.SHARE * sum(own.values()), set(names)
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if weight[s] * level > mixing.REPEATS * own[s]}
        for s in full or open_ones:
            target[s] = mixing.REPEATS * own[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ones = open_ones - full if full else set()
    out = defaultdict(int)
    for s in names:
        begin = 0
        for turn in range(mixing.REPEATS):
            for _, n, k in sorted(queues[s]):
                if n == 0:
                    out[k] = 1
                elif begin < int(target[s] + 1e-6):
                    out[k] += 1
                begin += n
    return out


def test_repeat_passes_keeps_documents_without_words(spark):
    rows = [(1, "a b c d", "s"), (2, None, "s"), (3, "", None), (4, " \t", "s"), (5, "e f", "t"), (6, "g", "u"),
            (2, None, "s"), (None, "", "t")]
    docs = documents(spark, rows).withColumn("mix_pass", F.lit(1))
    mixed = mixing.mix(docs, mixing.word_count(docs["text"]))
    taken = {r["doc_id"]: len(r["passes"]) for r in mixed.filter("size > 0").collect()}
    out = mixing.repeat_passes(mixed, [c for c in docs.columns if c != "size"], wordless=True).collect()
    assert sorted(taken) == [1, 5, 6]
    assert [r["doc_id"] for r in out[:5] if r["text"] and r["text"].strip()] == []
    count = lambda k: sum(r["doc_id"] == k for r in out)
    assert {k: count(k) for k in (1, 5, 6)} == taken
    assert [count(k) for k in (2, 3, 4, None)] == [2, 1, 1, 1]


def test_pipeline_equals_brute_force(spark, sf_small):
    import corpus_pipeline

    from salesmart.llm import toxicity
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    rows = {r["doc_id"]: r for r in docs.collect() if model.probability(*model.best(r["text"])) < toxicity.THRESHOLD}
    last = {}
    for k in sorted(rows):
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in rows[k]["text"] or "")] = k
    left = [(k, rows[k]["text"]) for k in sorted(last.values())]
    kept = [k for k, n, c in brute_components(left, 5, 80) if k == c or n == 0]
    size = {k: len(words_of(rows[k]["text"])) for k in kept}
    got = corpus_pipeline.run(spark, sf_small)
    counts = defaultdict(int)
    coder = tiktoken_coder()
    for r in got.collect():
        counts[r["doc_id"]] += 1
        text = rows[r["doc_id"]]["text"] or ""
        ids = coder.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert counts == replayed_passes([(k, rows[k]["source"], size[k]) for k in kept])
    assert set(counts) <= set(kept) and max(counts.values()) <= 2 and got.columns[0] == "doc_id"
    total = sum(size.values())
    assert 1.4 * total <= sum(size[k] * n for k, n in counts.items()) <= 1.7 * total
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
