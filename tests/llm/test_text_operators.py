"""Edge cases and brute-force versions of the operators that work text by text."""

import base64
import gc
import gzip
import hashlib
import io
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from salesmart.llm import bpe, common, html, huffman, registry, tokenfile, toxicity, warc  # noqa: E402

TEXTS = [None, "", " ", "a", "Hello, world!", "It's\n\n two  lines \t", "é中😀 naïve", "x" * 5000, "word " * 3000,
         "Hello, world!", "don't 12345 #$%", " wide blank"]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark, texts=TEXTS):
    rows = [(i if i % 5 else None if i == 5 else i, t, 7, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids2 int, start string")


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, encoding):
    df = documents(spark)
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert coded.columns[:4] == df.columns
    for row in bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect():
        text = row["text"] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == encoding.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()


def test_bpe_query_equals_the_library(spark, sf_small, encoding):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = registry.op3_byte_bpe(spark, sf_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(encoding.encode_ordinary(docs[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_bpe_task_leaves_no_chunks_and_decodes_without_the_model(monkeypatch, encoding):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    encode, other = codec.encoder(), codec.encoder()
    chunks = weakref.ref(encode.__closure__[0].cell_contents)
    texts = [t or "" for t in TEXTS]
    ids = [v.as_py() for v in encode(TEXTS)]
    assert ids == [np.array(encoding.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert chunks().kept and not other.__closure__[0].cell_contents.kept
    del encode
    gc.collect()
    assert chunks() is None
    monkeypatch.setattr(bpe, "Codec", None)
    bpe.codec.cache_clear()
    assert bpe.decoder(RANKS)([*ids, None]).to_pylist() == [*(t.encode() for t in texts), b""]


def test_a_task_gives_memory_back(monkeypatch):
    asked = []

    class Trim:
        def malloc_trim(self, pad):
            asked.append(alive() is None)

    class Held:
        pass

    def run(batches):
        nonlocal alive
        held = Held()
        alive = weakref.ref(held)
        yield from batches

    alive = None
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: Trim())
    assert list(common.tidy(run)(iter([1, 2]))) == [1, 2]
    assert asked == [True]


def test_toxicity_holds_a_part_of_a_batch_as_python_values(monkeypatch):
    texts = ["a" * 10, None, "", "b" * 7, "c"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array(texts)], names=["n", "text"])
    parts, size = [], 8

    def pieces(batch, place):
        for part in common.pieces(batch, place, size):
            parts.append(part.num_rows)
            yield part

    monkeypatch.setattr(toxicity, "pieces", pieces)
    assert list(toxicity.rows_of(batch)) == list(zip(range(15), texts))
    assert len(parts) > 3 and list(toxicity.rows_of(batch.slice(0, 0))) == []


def test_code_lengths_are_limited_and_optimal():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    lengths = huffman.code_lengths(counts, 18)
    assert lengths[0] == 0 and sum(2.0 ** -int(n) for n in lengths[1:]) == 1
    heap = sorted(counts[1:].tolist())
    cost = 0
    while len(heap) > 1:  # plain Huffman
        a, b = heap[:2]
        cost += a + b
        heap = sorted(heap[2:] + [a + b])
    assert int((counts * lengths).sum()) == cost
    limited = huffman.code_lengths(counts, 4)
    assert limited.max() == 4 and sum(2.0 ** -int(n) for n in limited[1:]) <= 1


@pytest.mark.parametrize("ids", [[], [3], [3] * 1000, list(range(200)) * 7])
def test_huffman_round_trip(ids):
    ids = np.array(ids, np.uint32)
    code = huffman.Code(huffman.code_lengths(np.bincount(ids, minlength=300)))
    payload, marks = code.encode(ids)
    lanes = np.array([min(huffman.STEP, len(ids) - i) for i in range(0, len(ids), huffman.STEP)], np.int64)
    assert code.decode(payload, marks, lanes).tolist() == ids.tolist()


def test_huffman_runs_equal_single_runs():
    random = np.random.default_rng(5)
    sizes = np.array([0, 1, 127, 128, 129, 0, 1000, 3, 0])
    ids = random.integers(0, 300, sizes.sum())
    code = huffman.Code(huffman.code_lengths(np.bincount(ids, minlength=300)))
    payload, filled, marks = code.encode_runs(ids, sizes)
    single = [code.encode(part) for part in np.split(ids, np.cumsum(sizes)[:-1])]
    assert payload == b"".join(p for p, _ in single) and filled.tolist() == [len(p) for p, _ in single]
    assert marks.tolist() == [at for _, m in single for at in m.tolist()]


def test_token_file_edge_cases_and_damage(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    tokens = tokenfile.tokenize(documents(spark), path, 2, registry.VOCABULARY)
    manifest = tokenfile.write(tokens, tokenfile.count_ids(tokens, registry.VOCABULARY))
    rows = sorted(tokenfile.read(manifest).collect(), key=lambda r: r["start"])
    assert rows[0]["doc_id"] is None and [r["doc_id"] for r in rows[1:]] == sorted(r["doc_id"] for r in rows[1:])
    at = 0
    for r in rows:
        text = TEXTS[5 if r["doc_id"] is None else r["doc_id"]] or ""
        want = library.encode(text, add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"]) == (at, len(want)) and np.frombuffer(r["ids"], "<u4").tolist() == want
        at += len(want)
    uri = manifest.first()["file"].removeprefix("file:")
    data = bytearray(open("/" + uri.lstrip("/"), "rb").read())
    data[-1] ^= 1
    bad = tmp_path / "bad.bin"
    bad.write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        list(tokenfile.read_blocks(str(bad)))


def test_token_file_query(spark, sf_small):
    from tokenizers import Tokenizer

    library, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.op1_token_file(spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert got[r["doc_id"]] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert tokenfile.round_trip(none, public_tokenizers.path("byte_bpe_50k.json"), 2, registry.VOCABULARY).count() == 0
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    pages = none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"))
    assert warc.read(warc.write(pages)).count() == 0
    assert html.extract(pages).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(none, toxicity.train(none, labels)).count() == 0
    assert toxicity.reject(documents(spark), labels).count() == len(TEXTS)


PAGES = [(1, "http://h/1", "<p>one</p>"), (2, "http://h/2", "<p>one</p>"), (3, None, None), (4, "x", ""),
         (None, "y", "<p>one</p>"), (6, "http://h/6", "é" * 100_000), (6, "http://h/6", "é" * 100_000)]


def test_warc_round_trip_and_framing(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string")
    manifest = warc.write(pages)
    rows = sorted(warc.read(manifest).collect(), key=lambda r: (r["page_id"] or 0, r["url"] or ""))
    assert [(r["page_id"], r["record_type"], r["refers_to"]) for r in rows] == [
        (None, "revisit", 2), (1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None),
        (6, "response", None), (6, "response", None)]
    assert all(r["payload_bytes"] == len(h.encode()) and r["payload_digest"] == warc.base32_sha1(h.encode())
               for r, h in zip(rows, ["<p>one</p>"] * 3 + ["", ""] + ["é" * 100_000] * 2))
    for r in manifest.collect():  # each record is a member: the archive is plain gzip, too
        raw = open("/" + r["file"].removeprefix("file:").lstrip("/"), "rb").read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == r["n_records"] + 1
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(raw[:-5])))
    all_responses = warc.read(warc.write(pages, least=1 << 30))
    assert {r["record_type"] for r in all_responses.collect()} == {"response"}


def test_html_blocks_and_markup():
    page = ("<html><head><title>T</title><style>p{}</style></head><body class=x><nav><a>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>A &amp; B</h1><p><b>One.<br><p>Two\n  words"
            "<script>var x='</p>'</script><form>Name</form></p><aside>See also</aside><ul><li>x<li>y</ul>"
            "<section id=comments><p>First!</p></section></article><footer>&copy; us</footer>")
    assert html.main_texts([page, None, ""]) == ["A & B\n\nOne.\n\nTwo words\n\nx\n\ny", "", ""]


@pytest.mark.parametrize("around", ["<div class='has-sidebar'>", "<div class='no-comments hidden-xs'>", "<form id=aspnetForm>",
                                    "<div id='content-with-nav'>", "<div class=sidebar>", "<div role=search><section>"])
def test_html_marks_of_layout_boxes_do_not_empty_the_article(around):
    article = ("<article><h1>Head</h1><p class=notice>A notice.</p><p class='social'>On social life.</p>"
               "<div class='related-posts'>See also</div><section id=comments>First!</section></article>")
    page = f"<body><header>Site</header>{around}{article}<div class=site-footer>End</div></body>"
    assert html.main_texts([page]) == ["Head\n\nA notice.\n\nOn social life."]
    teaser = "<aside><article>A teaser that is much longer than the article</article></aside>"
    assert html.main_texts([teaser + "<article>Short</article>"]) == ["Short"]
    assert html.main_texts(["<form><p>all is marked</p></form>"]) == ["all is marked"]


def test_html_without_article_loses_what_pages_repeat():
    top, end = "welcome to our little site on the web", "all rights are reserved by the owner here"
    pages = [f"<div>{top}</div><div>{body}</div><div>{end}</div>" for body in
             ("a text of its own about rivers", "another one on the hills and the sea", "third words")]
    assert html.main_texts(pages) == ["a text of its own about rivers", "another one on the hills and the sea", "third words"]
    assert html.main_texts(pages[:1] * 2) == [f"{top}\n\na text of its own about rivers\n\n{end}"] * 2  # mirrors count once


def test_html_repeats_hold_over_the_whole_host(spark, monkeypatch):
    note, quote = "this note is under every one of our articles here", "a passage that only some of the articles quote at length"
    rng = np.random.default_rng(9)
    own = [" ".join(f"w{x}" for x in rng.integers(0, 9000, 40)) for _ in range(700)]
    pages = [f"<article><p>{t}</p>{f'<p>{quote}</p>' if i % 3 == 0 else ''}<p>{note}</p></article>" if i < 600 else
             f"<div>{t}</div>{'<div>a template that only two far pages of this host have</div>' if i in (600, 699) else ''}"
             for i, t in enumerate(own)]
    df = spark.createDataFrame([(i, "http://h/" if i < 690 or i == 699 else "http://o/", p) for i, p in enumerate(pages)]
                               + [(700, "http://h/", pages[601]), (701, "http://h/", None)],
                               "page_id long, url string, html string")
    want = {i: t + (f"\n\n{quote}" if i % 3 == 0 and i < 600 else "") for i, t in enumerate(own)} | {700: own[601], 701: ""}
    for parts, words in ((1, 1 << 20), (9, 300)):
        monkeypatch.setattr(html, "PART", words)
        assert {r["page_id"]: r["text"] for r in html.extract(df.repartition(parts)).collect()} == want


def test_html_runs_of_several_pages_are_those_of_each():
    long = "x" * html.LONG
    texts = ["a b c d e f g", "", "one\ntwo three", "a b c d\ne f g", f"{long} {long}y {long}z {long}y b {long}", "b c d e f g h é\n中", ""]
    hosts = ["h", "h", "h", "other", "h", "h", ""]
    hashes = html.Runs()
    each = [hashes(t, h) for t, h in zip(texts, hosts)]
    runs = [[(h, *w[i:i + html.RUN]) for i in range(len(w) - html.RUN + 1)]
            for h, w in zip(hosts, (t.replace("\n", " ").split(" ") for t in texts))]
    assert [a.tolist() for a in hashes.pages(texts, hosts)] == [a.tolist() for a in each] == [
        a.tolist() for a in hashes.each(texts, hosts)]
    assert list(map(len, each)) == list(map(len, runs))
    named = dict(zip(sum(runs, []), np.concatenate(each).tolist()))
    assert [named[r] for r in sum(runs, [])] == np.concatenate(each).tolist()
    assert len(set(named.values())) == len(named)
    words = [bytes([65 + i % 7]) * n for n in range(1, 40) for i in range(7)]
    assert len(set(hashes.words(b" ".join(words)).tolist())) == len(words)


def test_repeats_equal_brute_force():
    rng = np.random.default_rng(1)
    streams = [[str(w) for w in rng.integers(0, 4, rng.integers(0, 60))] for _ in range(12)]
    streams += [streams[0], []]
    for run in (1, 3, 6):
        got = html.repeated(streams, run)
        seen: dict = {}
        for s in streams:
            for i in range(len(s) - run + 1):
                seen.setdefault(tuple(s[i:i + run]), set()).add(tuple(s))
        for s, cover in zip(streams, got):
            want = np.zeros(len(s), bool)
            for i in range(len(s) - run + 1):
                if len(seen[tuple(s[i:i + run])]) > 1:
                    want[i:i + run] = True
            assert cover.tolist() == want.tolist()


def test_html_keeps_formulas_and_whole_sentences():
    assert html.main_texts(["<article><p>Energy <math><mi>E</mi>=<mi>m</mi></math> holds</p></article>"]) == ["Energy E=m holds"]
    shared = "the results of the study were published in the journal"
    pages = [f"<p>last week {shared} and drew wide attention</p>", f"<p>he said {shared} before anyone noticed</p>"]
    assert html.main_texts(pages) == [f"last week {shared} and drew wide attention", f"he said {shared} before anyone noticed"]


def test_html_stray_end_tags_take_linear_time():
    import time
    begun = time.perf_counter()
    assert html.main_texts(["<div>" * 100_000 + "</i>" * 100_000 + "<p>end</p>"]) == ["end"]
    assert time.perf_counter() - begun < 20


def test_html_query(spark, sf_small):
    rows = registry.op5_html_text(spark, sf_small).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    import html as entities
    import re
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub("</?(b|br)>", "", p)).split()) for p in re.split("</?p>|</?h1>", body)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_segments_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        scores = [float(x) if x > 0 else -0.5 for x in rng.integers(-3, 3, rng.integers(1, 25))]
        got = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0], 0.5)

        def split(a, b):  # the best segment, then those left and right of it
            best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] <= 0:
                return []
            _, _, i, j = best
            return split(a, i) + [(sum(scores[i:j]), i, j - 1)] + split(j, b)

        assert sum(s for s, _, _ in got) == pytest.approx(sum(s for s, _, _ in split(0, len(scores))))
        assert max((s for s, _, _ in got), default=0) == pytest.approx(max((s for s, _, _ in split(0, len(scores))), default=0))


def test_toxicity_learns_stems_and_finds_passages(spark):
    rng = np.random.default_rng(3)
    clean = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for _ in range(300)]
    bad = [t + " you vilename" + "xyz"[i % 3] + " vilenames " + t for i, t in enumerate(clean[:80])]
    docs = [(i, t) for i, t in enumerate(bad + clean[80:])]
    df = spark.createDataFrame(docs + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 80)) for i, _ in docs] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_documents(df, model).collect()}
    assert all((scored[i] >= 0.3) == (i < 80) for i, _ in docs) and scored[9000] == scored[9001] < 0.3
    found = {r["doc_id"]: r for r in toxicity.find_passages(df, model).collect()}
    assert set(found) == set(range(80))
    assert all("vilename" in bad[i][r["begin"]:r["end"]] and r["end"] - r["begin"] < 40 for i, r in found.items())
    kept = toxicity.reject(df.withColumn("toxicity", F.lit("own")), labels)
    assert kept.columns == ["doc_id", "text", "toxicity"] and kept.count() == len(docs) - 80 + 2


def test_toxicity_drops_real_copies_only(spark):
    rng = np.random.default_rng(5)
    texts = ["the " + " ".join(f"w{x}" for x in rng.integers(0, 3000, 80)) for _ in range(300)]  # share one word
    near = [texts[0].rsplit(" ", i)[0] + f" n{i}" for i in (1, 2, 3, 4)]
    rows = [(0, t) for t in texts + near + texts[:50] + [None, "", " "]] + [(1, t) for t in texts[:20] + texts[:20]]
    df = spark.createDataFrame(rows, "toxic int, text string")
    got = [tuple(r) for r in toxicity.drop_copies(df).collect()]
    assert sorted(t for c, t in got if c) == sorted(texts[:20])
    kept = {t for c, t in got if not c}
    assert set(texts[1:]) <= kept and len(kept & {texts[0], *near}) == 1 and len(got) == 20 + 300 + 1
    assert sorted(map(tuple, toxicity.drop_copies(df.repartition(7)).collect())) == sorted(got)
    sign = toxicity.Signer()
    for a in rng.random(50):  # the share of agreeing values estimates the Jaccard similarity
        one, two = {f"a{i}" for i in range(200)}, {f"a{i}" for i in range(int(a * 200), 200 + int(a * 200))}
        assert abs((sign(" ".join(one)) == sign(" ".join(two))).mean() - len(one & two) / len(one | two)) < 0.17


def test_toxicity_query_held_out(spark):
    import pandas as pd

    got = registry.op8_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    y, rank = both["toxic"] == 1, both["score"].rank()
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.93 and both["predicted"][~y].mean() < 0.02 and both["predicted"][y].mean() > 0.75
