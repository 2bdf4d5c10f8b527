"""Toxicity by maximum-scoring segments (operator 8).

Training, from a bounded sample of labelled rows (at most MAX_TRAIN, the ones
with the smallest hash of their id):

* a token's features are the lower-cased word and its prefixes of four to six
  letters, so inflected forms share what is learned of their stem;
* copies count once, so that one toxic text copied many times does not make
  its other words toxic: equal texts, and texts of one class whose word sets
  have a Jaccard similarity of COPY or more, estimated from SIGNS MinHash
  values; the text with the smallest digest stays (see ``drop_copies``);
* the log-odds of a feature between the classes are smoothed by a Dirichlet
  prior in proportion to its frequency in the whole corpus, and features whose
  log-odds stand out by MIN_Z standard errors form the model, at most
  MAX_TERMS of them.

Scoring: a token scores the log-odds of its strongest feature, any other token
the (negative) log-odds of not being one.  One linear scan finds all maximal
scoring segments of the whole text.  By extreme-value theory a clean text of n
tokens holds ``K n exp(-S)`` segments of score S or more (scores are log-odds,
so lambda is 1; K comes from the clean training texts).  A segment with an
expected count below ALPHA is a toxic passage; the best segment's
``S - log(K n)`` is mapped to a probability by a logistic fit on the sample.

Edge cases: null and empty texts have no tokens and get the score of a text
without segment; rows with a null label are not trained on; repeated labels of
one id are combined by their maximum; null ids are never labelled; without
both classes the score is the prior of the sample (0.0 when it is empty).
Extra columns are kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, fresh, pieces, ship, stage, tidy

TOKEN = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
#: Bounds of the sample and of the model (which every task holds).
MAX_TRAIN, MAX_TERMS = 50_000, 20_000
MIN_Z, PRIOR, FLOOR, ALPHA, THRESHOLD = 3.0, 500.0, 0.5, 0.01, 0.3
#: MinHash values of a text, how many of them make a band, and the bands compared.
SIGNS, BAND, BANDS, COPY = 128, 4, 16, 0.8
#: Distinct features a counting task holds before it passes them on, and words whose values a task keeps.
FLUSH, KNOWN = 300_000, 250_000


def rows_of(batch: pa.RecordBatch):
    """Its rows, the last column texts, of which a part is held as Python values at a time."""
    for part in pieces(batch, batch.num_columns - 1):
        yield from zip(*(c.to_pylist() for c in part.columns))


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def features(word: str) -> list[str]:
    """The word, and its prefixes marked as such."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments: (score, first token, last token).

    ``hits``: position and score of the positive tokens, ascending; each token
    between scores ``-drift``.  Every candidate remembers the running total
    before and after it; a new one joins the candidates back to the nearest
    that began lower, as long as that makes a higher end.
    """
    found: list[tuple[float, float, int, int]] = []
    total, last = 0.0, -1
    for at, score in hits:
        total -= drift * (at - last - 1)
        low, high, first = total, total + score, at
        total, last = high, at
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j -= 1
            if j < 0 or found[j][1] >= high:
                found.append((low, high, first, at))
                break
            low, first = found[j][0], found[j][2]
            del found[j:]
    return [(high - low, first, end) for low, high, first, end in found]


@dataclass
class Model:
    """Bounded: at most MAX_TERMS log-odds and a few numbers."""

    odds: dict[str, float] = field(default_factory=dict)
    drift: float = 0.01
    k: float = 1e-3
    intercept: float = 0.0
    slope: float = 0.0
    base: float = 0.0
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        score = self._known.get(word)
        if score is None:
            if len(self._known) > KNOWN:
                self._known.clear()
            score = self._known[word] = max((self.odds.get(f, 0.0) for f in features(word)), default=0.0)
        return score

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        toxic = {w: s for w in set(words) if (s := self.word(w)) > 0}
        return [(i, toxic[w]) for i, w in enumerate(words) if w in toxic] if toxic else []

    def best(self, text: str | None) -> tuple[float, int]:
        """Best segment's score and the number of tokens."""
        words = tokens(text)
        found = segments(self.hits(words), self.drift)
        return max((s for s, _, _ in found), default=0.0), len(words)

    def excess(self, score: float, n: int) -> float:
        """-log of the number of segments as good that a clean text of that length
        holds; 0 without a segment, or if a clean text holds one or more."""
        return max(0.0, score - math.log(self.k * max(n, 1))) if score > 0 else 0.0

    def probability(self, score: float, n: int) -> float:
        if not self.odds:
            return self.base
        z = self.intercept + self.slope * self.excess(score, n)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_labels(labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """At most ``most`` rows (doc_id, toxic) outside the held-out quarter, by hash of the id."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
    rows = rows.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return stage(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def _count(df: DataFrame, groups: int, spread) -> DataFrame:
    """feature, n0 .. : in how many rows of each group a feature occurs.

    ``spread`` gives the pair (groups of the row, its features); counts are
    combined in the task and passed on whenever FLUSH features have come up.
    """
    ship(df.sparkSession)
    names = [f"n{i}" for i in range(groups)]

    def run(batches):
        held = [Counter() for _ in names]

        def flush():
            keys = list(set().union(*held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([h[k] for k in keys], pa.int64()) for h in held)],
                names=["feature", *names])
            for h in held:
                h.clear()

        for batch in batches:
            for row in rows_of(batch):
                own, found = spread(*row)
                for i in own:
                    held[i].update(found)
                if sum(map(len, held)) > FLUSH:
                    yield from flush()
        yield from flush()

    rows = df.mapInArrow(tidy(run), "feature string, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("feature").agg(*(F.sum(n).alias(n) for n in names))


def log_odds(toxic, clean, toxic_total: float, clean_total: float, prior, prior_total: float):
    """Log-odds of a feature between the classes and their standard error."""
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (toxic_total + prior_total - a)) - np.log(b / (clean_total + prior_total - b))
    return odds, np.sqrt(1 / a + 1 / b)


class Signer:
    """MinHash values of the set of tokens of a text (all ones without tokens)."""

    def __init__(self):
        self.known: dict[str, int] = {}
        made = np.random.default_rng(8).integers(0, 1 << 62, (2, SIGNS, 1), np.uint64)
        self.factor, self.shift = made[0] * np.uint64(2) + np.uint64(1), made[1]

    def _word(self, word: str) -> int:
        h = self.known.get(word)
        if h is None:
            if len(self.known) > KNOWN:
                self.known.clear()
            h = self.known[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = set(tokens(text))
        least = np.full(SIGNS, (1 << 32) - 1, np.uint32)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        for i in range(0, len(h), 4096):
            mixed = (h[i:i + 4096] ^ self.shift) * self.factor
            mixed = (mixed ^ (mixed >> np.uint64(29))) * self.factor
            least = np.minimum(least, (mixed >> np.uint64(32)).astype(np.uint32).min(axis=1))
        return least


def drop_copies(rows: DataFrame) -> DataFrame:
    """One row (toxic, text) of each group of copies: the one whose text has the smallest md5.

    Equal texts go first, by a grouping that the map side combines.  Of the
    rest, each band of the signature has a head, the row with the smallest
    digest; a row goes if at least COPY of all SIGNS values agree with those
    of a head of one of its bands.  At most MAX_TRAIN rows come in, so the heads
    (a digest and SIGNS numbers) are bounded and broadcast, and no task gets the
    rows of one band.
    """
    ship(rows.sparkSession)
    rows = stage(rows.select("toxic", F.coalesce("text", F.lit("")).alias("text")).groupBy("toxic", "text").agg(
        F.lit(1)).select("toxic", "text", F.md5(F.col("text").cast("binary")).alias("name")))
    schema = pa.schema([("toxic", pa.int32()), ("name", pa.string()), ("signs", pa.binary()), ("bands", pa.list_(pa.binary()))])

    def sign(batches):
        make = Signer()
        for batch in batches:
            out = []
            for toxic, text, name in zip(*(c.to_pylist() for c in batch.columns)):
                signs = make(text)
                out.append({"toxic": toxic, "name": name, "signs": signs.tobytes(),
                            "bands": [bytes([i]) + signs[i * BAND:(i + 1) * BAND].tobytes() for i in range(BANDS)]})
            yield pa.RecordBatch.from_pylist(out, schema)

    signed = stage(rows.mapInArrow(tidy(sign), "toxic int, name string, signs binary, bands array<binary>"))
    banded = signed.select("toxic", "name", F.explode("bands").alias("band"))
    heads = stage(banded.groupBy("toxic", "band").agg(F.min("name").alias("head"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1").drop("n"))
    wanted = heads.select("toxic", F.col("head").alias("name")).distinct()
    marks = signed.join(F.broadcast(wanted), ["toxic", "name"]).select(
        "toxic", F.col("name").alias("head"), F.col("signs").alias("other"))
    pairs = signed.select("toxic", "name", "signs", F.explode("bands").alias("band")).join(
        F.broadcast(heads), ["toxic", "band"]).filter("name <> head").drop("band").join(
        F.broadcast(marks), ["toxic", "head"]).select("toxic", "name", "signs", "other")

    def agree(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, SIGNS) for i in (2, 3))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["toxic", "name"]).filter(
                pa.array((a == b).mean(axis=1) >= COPY))

    copies = stage(pairs.mapInArrow(tidy(agree), "toxic int, name string").distinct())
    return rows.join(F.broadcast(copies), ["toxic", "name"], "left_anti").select("toxic", "text")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most: int = MAX_TRAIN) -> Model:
    """Fit the model on ``docs`` (all of them give the prior) and ``labels`` (doc_id, toxic)."""
    body = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    marked = body.join(F.broadcast(sample_labels(labels, most)), "doc_id")
    rows = stage(drop_copies(marked.select((F.col("toxic") > 0).cast("int").alias("toxic"), "text")))

    counts = stage(_count(rows, 2, lambda toxic, text: ((int(toxic > 0),), {
        f for w in set(tokens(text)) for f in features(w)})).select(
            "feature", F.col("n1").alias("toxic"), F.col("n0").alias("clean")))
    total = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic_total, clean_total = (float(x or 0) for x in total)
    if not toxic_total or not clean_total:
        return Model(base=1.0 if toxic_total else 0.0)

    a, b = F.col("toxic") + FLOOR, F.col("clean") + FLOOR
    first = (F.log(a / toxic_total) - F.log(b / clean_total)) / F.sqrt(1 / a + 1 / b)
    terms = counts.withColumn("z", first).filter(F.col("z") > MIN_Z / 2).orderBy(
        F.desc("z"), "feature").limit(MAX_TERMS).toPandas()
    if terms.empty:
        return Model(base=0.0)

    wanted = frozenset(terms["feature"])
    corpus = _count(body.select("text"), 1, lambda text: ((0,), {
        f for w in set(tokens(text)) for f in features(w) if f in wanted})).toPandas()
    in_corpus = terms["feature"].map(dict(zip(corpus["feature"], corpus["n0"]))).fillna(0).to_numpy(float)
    prior = FLOOR + PRIOR * in_corpus / (in_corpus.sum() + toxic_total + clean_total)
    odds, error = log_odds(terms["toxic"].to_numpy(float), terms["clean"].to_numpy(float),
                           toxic_total, clean_total, prior, PRIOR)
    good = (odds / error >= MIN_Z) & (odds > 0)
    model = Model(odds=dict(zip(terms["feature"][good], odds[good].tolist())))
    if not model.odds:
        return Model(base=0.0)
    return _calibrate(model, rows)


def _calibrate(model: Model, rows: DataFrame) -> Model:
    """Drift, K and the logistic map from the sample, at most MAX_TRAIN rows."""

    def hit_rate(batches):
        for batch in batches:
            out = []
            for toxic, text in rows_of(batch):
                words = tokens(text)
                out.append({"toxic": int(toxic > 0), "hits": len(model.hits(words)), "n": len(words)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("toxic", pa.int32()), ("hits", pa.int64()), ("n", pa.int64())]))

    rates = rows.mapInArrow(tidy(hit_rate), "toxic int, hits long, n long").groupBy("toxic").agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    rate = {r["toxic"]: (r["hits"] + FLOOR) / (r["n"] + 1) for r in rates}
    model.drift = max(0.01, math.log((1 - min(rate[0], 0.5)) / (1 - min(rate[1], 0.5))))

    def best(batches):
        for batch in batches:
            out = []
            for toxic, text in rows_of(batch):
                score, n = model.best(text)
                out.append({"toxic": int(toxic > 0), "score": score, "n": n})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("toxic", pa.int32()), ("score", pa.float64()), ("n", pa.int64())]))

    seen = rows.mapInArrow(tidy(best), "toxic int, score double, n long").toPandas().sort_values(
        ["toxic", "score", "n"])  # a fixed order, so that reruns add up alike
    y, score = seen["toxic"].to_numpy(float), seen["score"].to_numpy(float)
    n = np.maximum(seen["n"].to_numpy(float), 1)
    least = min(model.odds.values())
    clean = y == 0
    model.k = float((np.sum(score[clean] >= least) + FLOOR) / (n[clean].sum() * math.exp(-least)))
    x = np.where(score > 0, np.maximum(0.0, score - np.log(model.k * n)), 0.0)

    centre, width = x.mean(), x.std() or 1.0
    design, beta = np.stack([np.ones_like(x), (x - centre) / width], 1), np.zeros(2)
    for _ in range(50):  # Newton steps of a ridge-penalised logistic fit
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - [0, beta[1]]
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1.0]), slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    model.slope = float(max(0.0, beta[1] / width))
    model.intercept = float(beta[0] - model.slope * centre)
    return model


def score_documents(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability that the whole text is toxic."""
    ship(df.sparkSession)
    base = df.drop(name)
    place = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            made = [model.probability(*model.best(t)) for (t,) in rows_of(batch.select([place]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())],
                                             names=[*batch.schema.names, name])

    return base.mapInArrow(tidy(run), T.StructType([*base.schema.fields, T.StructField(name, T.DoubleType())]))


def find_passages(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                  alpha: float = ALPHA) -> DataFrame:
    """Every significant toxic passage: doc_id, begin, end (code points), score, expected."""
    ship(df.sparkSession)
    body = df.select(column(df, id_col).cast("long").alias("doc_id"), column(df, text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()),
                        ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches):
        for batch in batches:
            out = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                low = (text or "").lower()
                low = low if len(low) == len(text or "") else "".join(
                    c.lower() if len(c.lower()) == 1 else c for c in text)
                spans = [m.span() for m in TOKEN.finditer(low)]
                words = [low[a:b] for a, b in spans]
                for score, first, last in segments(model.hits(words), model.drift):
                    if (expected := math.exp(-model.excess(score, len(words)))) <= alpha:
                        out.append({"doc_id": key, "begin": spans[first][0], "end": spans[last][1],
                                    "score": score, "expected": expected})
            yield pa.RecordBatch.from_pylist(out, schema)

    return body.mapInArrow(tidy(run), "doc_id long, begin long, end long, score double, expected double")


def reject(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score below ``threshold``."""
    name = fresh(df, "toxicity")
    scored = score_documents(df, train(df, labels, id_col, text_col), text_col, name)
    return scored.filter(F.col(name) < threshold).select(*df.columns)
