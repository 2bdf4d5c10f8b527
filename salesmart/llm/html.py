"""HTML extraction by repeated runs of a host (operator 5).

1. Every page becomes blocks of visible words.  Scripts, styles and other
   markup never show; each block knows whether it stands in the article (or
   main) element, and whether an element around it is marked as something else
   (menu, footer, sidebar, notice, advert, form, reader comments).  A class
   name counts by its last word (site-footer, not footer-free or has-footer);
   an article or main element ends the marks of what is around it.
2. Runs of RUN words that two or more distinct pages of a host hold are
   repeated, over the whole table: each part of the pages (about PART words)
   sends its distinct runs as 64-bit hashes, with the host, to buckets of the
   hashes; a bucket adds up the pages of each run and answers every part with
   its repeated ones.  The answers lie in the shared folder, one file per part
   and bucket.  Hashes go in SLICES turns, which bounds the disk.
   ``repeated`` finds the same runs of a few pages by a suffix array.
3. Words covered by repeats are boilerplate and leave; unique runs stay.  In an
   article a block leaves only if nearly all of it (WHOLE) is covered by runs
   on MANY pages and a SHARE of the host's pages: a passage that some articles
   quote stays.  Where there is an article nothing outside it is main text.
   Pages with the same words count as one page, and a page of which nothing
   would be left (a mirror) keeps its blocks.

Edge cases: null and empty html give an empty text; unclosed elements end with
their parent; character references are decoded, cut ones stay as they are;
a null or relative url has an empty host; repeated pages are all returned; an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SharedFile, column, open_folder, release, shared_folder, ship, slices, stage

RUN, PART, BUCKET, SLICES = 6, 1 << 20, 1 << 21, 3
#: When a block of an article is boilerplate: share of its words covered, pages of the host and their share.
WHOLE, MANY, SHARE = 0.9, 8, 0.5
MIX, STEP = np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: The lowest 0 to 8 bytes; bytes of a word from which it is hashed alone; characters of the pages hashed together.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG, TOGETHER = 256, 1 << 16

# Element names and the words in class, id and role that mark what is not the article.
HIDDEN = frozenset("script style template noscript iframe svg head title select textarea button datalist".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var img wbr "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mspace msub msup msubsup munder mover munderover".split())
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                  "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
                  "sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer comment comments "
                  "commentlist reply replies disqus respond share sharing social related recommended recommendations "
                  "pagination pager toolbar search complementary contentinfo dialog skip hidden".split())
HEADS = frozenset("header masthead topbar".split())
#: Marks that a text element inside an article may have as its own class.
SOFT = frozenset("notice notices alert related search social".split())
TEXTS = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th".split())
#: Names that speak of the layout (has-sidebar, content-with-nav), and ends that only say how a marked box is built.
LAYOUT = frozenset("has no not with without is hide show if".split())
BOXES = frozenset("area areas wrapper wrap container content box bar block blocks list lists section slot slots inner outer unit "
                  "left right top bottom item items links posts articles stories primary secondary".split())
MAIN = frozenset(("article", "main"))
PARTS = re.compile(r"[a-z]+")


@lru_cache(maxsize=4096)
def marks(value: str) -> frozenset[str]:
    """The marks among the names in a class, id or role: a name ends in one, apart from words for boxes."""
    found = set()
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
        parts = PARTS.findall(name)
        if LAYOUT.intersection(parts):
            continue
        while len(parts) > 1 and parts[-1] in BOXES:
            parts.pop()
        found.update(parts[-1:])
    return frozenset(found & (MARKS | HEADS))


@dataclass
class Block:
    text: str
    level: int  # 2: in an article, 1: in main, 0: elsewhere
    marked: bool
    outer: bool = False  # its article or main element stands in something marked


class Blocks(HTMLParser):
    """The visible blocks of a page, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # element, hidden, marked, level, outer
        self.open: list[tuple[str, bool, bool, int, bool]] = [("", False, False, 0, False)]
        self.names: dict[str, int] = {}  # open elements by name
        self.words: list[str] = []
        self.found: list[Block] = []

    def updatepos(self, i, j):
        return j  # nothing asks for lines and columns

    def end_block(self):
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                _, _, marked, level, outer = self.open[-1]
                self.found.append(Block(text, level, marked, outer))
            self.words = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            if not self.open[-1][1]:
                self.words.append(" ")
            return
        if tag not in INLINE:
            self.end_block()
        if tag in VOID:
            return
        if tag == "p" or tag == "li":  # an open one ends here
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] == tag:
                    self.close_from(i)
                    break
                if self.open[i][0] not in INLINE and self.open[i][0] != "p":
                    break
        _, hidden, marked, level, outer = self.open[-1]
        own = 2 if tag == "article" else 1 if tag == "main" else 0
        if own > level:  # the marks of what is around it end here
            level, outer, marked = own, outer or marked, False
        if tag not in ("html", "body", "article", "main") and not marked:
            named = frozenset().union(*(marks(v) for k, v in attrs if k in ("class", "id", "role") and v))
            if level and tag in TEXTS:
                named -= SOFT
            marked = (tag in ASIDE or bool(named & MARKS) or level == 0 and (tag == "header" or bool(named & HEADS)))
        hidden = hidden or tag in HIDDEN or any(k == "hidden" for k, _ in attrs)
        self.open.append((tag, hidden, marked, level, outer))
        self.names[tag] = self.names.get(tag, 0) + 1

    def close_from(self, i: int):
        for name, *_ in self.open[i:]:
            self.names[name] -= 1
        del self.open[i:]

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.end_block()
        if not self.names.get(tag):  # else a page of stray end tags would walk its open elements again and again
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.close_from(i)
                break

    def handle_data(self, data):
        if not self.open[-1][1]:
            self.words.append(data)


def blocks(html: str | None) -> list[Block]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.found


def repeated(streams: list[list[str]], run: int = RUN) -> list[np.ndarray]:
    """Per stream of words, which of them lie in ``run`` words that a different stream repeats."""
    sizes = [len(s) for s in streams]
    if not sum(sizes):
        return [np.zeros(0, bool) for _ in streams]
    names, where = {}, []
    for i, s in enumerate(streams):
        where.append(names.setdefault(tuple(s), i))  # equal streams are one page
    number: dict[str, int] = {}
    flat: list[int] = []
    for i, s in enumerate(streams):
        flat.extend(number.setdefault(w, len(number)) for w in s)
        flat.append(-1 - i)
    rank = np.unique(np.array(flat), return_inverse=True)[1].astype(np.int64)
    page = np.repeat(np.array(where), np.array(sizes) + 1)
    length = 1
    while length < run:
        step = min(length, run - length)
        ahead = np.concatenate([rank[step:], np.full(step, -1)])
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        length += step
    suffixes = np.argsort(rank, kind="stable")
    same = rank[suffixes[1:]] == rank[suffixes[:-1]]
    group = np.concatenate([[0], np.cumsum(~same)])
    first = page[suffixes][np.concatenate([[0], np.flatnonzero(~same) + 1])]
    other = np.zeros(group[-1] + 1, bool)
    other[group[page[suffixes] != first[group]]] = True
    starts = np.zeros(len(rank) + 1, np.int64)
    begin = suffixes[other[group]]
    starts[begin] += 1
    np.subtract.at(starts, np.minimum(begin + run, len(rank)), 1)
    covered = np.cumsum(starts)[:-1] > 0
    ends = np.cumsum(np.array(sizes) + 1)
    return [covered[e - n - 1:e - 1] for e, n in zip(ends, sizes)]


def chosen(page: list[Block]) -> list[bool]:
    """Which blocks are main text unless repeated: the unmarked ones of the highest level.

    An article whose surroundings are marked (a form or a layout box around the
    whole page) counts if no other article is there and it holds more
    characters than the unmarked blocks; if every block is marked, all count.
    """
    free = [not (b.marked or b.outer) for b in page]
    level = max((b.level for b, f in zip(page, free) if f), default=0)
    if not level:
        inner = [b.outer and not b.marked for b in page]
        if sum(len(b.text) for b, i in zip(page, inner) if i) > sum(len(b.text) for b, f in zip(page, free) if f):
            free, level = inner, max(b.level for b, i in zip(page, inner) if i)
    if not any(free):
        return [True] * len(page)
    return [f and b.level == level for b, f in zip(page, free)]


def main_text(texts: list[str], wanted: list[bool], trusted: bool, cover: np.ndarray, often: np.ndarray) -> str:
    """The wanted blocks without boilerplate; ``cover`` and ``often`` say which words lie in repeats and in common ones."""
    if not (often if trusted else cover).any():
        return "\n\n".join(t for t, take in zip(texts, wanted) if take)
    at, kept = 0, []
    for text, take in zip(texts, wanted):
        own = text.split(" ")
        here = slice(at, at + len(own))
        at += len(own)
        if not take:
            continue
        # a block leaves as a whole or not at all: no words are cut out of sentences
        if (often if trusted else cover)[here].mean() < WHOLE:
            kept.append(text)
    kept = [k for k in kept if k] or [t for t, take in zip(texts, wanted) if take]
    return "\n\n".join(kept)


def judged(page: list[Block]) -> tuple[list[bool], bool]:
    """The chosen blocks, and whether they are those of an article."""
    wanted = chosen(page)
    return wanted, any(w and b.level and not b.marked for w, b in zip(wanted, page))


def main_texts(pages: list[str | None]) -> list[str]:
    """Main texts of a few pages of a host."""
    found = [blocks(p) for p in pages]
    streams = [[w for b in page for w in b.text.split(" ")] for page in found]
    hashes, cover = Runs(), repeated(streams)
    runs, counts = np.unique(np.concatenate([np.zeros(0, np.uint64)] + [
        np.unique(hashes(" ".join(s), "")) for s in dict(zip(map(tuple, streams), streams)).values()]), return_counts=True)
    least = max(MANY, SHARE * len(set(map(tuple, streams))))
    out = []
    for page, stream, gone in zip(found, streams, cover):
        wanted, trusted = judged(page)
        out.append(main_text([b.text for b in page], wanted, trusted, gone,
                             spread(np.isin(hashes(" ".join(stream), ""), runs[counts >= least]), len(stream))))
    return out


class Runs:
    """Hashes of the runs of RUN words of a page."""

    def host(self, host: str) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest("//" + host)], np.uint64)

    def words(self, raw: bytes) -> np.ndarray:
        """A hash per word, eight bytes at a time; words have one space or line feed between them."""
        data = np.frombuffer(raw + bytes(8), np.uint8)
        eight = np.ndarray((len(raw) + 1,), "<u8", data, strides=(1,))
        begin = np.concatenate([[0], np.flatnonzero((data[:len(raw)] == 32) | (data[:len(raw)] == 10)) + 1])
        size = np.append(begin[1:] - 1, len(raw)) - begin
        out = size.astype(np.uint64) * MIX
        rest, at = np.arange(len(size)), 0
        while len(rest):
            part = (eight[begin[rest] + at] & MASKS[np.minimum(size[rest] - at, 8)]) * STEP
            part = (out[rest] ^ part ^ (part >> np.uint64(32))) * MIX
            out[rest] = part ^ (part >> np.uint64(29))
            at += 8
            rest = rest[size[rest] > at]
            if at == LONG:
                for i in rest.tolist():
                    out[i] = xxhash.xxh3_64_intdigest(raw[begin[i]:begin[i] + size[i]])
                break
        return out

    def pages(self, texts: list[str], hosts: list[str]) -> list[np.ndarray]:
        """The hashes of some pages: their words (see ``words``) and hosts."""
        counts = np.array([t.count(" ") + t.count("\n") + 1 if t else 0 for t in texts])
        ends = np.cumsum(counts)
        if not len(ends) or ends[-1] < RUN:
            return [np.zeros(0, np.uint64)] * len(texts)
        h = self.words("\n".join(filter(None, texts)).encode())
        n = len(h) - RUN + 1
        total = np.zeros(n, np.uint64)
        for i in range(RUN):
            total = (total ^ (total >> np.uint64(31))) * STEP + h[i:i + n]
        total = (total ^ (total >> np.uint64(30))) * MIX
        total += np.repeat(np.concatenate(list(map(self.host, hosts))), counts)[:n]
        total = (total ^ (total >> np.uint64(31))) * STEP
        # runs from one page into the next are left out
        return [total[e - c:max(e - c, e - RUN + 1)] for c, e in zip(counts.tolist(), ends.tolist())]

    def each(self, texts: list[str], hosts: list[str]):
        """``pages``, a few at a time."""
        for a, b in slices(texts, TOGETHER):
            yield from self.pages(texts[a:b], hosts[a:b])

    def __call__(self, text: str, host: str) -> np.ndarray:
        return self.pages([text], [host])[0]


def spread(starts: np.ndarray, n: int) -> np.ndarray:
    """Of n words, which lie in a run that ``starts`` marks."""
    at = np.zeros(n + 1, np.int64)
    at[:len(starts)] += starts
    at[RUN:RUN + len(starts)] -= starts[:max(0, n + 1 - RUN)]
    return np.cumsum(at)[:n] > 0


def pack(hashes: np.ndarray) -> bytes:
    """Ascending hashes as differences, byte by byte place, compressed."""
    planes = np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return len(hashes).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype(np.uint32).tobytes(), "zstd", asbytes=True)


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint32)


def read_files(folder: str, part: int) -> list[bytes]:
    import pyarrow.fs

    fs, base = open_folder(folder)
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/{part}", allow_not_found=True))
    out = []
    for f in sorted(f.path for f in found if f.is_file and not f.base_name.startswith(".")):
        with fs.open_input_stream(f, compression=None) as data:
            out.append(data.read())
    return out


def parsed(df: DataFrame) -> DataFrame:
    """page_id, url, host, part, place, words, digest, trusted, wanted, text of every page.

    ``text`` holds the blocks, one per line, ``wanted`` a byte for each.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("part", pa.int64()),
                        ("place", pa.int32()), ("words", pa.int64()), ("digest", pa.binary()), ("trusted", pa.bool_()),
                        ("wanted", pa.binary()), ("text", pa.string())])

    def run(batches):
        part, place, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            out = []
            for key, url, html, host in zip(*(c.to_pylist() for c in batch.columns)):
                page = blocks(html)
                wanted, trusted = judged(page)
                text = "\n".join(b.text for b in page)
                stream = text.replace("\n", " ")
                words = stream.count(" ") + 1 if stream else 0
                if size and size + words > PART:
                    part, place, size = part + 1, 0, 0
                out.append({"page_id": key, "url": url, "host": host, "part": part, "place": place, "words": words,
                            "digest": hashlib.blake2b(f"{host}\n{stream}".encode("utf-8", "replace"), digest_size=16).digest(),
                            "trusted": trusted, "wanted": bytes(wanted), "text": text})
                place, size = place + 1, size + words
            yield pa.RecordBatch.from_pylist(out, schema)

    return df.mapInArrow(run, "page_id long, url string, host string, part long, place int, words long, digest binary, "
                              "trusted boolean, wanted binary, text string")


def copies(pages: DataFrame) -> str:
    """Folder with the places of pages whose words an earlier page of the host has, a file per part."""
    folder = shared_folder(pages.sparkSession)
    keys = pages.select("digest", "part", "place")
    first = stage(keys.groupBy("digest").agg(F.min(F.struct("part", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").drop("n"))
    again = keys.join(first, "digest").filter(F.struct("part", "place") != F.col("first"))

    def write(batches):
        for batch in batches:
            for part, places in zip(*(c.to_pylist() for c in batch.columns)):
                with SharedFile(f"{folder}/{part}", "copies") as file:
                    file.write(np.array(sorted(places), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["part"])

    again.groupBy("part").agg(F.collect_list("place")).mapInArrow(write, "part long").agg(F.count("part")).first()
    return folder


def repeats(pages: DataFrame, buckets: int, slices: int = SLICES) -> str:
    """Folder with the repeated runs of each part and the number of pages that hold them."""
    spark = pages.sparkSession
    twice, folder = copies(pages), shared_folder(spark)

    def send(turn):
        def run(batches):
            hashes, at, held, again, size = Runs(), None, [], frozenset(), 0

            def flush():
                every = np.sort(np.concatenate([h for h, _ in held]))
                begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[:len(every)])
                runs, counts = every[begin], np.diff(begin, append=len(every))
                for h, counted in held:
                    if not counted:  # the same words were counted before
                        counts[np.searchsorted(runs, h)] -= 1
                bucket = ((runs >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                for i in range(buckets):
                    a, b = edges[i], edges[i + 1]
                    if a < b:
                        yield {"bucket": i, "part": at, "runs": pack(runs[a:b]), "counts": pack_counts(counts[a:b])}

            def sent():
                return pa.RecordBatch.from_pylist(list(flush()), pa.schema(
                    [("bucket", pa.int32()), ("part", pa.int64()), ("runs", pa.binary()), ("counts", pa.binary())]))

            for batch in batches:
                hosts, parts, places, texts = (c.to_pylist() for c in batch.columns)
                for part, place, host, own in zip(parts, places, hosts, hashes.each(texts, hosts)):
                    if part != at or size > 2 * PART:
                        if held:
                            yield sent()
                        if part != at:
                            again = frozenset(x for f in read_files(twice, part) for x in np.frombuffer(f, np.int32).tolist())
                        at, held, size = part, [], 0
                    size += len(own)
                    own = np.concatenate([own, hashes.host(host)])
                    held.append((np.unique(own[own % np.uint64(slices) == turn]), place not in again))
            if held:
                yield sent()

        return run

    def add(batches):
        at, held = None, []

        def flush():
            every = np.sort(np.concatenate([r for _, r, _ in held] + [r[c > 1] for _, r, c in held]))
            runs = every[:-1][every[1:] == every[:-1]]  # of several parts, or of several pages of one
            runs = runs[np.concatenate([[True], runs[1:] != runs[:-1]])[:len(runs)]]
            total, found = np.zeros(len(runs) + 1, np.int64), []
            for _, own, counts in held:
                spot = np.searchsorted(own, runs)
                own = np.append(own, np.uint64(0))
                found.append(np.flatnonzero((own[spot] == runs) & (spot < len(own) - 1)))
                total[found[-1]] += counts[spot[found[-1]]]
            out = []
            for (part, _, _), here in zip(held, found):
                here = here[total[here] > 1]
                if len(here):
                    out.append({"bucket": at, "part": part, "runs": pack(runs[here]), "counts": pack_counts(total[here])})
            return pa.RecordBatch.from_pylist(out, pa.schema(
                [("bucket", pa.int32()), ("part", pa.int64()), ("runs", pa.binary()), ("counts", pa.binary())]))

        for batch in batches:
            for bucket, part, runs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at and held:
                    yield flush()
                    held = []
                at = bucket
                own = unpack(runs)
                held.append((part, own, unpack_counts(counts, len(own))))
        if held:
            yield flush()

    fields = "bucket int, part long, runs binary, counts binary"
    for turn in range(slices):
        def write(batches, turn=turn):
            for batch in batches:
                for bucket, part, runs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                    for i, (r, c) in enumerate(zip(runs, counts)):
                        with SharedFile(f"{folder}/{part}", f"{turn}-{bucket}-{i}") as file:
                            file.write(len(r).to_bytes(8, "little") + r + c)
                yield pa.RecordBatch.from_arrays([batch.column(1)], names=["part"])

        sent = pages.select("host", "part", "place", "text").mapInArrow(send(np.uint64(turn)), fields)
        answers = stage(sent.repartition("bucket").sortWithinPartitions("bucket", "part").mapInArrow(add, fields))
        answers.select("bucket", "part", F.array("runs").alias("runs"), F.array("counts").alias("counts")).groupBy("bucket", "part").agg(
                F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("counts")).alias("counts")).mapInArrow(
                    write, "part long").agg(F.count("part")).first()
        del sent, answers
        release(spark)
    return folder


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text of every page."""
    ship(df.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(column(df, url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = df.select(column(df, id_col).cast("long").alias("page_id"), column(df, url_col).alias("url"),
                     column(df, html_col).alias("html"), host.alias("host"))
    pages = stage(parsed(rows.select("page_id", "url", "html", "host")))
    words = pages.agg(F.sum("words")).first()[0] or 0
    folder = repeats(pages, max(1, -(-words // BUCKET), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))

    def run(batches):
        hashes, at = Runs(), None
        for batch in batches:
            ids, urls, hosts, parts, trust, want, texts = (c.to_pylist() for c in batch.columns)
            out = []
            for host, part, trusted, wanted, text, own in zip(hosts, parts, trust, want, texts, hashes.each(texts, hosts)):
                if part != at:
                    at, runs, counts = part, [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
                    for data in read_files(folder, part):
                        n = int.from_bytes(data[:8], "little")
                        runs.append(unpack(data[8:8 + n]))
                        counts.append(unpack_counts(data[8 + n:], len(runs[-1])))
                    runs, place = np.unique(np.concatenate(runs), return_index=True)
                    counts = np.append(np.concatenate(counts)[place], np.uint32(0))
                    runs = np.append(runs, np.uint64(0))
                n = text.count(" ") + text.count("\n") + 1 if text else 0
                own = np.concatenate([own, hashes.host(host)])
                spot = np.searchsorted(runs[:-1], own)
                seen = np.where(runs[spot] == own, counts[spot], 0)
                least = max(MANY, SHARE * int(seen[-1]))
                out.append(main_text(text.split("\n") if text else [], list(wanted), trusted,
                                     spread(seen[:-1] > 1, n), spread(seen[:-1] >= least, n)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "host", "part", "trusted", "wanted", "text").mapInArrow(
        run, "page_id long, url string, text string")
