"""Token-ID output (operator 1): Huffman-coded files of ids, written and read on Spark.

1. ``tokenize`` encodes each text and stages the ids.
2. One aggregation counts every id over all documents; the driver gets one
   number per vocabulary entry and derives the canonical code lengths.
3. ``write`` range-sorts the documents by id, encodes each and writes one file
   per range.  The manifest has a row per file.
4. ``read`` decodes the files block by block.

File (integers little-endian): magic, u32 length of the code lengths, these
zlib-packed; then blocks.  A block is independent: u32 documents, u32 bytes of
its tables, u32 bytes of payload, u32 crc32 of both, tables, payload.  Tables:
per document id i64, id-is-null u8, ids u64, payload offset u64; then, per
document and STEP ids, the bit offset (u64) from the document's start.  A
document begins on a byte, and a block ends after BLOCK ids.

Edge cases: null text counts as empty and yields the end id alone; null ids
come first; repeated ids are kept, ordered by content; empty tables give no
files and no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import LETTER, ChunkEncoder, Pool, binary, runs, strings
from .common import SharedFile, column, open_folder, pieces, shared_folder, ship, stage, tidy
from .huffman import LIMIT, STEP, Code, code_lengths

MAGIC = b"IDSH0001"
BLOCK = 1 << 16
#: Bytes of text that are encoded together.
SLICE = 1 << 21
#: Bytes of ids that become codes together.
RUNS = 1 << 20
#: Words of letters, and how many of them make one text for the library.
SPACED, LINE = rf"\A {LETTER}+\z", 2000


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if
    it is a visible Latin-1 character, else the next one from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(0x100) if b not in seen]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = byte_letters()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkEncoder:
    """What it keeps serves a worker's next tasks too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    library = Tokenizer.from_file(path)
    library.model._resize_cache(0)  # the chunks are kept here, each comes once
    # letters after one space are one pre-token: they come mapped to the vocabulary's letters, parted by blanks
    mapped = Tokenizer(library.model)
    mapped.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    space = BYTE_LETTERS[0x20]
    begins = np.zeros(library.get_vocab_size(), bool)
    begins[[i for piece, i in library.get_vocab().items() if piece.startswith(space)]] = True
    table = np.array([0x20 if byte == 0x0A else ord(BYTE_LETTERS.get(byte, chr(byte))) for byte in range(0x100)], "<u2")

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word is a space and letters, so its first id alone begins with a space."""
        lines = [table[np.frombuffer("\n".join(words[i:i + LINE]).encode(), np.uint8)].tobytes().decode("utf-16-le")
                 for i in range(0, len(words), LINE)]
        ids = np.concatenate([np.zeros(0, "<u4"), *(np.array(mapped.encode_batch_fast([line])[0].ids, "<u4")
                                                    for line in lines)])
        return ids, np.diff(np.append(np.flatnonzero(begins[ids]), len(ids)))

    def encode_many(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        array = pa.array(texts, pa.string())
        is_alone = pc.match_substring_regex(array, SPACED)
        pool = Pool(*encode_words(strings(array.filter(is_alone))))
        rest = strings(array.filter(pc.invert(is_alone)))
        coded = library.encode_batch_fast(rest, add_special_tokens=False) if rest else ()
        pool.add(*runs([e.ids for e in coded]))
        alone = is_alone.to_numpy(zero_copy_only=False)
        order = np.zeros(len(texts), np.int64)
        order[alone] = np.arange(alone.sum())
        order[~alone] = alone.sum() + np.arange(len(rest))
        return pool.take(order)

    return ChunkEncoder(encode_many)


def narrow(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokenize(df: DataFrame, path: str, end_id: int, vocabulary: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id and ids (with the end id) in the narrowest unsigned integers."""
    ship(df.sparkSession)
    kind = narrow(vocabulary)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, SLICE):
                ids, sizes = tokenizer(path).encode([t or "" for t in part.column(1).to_pylist()])
                ids = np.insert(ids.astype(kind), np.cumsum(sizes), end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), binary(ids, sizes + 1)], names=["doc_id", "ids"])
            pa.default_memory_pool().release_unused()

    return df.select(column(df, id_col).cast("long").alias("doc_id"), column(df, text_col).alias("text")
                     ).mapInArrow(tidy(run), "doc_id long, ids binary")


def count_ids(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    kind = narrow(vocabulary)

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for part in pieces(batch, 0, RUNS):
                total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(tidy(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for r in rows.toLocalIterator():  # at most one row per vocabulary entry
        counts[r["id"]] = r["n"]
    return counts


class BlockWriter:
    """Collects coded documents into blocks of one file."""

    def __init__(self, stream, lengths: np.ndarray):
        packed = zlib.compress(lengths.tobytes(), 9)
        self.stream, self.docs, self.ids, self.blocks = stream, [], 0, 0
        self.total_docs = self.total_ids = 0
        stream.write(MAGIC + struct.pack("<I", len(packed)) + packed)

    def add(self, doc_id: int | None, n: int, marks: bytes, payload: bytes) -> None:
        self.docs.append((doc_id, n, marks, payload))
        self.ids += n
        if self.ids >= BLOCK:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        keys, counts, marks, payloads = zip(*self.docs)
        offsets = np.cumsum([0, *map(len, payloads)])[:-1]
        tables = b"".join([np.array([k or 0 for k in keys], "<i8").tobytes(),
                           np.array([k is None for k in keys], "u1").tobytes(),
                           np.array(counts, "<u8").tobytes(), offsets.astype("<u8").tobytes(), *marks])
        payload = b"".join(payloads)
        self.stream.write(struct.pack("<IIII", len(keys), len(tables), len(payload),
                                      zlib.crc32(payload, zlib.crc32(tables))) + tables + payload)
        self.total_docs += len(keys)
        self.total_ids += self.ids
        self.docs, self.ids, self.blocks = [], 0, self.blocks + 1


def write(tokens: DataFrame, counts: np.ndarray, limit: int = LIMIT) -> DataFrame:
    """Write ``tokens`` in ascending doc_id order; the manifest: file, part, n_docs, n_tokens, blocks."""
    spark = tokens.sparkSession
    lengths, kind, folder = code_lengths(counts, limit), narrow(len(counts)), shared_folder(spark)

    def encode(batches):
        code = Code(lengths)
        for batch in batches:
            for part in pieces(batch, 1, RUNS):
                raw = part.column(1).to_pylist()
                n = np.array([len(r) for r in raw]) // np.dtype(kind).itemsize
                payload, filled, marks = code.encode_runs(np.frombuffer(b"".join(raw), kind), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), binary(marks.astype("<u8"), (n + STEP - 1) // STEP),
                     binary(np.frombuffer(payload, np.uint8), filled)], names=["doc_id", "n", "marks", "payload"])

    def save(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}.bin"
        with SharedFile(folder, name) as stream:
            writer = BlockWriter(stream, lengths)
            while first is not None:
                for row in zip(*(c.to_pylist() for c in first.columns)):
                    writer.add(*row)
                first = next(batches, None)
            writer.flush()
        yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "part": part, "n_docs": writer.total_docs,
                                           "n_tokens": writer.total_ids, "blocks": writer.blocks}])

    # the ids are dealt uncoded: Spark samples the ranges from the same plan, which would encode twice
    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    coded = ordered.mapInArrow(tidy(encode), "doc_id long, n long, marks binary, payload binary")
    return stage(coded.mapInArrow(tidy(save), "file string, part long, n_docs long, n_tokens long, blocks long"))


def read_blocks(uri: str):
    """Of each block: ids or None, numbers of token ids, and the token ids of all its documents."""
    fs, path = open_folder(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is no file of ids")
        code = Code(np.frombuffer(zlib.decompress(stream.read(struct.unpack("<I", stream.read(4))[0])), np.uint8))
        while head := stream.read(16):
            docs, size, bulk, crc = struct.unpack("<IIII", head)
            tables, payload = stream.read(size), stream.read(bulk)
            if zlib.crc32(payload, zlib.crc32(tables)) != crc:
                raise ValueError(f"{uri}: a block is damaged")
            keys, rest = np.frombuffer(tables, "<i8", docs), tables[8 * docs:]
            null, rest = np.frombuffer(rest, "u1", docs), rest[docs:]
            counts, offsets = np.frombuffer(rest, "<u8", 2 * docs).astype(np.int64).reshape(2, docs)
            marks = np.frombuffer(rest[16 * docs:], "<u8").astype(np.int64)
            lanes = (counts + STEP - 1) // STEP
            left = np.repeat(counts, lanes) - STEP * (np.arange(len(marks)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
            ids = code.decode(payload, marks + 8 * np.repeat(offsets, lanes), np.minimum(left, STEP))
            yield [None if z else int(k) for k, z in zip(keys, null)], counts, ids


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (u32 bytes) of every document in the files."""
    ship(manifest.sparkSession)
    files = manifest.withColumn(
        "first", F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0))).select("file", "first")
    spark: SparkSession = manifest.sparkSession
    rows = stage(files)
    tasks = max(1, min(rows.count(), 4 * spark.sparkContext.defaultParallelism + 100))

    def run(batches):
        for batch in batches:
            for uri, start in zip(*(c.to_pylist() for c in batch.columns)):
                for keys, counts, ids in read_blocks(uri):
                    ends = np.cumsum(counts)
                    cut = [ids[e - n:e].astype("<u4").tobytes() for e, n in zip(ends, counts)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(start + ends - counts, pa.int64()),
                         pa.array(counts, pa.int64()), pa.array(cut, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    start += int(counts.sum())

    return rows.repartition(tasks, "file").mapInArrow(
        tidy(run), "doc_id long, start long, n_tokens long, ids binary")


def round_trip(df: DataFrame, path: str, end_id: int, vocabulary: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Tokenize, write and read back: the ids of every document as the files give them."""
    tokens = stage(tokenize(df, path, end_id, vocabulary, id_col, text_col))
    return read(write(tokens, count_ids(tokens, vocabulary)))
