"""Byte-level BPE encoding and decoding with sentencepiece (operator 3).

The model is serialised directly from a rank file: one piece per vocabulary
entry, each byte mapped to one letter, scored by its negative rank (so the
lowest rank merges first), identity normalisation, no dummy prefix, no
white-space escapes.  The piece number is the id; one unknown piece, which
never occurs since all 256 bytes are pieces, comes last.

Texts are cut into pre-tokens by the splitting pattern and each pre-token is
encoded alone; a pre-token that is itself an entry gets that entry.  Decoding
maps each id back to its entry.

Edge cases: null and empty texts have no ids and decode to empty bytes; very
long texts are processed whole, in slices of a batch; special-token strings
are ordinary text.  Extra columns are kept; ``ids`` or ``decoded`` replace
columns of that name.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import ChunkEncoder, binary, runs
from .common import pieces, ship, tidy

#: Letter of byte b: chr(FIRST + b).
FIRST = 0x100
#: Bytes of a column that are turned into Python values at a time, and chunks that a task keeps encoded.
PIECE, KEEP = 1 << 20, 200_000


def letters(raw: bytes) -> str:
    return (np.frombuffer(raw, np.uint8).astype("<u2") + FIRST).tobytes().decode("utf-16-le")


def read_ranks(path: str) -> list[bytes]:
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece ModelProto.  Fixed values: field numbers and enums of its format."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [(letters(token), -float(rank), normal) for rank, token in enumerate(vocabulary)]
    pieces.append(("<unk>", 0.0, unknown))
    out = [_block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
                  + _number(3, kind)) for text, score, kind in pieces]
    trainer = (_number(3, bpe) + _number(4, len(pieces)) + _number(40, len(vocabulary))
               + b"".join(_number(field, -1) for field in (41, 42, 43)))
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _block(2, trainer) + _block(3, normaliser)


class Codec:
    def __init__(self, path: str, pattern: str):
        vocabulary = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(vocabulary))
        self.whole = {letters(token): rank for rank, token in enumerate(vocabulary)}
        self.split = regex.compile(pattern)

    def _encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokens = [[letters(t.encode()) for t in self.split.findall(text)] for text in texts]
        rest = list({t for row in tokens for t in row if t not in self.whole})
        coded = dict(zip(rest, self.model.encode(rest, out_type=int, num_threads=1) if rest else ()))
        out = []
        for row in tokens:
            ids: list[int] = []
            for t in row:
                one = self.whole.get(t)
                ids.extend(coded[t] if one is None else (one,))
            out.append(ids)
        return runs(out)

    def encoder(self) -> Callable[[list[str]], pa.Array]:
        """Encodes texts; the chunks that it keeps go with it."""
        chunks = ChunkEncoder(self._encode_many, KEEP)
        return lambda texts: binary(*chunks.encode([t or "" for t in texts]))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def decoder(path: str) -> Callable[[list[bytes | None]], pa.Array]:
    """Decodes ids; it needs the vocabulary, not the model."""
    vocabulary = read_ranks(path)
    return lambda rows: pa.array([b"".join(map(vocabulary.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                                  for ids in rows], pa.binary())


def _appended(df: DataFrame, source: str, name: str, make) -> DataFrame:
    """``df`` plus binary column ``name``, made from values of ``source`` by what ``make`` gives each task.

    What a task kept goes when it ends: its worker waits for the next one,
    beside others, and would hold it.
    """
    ship(df.sparkSession)
    base = df.drop(name) if name != source else df
    place = base.columns.index(source)
    schema = T.StructType([*base.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches):
        rows = make()
        for batch in batches:
            for part in pieces(batch, place, PIECE):
                yield pa.RecordBatch.from_arrays([*part.columns, rows(part.column(place).to_pylist())],
                                                 names=[*part.schema.names, name])
            pa.default_memory_pool().release_unused()

    return base.mapInArrow(tidy(run), schema)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """Add the ids of each text: little-endian unsigned 32-bit integers."""
    return _appended(df, text_col, name,
                     lambda: codec(path, pattern).encoder())


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for."""
    return _appended(df, ids_col, name,
                     lambda: decoder(path))


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id, number of ids, and SHA-256 of ids and of the decoded bytes."""
    return df.select(F.col(id_col).alias("doc_id"),
                     (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                     F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))
