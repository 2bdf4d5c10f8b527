"""Encode texts chunk by chunk with a bounded cache of encoded chunks.

A byte-level BPE vocabulary is applied to each match of a splitting pattern
whose matches hold blanks only at their start (`` ?word``) or are blanks only.
So no match spans a single space between two visible characters, and nothing
before it changes the matches after it: a text can be cut there, and each
chunk (space and what follows) encoded alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are surely not blanks, and letters among them.
SEEN, LETTER = r"[!-~À-ɏ]", "[A-Za-zÀ-ÖØ-öø-ɏ]"
#: A space between two such characters.
CUT = re.compile(f"(?<={SEEN}) (?={SEEN})")
#: What the cuts leave if nothing but single spaces parts the words; for one chunk, and for an array of them.
PLAIN = re.compile(f"{SEEN}(?:.*{SEEN})?", re.DOTALL)
PLAINS = rf"(?s)\A{SEEN}(?:.*{SEEN})?\z"
#: A word and the marks after it, which the pattern matches apart.
MARKED = rf"\A(?P<word>{LETTER}+)(?P<marks>[.,;:!?#$%&*]+)\z"
#: Chunks kept between batches, and ids of theirs per chunk; chunks longer than LONG are never kept.
KEEP, KEEP_IDS, LONG = 500_000, 8, 64


class Pool:
    """Runs of ids, one after the other, named by their number."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids, sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """Append runs; their numbers."""
        first = len(self)
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return range(first, len(self))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these runs, one run after the other, and their sizes."""
        sizes = self.sizes[numbers]
        shift = (np.cumsum(self.sizes) - self.sizes)[numbers] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def runs(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.array([i for row in rows for i in row], "<u4"),
            np.fromiter(map(len, rows), np.int64, len(rows)))


class ChunkEncoder:
    """``encode_many`` turns strings into their ids, one string after the other, and the number of ids of each."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], keep: int = KEEP):
        self.encode_many, self.keep, self.kept, self.pool = encode_many, keep, {}, Pool(*runs([]))

    def learn(self, chunks: list[str]) -> None:
        """Keep the ids of ``chunks``; a word is encoded once for all marks after it, and marks once."""
        if not chunks:
            return
        array = pa.array(chunks, pa.string())
        found = pc.extract_regex(array, MARKED)
        is_marked = found.is_valid()
        words, marked = strings(array.filter(pc.invert(is_marked))), strings(array.filter(is_marked))
        bare, marks = (strings(found.field(k).filter(is_marked)) for k in range(2))
        words += set(bare).difference(words, self.kept)
        self.kept.update(zip(words, self.pool.add(*self.encode_many([" " + w for w in words]))))
        if marked:
            alone = list(set(marks))
            at = dict(zip(alone, self.pool.add(*self.encode_many(alone))))
            pairs = np.array([list(map(self.kept.__getitem__, bare)), list(map(at.__getitem__, marks))])
            ids, sizes = self.pool.take(pairs.T.ravel())
            self.kept.update(zip(marked, self.pool.add(ids, sizes.reshape(-1, 2).sum(1))))

    def assemble(self, chunks: list[str], numbers: np.ndarray, codes: np.ndarray, counts: np.ndarray,
                 heads: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number in each; a text is its head and the
        chunks that ``codes`` name after the first of its ``counts`` places.
        ``numbers`` are those of the chunks in the pool, -1 for new ones;
        ``plain`` if all chunks are known to be."""
        begins = np.cumsum(counts) - counts
        used = np.zeros(len(chunks), bool)
        used[np.delete(codes, begins)] = True
        fresh = np.flatnonzero(used & (numbers < 0))
        if len(self.pool) + len(fresh) > self.keep or len(self.pool.ids) > KEEP_IDS * self.keep:
            old = np.flatnonzero(used & (numbers >= 0))
            self.pool = Pool(*self.pool.take(numbers[old]))
            self.kept = dict(zip([chunks[i] for i in old.tolist()], range(len(old))))
            numbers[old] = np.arange(len(old))
        new = [chunks[i] for i in fresh.tolist()]
        self.learn(new)
        numbers[fresh] = [self.kept[c] for c in new]
        runs_of, kept = numbers[codes], len(self.pool)
        runs_of[begins] = self.pool.add(*self.encode_many(heads))
        ids, sizes = self.pool.take(runs_of)
        self.pool = Pool(self.pool.ids[:self.pool.sizes[:kept].sum()], self.pool.sizes[:kept])
        for c in new:
            if len(c) > LONG or not plain and not c.isalnum() and not PLAIN.fullmatch(c):
                del self.kept[c]
        return ids, np.add.reduceat(sizes, begins)

    def known(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.kept.get, chunks, repeat(-1)), np.int64, len(chunks))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if not texts:
            return runs([])
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        words = parts.values.dictionary_encode()
        chunks, codes = strings(words.dictionary), words.indices.to_numpy()
        counts = np.diff(parts.offsets.to_numpy())
        begins = np.cumsum(counts) - counts
        numbers = self.known(chunks)
        # elsewhere than between visible characters a space is no place to cut
        odd = numbers < 0
        new = words.dictionary.filter(pa.array(odd))
        odd[odd] = ~pc.match_substring_regex(new, PLAINS).to_numpy(zero_copy_only=False)
        odd = np.logical_or.reduceat(odd[codes], begins)
        if not odd.any():
            return self.assemble(chunks, numbers, codes, counts, [chunks[i] for i in codes[begins].tolist()],
                                 plain=True)
        sizes, pieces = np.zeros(len(texts), np.int64), [np.zeros(0, "<u4")] * len(texts)
        for group in (np.flatnonzero(~odd), np.flatnonzero(odd)):
            if not len(group):
                continue
            cut = [CUT.split(texts[i]) if odd[i] else texts[i].split(" ") for i in group.tolist()]
            words = pa.array([c for row in cut for c in row], pa.string()).dictionary_encode()
            chunks = strings(words.dictionary)
            ids, n = self.assemble(chunks, self.known(chunks), words.indices.to_numpy(),
                                   np.array([len(row) for row in cut]), [row[0] for row in cut])
            sizes[group] = n
            for i, piece in zip(group.tolist(), np.split(ids, np.cumsum(n)[:-1])):
                pieces[i] = piece
        return np.concatenate(pieces), sizes


def binary(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary value per text from the ids of all texts and the number of each."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * ids.itemsize
    if offsets[-1] >= 1 << 31:
        raise OverflowError("more than 2 GB of ids in one slice of a batch")
    return pa.Array.from_buffers(pa.binary(), len(sizes),
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])
