"""Conversation structure repair (operator 13): the cheapest edits that make turns alternate.

A conversation's roles are to read ``(s?(ua)+)?`` by their initials: perhaps a
system turn, then user and assistant in turn, or nothing at all.  Edits: Keep
costs 0, Rerole to user or assistant 3, Delete 4 (a must for blank turns and
for repeats of an earlier turn), Insert an empty user or assistant turn 3; a
truncated turn that is not deleted costs 3 more.  Of all cheapest edits the
ones whose initials in order are least in ASCII are taken.

Four-Russians tables.  What is left to pay from each of the four states of the
pattern is a vector; less its minimum there are only a few such vectors.  For
each of them and every block of BLOCK turn symbols a table holds the vector
before the block and what is added, so a conversation is read from its end,
one lookup per block.  Then blocks are expanded against the direction of the
reading, from the first to the last: with the vectors within a block known,
the least letter that stays cheapest is taken at every turn, which settles
ties for good.

On Spark, turns are range-partitioned and sorted by conversation, turn, role
and text, so a long conversation spreads over many tasks.  A conversation
that lies within a task is repaired there.  Others come as pieces of at most
PIECE turns; a piece is summed up as a map from each vector behind it to the
one before it, with the state it is left in for each state it is entered in.
The maps of a conversation's pieces are composed, backward for the vectors and
forward for the states, and then all pieces are repaired side by side.

Edge cases: a null role or text is one space.  Rows are ordered by turn, nulls
first; rows of one turn by role, then by the SHA-256 of the text, then as they
come.  Roles count by their first character; the empty role has none.  A
conversation whose id is null is one conversation.  An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ship, stage

BLOCK, PIECE, PIECE_CHARS = 3, 4096, 4_000_000
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user turn is put out; an assistant turn can only follow USER.
FOLLOWS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KINDS, SYMBOLS = "sua", 9
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: What is left to pay behind the last turn.
END = (0, 6, 3, 0)
LEGAL = {"su", "ua", "au"}
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def symbol(initial: str, must_delete: bool, truncated: bool) -> int:
    """0: must be deleted; else 1 + 2 * kind of role + whether truncated."""
    kind = KINDS.index(initial) if initial and initial in KINDS else len(KINDS)
    return 0 if must_delete else 1 + 2 * kind + truncated


def kept_as(state: int, code: int) -> int | None:
    """State after a kept turn, None if it does not fit."""
    kind = (code - 1) // 2
    if kind == 0:
        return SYSTEM if state == START else None
    if kind in (1, 2):
        return FOLLOWS[state] if FOLLOWS[state] == kind + 1 else None
    return None


def choices(state: int, code: int):
    """(letter, cost, state after) of the edits that use up a turn, letters ascending."""
    yield "D", DELETE, state
    if code:
        more = TRUNCATED * ((code - 1) % 2)
        if (kept := kept_as(state, code)) is not None:
            yield "K", KEEP + more, kept
        yield "R", REROLE + more, FOLLOWS[state]


def before(code: int, after: tuple) -> tuple:
    """What is left to pay before a turn, from what is left behind it."""
    best = [min(cost + after[then] for _, cost, then in choices(q, code)) for q in range(4)]
    for _ in range(2):  # two inserts lead everywhere
        best = [min(best[q], INSERT + best[FOLLOWS[q]]) for q in range(4)]
    return tuple(best)


def number_of(block: tuple) -> int:
    number = 0
    for code in block:
        number = number * SYMBOLS + code
    return number


class Tables:
    """All vectors that occur and their transitions over single turns and over blocks."""

    def __init__(self):
        self.vectors, number = [END], {END: 0}
        single, added = [], []
        for vector in self.vectors:
            row = [before(code, vector) for code in range(SYMBOLS)]
            for v in row:
                small = tuple(x - min(v) for x in v)
                if small not in number:
                    number[small] = len(self.vectors)
                    self.vectors.append(small)
            single.append([number[tuple(x - min(v) for x in v)] for v in row])
            added.append([min(v) for v in row])
        self.single = np.array(single)
        add = np.array(added)
        # a block's number has its last turn as the lowest digit: that one is read first
        n = len(self.vectors)
        self.block = np.broadcast_to(np.arange(n)[:, None], (n, 1))
        self.added = np.zeros((n, 1), np.int64)
        for _ in range(BLOCK):
            width = self.block.shape[1]
            head = np.repeat(np.arange(SYMBOLS), width)
            tail = np.tile(self.block, (1, SYMBOLS))
            self.added = np.tile(self.added, (1, SYMBOLS)) + add[tail, head]
            self.block = self.single[tail, head]
        self.rows, self.row_added = self.single.tolist(), add.tolist()

    @lru_cache(maxsize=None)  # noqa: B019  as many entries as the tables have
    def expand(self, codes: tuple, vector: int, state: int) -> tuple[str, int]:
        """Letters of a block entered in a state, given the vector behind it; state after it."""
        behind = [vector]
        for code in reversed(codes):
            behind.append(self.rows[behind[-1]][code])
        letters = []
        for code, v in zip(codes, reversed(behind[:-1])):
            after = self.vectors[v]
            now = before(code, after)
            letter = "I"
            while letter == "I":
                edits = list(choices(state, code))
                edits.insert(1, ("I", INSERT, FOLLOWS[state]))  # D < I < K < R
                letter, state = next((x, then) for x, cost, then in edits
                                     if cost + (now if x == "I" else after)[then] == now[state])
                letters.append(letter)
        return "".join(letters), state

    def read(self, codes: np.ndarray, vector: int = 0) -> tuple[list[tuple[tuple, int]], int]:
        """Blocks in order with the vector behind each, the first block may be short; cost of it all from START."""
        out, stop, cost = [], len(codes), 0
        digits = codes.tolist()
        while stop > 0:
            begin = max(stop - BLOCK, 0)
            block = tuple(digits[begin:stop])
            out.append((block, vector))
            if len(block) == BLOCK:
                place = number_of(block)
                cost += int(self.added[vector, place])
                vector = int(self.block[vector, place])
            else:
                for d in reversed(block):
                    cost += self.row_added[vector][d]
                    vector = self.rows[vector][d]
            stop = begin
        return out[::-1], cost + self.vectors[vector][START]

    def repair(self, codes: np.ndarray, vector: int = 0, state: int = START, last: bool = True) -> tuple[str, int]:
        """Letters of the edits, and the state after them."""
        parts = []
        for block, behind in self.read(codes, vector)[0]:
            letters, state = self.expand(block, behind, state)
            parts.append(letters)
        while last and state not in (START, ASSISTANT):
            parts.append("I")
            state = FOLLOWS[state]
        return "".join(parts), state

    def summary(self, codes: np.ndarray) -> bytes:
        """For each vector behind a piece the one before it, and for each state at its begin the one at its end."""
        n = len(self.vectors)
        vector, exits = np.arange(n), np.tile(np.arange(4), (n, 1))
        stop = len(codes)
        digits = codes.tolist()
        while stop > 0:
            begin = max(stop - BLOCK, 0)
            block = tuple(digits[begin:stop])
            through = np.array([[self.expand(block, v, q)[1] for q in range(4)] for v in range(n)])
            exits = np.take_along_axis(exits, through[vector], axis=1)
            if len(block) == BLOCK:
                vector = self.block[vector, number_of(block)]
            else:
                for d in reversed(block):
                    vector = self.single[vector, d]
            stop = begin
        return vector.astype(np.uint8).tobytes() + exits.astype(np.uint8).tobytes()


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def repaired_turns(letters: str, roles: list[str], texts: list[str], state: int = START):
    """The turns that the edits leave: roles, texts."""
    out_roles, out_texts, i = [], [], 0
    for letter in letters:
        if letter == "D":
            i += 1
            continue
        if letter == "K" and state == START and roles[i][:1] == "s":
            state = SYSTEM
        else:
            state = FOLLOWS[state]
        out_roles.append(roles[i] if letter == "K" else ROLE_OF[state])
        out_texts.append("" if letter == "I" else texts[i])
        i += letter != "I"
    return out_roles, out_texts


def edits_cost(letters: str, codes: np.ndarray) -> int:
    used = [x for x in letters if x != "I"]
    return (letters.count("I") * INSERT + letters.count("D") * DELETE + letters.count("R") * REROLE
            + sum(TRUNCATED for x, c in zip(used, codes.tolist()) if x != "D" and c and (c - 1) % 2))


FOUND = ("conv_id {id}, at long, whole boolean, low long, high long, turns long, tail long, head_role string, tail_role string, "
         "blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles array<string>, "
         "texts array<string>, codes binary, map binary")
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


class Piece:
    """Turns of one conversation, in order."""

    def __init__(self):
        self.roles, self.texts, self.codes, self.turns = [], [], [], []
        self.faults, self.illegal, self.chars = [0, 0, 0], 0, 0

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        body = text.rstrip(BLANKS)
        fault = 0 if not body else 1 if repeated else 2 if body[-1] not in ".!?" else None
        if fault is not None:
            self.faults[fault] += 1
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.codes.append(symbol(role[:1], fault in (0, 1), fault == 2))
        self.roles.append(role)
        self.texts.append(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.chars += len(text)

    def row(self, conversation, at: int, whole: bool) -> tuple:
        codes = np.array(self.codes, np.uint8)
        turns = self.turns or [None]
        audit = cost = packed = map_ = None
        roles, texts = self.roles, self.texts
        if whole:
            audit, _ = tables().repair(codes)
            cost = tables().read(codes)[1]
            roles, texts = repaired_turns(audit, roles, texts)
        else:
            packed, map_ = codes.tobytes(), tables().summary(codes)
        return (conversation, at, whole, turns[0], turns[-1], len(self.turns), turns[-1], self.roles[0][:1], self.roles[-1][:1],
                *self.faults, self.illegal, cost, audit, roles, texts, packed, map_)


def _table(rows: list[tuple], schema: pa.Schema):
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _in_order(turns: DataFrame) -> DataFrame:
    """Rows range-partitioned and sorted; before a row that repeats an earlier one comes a mark of it."""
    key = ["conv_id", "turn", "role", "digest", "row"]
    skinny = turns.select(*key)
    order = F.struct("turn", "row")
    firsts = stage(skinny.groupBy(F.col("conv_id").alias("conv"), F.col("role").alias("as_role"), F.col("digest").alias("as_digest"))
                   .agg(F.min(F.struct("turn", "role", "digest", "row")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    marks = skinny.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("role") == F.col("as_role"))
                        & (F.col("digest") == F.col("as_digest")))
    marks = marks.filter(~F.struct("turn", "row").eqNullSafe(F.struct("first.turn", "first.row")))
    every = turns.select(*key, "text", F.lit(1).alias("kind")).unionByName(
        marks.select(*key, F.lit(None).cast("string").alias("text"), F.lit(0).alias("kind")))
    sort = [F.col(c).asc_nulls_first() for c in key]
    return every.repartitionByRange(*sort).sortWithinPartitions(*sort, "kind")


def pieces(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Staged: repaired conversations, one row each, the longest as several pieces ordered by ``at``.

    ``roles`` and ``texts`` are the repaired turns, ``audit`` the initials of
    the edits; ``whole`` tells a conversation that is a single piece.
    """
    spark = df.sparkSession
    ship(spark)
    blank = F.lit(" ")
    turns = stage(df.select(column(df, conv_col).alias("conv_id"), column(df, turn_col).cast("long").alias("turn"),
                            F.coalesce(column(df, role_col), blank).alias("role"), F.coalesce(column(df, text_col), blank).alias("text"),
                            F.monotonically_increasing_id().alias("row")))
    turns = turns.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    ddl = FOUND.format(id=dict(turns.dtypes)["conv_id"])
    schema = _arrow(spark, ddl)

    def run(batches):
        held, conversation, piece, repeated, first, number, part = [], None, None, False, True, 0, 0

        def close(open_):
            nonlocal number
            if piece is not None and piece.codes:
                number += 1
                held.append(piece.row(conversation, (part << 32) + number, not open_))

        for batch in batches:
            part = batch.column(5)[0].as_py()
            for conv, turn, role, text, kind in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if piece is None or conv != conversation:
                    close(first)  # the first conversation of a task may begin in another one
                    first = piece is None
                    conversation, piece = conv, Piece()
                if kind == 0:
                    repeated = True
                    continue
                if len(piece.codes) >= PIECE or piece.chars > PIECE_CHARS:
                    close(True)
                    first, piece = True, Piece()
                piece.add(turn, role, text, repeated)
                repeated = False
            if held:
                yield _table(held, schema)
                held = []
        close(True)  # the last one may go on in another task
        if held:
            yield _table(held, schema)

    sorted_ = _in_order(turns).select("conv_id", "turn", "role", "text", "kind", F.spark_partition_id().alias("part"))
    found = stage(sorted_.mapInArrow(run, ddl))
    return stage(found.filter("whole").unionByName(_joined(found.filter("not whole"), ddl)))


def _by_conversation(df: DataFrame, descending: bool = False) -> DataFrame:
    at = F.col("at").desc() if descending else F.col("at")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", at)


def _joined(opened: DataFrame, ddl: str) -> DataFrame:
    """Pieces of conversations that may span tasks, repaired."""
    spark = opened.sparkSession
    id_ = dict(opened.dtypes)["conv_id"]
    n = len(tables().vectors)
    schema = _arrow(spark, ddl)

    def vectors(batches):
        last, vector = None, 0
        for batch in batches:
            behind = []
            for i, (conv, map_) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if last is None or last[0] != conv:
                    vector = 0
                last = (conv,)
                behind.append(vector)
                vector = map_[vector]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(behind, pa.int64())], names=["conv_id", "at", "map", "behind"])

    def states(batches):
        last, state = None, START
        for batch in batches:
            enter = []
            for conv, map_, behind in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if last is None or last[0] != conv:
                    state = START
                last = (conv,)
                enter.append(state)
                state = map_[n + 4 * behind + state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(enter, pa.int64())],
                                             names=["conv_id", "at", "behind", "enter"])

    def repair(batches):
        names = schema.names
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.uint8)
                row["audit"], _ = tables().repair(codes, row["behind"], row["enter"], last=row["is_last"])
                row["cost"] = edits_cost(row["audit"], codes)
                row["roles"], row["texts"] = repaired_turns(row["audit"], row["roles"], row["texts"], row["enter"])
                row["codes"] = row["map"] = None
                rows.append(tuple(row[c] for c in names))
            if rows:
                yield _table(rows, schema)

    behind = _by_conversation(opened.select("conv_id", "at", "map"), descending=True).mapInArrow(
        vectors, f"conv_id {id_}, at long, map binary, behind long")
    enter = _by_conversation(behind).mapInArrow(states, f"conv_id {id_}, at long, behind long, enter long")
    last = opened.groupBy("conv_id").agg(F.max("at").alias("last_at"))
    known = stage(enter.join(last, enter["conv_id"].eqNullSafe(last["conv_id"])).select(
        "at", "behind", "enter", (F.col("at") == F.col("last_at")).alias("is_last")))
    return opened.join(known, "at").select(*opened.columns, "behind", "enter", "is_last").mapInArrow(repair, ddl)


def _lines() -> Column:
    return F.concat_ws("\n", F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])))


def conversations(found: DataFrame, every: DataFrame) -> DataFrame:
    """One row per conversation of ``every`` (column conv_id): counts, cost, audit, digest of the repaired turns."""
    columns = ["gaps", *COUNTS, "audit", "repaired_sha256"]
    whole = found.filter("whole").select(
        "conv_id", (F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"), *COUNTS, "audit",
        F.sha2(_lines(), 256).alias("repaired_sha256"))
    id_ = dict(found.dtypes)["conv_id"]
    ddl = f"conv_id {id_}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = _arrow(found.sparkSession, ddl)

    def merge(batches):
        held, out = None, []

        def close():
            if held:
                gaps = held["high"] - held["low"] + 1 - held["turns"] if held["low"] is not None else None
                out.append((held["conv_id"], gaps, *(held[c] for c in COUNTS), "".join(held["audit"]), held["hash"].hexdigest()))

        for batch in batches:
            for row in batch.to_pylist():
                if held is None or held["conv_id"] != row["conv_id"]:
                    close()
                    held = row | {"audit": [], "hash": hashlib.sha256(), "lines": 0}
                else:
                    for c in COUNTS:
                        held[c] += row[c]
                    held["illegal"] += held["tail_role"] + row["head_role"] not in LEGAL
                    if row["low"] is not None:
                        held["turns"] += row["turns"] - (held["high"] == row["low"])
                        held["low"] = row["low"] if held["low"] is None else held["low"]
                        held["high"] = row["high"]
                    held["tail_role"] = row["tail_role"]
                held["audit"].append(row["audit"])
                for role, text in zip(row["roles"], row["texts"]):
                    held["hash"].update(("\n" * bool(held["lines"]) + role + ":" + text).encode())
                    held["lines"] += 1
            if out:
                yield _table(out, schema)
                out = []
        close()
        if out:
            yield _table(out, schema)

    cut = _by_conversation(found.filter("not whole")).mapInArrow(merge, ddl)
    known = stage(whole.unionByName(cut).withColumnRenamed("conv_id", "known_id").withColumn("known", F.lit(True)))
    ids = every.select("conv_id").distinct()
    joined = ids.join(known, F.col("conv_id").eqNullSafe(F.col("known_id")), "left")
    zero, empty = F.lit(0).cast("long"), {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.select("conv_id", *(F.coalesce(F.col(c), empty.get(c, zero)).alias(c) for c in columns))


def damage(df: DataFrame) -> DataFrame:
    """Planted faults: by crc32(conv_id:turn) mod 20 a row is dropped (0), emptied (1), stripped of its ends of
    sentences (2), repeated (3) or made a user's (4); nulls are one space first."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    marked = df.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       (F.crc32(name.cast("binary")) % 20).alias("fault")).filter("fault <> 0")
    return marked.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
