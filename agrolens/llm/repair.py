"""Operator 12, conversation structure repair by secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn inside each partition; one
``mapInArrow`` streams them and carries the state of a dynamic program across Arrow batches.
The stream runs from a conversation's last row to its first, so the state is the cheapest cost
to finish from each of the four states of the role automaton ``(s?(ua)+)?`` (nothing yet, after
system, after user, after assistant): four small numbers, whatever the conversation's length.
Each row leaves one byte of backpointers (two bits a state). Backpointers and texts of a
conversation beyond SPILL_BYTES go to a temporary file of the task, are walked from the first
row on when its stream ends, and are deleted with it.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only edit of a blank or duplicate
row), Insert a user or assistant row without text 3; an undeleted truncated row adds 3. Among
the cheapest edits the audit (their initials in order) is the ASCII-least one. A letter has one
successor in every state, so the least optimal letter at every step is the least audit, and an
audit fixes the repaired rows.

Rows repeated in role and text are found by a window over (conversation, role, text), which the
partitioning by conversation already serves: no further shuffle, and its sort spills.

Defined results: a NULL conv_id is a conversation like any other; NULL turns come first; rows of
one turn are ordered by role, then text; NULL role or text count as one space, so such a text is
blank; equal rows are duplicates of the first; an empty table gives no rows; extra columns are
ignored. A conversation is one task's stream (its digest needs its texts in order), in bounded
memory; its audit has a letter a row and must fit a string of 2 GB.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agrolens.llm.common import SPACE_CLASS, small_batches

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # edit costs; CUT is added to undeleted truncated rows
SPILL_BYTES = 32 << 20
OUT_ROWS = 1000
LETTERS = "DIKR"                       # ASCII order: codes 0 to 3 of a backpointer
_NEEDS = ("u", "u", "a", "u")          # role that each automaton state takes next (state 0 takes s as well)
_ROLE = {"u": "user", "a": "assistant"}
_AFTER = {"u": 2, "a": 3}
_END = (0, 2 * INSERT, INSERT, 0)      # cheapest ending from each state: nothing, or the rows still due
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3  # first fault of a row; 0: none

AUDIT_COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _next(state: int, initial: str) -> int | None:
    if state == 0 and initial == "s":
        return 1
    return _AFTER[initial] if _NEEDS[state] == initial else None


def _step(after: tuple, initial: str, fault: int) -> tuple[tuple, int]:
    """Costs to finish from before a row, given those from after it, and its packed backpointers."""
    cut = CUT if fault == TRUNCATED else 0
    stays = fault not in (BLANK, DUPLICATE)
    ways = []
    for s in range(4):
        way = {"D": DELETE + after[s]}
        if stays:
            to = _next(s, initial)
            if to is not None:
                way["K"] = KEEP + cut + after[to]
            way["R"] = REROLE + cut + after[_AFTER[_NEEDS[s]]]
        ways.append(way)
    best = [min(w.values()) for w in ways]
    best[2], best[3] = min(best[2], INSERT + best[3]), min(best[3], INSERT + best[2])
    best[0], best[1] = min(best[0], INSERT + best[2]), min(best[1], INSERT + best[2])
    code = 0
    for s in range(4):
        ways[s]["I"] = INSERT + best[_AFTER[_NEEDS[s]]]
        letter = min(x for x, c in ways[s].items() if c == best[s])
        code |= LETTERS.index(letter) << 2 * s
    return tuple(best), code


class _Conversation:
    """The stream of one conversation, last row first."""

    def __init__(self, key, steps: dict, spill_bytes: int):
        self.key, self.steps, self.spill_bytes = key, steps, spill_bytes
        self.base, self.costs = 0, _END   # cheapest costs are base + costs
        self.codes, self.roles, self.texts, self.held = bytearray(), [], [], 0
        self.file, self.places = None, []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.later = self.turn = self.first = self.last = None

    def add(self, turn, role, text, fault):
        initial = role[:1]
        seen = (self.costs, initial if initial in ("s", "u", "a") else "", fault)
        if seen not in self.steps:
            costs, code = _step(*seen)
            low = min(costs)
            self.steps[seen] = (tuple(c - low for c in costs), low, code)
        self.costs, low, code = self.steps[seen]
        self.base += low
        self.codes.append(code)
        self.roles.append(role)
        self.texts.append(text)
        self.held += len(text) + 100
        self.faults[fault] += 1
        if self.later is not None and initial + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = initial
        if turn is not None:
            if self.turns == 0:
                self.last = turn
            if self.turns == 0 or turn != self.turn:
                self.turns += 1
            self.turn = self.first = turn
        if self.held > self.spill_bytes:
            self.spill()

    def spill(self):
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.places.append(self.file.seek(0, 2))
        pickle.dump((bytes(self.codes), self.roles, self.texts), self.file, protocol=5)
        self.codes, self.roles, self.texts, self.held = bytearray(), [], [], 0

    def rows(self):
        """(letter, role, text) of every edit in order; role and text None for Delete."""
        state = 0
        for codes, roles, texts in self._chunks():
            for i in range(len(codes) - 1, -1, -1):
                letter = LETTERS[codes[i] >> 2 * state & 3]
                while letter == "I":
                    yield "I", _ROLE[_NEEDS[state]], ""
                    state = _AFTER[_NEEDS[state]]
                    letter = LETTERS[codes[i] >> 2 * state & 3]
                if letter == "D":
                    yield "D", None, None
                elif letter == "K":
                    yield "K", roles[i], texts[i]
                    state = _next(state, roles[i][:1])
                else:
                    yield "R", _ROLE[_NEEDS[state]], texts[i]
                    state = _AFTER[_NEEDS[state]]
        while state in (1, 2):
            yield "I", _ROLE[_NEEDS[state]], ""
            state = _AFTER[_NEEDS[state]]

    def _chunks(self):
        yield bytes(self.codes), self.roles, self.texts
        for at in reversed(self.places):
            self.file.seek(at)
            yield pickle.load(self.file)
        if self.file is not None:
            self.file.close()

    def audit(self) -> tuple:
        gaps = int(self.last - self.first) + 1 - self.turns if self.turns else 0
        digest, letters, n = hashlib.sha256(), [], 0
        for letter, role, text in self.rows():
            letters.append(letter)
            if role is not None:
                digest.update(("\n" if n else "").encode() + f"{role}:{text}".encode())
                n += 1
        return (self.key, gaps, *self.faults[1:], self.illegal, self.base + self.costs[0], "".join(letters), digest.hexdigest())


def _faulty(conversations: DataFrame) -> DataFrame:
    """Rows partitioned by conversation and sorted from last to first, with their first fault."""
    rows = conversations.select(
        F.col("conv_id").alias("__conv"), F.col("turn").cast("long").alias("__turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("__role"), F.coalesce(F.col("text"), F.lit(" ")).alias("__text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "__conv").withColumn("__hash", F.xxhash64("__role", "__text"))
    same = Window.partitionBy("__conv", "__hash", "__role", "__text").orderBy(F.col("__turn").asc_nulls_first())
    end = F.regexp_extract("__text", rf"([^\x20\x09-\x0D]){SPACE_CLASS}*\z", 1)
    rows = rows.withColumn("__again", F.row_number().over(same) > 1).withColumn("__end", end)
    fault = (F.when(F.col("__end") == "", BLANK).when(F.col("__again"), DUPLICATE)
             .when(~F.col("__end").isin(".", "!", "?"), TRUNCATED).otherwise(0))
    return rows.select("__conv", "__turn", "__role", "__text", fault.cast("int").alias("__fault"), "__again").sortWithinPartitions(
        "__conv", F.col("__turn").desc_nulls_last(), F.col("__role").desc(), F.col("__text").desc(), F.col("__again").desc()).drop("__again")


def _stream(batches, spill_bytes: int):
    """Finished conversations of a sorted partition."""
    steps, now = {}, None
    for b in batches:
        for key, turn, role, text, fault in zip(*[c.to_pylist() for c in b.columns]):
            if now is None or now.key != key:
                if now is not None:
                    yield now
                now = _Conversation(key, steps, spill_bytes)
            now.add(turn, role, text, fault)
    if now is not None:
        yield now


def repair(conversations: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    small_batches(conversations.sparkSession)
    key = conversations.select("conv_id").schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *AUDIT_COLUMNS, "audit", "repaired_sha256"]

    def run(batches):
        out, arrow = [], None
        for talk in _stream(batches, spill_bytes):
            out.append(talk.audit())
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, arrow) for i, c in enumerate(zip(*out))], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, arrow) for i, c in enumerate(zip(*out))], names=names)

    return _faulty(conversations).mapInArrow(
        run, f"conv_id {key}, " + ", ".join(f"{c} long" for c in AUDIT_COLUMNS) + ", audit string, repaired_sha256 string")


def repaired_rows(conversations: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """The repaired conversations themselves: conv_id, turn (from 0), role, text, edit (K, R or I)."""
    small_batches(conversations.sparkSession)
    key = conversations.select("conv_id").schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "turn", "role", "text", "edit"]

    def run(batches):
        out = []
        for talk in _stream(batches, spill_bytes):
            kept = (r for r in talk.rows() if r[1] is not None)
            for n, (letter, role, text) in enumerate(kept):
                out.append((talk.key, n, role, text, letter))
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return _faulty(conversations).mapInArrow(run, f"conv_id {key}, turn long, role string, text string, edit string")


def damage(conversations: DataFrame) -> DataFrame:
    """Damage rows by crc32('conv_id:turn') % 20: 0 drops, 1 empties, 2 strips ``[.!?]``, 3 repeats, 4 makes a user of it."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("__times"), kind.alias("__kind")).where("__kind <> 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("conv_id", "turn", "role", "text")
