"""Conversation structure repair: the cheapest edits that make the roles ``(s?(ua)+)?``.

Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant turn 2; a
blank turn, or one whose role and text came before, must go, and a truncated turn that stays adds 1.
Of all cheapest edit sequences the one whose initials are least in ASCII order is taken.

The search is a dynamic program over four states (nothing yet, after system, user, assistant). Cost
vectors run backward and are stored at every sqrt(n)-th turn only; walking forward, each block's vectors
are computed again from its checkpoint, and the least letter whose cost is tight is emitted. For a
conversation larger than a section the checkpoints are the section ends: sections give min-plus matrices,
a backward pass over them gives the vector at each end, sections map every entry state to an exit state,
a forward pass fixes the entries, and all sections are walked side by side. Only codes of a few bytes a
turn take part. Texts move once, at the end, when each conversation is told in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import Scratch, partitions

# Turns of a section, at least; sections grow with the root of all turns.
SECTION = 1024
SPACES = " \t\n\v\f\r"
ENDS = ".!?"

# codes of a turn: the initial of its role, and its faults
_OTHER, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIAL, _BLANK, _TRUNCATED, _SEEN = 3, 4, 8, 16
# states: nothing yet, after system, after user, after assistant
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = (None, None, "user", "assistant")
_KEEP = ({_SYSTEM: 1, _USER: 2}, {_USER: 2}, {_ASSISTANT: 3}, {_USER: 2})
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}
_END = (0, 4, 2, 0)
_FAR = 1 << 60


def _relaxed(v: list[int]) -> tuple[int, ...]:
    """Costs to go if turns may be inserted first."""
    user, assistant = min(v[2], v[3] + 2), min(v[3], v[2] + 2)
    return min(v[0], user + 2), min(v[1], user + 2), user, assistant


class Costs:
    """Cost vectors of turns; vectors differ by constants from a small set, which is remembered."""

    def __init__(self) -> None:
        self._known: dict[tuple, tuple[int, ...]] = {}

    def before(self, code: int, copies: int, after: tuple[int, ...]) -> tuple[int, ...]:
        """Costs to go before a turn, from those after it. All copies but the first are deleted."""
        least = min(after)
        key = (code, *[a - least for a in after])
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = self._step(code, key[1:])
        least += 3 * (copies - 1)
        return tuple([v + least for v in found])

    @staticmethod
    def _step(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
        best = [3 + a for a in after]
        if not code & (_BLANK | _SEEN):
            cut = 1 if code & _TRUNCATED else 0
            for state in range(4):
                kept = _KEEP[state].get(code & _INITIAL)
                if kept is not None:
                    best[state] = min(best[state], cut + after[kept])
                best[state] = min(best[state], 2 + cut + after[_NEXT[state]])
        return _relaxed(best)


def _edits(code: int, copies: int, state: int, costs: tuple[int, ...], after: tuple[int, ...]) -> tuple[str, int]:
    """The least tight letters for one turn and the state after it."""
    letters, rest = "", 3 * (copies - 1)
    cut = 1 if code & _TRUNCATED else 0
    free = not code & (_BLANK | _SEEN)
    while True:
        cost = costs[state] - rest
        if cost == 3 + after[state]:
            return letters + "D" * copies, state
        if costs[state] == 2 + costs[_NEXT[state]]:
            letters, state = letters + "I", _NEXT[state]
            continue
        kept = _KEEP[state].get(code & _INITIAL)
        if free and kept is not None and cost == cut + after[kept]:
            return letters + "K" + "D" * (copies - 1), kept
        return letters + "R" + "D" * (copies - 1), _NEXT[state]


def walk(turns: list[tuple[int, int]], entry: int, after: tuple[int, ...], costs: Costs) -> Iterator[tuple[str, int]]:
    """Per turn ``(code, copies)`` its letters and the state before it.

    Holds sqrt(n) checkpoints and the vectors of one block.
    """
    n = len(turns)
    block = max(1, isqrt(n))
    checkpoints, vector = [], after
    for at in range(n - 1, -1, -1):
        if (at + 1) % block == 0 or at == n - 1:
            checkpoints.append(vector)  # the vector after the last turn of a block
        vector = costs.before(*turns[at], vector)
    state = entry
    for start in range(0, n, block):
        vector = checkpoints.pop()
        end = min(start + block, n)
        vectors = [vector]
        for at in range(end - 1, start - 1, -1):
            vector = costs.before(*turns[at], vector)
            vectors.append(vector)
        for at in range(start, end):
            letters, then = _edits(*turns[at], state, vectors[end - at], vectors[end - at - 1])
            yield letters, state
            state = then
    yield "", state


def _closing(state: int) -> str:
    """Insertions that a conversation ends with."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]


def _exit(turns: list[tuple[int, int]], entry: int, after: tuple[int, ...], costs: Costs) -> int:
    state = entry
    for _, state in walk(turns, entry, after, costs):
        pass
    return state


def _matrix(turns: list[tuple[int, int]], costs: Costs) -> list[int]:
    """Least costs from every entry state (rows) to every exit state, insertions before each turn included."""
    columns = []
    for out in range(4):
        vector = tuple(0 if state == out else _FAR for state in range(4))
        for turn in reversed(turns):
            vector = costs.before(*turn, vector)
        columns.append(vector)
    return [columns[out][state] for state in range(4) for out in range(4)]


def _turns(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    for turns in batch.column("turns").to_pylist():
        yield [(t["code"], t["copies"]) for t in turns]


def _added(batch: pa.RecordBatch, names: list[str], **columns: list) -> pa.RecordBatch:
    """Some columns of a batch and new ones given as ``name=(values, type)``."""
    arrays = [batch.column(n) for n in names] + [pa.array(values, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *columns])


_LONGS, _PLACE = pa.list_(pa.int64()), ["key", "section"]


def _section_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    costs = Costs()
    for batch in batches:
        yield _added(batch, _PLACE, matrix=([_matrix(t, costs) for t in _turns(batch)], _LONGS))


def _section_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost vectors at the ends of sections; a conversation's sections arrive last first."""
    key, vector = None, _END
    for batch in batches:
        after = []
        for own, matrix in zip(batch.column("key").to_pylist(), batch.column("matrix").to_pylist()):
            if own != key:
                key, vector = own, _END
            after.append(list(vector))
            vector = tuple(min(matrix[4 * s + o] + vector[o] for o in range(4)) for s in range(4))
        yield _added(batch, _PLACE, after=(after, _LONGS))


def _section_exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    costs = Costs()
    for batch in batches:
        pairs = zip(_turns(batch), batch.column("after").to_pylist())
        exits = [[_exit(turns, entry, tuple(after), costs) for entry in range(4)] for turns, after in pairs]
        yield _added(batch, [*_PLACE, "after"], exits=(exits, _LONGS))


def _section_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry states; a conversation's sections arrive in order."""
    key, state = None, 0
    for batch in batches:
        entries = []
        for own, exits in zip(batch.column("key").to_pylist(), batch.column("exits").to_pylist()):
            if own != key:
                key, state = own, 0
            entries.append(state)
            state = exits[state]
        yield _added(batch, [*_PLACE, "after"], entry=(entries, pa.int64()))


def _section_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, edits, state)`` of every turn; the last of a conversation carries the closing insertions."""
    costs = Costs()
    for batch in batches:
        ids, edits, states = [], [], []
        rows = (batch.column(c).to_pylist() for c in ("turns", "after", "entry", "is_last"))
        for turns, after, entry, is_last in zip(*rows):
            told = list(walk([(t["code"], t["copies"]) for t in turns], entry, tuple(after), costs))
            _, state = told.pop()
            ids += [t["id"] for t in turns]
            edits += [letters for letters, _ in told]
            states += [before for _, before in told]
            if is_last:
                edits[-1] += _closing(state)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(edits, pa.string()), pa.array(states, pa.int32())], names=["id", "edits", "state"]
        )


def conversation_key(conv_id: Column) -> Column:
    """A text that is never null and differs for different ids."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _typed(turns: DataFrame) -> DataFrame:
    """``(key, turn, role, text, digest)``: nulls count as one space, but for turn."""
    space = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = turns.select(
        conversation_key(F.col("conv_id")).alias("key"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), text.alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _codes(typed: DataFrame) -> DataFrame:
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", _SYSTEM).when(first == "u", _USER).when(first == "a", _ASSISTANT).otherwise(_OTHER)
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    blank = F.when(end == "", _BLANK).otherwise(0)
    truncated = F.when((end != "") & (F.instr(F.lit(ENDS), end) == 0), _TRUNCATED).otherwise(0)
    code = (initial + blank + truncated).cast("int").alias("code")
    return typed.select("key", "turn", "role", "digest", code)


def plan_edits(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``(key, turn, role, digest, code, copies, edits, state)``: one row per distinct turn, in stored form.

    Turns are ordered by (turn, role, text digest), null turns first. The order is laid down by a range
    partition of narrow rows, so a conversation of any size lies in as many tasks as it needs.
    """
    spark = turns.sparkSession
    distinct = _codes(_typed(turns)).groupBy("key", "turn", "role", "digest", "code").agg(F.count("*").alias("copies"))
    order = ["key", "turn", "role", "digest"]
    sorted_rows = distinct.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ordered = scratch.keep(sorted_rows.withColumn("id", F.monotonically_increasing_id()), "ordered")
    firsts = ordered.groupBy("key", "role", "digest").agg(F.min("id").alias("id")).select("id", F.lit(0).alias("seen"))
    coded = ordered.join(firsts, "id", "left").select(
        "key", "id", "copies", F.col("code").bitwiseOR(F.coalesce("seen", F.lit(_SEEN))).alias("code")
    )
    # an id counts rows of its partition, so turns of a section are at most this many
    length = max(SECTION, isqrt(ordered.count()))
    section = F.floor(F.col("id") / F.lit(length)).alias("section")
    turn = F.struct("id", "code", "copies")
    sections = coded.groupBy("key", section).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    sections = scratch.keep(sections, "sections")
    spans = sections.groupBy("key").agg(F.count("*").alias("n"), F.max("section").alias("last"))
    spans = scratch.keep(spans.filter("n > 1").select("key", "last"), "spans")

    def in_order(rows: DataFrame, fn: Callable, schema: str, backward: bool = False) -> DataFrame:
        at = F.desc("section") if backward else F.asc("section")
        return rows.repartition(partitions(spark), "key").sortWithinPartitions("key", at).mapInArrow(fn, schema)

    place = "key string, section bigint"
    large = sections.join(spans.select("key"), "key", "left_semi")
    matrices = large.mapInArrow(_section_matrices, f"{place}, matrix array<bigint>")
    vectors = scratch.keep(in_order(matrices, _section_vectors, f"{place}, after array<bigint>", backward=True), "vectors")
    exits = large.join(vectors, _PLACE).mapInArrow(_section_exits, f"{place}, after array<bigint>, exits array<bigint>")
    entries = scratch.keep(in_order(exits, _section_entries, f"{place}, after array<bigint>, entry bigint"), "entries")
    end = F.array(*[F.lit(v).cast("bigint") for v in _END])
    known = sections.join(entries, _PLACE, "left").join(spans, "key", "left").select(
        "turns",
        F.coalesce("after", end).alias("after"),
        F.coalesce("entry", F.lit(0).cast("bigint")).alias("entry"),
        F.coalesce(F.col("section") == F.col("last"), F.lit(True)).alias("is_last"),
    )
    edits = known.mapInArrow(_section_edits, "id bigint, edits string, state int")
    edited = ordered.drop("code").join(coded.select("id", "code"), "id").join(edits, "id")
    return scratch.keep(edited.select("key", "turn", "role", "digest", "code", "copies", "edits", "state"), "edits")


class _Report:
    """What is counted while one conversation is told."""

    FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    SCHEMA = ", ".join(["key string", *[f"{f} bigint" for f in FIELDS], "audit string", "repaired_sha256 string"])

    def __init__(self, key: str):
        self.key, self.audit, self.hash, self.lines = key, [], hashlib.sha256(), 0
        self.low = self.high = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0

    def turn(self, turn: int | None, code: int, copies: int, edits: str) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = code & _INITIAL
        self.illegal += copies - 1
        if self.before is not None and (self.before, initial) not in _LEGAL:
            self.illegal += 1
        self.before = initial
        if code & _BLANK:
            self.blank += copies
        else:
            self.duplicate += copies - (0 if code & _SEEN else 1)
            stays = code & _TRUNCATED and not code & _SEEN
            self.truncated += 1 if stays else 0
            self.cost += 1 if stays and ("K" in edits or "R" in edits) else 0
        self.cost += 3 * edits.count("D") + 2 * (edits.count("I") + edits.count("R"))
        self.audit.append(edits)

    def line(self, role: str, text: str) -> None:
        self.hash.update(f"\n{role}:{text}".encode() if self.lines else f"{role}:{text}".encode())
        self.lines += 1

    def values(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.key, *counts, "".join(self.audit), self.hash.hexdigest())


def _spoken(edits: str, state: int, role: str, text: str | None) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of what one turn's letters leave."""
    for letter in edits:
        if letter == "K":
            state = _KEEP[state][{"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]]
            yield letter, role, text
        elif letter != "D":
            state = _NEXT[state]
            yield letter, _ROLE[state], text if letter == "R" else ""


def _told(batches: Iterator[pa.RecordBatch], report: bool) -> Iterator[pa.RecordBatch]:
    """Reports, or the repaired turns. Per turn its edits arrive before its texts."""
    schema = pa.schema(
        [("key", pa.string()), *[(f, pa.int64()) for f in _Report.FIELDS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
        if report
        else [("key", pa.string()), ("number", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    )
    now, pending, number = None, None, 0
    for batch in batches:
        out = []
        rows = zip(*[batch.column(c).to_pylist() for c in ("key", "turn", "role", "code", "copies", "edits", "state", "text")])
        for key, turn, role, code, copies, edits, state, text in rows:
            if now is None or now.key != key:
                if report and now is not None:
                    out.append(now.values())
                now, number = _Report(key), 0
            if edits is not None:
                now.turn(turn, code, copies, edits)
                pending = edits, state
                if "K" in edits or "R" in edits:
                    continue  # waits for its text
            elif pending is None:
                continue  # a further copy
            for edit, speaker, said in _spoken(*pending, role, text):
                if report:
                    now.line(speaker, said)
                else:
                    out.append((key, number, turn, edit, speaker, said))
                number += 1
            pending = None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if report and now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(now.values(), schema)], schema=schema)


def _tell(turns: DataFrame, report: bool) -> DataFrame:
    spark, scratch = turns.sparkSession, Scratch(turns.sparkSession, "conversations")
    edits = plan_edits(turns, scratch).withColumn("text", F.lit(None).cast("string"))
    empty = {"code": "int", "copies": "bigint", "edits": "string", "state": "int"}
    texts = _typed(turns).withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    rows = edits.unionByName(texts).repartition(partitions(spark), "key")
    rows = rows.sortWithinPartitions("key", "turn", "role", "digest", F.col("edits").isNull())
    schema = _Report.SCHEMA if report else "key string, number bigint, turn bigint, edit string, role string, text string"
    return rows.mapInArrow(lambda batches: _told(batches, report), schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations of ``turns(conv_id, turn, role, text, ...)``: conv_id, number, turn, edit, role, text.

    ``number`` counts a conversation's repaired turns from 0, ``edit`` is K, R or I, and ``turn`` is the place of
    the row or, for an inserted one, of its neighbour. Null roles and texts count as one space, a null
    conv_id as a conversation like others; null turns come first, equal turns go by role, then by the text's
    SHA-256. Repeated rows are duplicates. Other columns are not read, and an empty table gives an empty result.
    """
    told = _tell(turns, report=False)
    ids = turns.select("conv_id", conversation_key(F.col("conv_id")).alias("key")).distinct()
    return told.join(ids, "key").select("conv_id", "number", "turn", "edit", "role", "text")


def repair_report(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults and repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``every`` may name more conversations (conv_id); those without turns have zeros, an empty audit and the hash
    of the empty string. Faults: each turn's first of blank, duplicate, truncated; ``gaps`` are missing turn
    numbers, ``illegal`` neighbours that are not system-user, user-assistant or assistant-user. Rows are
    read as in ``repaired_turns``. The hash of one conversation is one stream, so its texts meet in one task,
    which holds one batch of them; the audit is a single value by contract.
    """
    told = _tell(turns, report=True)
    ids = (turns if every is None else every).select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    joined = ids.join(told, "key", "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in _Report.FIELDS]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Trial damage by crc32 of ``conv_id:turn`` modulo 20, nulls as one space.

    0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copy = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copy.alias("copy")).drop("copy")
