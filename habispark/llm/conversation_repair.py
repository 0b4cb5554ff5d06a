"""Lightest repair of damaged conversations, by Knuth's agenda over weighted deductions.

The rows of a conversation, in order, are edited so that the initials of the roles that stay spell
`(s?(ua)+)?`. An item is "the rows before `at` are repaired and the automaton is in `state`"; each edit of
the next row, and each inserted turn, is a deduction that leads from one item to another. A
derivation is worth the pair (cost, audit), the audit being the initials of its edits, and the agenda always
finalises the least pair it holds. That is right because every deduction is superior: it never lowers
the cost, and it lengthens the audit. It is also monotone: two derivations of one item of equal cost
differ at some letter of both, as letters fix their cost, so whatever follows keeps their order.

Only a light row per text (digest, initial, faults) takes part in the search. The light rows are sorted by
ranges of (conversation, turn), so a conversation of any length is spread over tasks. Each task deduces,
piece by piece, items [from state, to state] for its part of a conversation, and parts of one
conversation are joined by deductions with two antecedents: an item of the parts so far and
one of the next part. What is joined in one task is audits, one letter a row, which is the size of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import stored

# States: nothing yet, after s, after u, after a. A repaired conversation ends in the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_AFTER = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
_NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
KEEP, DELETE, INSERT, REROLE = "K", "D", "I", "R"
_COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
_TRUNCATED_COST = 5
# Rows whose audits are spelt out in one search; longer parts are joined from pieces of so many.
PIECE_ROWS = 64

Value = tuple[int, str]
Ways = dict[tuple[int, int], Value]


def lightest(axioms: Iterable[tuple], consequences: Callable[[object, Value], Iterable[tuple]], goal=None) -> dict:
    """Values of all items that can be deduced, or of those up to `goal`, finalised from the least value on.

    `axioms` are pairs (item, value); `consequences` gives such pairs for an item that has just been finalised.
    """
    agenda: list = []
    for item, value in axioms:
        heappush(agenda, (value, item))
    final: dict = {}
    while agenda:
        value, item = heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if item == goal:
            break
        for deduced, its_value in consequences(item, value):
            if deduced not in final:
                heappush(agenda, (its_value, deduced))
    return final


def _piece(rows: list[tuple[str, bool, bool]], start: int) -> dict[int, Value]:
    """Least values from `start` to each state over some rows (initial, must go, truncated)."""
    last = len(rows)

    def edits(item: tuple[int, int], value: Value) -> Iterator[tuple]:
        (at, state), (cost, audit) = item, value
        role = _NEXT_ROLE[state]
        yield (at, _AFTER[state, role[0]]), (cost + _COST[INSERT], audit + INSERT)
        if at == last:
            return
        initial, must_go, truncated = rows[at]
        yield (at + 1, state), (cost + _COST[DELETE], audit + DELETE)
        if must_go:
            return
        more = cost + _TRUNCATED_COST * truncated
        if (state, initial) in _AFTER:
            yield (at + 1, _AFTER[state, initial]), (more, audit + KEEP)
        yield (at + 1, _AFTER[state, role[0]]), (more + _COST[REROLE], audit + REROLE)

    found = lightest([((0, start), (0, ""))], edits)
    return {state: value for (at, state), value in found.items() if at == last}


def joined(parts: list[Ways], starts: Iterable[int]) -> Ways:
    """Ways through several parts in a row: [from, k parts, to] and a way of part k deduce [from, k + 1 parts, to]."""
    ways: Ways = {}
    for start in starts:

        def longer(item: tuple[int, int], value: Value) -> Iterator[tuple]:
            done, state = item
            if done < len(parts):
                for to in STATES:
                    if (state, to) in parts[done]:
                        cost, audit = parts[done][state, to]
                        yield (done + 1, to), (value[0] + cost, value[1] + audit)

        for (done, to), value in lightest([((0, start), (0, ""))], longer).items():
            if done == len(parts):
                ways[start, to] = value
    return ways


class Part:
    """The rows of one conversation that one task holds, taken in order and joined piece by piece."""

    def __init__(self, first: bool):
        # The first part of a conversation can only begin with nothing.
        self.starts = (START,) if first else STATES
        self.rows: list[tuple[str, bool, bool]] = []
        self.levels: list[list[Ways]] = []
        self.begun = False

    def add(self, row: tuple[str, bool, bool]) -> None:
        self.rows.append(row)
        if len(self.rows) == PIECE_ROWS:
            self._close()

    def _close(self) -> None:
        starts = STATES if self.begun else self.starts
        self.begun = True
        ways = {(start, to): value for start in starts for to, value in _piece(self.rows, start).items()}
        self.rows = []
        # As in a binary counter: two stretches of equal length become one, so audits are copied log(n) times.
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            if not self.levels[level]:
                self.levels[level].append(ways)
                return
            earlier = self.levels[level].pop()
            ways = joined([earlier, ways], sorted({start for start, _ in earlier}))
            level += 1

    def ways(self) -> Ways:
        if self.rows or not self.begun:
            self._close()
        return joined([level[0] for level in reversed(self.levels) if level], self.starts)


def lightest_repair(parts: list[Ways]) -> Value:
    """Cost and audit of the goal, which the first and the last state deduce."""
    ways = joined(parts, (START,))
    goals = [(ways[START, to], ("goal",)) for to in (START, ASSISTANT) if (START, to) in ways]
    return lightest([(item, value) for value, item in goals], lambda item, value: (), ("goal",))[("goal",)]


# --- rows and their faults ---------------------------------------------------------------------------

_BLANKS = " \t\n\x0b\x0c\r"
_KEYS = ("conv_id", "turn", "text_key")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows as they are, a NULL role or text as one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _spaced("role").alias("role"),
        _spaced("text").alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """`turns` after the damage that the checksum of conversation and turn chooses; a repeated row has two copies."""
    name = F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))
    fate, text = F.col("fate"), F.col("text")
    emptied = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    return (
        turns(conversations)
        .withColumn("fate", F.crc32(name.cast("binary")) % 20)
        .filter(fate != 0)
        .select(
            "conv_id", "turn",
            F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
            emptied.alias("text"),
            F.when(fate == 3, 2).otherwise(1).alias("copies"),
        )
    )


def _text_key() -> Column:
    """16 bytes that stand for a role and a text; they also order the rows of one turn."""
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("text_key")


def _light(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a conversation and turn: what the search needs to know of them."""
    ended = F.rtrim(F.col("text"), F.lit(_BLANKS))
    light = rows.select(
        "conv_id", "turn", _text_key(), F.substring("role", 1, 1).alias("initial"),
        (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("truncated"), "copies",
    )
    facts = [c for c in light.columns if c != "copies"]
    light = stored(light.groupBy(*facts).agg(F.sum("copies").alias("copies")), "turns")
    # Texts that come back in a later turn: one row each, and few of them as a rule. A NULL turn is the first.
    again = (
        light.groupBy(F.col("conv_id").alias("other_conv"), F.col("text_key").alias("other_key"))
        .agg(
            F.count(F.lit(1)).alias("places"),
            F.min("turn").alias("first_turn"),
            F.bool_or(F.col("turn").isNull()).alias("first_is_null"),
        )
        .filter(F.col("places") > 1)
        .drop("places")
    )
    same = F.col("conv_id").eqNullSafe(F.col("other_conv")) & (F.col("text_key") == F.col("other_key"))
    later = F.col("turn").isNotNull() & (F.col("first_is_null") | (F.col("turn") > F.col("first_turn")))
    return light.join(again, same, "left").select(*light.columns, F.coalesce(later, F.lit(False)).alias("seen"))


# --- the search over all conversations ---------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PARTS = (
    "conv_id long, part int, ways array<struct<start:int,end:int,cost:long,audit:string>>, "
    + ", ".join(f"{c} long" for c in _COUNTS)
    + ", turns long, first_turn long, last_turn long, first_initial string, last_initial string"
)
_REPAIRS = "conv_id long, gaps long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string"
_LEGAL = {"su", "ua", "au"}
_BATCH = 2048


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _parts(rows: Iterator[dict], part: int) -> Iterator[dict]:
    """Sums up each stretch of sorted rows of one conversation."""
    out, search, conv, any_before = None, None, None, False

    def closed() -> dict:
        ways = search.ways()
        out["ways"] = [{"start": a, "end": b, "cost": c, "audit": x} for (a, b), (c, x) in ways.items()]
        return out

    for row in rows:
        if out is None or row["conv_id"] != conv:
            if out is not None:
                yield closed()
            conv = row["conv_id"]
            # Whatever a task begins with may have begun in an earlier one.
            search = Part(any_before)
            any_before = True
            out = dict.fromkeys(_COUNTS, 0) | {
                "conv_id": conv, "part": part, "turns": 0, "first_turn": None, "last_turn": None,
                "first_initial": row["initial"], "last_initial": None,
            }
        initial, copies = row["initial"], row["copies"]
        if out["last_initial"] is not None:
            out["illegal"] += out["last_initial"] + initial not in _LEGAL
        out["illegal"] += copies - 1
        out["last_initial"] = initial
        if row["turn"] is not None and row["turn"] != out["last_turn"]:
            out["turns"] += 1
            out["first_turn"] = row["turn"] if out["first_turn"] is None else out["first_turn"]
            out["last_turn"] = row["turn"]
        if row["blank"]:
            out["blank"] += copies
        else:
            out["duplicate"] += copies - 1 + row["seen"]
            out["truncated"] += row["truncated"] and not row["seen"]
        must_go = row["blank"] or row["seen"]
        search.add((initial, must_go, row["truncated"] and not must_go))
        for _ in range(copies - 1):
            search.add((initial, True, False))
    if out is not None:
        yield closed()


def _joined_parts(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation out of its parts, which come in order."""
    held: list[dict] = []

    def closed() -> dict:
        ways = [{(w["start"], w["end"]): (w["cost"], w["audit"]) for w in part["ways"]} for part in held]
        cost, audit = lightest_repair(ways)
        out = {c: sum(part[c] for part in held) for c in _COUNTS}
        distinct = sum(part["turns"] for part in held)
        seen_turn = first_turn = None
        for part in held:
            distinct -= seen_turn is not None and part["first_turn"] == seen_turn
            first_turn = part["first_turn"] if first_turn is None else first_turn
            seen_turn = part["last_turn"] if part["last_turn"] is not None else seen_turn
        for earlier, part in zip(held[:-1], held[1:], strict=True):
            out["illegal"] += earlier["last_initial"] + part["first_initial"] not in _LEGAL
        gaps = 0 if first_turn is None else seen_turn - first_turn + 1 - distinct
        return out | {"conv_id": held[0]["conv_id"], "gaps": gaps, "cost": cost, "audit": audit}

    for row in rows:
        if held and row["conv_id"] != held[0]["conv_id"]:
            yield closed()
            held = []
        held.append(row)
    if held:
        yield closed()


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit for every conversation of `rows`.

    `rows` has the columns of `turns`. Rows are taken by turn, NULL first, and within a turn by a digest of role
    and text, so the result does not depend on how they lie; equal rows of a turn are neighbours. Of equal rows
    only the first is no duplicate. A conversation without an identifier is one conversation. A role that is
    empty, or begins with another letter than s, u and a, can only be changed or deleted. Texts may be of any
    length: only their digests and ends are looked at. An empty table gives an empty result.
    """

    part_columns, repair_columns = _arrow(_PARTS), _arrow(_REPAIRS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _batches(_parts(_in_order(batches), TaskContext.get().partitionId()), part_columns)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_joined_parts(_in_order(batches)), repair_columns)

    light = _light(rows)
    ranges = light.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    # Stored, as parts are numbered by the ranges of this run.
    parts = stored(ranges.mapInArrow(search, _PARTS), "repair-parts")
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(join, _REPAIRS)


# --- repaired conversations --------------------------------------------------------------------------


def _walk(rows: Iterator[dict]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of every turn, deleted ones too, as the audits say; (conv_id, None, …) ends
    a conversation. Audits come before the rows of their conversation."""
    audit, at, kept, odd, conv, open_ = "", 0, 0, False, None, False

    def placed(edit: str, role: str, text: str) -> tuple:
        nonlocal kept
        kept += 1
        if edit != KEEP:
            # The roles that stay alternate, behind a system turn if their number is odd.
            role = ("assistant", "user")[(kept + odd) % 2]
        return conv, edit, role, text

    def inserted() -> Iterator[tuple]:
        nonlocal at
        while at < len(audit) and audit[at] == INSERT:
            at += 1
            yield placed(INSERT, "", "")

    for row in rows:
        if row["audit"] is not None:
            if open_:
                yield from inserted()
                yield conv, None, None, None
            audit, at, kept, conv, open_ = row["audit"], 0, 0, row["conv_id"], True
            odd = (len(audit) - audit.count(DELETE)) % 2 == 1
            continue
        for _ in range(row["copies"]):
            yield from inserted()
            edit = audit[at]
            at += 1
            yield (conv, DELETE, row["role"], row["text"]) if edit == DELETE else placed(edit, row["role"], row["text"])
    if open_:
        yield from inserted()
        yield conv, None, None, None


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows, in order. Streams through a task: a batch at a time."""
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", _text_key(), "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    none = lambda kind: F.lit(None).cast(kind)
    audits = found.select(
        "conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("binary").alias("text_key"),
        none("string").alias("role"), none("string").alias("text"), F.lit(0).alias("copies"), "audit",
    )
    order = ("conv_id", "kind", "turn", "text_key")
    both = audits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "role", "text", "copies", "audit")


def repaired_turns(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """conv_id, position, role, text, edit of the repaired conversations: K kept, R with another role, I inserted.

    `found` are the `repairs` of the same rows. A conversation of which nothing is left has no row here. The
    texts of one conversation are written by one task, in order, a batch at a time.
    """
    schema = "conv_id long, position long, role string, text string, edit string"
    columns = _arrow(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed() -> Iterator[dict]:
            position = 0
            for conv, edit, role, text in _walk(_in_order(batches)):
                if edit is None:
                    position = 0
                elif edit != DELETE:
                    yield {"conv_id": conv, "position": position, "role": role, "text": text, "edit": edit}
                    position += 1

        yield from _batches(placed(), columns)

    return _with_audits(rows, repairs(rows) if found is None else found).mapInArrow(walk, schema)


def repair_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired turns as `role:text`, joined by line breaks."""
    schema = "conv_id long, repaired_sha256 string"
    columns = _arrow(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[dict]:
            digest, between = hashlib.sha256(), ""
            for conv, edit, role, text in _walk(_in_order(batches)):
                if edit is None:
                    yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}
                    digest, between = hashlib.sha256(), ""
                elif edit != DELETE:
                    digest.update(f"{between}{role}:{text}".encode())
                    between = "\n"

        yield from _batches(digests(), columns)

    return _with_audits(rows, found).mapInArrow(walk, schema)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conversation
    of the table, after `damaged`.

    A conversation of which the damage leaves nothing has zeros, an empty audit and the digest of the empty
    text. NULLs, ties, long texts, repeated rows and empty tables: see `turns` and `repairs`. Other
    columns may have any name.
    """
    rows = damaged(conversations)
    found = stored(repairs(rows), "repairs")
    digests = repair_digests(rows, found)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    of = F.col("conv_id").eqNullSafe(F.col("found_id"))
    out = every.join(found.withColumnRenamed("conv_id", "found_id"), of, "left").drop("found_id")
    out = out.join(digests.withColumnRenamed("conv_id", "found_id"), of, "left").drop("found_id")
    numbers = ("gaps", *_COUNTS, "cost")
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
