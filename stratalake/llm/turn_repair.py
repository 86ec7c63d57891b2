"""Repair of the turn structure of conversations by auction shortest paths.

A conversation's rows and the roles asked for so far span a lattice: node (i, state) stands before
row i, in state START, S (a system turn), U (a user turn is open) or A (the last pair is complete).
Edits are arcs with integer costs: Keep 0, Rerole 3, Delete 4, Insert 3, and 3 more for a truncated
row that is not deleted; blank and duplicate rows can only be deleted. Role initials of what comes
out read `(s?(ua)+)?`.

The auction keeps a price per node, never above an arc's cost plus the price at its end, and one
path from an origin: where the last node's price is below its best arc, the price rises to it and
the path contracts, else the path extends along that arc, until it meets the destination or a node
whose price has converged. Origins are taken from the last row backwards, so that in the end every
price is the exact cost that remains: an arc lies on a cheapest path if and only if it is tight.
The audit is traced along tight arcs, the least letter first (D, I, K, R); a letter and a row tell
the next node, so this gives the ASCII-least one.

Conversations of at most `block_rows` rows are streamed through tasks by id. Longer ones are sorted
over many tasks and cut into blocks: each block's auction gives what it costs from each state before
it to each state after it, an auction over a conversation's blocks gives what remains after each,
and every block is then traced on its own from each state. Only the SHA-256 of a repaired text,
sequential by definition, sees a long conversation in one task, as a stream.

Rows of one turn are taken by role, then text. Defined cases: null ids are one conversation. A null
id or turn reads as one space where it is hashed, a null role or text is one space; null turns come
first and are ignored by gaps. An empty role has no initial and must be replaced or deleted. A
conversation that loses all its rows has zeros, an empty audit and the hash of nothing. Repeated
rows are rows: all but the first are duplicates. An empty table gives no rows. Only the four columns
are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import fits_broadcast
from stratalake.sources.staging import Staging

BLANKS = " \t\n\v\f\r"
START, S, U, A = range(4)
STATES = (START, S, U, A)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# The role that continues each state, and where it leads.
_ASKED = {START: ("user", U), S: ("user", U), U: ("assistant", A), A: ("user", U)}
_KEPT = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
_LEGAL = {"su", "ua", "au"}
FAR = 1 << 60

Arc = tuple[str, int, int]  # letter, cost, node


@dataclass(frozen=True)
class RepairParams:
    # Rows of a conversation that one task holds at a time.
    block_rows: int = 256


@dataclass(frozen=True)
class Turn:
    """What the lattice knows of a row."""

    initial: str
    doomed: bool
    truncated: bool


# --- the auction --------------------------------------------------------------------------------

def auction(origins: Iterable[int], arcs: Sequence[list[Arc]], destination: int) -> list[int]:
    """Cost of the cheapest path from every origin to the destination, FAR if there is none."""
    # Prices of nodes without a way to the destination would rise for ever.
    before: list[list[int]] = [[] for _ in arcs]
    for node, own in enumerate(arcs):
        for _, _, end in own:
            before[end].append(node)
    price, settled = [FAR] * len(arcs), [True] * len(arcs)
    open_nodes = [destination]
    price[destination] = 0
    while open_nodes:
        for node in before[open_nodes.pop()]:
            if price[node]:
                price[node], settled[node] = 0, False
                open_nodes.append(node)
    for origin in origins:
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, to = FAR, -1
            for _, cost, end in arcs[node]:
                if cost + price[end] < best:
                    best, to = cost + price[end], end
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            settled[node] = True
    return price


def tight(node: int, arcs: Sequence[list[Arc]], price: Sequence[int]) -> Arc:
    """The tight arc with the least letter."""
    return min(a for a in arcs[node] if a[1] + price[a[2]] == price[node])


class Lattice:
    """Nodes 4 * i + state and, last, the destination. `after` is what remains after the rows, by
    state; without it the conversation ends there, and turns may be inserted at its end."""

    def __init__(self, turns: Sequence[Turn], after: Sequence[int] | None = None):
        self.n, self.end = len(turns), 4 * len(turns) + 4
        self.arcs: list[list[Arc]] = []
        for i, turn in enumerate(turns):
            for state in STATES:
                role, to = _ASKED[state]
                own = [("D", DELETE, 4 * i + 4 + state), ("I", INSERT, 4 * i + to)]
                if not turn.doomed:
                    more = TRUNCATED * turn.truncated
                    kept = _KEPT[state].get(turn.initial)
                    if kept is not None:
                        own.append(("K", KEEP + more, 4 * i + 4 + kept))
                    own.append(("R", REROLE + more, 4 * i + 4 + to))
                self.arcs.append(own)
        for state in STATES:
            if after is not None:
                self.arcs.append([("", after[state], self.end)] if after[state] < FAR else [])
            else:
                done = [("", 0, self.end)] if state in (START, A) else []
                self.arcs.append([*done, ("I", INSERT, 4 * self.n + _ASKED[state][1])])
        self.arcs.append([])
        self.price = auction(range(self.end - 1, -1, -1), self.arcs, self.end)

    def remaining(self) -> list[int]:
        """Cost from each state before the rows."""
        return self.price[:4]

    def trace(self, state: int) -> tuple[str, int]:
        """The least audit from a state, and the state after the rows."""
        node, audit = state, []
        while True:
            letter, _, to = tight(node, self.arcs, self.price)
            if to == self.end:
                return "".join(audit), node - 4 * self.n
            audit.append(letter)
            node = to


def solve(turns: Sequence[Turn]) -> tuple[int, str]:
    lattice = Lattice(turns)
    return lattice.price[START], lattice.trace(START)[0]


class Repairer:
    """Repaired lines of a conversation, from its audit and its rows in order, hashed as they come."""

    def __init__(self) -> None:
        self.state, self.digest, self.lines = START, hashlib.sha256(), 0
        self.audit: Iterator[str] = iter("")

    def follow(self, audit: str) -> None:
        """Go on with the next block's audit."""
        self.close()
        self.audit = iter(audit)

    def _line(self, role: str, text: str, state: int) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.lines, self.state = self.lines + 1, state

    def row(self, role: str, text: str) -> None:
        for letter in self.audit:
            if letter == "D":
                return
            if letter == "K":
                return self._line(role, text, _KEPT[self.state][role[:1]])
            asked, to = _ASKED[self.state]
            if letter == "R":
                return self._line(asked, text, to)
            self._line(asked, "", to)

    def close(self) -> None:
        """What the audit inserts after the last row."""
        for _ in self.audit:
            asked, to = _ASKED[self.state]
            self._line(asked, "", to)


# --- damage -------------------------------------------------------------------------------------

def damage(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """conv_id, turn, role, text, gone: dropped rows are marked, repeated ones there twice."""
    def spaced(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(" "))

    case = F.crc32(F.concat(spaced(conv_id), F.lit(":"), spaced(turn))) % 20
    own = spaced(text)
    return conversations.select(
        conversations[conv_id].alias("conv_id"), conversations[turn].cast("bigint").alias("turn"),
        F.when(case == 4, F.lit("user")).otherwise(spaced(role)).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate(own, ".!?", "")).otherwise(own).alias("text"),
        (case == 0).alias("gone"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


_NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
COLUMNS = ["conv_id", *_NUMBERS, "audit", "repaired_sha256"]


def _turn(role: str, text: str, seen: set) -> tuple[Turn, str]:
    """A row and its first fault."""
    words = text.rstrip(BLANKS)
    if not words:
        return Turn(role[:1], True, False), "blank"
    if (role, text) in seen:
        return Turn(role[:1], True, False), "duplicate"
    seen.add((role, text))
    cut = words[-1] not in ".!?"
    return Turn(role[:1], False, cut), "truncated" if cut else ""


def repair(rows: Sequence[tuple[int | None, str, str]]) -> dict:
    """Everything about one conversation, from (turn, role, text) in order."""
    seen: set = set()
    found = [_turn(role, text, seen) for _, role, text in rows]
    faults = [f for _, f in found]
    cost, audit = solve([t for t, _ in found])
    told = Repairer()
    told.follow(audit)
    for _, role, text in rows:
        told.row(role, text)
    told.close()
    numbered = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0,
        "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": told.digest.hexdigest(),
    }


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", id_type), *(T.StructField(c, T.LongType()) for c in _NUMBERS),
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])


def _repair_short(rows: DataFrame) -> DataFrame:
    """Conversations of bounded length, streamed in order of their id."""
    schema = _schema(rows.schema["conv_id"].dataType)

    def batch_of(found: list[tuple], types: pa.Schema) -> pa.RecordBatch:
        columns = [[c for c, _ in found], *([r[name] for _, r in found] for name in COLUMNS[1:])]
        kinds = [types.field("conv_id").type, *[pa.int64()] * len(_NUMBERS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, found, types = None, None, [], None
        for batch in batches:
            types = batch.schema
            for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or conv != now:
                    if own is not None:
                        found.append((now, repair(own)))
                    now, own = conv, []
                if not gone:
                    own.append((turn, role, text))
            if len(found) > 1000:
                yield batch_of(found, types)
                found = []
        if own is not None:
            yield batch_of([*found, (now, repair(own))], types)

    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions(*order)
    return sorted_rows.select("conv_id", "turn", "role", "text", "gone").mapInArrow(run, schema)


# --- long conversations -------------------------------------------------------------------------

def _laid_out(rows: DataFrame, params: RepairParams, staging: Staging) -> DataFrame:
    """conv, slot, block, turn, role, text, fault: every row at its place, written once.

    Equal rows are counted before they move, the first turn of a text is a grouped minimum, and rows
    are sorted by ranges of all columns, so neither a long conversation nor a text that it repeats is
    held by one task.
    """
    said = F.sha2(F.concat("role", F.lit("\x1f"), "text"), 256)
    # Ids as text: grouped functions know no whole numbers with nulls.
    counted = rows.groupBy(F.col("conv_id").cast("string").alias("conv"), "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("_n")
    ).withColumn("_said", said)
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"))
    first = counted.groupBy(F.col("conv").alias("_conv"), F.col("_said").alias("_what")).agg(F.min(place).alias("_first"))
    joined = counted.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("_said") == F.col("_what")))
    words = F.rtrim(F.col("text"), F.lit(BLANKS))
    later = (F.col("_copy") > 1) | ~F.col("_first").eqNullSafe(place)
    faults = (
        F.when(words == "", F.lit("blank")).when(later, F.lit("duplicate"))
        .when(~F.substring(words, -1, 1).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit(""))
    )
    all_rows = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(
        "conv", "turn", "role", "text", "_copy", faults.alias("fault")
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "_copy"]
    staged = staging.table(
        all_rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "turn", "role", "text", "fault", F.monotonically_increasing_id().alias("slot"))
    )
    return staged.withColumn("block", F.floor(F.col("slot") / params.block_rows).cast("long"))


def _turns(rows: pd.DataFrame) -> list[Turn]:
    return [
        Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        for role, fault in zip(rows["role"], rows["fault"])
    ]


def _block_costs(rows: pd.DataFrame) -> pd.DataFrame:
    """A block's cost from each state to each state, and its count of illegal neighbours."""
    rows = rows.sort_values("slot")
    turns = _turns(rows)
    ends = [Lattice(turns, [0 if s == end else FAR for s in STATES]).remaining() for end in STATES]
    initials = [t.initial for t in turns]
    return pd.DataFrame({
        "conv": [rows["conv"].iloc[0]], "block": [rows["block"].iloc[0]],
        "costs": [[ends[e][s] for s in STATES for e in STATES]],
        "illegal": [sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:]))],
        "first": [initials[0]], "last": [initials[-1]],
    })


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """What remains after each block, by state, by an auction over a conversation's blocks."""
    blocks = blocks.sort_values("block", ignore_index=True)
    n, tail = len(blocks), Lattice([])
    end = 4 * n + 4
    arcs: list[list[Arc]] = [
        [(str(e), costs[4 * s + e], 4 * k + 4 + e) for e in STATES if costs[4 * s + e] < FAR]
        for k, costs in enumerate(blocks["costs"]) for s in STATES
    ]
    arcs += [[("", cost, end)] for cost in tail.remaining()] + [[]]
    price = auction(range(end - 1, -1, -1), arcs, end)
    seams = [x + y not in _LEGAL for x, y in zip(blocks["last"], blocks["first"][1:])] + [False]
    return pd.DataFrame({
        "conv": blocks["conv"], "block": blocks["block"],
        "after": [price[4 * k + 4 : 4 * k + 8] for k in range(n)],
        "illegal": blocks["illegal"] + pd.Series(seams, dtype="int64"), "cost": [price[START]] * n,
    })


def _block_traces(rows: pd.DataFrame) -> pd.DataFrame:
    """A block's audit from each state, and the state it leads to."""
    rows = rows.sort_values("slot")
    lattice = Lattice(_turns(rows), [int(x) for x in rows["after"].iloc[0]])
    traces = [lattice.trace(s) for s in STATES]
    return pd.DataFrame({
        "conv": [rows["conv"].iloc[0]], "block": [rows["block"].iloc[0]], "slot": [rows["slot"].iloc[0]],
        "audits": [[a for a, _ in traces]], "ends": [[e for _, e in traces]],
    })


def _walk(blocks: pd.DataFrame) -> pd.DataFrame:
    """The audits that the states of a conversation really ask for, one block after the other."""
    blocks = blocks.sort_values("block", ignore_index=True)
    state, audits = START, []
    for own, ends in zip(blocks["audits"], blocks["ends"]):
        audits.append(own[state])
        state = int(ends[state])
    audits[-1] += Lattice([]).trace(state)[0]
    return pd.DataFrame({"conv": blocks["conv"], "slot": blocks["slot"], "audit": audits})


def _hash_long(rows: DataFrame) -> DataFrame:
    """conv, repaired_sha256: rows in order, as a stream; a block's audit comes with its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told = None, None

        def done() -> pa.RecordBatch:
            told.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.string()), pa.array([told.digest.hexdigest()], pa.string())],
                names=["conv", "repaired_sha256"],
            )

        for batch in batches:
            for conv, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if told is None or conv != now:
                    if told is not None:
                        yield done()
                    now, told = conv, Repairer()
                if audit is not None:
                    told.follow(audit)
                told.row(role, text)
        if told is not None:
            yield done()

    sorted_rows = rows.repartition("conv").sortWithinPartitions("conv", "slot")
    return sorted_rows.select("conv", "role", "text", "audit").mapInArrow(run, "conv string, repaired_sha256 string")


def _repair_long(rows: DataFrame, params: RepairParams, staging: Staging) -> DataFrame:
    laid = _laid_out(rows, params, staging)
    light = laid.select("conv", "block", "slot", "role", "fault")
    costs = staging.table(light.groupBy("conv", "block").applyInPandas(
        _block_costs, "conv string, block long, costs array<long>, illegal long, first string, last string"
    ))
    chain = staging.table(costs.groupBy("conv").applyInPandas(
        _chain, "conv string, block long, after array<long>, illegal long, cost long"
    ))

    remaining = chain.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), "after")
    of_block = (F.col("block") == F.col("_block")) & F.col("conv").eqNullSafe(F.col("_conv"))
    traced = light.join(remaining, of_block).drop("_conv", "_block")
    traces = staging.table(traced.groupBy("conv", "block").applyInPandas(
        _block_traces, "conv string, block long, slot long, audits array<string>, ends array<long>"
    ))
    walked = staging.table(traces.groupBy("conv").applyInPandas(_walk, "conv string, slot long, audit string"))
    audits = walked.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("slot", "audit"))).alias("_parts")).select(
        "conv", F.array_join(F.col("_parts.audit"), "").alias("audit")
    )
    texts = laid.select("conv", "slot", "role", "text")
    hashes = _hash_long(
        texts.join(walked.select("slot", "audit"), "slot", "left").select("conv", "slot", "role", "text", "audit")
    )

    def count(fault: str) -> Column:
        return F.count_if(F.col("fault") == fault).alias(fault)

    numbers = laid.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *map(count, ("blank", "duplicate", "truncated")),
    )
    whole = chain.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"))
    out = numbers
    for more in (whole, audits, hashes):
        more = more.withColumnRenamed("conv", "_conv")
        out = out.join(more, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    id_type = rows.schema["conv_id"].dataType
    return out.select(
        F.col("conv").cast(id_type).alias("conv_id"), *(F.col(c).cast("bigint").alias(c) for c in _NUMBERS),
        "audit", "repaired_sha256",
    )


def repair_damaged(rows: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """COLUMNS of every conversation of `rows` (conv_id, turn, role, text, gone)."""
    spark = rows.sparkSession
    staging = Staging(spark)
    sizes = rows.groupBy(F.col("conv_id").alias("_long")).agg(F.count_if(~F.col("gone")).alias("_rows"))
    long = staging.table(sizes.where(F.col("_rows") > params.block_rows).select("_long"))
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    if long.isEmpty():
        return _repair_short(rows).select(*COLUMNS)
    few = F.broadcast(long) if fits_broadcast(long) else long
    short = _repair_short(rows.join(few, is_long, "left_anti"))
    of_long = rows.join(few, is_long, "left_semi").where(~F.col("gone"))
    return short.select(*COLUMNS).unionByName(_repair_long(of_long, params, staging).select(*COLUMNS))


def repair_conversations(conversations: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """Damage the rows of a table by the hash of their id and turn, and repair every conversation."""
    return repair_damaged(damage(conversations), params)

