from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import product

import pytest

from stratalake.llm.queries import QUERIES
from stratalake.llm.turn_repair import (
    COLUMNS, FAR, STATES, Lattice, RepairParams, Turn, auction, repair, repair_conversations, repair_damaged, solve,
)

sys.setrecursionlimit(10_000)
BLANKS = " \t\n\v\f\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(turns):
    """(cost, audit) by dynamic programming over whole audits, all states kept."""
    asked = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted=0):
        """Least (cost, audit) from row i on."""
        options = [(10**9, "")]
        if i == len(turns) and state in ("", "a"):
            options.append((0, ""))
        if inserted < 2:
            c, a = best(i, asked[state], inserted + 1)
            options.append((c + 3, "I" + a))
        if i < len(turns):
            t = turns[i]
            c, a = best(i + 1, state)
            options.append((c + 4, "D" + a))
            if not t.doomed:
                more = 3 * t.truncated
                if t.initial == asked[state] or (state == "" and t.initial == "s"):
                    c, a = best(i + 1, t.initial)
                    options.append((c + more, "K" + a))
                c, a = best(i + 1, asked[state])
                options.append((c + 3 + more, "R" + a))
        return min(options)

    return best(0, "")


def random_turns(rng, n):
    return tuple(Turn(rng.choice(["s", "u", "a", "a", "u", "t", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n))


def test_auction_equals_dynamic_programming():
    rng = random.Random(1)
    for n in [*range(8), *[20] * 40]:
        for _ in range(30 if n < 8 else 1):
            turns = random_turns(rng, n)
            assert solve(turns) == cheapest(turns), turns


def test_every_cheapest_audit_was_considered():
    """All edit strings of short conversations, by their definition."""
    rng = random.Random(2)
    for _ in range(25):
        turns = random_turns(rng, rng.randrange(4))
        found = []
        for length in range(len(turns) + 5):
            for audit in map("".join, product("DIKR", repeat=length)):
                if sum(x != "I" for x in audit) != len(turns):
                    continue
                rows = iter(turns)
                choices, cost = [], 0
                for letter in audit:
                    t = None if letter == "I" else next(rows)
                    cost += {"I": 3, "K": 0, "R": 3, "D": 4}[letter]
                    if letter in "KR":
                        cost += 3 * t.truncated + 10**6 * t.doomed
                    choices.append({"I": "ua", "R": "ua", "D": [""], "K": [t.initial if t else ""]}[letter])
                    if letter == "K" and not t.initial:
                        cost += 10**6
                if any(LEGAL.fullmatch("".join(c)) for c in product(*choices)):
                    found.append((cost, audit))
        assert solve(turns) == min(found), turns


def test_auction_on_any_graph():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(2, 12)
        arcs = [[("", rng.randrange(1, 9), rng.randrange(n)) for _ in range(rng.randrange(4))] for _ in range(n - 1)] + [[]]
        price = auction(range(n - 1), arcs, n - 1)
        real = [FAR] * (n - 1) + [0]
        for _ in range(n):
            for i, own in enumerate(arcs):
                real[i] = min([real[i], *(c + real[j] for _, c, j in own)])
        assert [min(p, FAR) for p in price[:-1]] == [min(r, FAR) for r in real[:-1]]


def test_blocks_compose():
    rng = random.Random(4)
    for _ in range(40):
        turns = random_turns(rng, 12)
        whole = Lattice(turns)
        after = Lattice(turns[5:])
        first = Lattice(turns[:5], after.remaining())
        assert first.remaining() == whole.remaining()
        for s in STATES:
            left, state = first.trace(s)
            assert left + after.trace(state)[0] == whole.trace(s)[0]


def expected(table):
    """(conv, turn, role, text) rows to all columns, by plain loops."""
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        own = convs[conv]
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, faults = set(), [], []
        for _, role, text in rows:
            own = text.strip(BLANKS)
            fault = "blank" if not own else "duplicate" if (role, text) in seen else "truncated" if own[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            turns.append(Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cheapest(tuple(turns))
        lines, state, left = [], "", iter(rows)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter != "D":
                role = row[1] if letter == "K" else {"u": "assistant"}.get(state, "user")
                lines.append(f"{role}:{row[2] if row else ''}")
                state = role[0]
        assert LEGAL.fullmatch("".join(x[0] for x in lines))
        known = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(df):
    rows = df.select(*COLUMNS).collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def conversation_rows(rng, convs, longest):
    says = ["Hello.", "Why?", "so", "", "  \n", "Done! ", "Hello.\x0b", None, "é.", "x\x00."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 2]), rng.choice(roles), rng.choice(says)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, gone int, block string, conv long, audit int"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("block_rows", [256, 4, 1])
def test_any_conversations_by_brute_force(spark, block_rows):
    rng = random.Random(5)
    rows = conversation_rows(rng, [*range(60), None], 14) + [(100, 3, "user", "Only this one.")]
    # Long ones, the second with hardly anything but one row.
    rows += conversation_rows(rng, [200], 60) + [(201, t // 30, "user", "Same.") for t in range(90)]
    rows += [(300 + i, 0, "user", "Perhaps dropped.") for i in range(60)]
    rng.shuffle(rows)
    have = got(repair_conversations(table_of(spark, rows), RepairParams(block_rows)))
    want = expected(rows)
    assert have == want
    assert any(x == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for x in have.values())


def test_long_conversation_over_several_partitions(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Turn {t}{rng.choice(['.', '', '?'])}") for t in range(700)]
    assert got(repair_conversations(table_of(spark, rows), RepairParams(32))) == expected(rows)


def test_query_on_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_turn_repair"](spark, "/root/testdata/sf0.001")) == expected(rows)


def test_text_ids_and_empty_table(spark):
    rows = spark.createDataFrame([("c", 0, "user", "Hi."), ("c", 1, "assistant", "Yes.")], "conv_id string, turn int, role string, text string")
    assert set(got(repair_conversations(rows))) == {"c"}
    assert repair_conversations(table_of(spark, [])).count() == 0
    undamaged = rows.selectExpr("conv_id", "cast(turn as bigint) turn", "role", "text", "false gone")
    assert got(repair_damaged(undamaged))["c"][-3:-1] == (0, "KK")


def test_repaired_text():
    told = repair([(0, "user", "Hi."), (1, "user", "Still there?"), (2, "assistant", "Yes."), (3, "assistant", "and")])
    assert (told["cost"], told["audit"]) == (7, "KIKKD")
    text = "user:Hi.\nassistant:\nuser:Still there?\nassistant:Yes."
    assert told["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
