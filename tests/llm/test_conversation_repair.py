"""Conversation repair against a cheapest-path search over the grammar's states."""
import hashlib
import random
import zlib

import pytest

from rubric.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, place string, symbol int, edits string"
NEXT = {"-": "u", "s": "u", "u": "a", "a": "u"}


def search(symbols):
    """Least (cost, audit) by relaxing (state -> cost, audit) turn by turn."""
    states = {"-": (0, "", ())}

    def add(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def inserts(states):
        out = dict(states)
        for _ in range(6):
            for s, (c, a, o) in list(out.items()):
                role = {"u": "user", "a": "assistant"}[NEXT[s]]
                add(out, NEXT[s], (c + 5, a + "I", (*o, (role, None))))
        return out

    for k, symbol in enumerate(symbols):
        new = {}
        for s, (c, a, o) in inserts(states).items():
            add(new, s, (c + 2, a + "D", o))
            if symbol == "X":
                continue
            extra = 5 if symbol.isupper() else 0
            low = symbol.lower()
            if low == NEXT[s] or (low == "s" and s == "-"):
                add(new, low, (c + extra, a + "K", (*o, (None, k))))
            if low != NEXT[s]:
                role = {"u": "user", "a": "assistant"}[NEXT[s]]
                add(new, NEXT[s], (c + 1 + extra, a + "R", (*o, (role, k))))
        states = new
    return min((v for s, v in inserts(states).items() if s in "-a"), key=lambda v: v[:2])


def judge(rows):
    """The contract over one conversation's (turn, role, text) after damage."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}"))
    seen, symbols, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not end:
            count["blank"] += 1
            symbols.append("X")
        elif (role, text) in seen:
            count["duplicate"] += 1
            symbols.append("X")
        elif end[-1] not in ".!?":
            count["truncated"] += 1
            symbols.append(initial.upper())
        else:
            symbols.append(initial)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, out = search(symbols) if rows else (0, "", ())
    lines = [f"{role or rows[k][1]}:{'' if k is None else rows[k][2]}" for role, k in out]
    return count | {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def damage(rows):
    for conv, turn, role, text in rows:
        blank = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        yield from [row, row] if kind == 3 else [row]


def expected(rows):
    out = {c: [] for c, *_ in rows}
    for conv, *rest in damage(rows):
        out[conv].append(tuple(rest))
    return {c: judge(r) for c, r in out.items()}


def got(spark, df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def test_alignment_equals_the_search():
    rng = random.Random(3)
    for _ in range(1500):
        symbols = "".join(rng.choices("suaSUAoOX", weights=[2, 6, 6, 1, 2, 2, 1, 1, 3], k=rng.randint(0, 9)))
        found = cr.transfers(symbols, "-")
        assert min(found[s] for s in "-a" if s in found) == search(symbols)[:2], symbols


def test_blocks_join_to_the_whole(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(cr, "SETTLE", 3)
    for _ in range(300):
        turns = [{"conv_id": 1, "turn": k, "copies": 1, "place": k, "later": False, "again": False, "initial": "u", "symbol": s}
                 for k, s in enumerate(rng.choices("suaSUAob", k=rng.randint(1, 60)))]
        chosen = list(cr._joined(cr._block(turns[i:i + 5]) for i in range(0, len(turns), 5)))
        whole = search("".join("X" if t["symbol"] == "b" else t["symbol"] for t in turns))
        assert (chosen[-1]["cost"], "".join(c["audit"] for c in chosen)) == whole[:2]
        edits = "".join(e["edits"] for c in chosen for e in cr.turn_edits(c))
        assert edits == whole[1]


def test_query_equals_brute_force(spark):
    from rubric.llm.queries import op11_conversation_repair
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(spark, op11_conversation_repair(spark, "/root/testdata/sf0.01")) == expected(rows)


def odd_conversations():
    rng = random.Random(5)
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (1, 3, "user", "Hi."), (None, 0, "user", "What?"), (None, 1, "assistant", "This."),
            (None, None, None, "x"), (2, 0, "", ""), (2, 0, "user", " \n\t"), (3, 5, "tool", "Out."), (3, 5, "admin", "Yes!"), (3, 9, "system", "é."),
            (4, 0, "user", "w " * 100_000 + "."), (4, 1, "assistant", "w" * 100_000)]
    rows += [(5, 7, "user", "Same again.")] * 400
    rows += [(6, k, "user" if k % 2 == 0 else "assistant", "Only one text.") for k in range(300)]
    rows += [(7, k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "B", "", f"t{k}.", f"t{k}"])) for k in range(700)]
    rows += [(8, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(600)]
    return rows


def test_odd_conversations(spark):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, "p", 1, "e") for r in rows], SCHEMA).repartition(7)
    assert got(spark, cr.repair_report(df, cr.damaged(df))) == expected(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(empty, cr.damaged(empty)).collect() == []
    assert cr.repair(empty).collect() == []


def test_repaired_conversations_are_sound(spark):
    df = spark.createDataFrame([(*r, "p", 1, "e") for r in odd_conversations()], SCHEMA)
    out = {}
    for r in cr.repair(df).orderBy("conv_id", "position").collect():
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["role"][:1]
    import re
    assert out and all(re.fullmatch("s?(ua)+", v) for v in out.values())
