"""Operator 11: conversation structure repair by target alignment.

A conversation is sound when the initials of its roles read
``(s?(ua)+)?``.  ``repair`` finds the cheapest edits that make it so and returns
the repaired turns; ``repair_summary`` gives faults, cost and audit a conversation.

Method: Wagner-Fischer alignment of the turns with every feasible length of the
alternating grammar string, inside the Ukkonen band that the cost of the best
alignment so far (the incumbent) allows; among equal costs the backtraced audits
are compared.  Costs: Keep 0, Rerole to user or assistant 1, Delete 2 (required for
blank and duplicate turns), Insert an empty user or assistant turn 5; a truncated
turn that stays adds 5.

Conversations of any length: rows are range-partitioned by conversation and turn,
so a huge one lies in many tasks.  Each run of ``BLOCK`` turns is aligned once for
each state in which the grammar may stand before it (nothing yet, ``s``, ``u`` or
``a`` last) and each state after it.  A block then is a table of at most sixteen
entries, and a conversation's blocks are joined in order by cost, then audit.
Audits of equal cost consume the same turns, so none is a prefix of another and
comparing them block by block compares the whole.  A task that joins blocks holds
only those on which the states still disagree.

Edge cases: a null role or text counts as one space, a null conversation id is a
conversation of its own, null turns come first.  Turns of equal number are ordered
by ``role:text``; equal rows follow one another, and each after the first is a
duplicate.  A role whose initial is none of s, u and a can be reroled or deleted.
An empty table gives an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubric.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns aligned at once.
BLOCK = 32
#: Blocks after which a joining task emits what all states agree on.
SETTLE = 64
#: A third of all rows may repeat one text in one conversation: such rows are dealt to this many tasks.
SALTS = 16
#: Characters of a turn that place it among turns of the same number when rows are dealt to tasks.
PLACE_CHARS = 64

# White space is the space and U+0009..U+000D; a turn ends with one of .!?
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: Grammar states: nothing emitted, then the initial emitted last.
NOTHING = "-"
STATES = (NOTHING, "s", "u", "a")
ACCEPTING = (NOTHING, "a")
FOLLOWS = {NOTHING: "u", "s": "u", "u": "a", "a": "u"}
#: Symbols of turns: lower case sound, upper case truncated, o any other initial, X to be deleted.
MUST_DELETE = "X"


# ---------------------------------------------------------------------------
# Alignment of one block (plain Python over at most a few dozen symbols)
# ---------------------------------------------------------------------------

def alternating(first: str, length: int) -> str:
    """``length`` initials from ``first`` on, user and assistant in turn."""
    return (("ua" if first == "u" else "au") * (length // 2 + 1))[:length]


def targets(state: str, length: int) -> list[str]:
    """Grammar strings of this length that may follow a state."""
    out = [alternating(FOLLOWS[state], length)]
    if state == NOTHING and length:
        out.append("s" + alternating("u", length - 1))
    return out


def _steps(symbol: str, wanted: str) -> list[tuple[int, str]]:
    """(cost, edit) of turning one turn into one wanted initial."""
    if symbol == MUST_DELETE:
        return []
    extra = TRUNCATED if symbol.isupper() else 0
    if symbol.lower() == wanted:
        return [(KEEP + extra, "K")]
    return [(REROLE + extra, "R")] if wanted != "s" else []


def align(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cheapest edits from ``turns`` to ``target`` and their least audit; None
    above ``limit``.

    ``rest[i][j]`` is the cost of turning ``turns[i:]`` into ``target[j:]``.  A path
    of cost ``limit`` has at most ``limit / 5`` insertions and ``limit / 2``
    deletions, so only that band about the diagonal is filled.
    """
    n, m = len(turns), len(target)
    ahead, behind = limit // INSERT, limit // DELETE
    far = limit + 1
    rest = [dict() for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = rest[i], rest[i + 1] if i < n else {}
        for j in range(min(m, i + ahead), max(0, i - behind) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = far
            if i < n:
                best = min(best, DELETE + below.get(j, far))
                if j < m:
                    for cost, _ in _steps(turns[i], target[j]):
                        best = min(best, cost + below.get(j + 1, far))
            if j < m and target[j] != "s":
                best = min(best, INSERT + row.get(j + 1, far))
            if best < far:
                row[j] = best
    if rest[0].get(0, far) > limit:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:   # the least letter that stays on a cheapest path: D, I, K, R
        left = rest[i][j]
        if i < n and rest[i + 1].get(j, far) + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i].get(j + 1, far) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            _, edit = next(s for s in _steps(turns[i], target[j]) if s[0] + rest[i + 1].get(j + 1, far) == left)
            audit.append(edit)
            i += 1
            j += 1
    return rest[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def transfers(turns: str, before: str) -> dict[str, tuple[int, str]]:
    """Least (cost, audit) from a state to each state that some length reaches.

    Lengths are tried outward from the number of turns that may stay.  One is left
    out when even its insertions or deletions alone cost more than the incumbent of
    the state it ends in.
    """
    may_stay = sum(s != MUST_DELETE for s in turns)
    must = DELETE * (len(turns) - may_stay)
    rerole_all = REROLE * may_stay + TRUNCATED * sum(s.isupper() and s != MUST_DELETE for s in turns)
    best: dict[str, tuple[int, str]] = {}
    # some length up to may_stay + 2 reaches each state by reroling all, so longer
    # ones than this cost more by their insertions alone
    longest = may_stay + rerole_all // INSERT + 2

    def least(length: int) -> int:
        return must + (INSERT * (length - may_stay) if length > may_stay else DELETE * (may_stay - length))

    for length in sorted(range(longest + 1), key=lambda k: (least(k), k)):
        for target in targets(before, length):
            after = target[-1] if target else before
            if after in best:
                limit = best[after][0]
            elif target[:1] == "s":   # keep one s, delete the other turns, insert the rest
                limit = DELETE * len(turns) + TRUNCATED + INSERT * length
            else:
                limit = least(length) + rerole_all
            if least(length) > limit:
                continue
            found = align(turns, target, limit)
            if found is not None and (after not in best or found < best[after]):
                best[after] = found
    return best


# ---------------------------------------------------------------------------
# Faults and order (native)
# ---------------------------------------------------------------------------

def _solid_end(text: Column) -> Column:
    """The text up to its last character that is not white space."""
    return F.rtrim(text, F.lit(BLANKS))


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, line (``role:text``), initial, symbol before the duplicate
    rule, and digest of conversation and line."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    end = _solid_end(F.col("text"))
    symbol = (F.when(end == "", F.lit("b"))
              .when(F.right(end, F.lit(1)).isin(*ENDS), known).otherwise(F.upper(known)))
    return rows.select("conv_id", "turn", "role", "text", initial.alias("initial"), symbol.alias("symbol"),
                       F.md5(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                                         F.length("role").cast("string"), "role", "text")).alias("digest"))


def ordered(rows: DataFrame) -> DataFrame:
    """Equal rows as one (``copies``), duplicates marked, in order: ``place``
    ascends with conversation, turn and ``role:text``.  Written to the shared
    folder, since the places must stay as they are."""
    base = prepared(rows).withColumn("salt", F.spark_partition_id() % SALTS)
    seen = (base.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("turn"))).alias("first"))
            .where("n > 1").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    marked = base.join(seen, ["digest", "salt"], "left")
    merged = marked.groupBy("digest", "salt", "conv_id", "turn", "role", "text", "initial", "symbol", "first").agg(F.count("*").alias("copies"))
    line = F.concat("role", F.lit(":"), "text")
    later = F.col("first").isNotNull() & (F.struct(F.col("turn")) > F.col("first"))
    merged = merged.select("conv_id", "turn", "role", "text", "initial", "symbol", "copies", "digest",
                           line.alias("line"), later.alias("later"))
    dealt = merged.repartitionByRange(F.col("conv_id"), F.col("turn"), F.substring("line", 1, PLACE_CHARS))
    placed = dealt.sortWithinPartitions("conv_id", "turn", "line").drop("line").withColumn("place", F.monotonically_increasing_id())
    return cut_lineage(placed)


# ---------------------------------------------------------------------------
# Blocks, their joining, and the edits of each turn
# ---------------------------------------------------------------------------

BLOCKS = ("conv_id long, first long, last long, turns string, copies array<long>, places array<long>, "
          "low long, high long, numbers long, blank long, duplicate long, truncated long, illegal long, head string, tail string")
_SUMS = ("numbers", "blank", "duplicate", "truncated", "illegal")
LEGAL = ("su", "ua", "au")


def _block(turns: list[dict]) -> dict:
    """One block: a symbol for each turn, and one X for all further copies of it."""
    symbols, copies, places = [], [], []
    out = dict.fromkeys(_SUMS, 0) | {"low": None, "high": None}
    last_line = None
    before = None
    for t in turns:
        number, n = t["turn"], t["copies"]
        if number is not None:
            out["numbers"] += number != out["high"]
            out["low"] = number if out["low"] is None else out["low"]
            out["high"] = number
        if t["symbol"] == "b":
            out["blank"] += n
            runs = [(MUST_DELETE, n)]
        elif t["later"] or t["again"]:
            out["duplicate"] += n
            runs = [(MUST_DELETE, n)]
        else:
            out["duplicate"] += n - 1
            out["truncated"] += t["symbol"].isupper()
            runs = [(t["symbol"], 1)] + ([(MUST_DELETE, n - 1)] if n > 1 else [])
        for symbol, count in runs:
            symbols.append(symbol)
            copies.append(count)
            places.append(t["place"])
        pair = t["initial"] + t["initial"]
        out["illegal"] += (n - 1) * (pair not in LEGAL)
        if before is not None:
            out["illegal"] += before + t["initial"] not in LEGAL
        before = t["initial"]
    return out | {"conv_id": turns[0]["conv_id"], "first": turns[0]["place"], "last": turns[-1]["place"],
                  "turns": "".join(symbols), "copies": copies, "places": places, "head": turns[0]["initial"], "tail": before}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def blocks():
        for _, turns in groupby(_rows(batches), key=lambda t: t["conv_id"]):
            held, previous = [], None
            for t in turns:
                # equal rows that several salted tasks counted follow one another
                t["again"] = previous == (t["turn"], t["digest"])
                previous = (t["turn"], t["digest"])
                held.append(t)
                if len(held) == BLOCK:
                    yield _block(held)
                    held = []
            if held:
                yield _block(held)
    yield from _batches(blocks(), _arrow(BLOCKS))


def blocks(turns: DataFrame) -> DataFrame:
    """Blocks of at most ``BLOCK`` consecutive turns of one conversation."""
    light = turns.select("conv_id", "turn", "initial", "symbol", "copies", "later", "place", "digest")
    return light.mapInArrow(_cut, BLOCKS)


EDITS = "place long, edits string, roles array<string>"
CHOICES = ("conv_id long, first long, before string, audit string, turns string, copies array<long>, places array<long>, "
           "final boolean, cost long, gaps long, blank long, duplicate long, truncated long, illegal long")


def _joined(block_rows: Iterator[dict]) -> Iterator[dict]:
    """One conversation's blocks in order: the chosen entry of each, the last with
    the conversation's figures."""
    paths: dict[str, tuple[int, str, list]] = {NOTHING: (0, "", [])}
    total = dict.fromkeys(_SUMS, 0)
    low = high = tail = None
    extra = 0
    for count, b in enumerate(block_rows, start=1):
        extra += sum(DELETE * (n - 1) for n in b["copies"])
        for name in _SUMS:
            total[name] += b[name]
        if tail is not None:
            total["illegal"] += tail + b["head"] not in LEGAL
        if b["low"] is not None:
            total["numbers"] -= b["low"] == high
            low, high = b["low"] if low is None else low, b["high"]
        tail = b["tail"]
        new: dict[str, tuple[int, str, list]] = {}
        for before, (cost, audit, trail) in paths.items():
            for after, (more, piece) in transfers(b["turns"], before).items():
                found = (cost + more, audit + piece)
                if after not in new or found < new[after][:2]:
                    new[after] = (*found, [*trail, (b, before, piece)])
        paths = new
        if count % SETTLE == 0:   # what all states agree on is settled
            trails = [t for _, _, t in paths.values()]
            same = 0
            while all(len(t) > same + 1 for t in trails) and len({(t[same][1], t[same][2]) for t in trails}) == 1:
                same += 1
            settled = trails[0][:same]
            size = sum(len(piece) for _, _, piece in settled)
            paths = {s: (c, a[size:], t[same:]) for s, (c, a, t) in paths.items()}
            for entry in settled:
                yield _choice(entry)
    cost, _, trail = min((paths[s] for s in ACCEPTING if s in paths), key=lambda p: p[:2])
    for entry in trail[:-1]:
        yield _choice(entry)
    gaps = high - low + 1 - total["numbers"] if low is not None else 0
    yield _choice(trail[-1]) | {"final": True, "cost": cost + extra, "gaps": gaps} | {
        k: total[k] for k in ("blank", "duplicate", "truncated", "illegal")}


def _choice(entry: tuple[dict, str, str]) -> dict:
    b, before, audit = entry
    return {"conv_id": b["conv_id"], "first": b["first"], "before": before, "audit": audit, "turns": b["turns"],
            "copies": b["copies"], "places": b["places"], "final": False}


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def chosen():
        for _, rows in groupby(_rows(batches), key=lambda b: b["conv_id"]):
            yield from _joined(rows)
    yield from _batches(chosen(), _arrow(CHOICES))


def choices(block_rows: DataFrame) -> DataFrame:
    """The cheapest joining of each conversation's blocks: one row a block, of about
    a thirty-second of the turns, the last of a conversation with its figures."""
    return block_rows.repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(_join_blocks, CHOICES)


def turn_edits(choice: dict) -> Iterator[dict]:
    """Edits of each turn of a block, and the role that each edit gives (null: the
    turn's own, or none).  Insertions stand with the turn before which they come;
    those at the end of a block with its last turn."""
    audit, state = choice["audit"], choice["before"]
    at = 0
    by_place: dict[int, list] = {}
    for symbol, copies, place in zip(choice["turns"], choice["copies"], choice["places"]):
        edits = by_place.setdefault(place, [])
        last = False
        while not last:
            edit = audit[at]
            at += 1
            last = edit != "I"
            role, state = _after(edit, symbol, state)
            edits.append((edit, role))
        edits.extend([("D", None)] * (copies - 1))
    for edit in audit[at:]:
        role, state = _after(edit, "", state)
        edits.append((edit, role))
    for place, edits in by_place.items():
        yield {"place": place, "edits": "".join(e for e, _ in edits), "roles": [r for _, r in edits]}


def _after(edit: str, symbol: str, state: str) -> tuple[str | None, str]:
    if edit == "D":
        return None, state
    if edit == "K":
        return None, symbol.lower()
    initial = FOLLOWS[state]
    return {"u": "user", "a": "assistant"}[initial], initial


def _to_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches((e for c in _rows(batches) for e in turn_edits(c)), _arrow(EDITS))


# ---------------------------------------------------------------------------
# Operator
# ---------------------------------------------------------------------------

def plan_repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with their place, chosen blocks); both written to the shared folder."""
    turns = ordered(rows)
    return turns, cut_lineage(choices(blocks(turns)))


def repaired_turns(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, place, edits, out: every turn, the edits at it and the
    ``(role, text)`` that these leave in order (none for a deleted turn)."""
    edits = chosen.select("before", "audit", "turns", "copies", "places").mapInArrow(_to_edits, EDITS)
    kept = lambda e, r, role, text: F.when(
        e != "D", F.struct(F.coalesce(r, role).alias("role"), F.when(e == "I", F.lit("")).otherwise(text).alias("text")))
    letters = F.split(F.regexp_replace("edits", "(.)", "$1 "), " ")
    out = F.filter(F.zip_with(F.slice(letters, F.lit(1), F.length("edits")), "roles",
                              lambda e, r: kept(e, r, F.col("role"), F.col("text"))), lambda x: x.isNotNull())
    return turns.join(edits, "place").select("conv_id", "place", "edits", out.alias("out"))


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, position (ascending, not dense), role, text of the repaired
    conversations in ``rows`` (conv_id, turn, role, text)."""
    turns, chosen = plan_repair(rows)
    return repaired_turns(turns, chosen).select("conv_id", "place", F.posexplode("out").alias("k", "t")).select(
        "conv_id", F.struct("place", "k").alias("position"), "t.role", "t.text")


def repair_summary(chosen: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost of each
    conversation that has turns."""
    return chosen.where("final").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


DIGESTS = "conv_id long, audit string, repaired_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done():
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r["conv_id"]):
            digest, audit, started = hashlib.sha256(), [], False
            for r in rows:
                audit.append(r["edits"])
                for line in r["lines"]:
                    digest.update(("\n" + line if started else line).encode())
                    started = True
            yield {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
    yield from _batches(done(), _arrow(DIGESTS))


def digests(repaired: DataFrame) -> DataFrame:
    """Audit and SHA-256 of the joined ``role:text`` lines of each conversation.

    The digest reads a conversation's lines one after another as they are sorted;
    none are gathered."""
    lines = F.transform("out", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return (repaired.select("conv_id", "place", "edits", lines.alias("lines"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_digest, DIGESTS))


def repair_report(conv_ids: DataFrame, rows: DataFrame) -> DataFrame:
    """Figures, audit and digest for every conversation of ``conv_ids`` (one column,
    conv_id); conversations without rows have zeros and the digest of nothing."""
    turns, chosen = plan_repair(rows)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = [conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), repair_summary(chosen),
             digests(repaired_turns(turns, chosen))]
    whole = parts[0]
    for part in parts[1:]:   # null ids meet in a grouping, not in a join
        whole = whole.unionByName(part, allowMissingColumns=True)
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))


# ---------------------------------------------------------------------------
# Damage (the query's input)
# ---------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by the CRC-32 of ``conv_id:turn`` (nulls:
    one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes its role user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("__copy")).drop("__copy")
