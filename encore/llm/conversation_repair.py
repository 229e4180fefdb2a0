"""Conversation structure repair: the cheapest edits that give a well-formed conversation, by a persistent audit DP.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows are kept (0), given the other role (1), deleted
(2; required of blank and duplicate rows) or an empty row is inserted (5); an undeleted truncated row costs 5
more. Of equally cheap edits the ASCII-least audit (the edits' initials K, R, D, I in order) is taken.

The DP holds one best audit for each of four states (nothing out yet, last out a system, user or
assistant row). Audits are persistent: each is a node that extends a shared prefix (``Trail``), with
binary-lifting ancestors and a rolling hash. Equally cheap audits are compared by a search for their
longest common prefix over prefix hashes; where hashes agree, the texts above the shared node are compared too, so a
collision can't decide. For one state, rows and cost no audit is a prefix of another (more inserts cost
more), so the best prefix stays best whatever follows.

Spark sorts the rows by (conversation, turn, role, text) over range partitions, so a conversation with a
third of all rows spans many. A task reads its rows in order and finishes the conversations that lie inside its
range. Those at its edges, and those longer than SEGMENT rows, are left as segments: repeated rows are
found by an aggregate, each segment gives its best audits from each state to each, and the segments of a
conversation are joined in order by the same comparison. Only the last step, SHA-256 of the repaired
text, needs a conversation's pieces in sequence; it streams them.

Defined results: null roles and texts are one space. Rows are taken by turn, nulls first, then role and text;
equal rows stay adjacent and all but the first are duplicates. A null conv_id is a conversation of its own. A role
with another initial can't be kept. Conversations without rows after damage give zeros, an empty audit and
the hash of an empty text. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize

WS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: The most rows of a conversation that a task holds.
SEGMENT = 4096
NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
#: What is out next from each state, and the state it leads to.
NEXT = {NONE: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
PRIME, BASE = (1 << 61) - 1, 0x1F3A5C7E9B2D4F61 % ((1 << 61) - 1)

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


class Trail:
    """A text as a node: a piece after a shared prefix. ``up[k]`` is the 2^k-th ancestor."""

    __slots__ = ("piece", "length", "hash", "up")

    def __init__(self, parent: "Trail | None" = None, piece: str = ""):
        self.piece = piece
        self.up: tuple[Trail, ...] = ()
        self.length, self.hash = 0, 0
        if parent is not None:
            self.length, self.hash = parent.length + len(piece), _rolled(parent.hash, piece)
            up = [parent]
            while len(up) <= len(up[-1].up):
                up.append(up[-1].up[len(up) - 1])
            self.up = tuple(up)

    def at(self, length: int) -> "Trail":
        """The ancestor (or this) that holds the last character of the prefix of ``length``."""
        node = self
        for k in range(len(self.up) - 1, -1, -1):
            while k < len(node.up) and node.up[k].length >= length:
                node = node.up[k]
        return node

    def prefix_hash(self, length: int) -> int:
        node = self.at(length)
        if node.length == length:
            return node.hash
        parent = node.up[0]
        return _rolled(parent.hash, node.piece[:length - parent.length])

    def character(self, place: int) -> str:
        """The character at ``place``; empty at the end."""
        if place >= self.length:
            return ""
        node = self.at(place + 1)
        return node.piece[place - node.up[0].length]

    def text(self) -> str:
        pieces, node = [], self
        while node.up:
            pieces.append(node.piece)
            node = node.up[0]
        return "".join(reversed(pieces))


def _rolled(value: int, piece: str) -> int:
    for c in piece:
        value = (value * BASE + ord(c)) % PRIME
    return value


def _above(a: Trail, b: Trail, length: int) -> tuple[str, str]:
    """What prefixes of ``length`` of both hold above their last shared node."""
    nodes, parts = [a.at(length), b.at(length)], ([], [])
    while nodes[0] is not nodes[1]:
        side = 0 if nodes[0].length >= nodes[1].length else 1
        node = nodes[side]
        if not node.up:
            side = 1 - side
            node = nodes[side]
        parent = node.up[0]
        parts[side].append(node.piece[:length - parent.length])
        nodes[side] = parent
    return "".join(reversed(parts[0])), "".join(reversed(parts[1]))


def precedes(a: Trail, b: Trail) -> bool:
    """Whether a's text is less than b's."""
    low, high = 0, min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if a.prefix_hash(middle) == b.prefix_hash(middle):
            low = middle
        else:
            high = middle - 1
    x, y = _above(a, b, low)
    return x < y if x != y else a.character(low) < b.character(low)


Best = list  # of (cost, Trail) or None, by state


def _offer(best: Best, state: int, cost: int, trail: Trail, piece: str) -> bool:
    """Takes trail + piece for the state if it is cheaper, or as cheap and less."""
    held = best[state]
    if held is not None and held[0] < cost:
        return False
    node = Trail(trail, piece) if piece else trail
    if held is not None and held[0] == cost and not precedes(node, held[1]):
        return False
    best[state] = (cost, node)
    return True


def with_inserts(best: Best) -> Best:
    """Empty rows inserted at this place, where they help."""
    changed = True
    while changed:
        changed = False
        for state in (NONE, SYSTEM, ASSISTANT, USER):
            if best[state] is not None:
                cost, trail = best[state]
                changed |= _offer(best, NEXT[state][1], cost + INSERT, trail, "I")
    return best


def advance(best: Best, initial: str, fault: str) -> Best:
    """All edits of one row, then inserts behind it. ``fault``: b(lank), d(uplicate), t(runcated) or empty."""
    after: Best = [None] * 4
    for state, held in enumerate(best):
        if held is None:
            continue
        cost, trail = held
        _offer(after, state, cost + DELETE, trail, "D")
        if fault in ("b", "d"):
            continue
        more = TRUNCATED if fault == "t" else 0
        kept = KEPT.get((state, initial))
        if kept is not None:
            _offer(after, kept, cost + KEEP + more, trail, "K")
        if kept != NEXT[state][1]:
            _offer(after, NEXT[state][1], cost + REROLE + more, trail, "R")
    return with_inserts(after)


def from_state(state: int) -> Best:
    best: Best = [None] * 4
    best[state] = (0, Trail())
    return with_inserts(best)


def end(best: Best) -> tuple[int, Trail]:
    """The cheapest well-formed end: nothing out, or an assistant's row last."""
    least = [None]
    for state in (NONE, ASSISTANT):
        if best[state] is not None:
            _offer(least, 0, *best[state], "")
    return least[0]


def fault_of(text: str, repeated: bool) -> str:
    stripped = text.strip(WS)
    if not stripped:
        return "b"
    return "d" if repeated else "" if stripped[-1] in STOPS else "t"


def lines(audit: str, rows: Iterable[tuple[str, str]], state: int = NONE) -> Iterator[str]:
    """The repaired ``role:text`` lines of ``rows``, from a state."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[state, role[:1]]
        else:
            role, state = NEXT[state]
        yield f"{role}:{text}"


class Counter:
    """Turn gaps, faults and illegal neighbours of rows in order."""

    def __init__(self):
        self.turns = [None, None, 0]  # least, largest, distinct
        self.faults = {"b": 0, "d": 0, "t": 0, "": 0}
        self.illegal, self.first, self.last = 0, None, None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.add_turns(turn, turn, 0 if turn is None else 1)
        self.faults[fault] += 1
        self.add_neighbours(initial, initial, 0)

    def add_turns(self, least, largest, distinct) -> None:
        if least is not None:
            held = self.turns
            repeated = held[1] is not None and held[1] == least
            self.turns = [least if held[0] is None else held[0], largest, held[2] + distinct - repeated]

    def add_neighbours(self, first: str | None, last: str | None, illegal: int) -> None:
        if first is not None:
            self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
            self.first, self.last = first if self.first is None else self.first, last

    def values(self) -> list[int]:
        least, largest, distinct = self.turns
        gaps = 0 if least is None else largest - least + 1 - distinct
        return [gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal]


def repair_rows(rows: list[tuple[int | None, str, str]]) -> tuple[list[int], int, str, str]:
    """(counts, cost, audit, SHA-256 of the repaired text) of one conversation's rows (turn, role, text) in order."""
    counter, seen, best = Counter(), set(), from_state(NONE)
    for turn, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        counter.add(turn, role[:1], fault)
        best = advance(best, role[:1], fault)
    cost, trail = end(best)
    audit = trail.text()
    repaired = "\n".join(lines(audit, ((role, text) for _, role, text in rows)))
    return counter.values(), cost, audit, hashlib.sha256(repaired.encode()).hexdigest()


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, absent): rows by crc32(``conv_id:turn``) % 20 dropped (absent), emptied, without
    stops, repeated or given the role user; nulls are one space in the key, the role and the text."""
    or_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(or_space(conv_id), F.lit(":"), or_space(turn)), "UTF-8")) % 20
    rows = conversations.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                                or_space(role).alias("role"), or_space(text).alias("text"), fate.alias("fate"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("fate") == 0).alias("absent"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _finish_inside(conv_type: pa.DataType):
    """Rows in order: finished conversations that lie inside the partition, segments of rows of all others."""
    names = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256", "part", "segment", "place", "turn", "role", "text"]
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types)))

    def finished(key, rows):
        counts, cost, audit, digest = repair_rows([r[:3] for r in rows if not r[3]])
        return (key, *counts, cost, audit, digest, *[None] * 6)

    def held(key, rows, part, segment):
        # a segment of absent rows only is one row without role: the conversation is still listed
        present = [r for r in rows if not r[3]]
        for place, (turn, role, text, _) in enumerate(present or [(None, None, None, True)]):
            yield (key, *[None] * 8, part, segment, place, turn, role, text)

    def run(batches):
        part, out, rows, key, runs, segment = TaskContext.get().partitionId(), [], [], None, 0, 0

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)
            out.clear()
            return made

        for arrived in batches:
            columns = [arrived.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "absent")]
            for conv, *row in zip(*columns):
                if not runs or conv != key:
                    if rows:
                        # the first run of a partition, and what was cut already, may go on elsewhere
                        out.extend(held(key, rows, part, segment) if runs == 1 or segment else [finished(key, rows)])
                    key, rows, runs, segment = conv, [], runs + 1, 0
                if len(rows) == SEGMENT:
                    out.extend(held(key, rows, part, segment))
                    rows, segment = [], segment + 1
                rows.append(row)
                if len(out) >= 2 * SEGMENT:
                    yield batch()
        if rows:
            out.extend(held(key, rows, part, segment))
        if out:
            yield batch()

    return run


def _segment_table(conv_type: pa.DataType):
    """Codes of one segment's rows to its counts and its best audits from each state to each."""
    move = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    names = ["conv_id", "part", "segment", "least", "largest", "distinct", "blank", "duplicate", "truncated", "illegal", "first", "last", "moves"]
    schema = pa.schema(list(zip(names, [conv_type, *[pa.int64()] * 9, pa.string(), pa.string(), pa.list_(move)])))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counter, tables = Counter(), [from_state(s) for s in range(4)]
        for row in sorted((r for r in table.to_pylist() if r["initial"] is not None), key=lambda r: r["place"]):
            counter.add(row["turn"], row["initial"], row["fault"])
            tables = [advance(t, row["initial"], row["fault"]) for t in tables]
        moves = [{"start": s, "end": e, "cost": held[0], "audit": held[1].text()}
                 for s, t in enumerate(tables) for e, held in enumerate(t) if held is not None]
        f = counter.faults
        row = [*(k.as_py() for k in key), *counter.turns, f["b"], f["d"], f["t"], counter.illegal, counter.first, counter.last, moves]
        return pa.table([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    return run


SEGMENT_SCHEMA = ("part long, segment long, least long, largest long, distinct long, blank long, duplicate long, truncated long, illegal long, "
                  "first string, last string, moves array<struct<start:int,end:int,cost:long,audit:string>>")


def _join_segments(conv_type: pa.DataType):
    """Segments in order: a row for each conversation, and for each segment the edits it gets and the state before it."""
    names = ["conv_id", *COUNTS, "cost", "audit", "part", "segment", "state", "edits"]
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = pa.schema(list(zip(names, types)))

    def settle(key, counter, best, history):
        cost, trail = end(best)
        yield (key, *counter.values(), cost, trail.text(), *[None] * 4)
        # back over the segments: the node of the end, its piece in each segment and the state before
        node = trail
        for part, segment, origins in reversed(history):
            state, before, piece = origins[id(node)]
            yield (key, *[None] * 7, part, segment, state, piece)
            node = before

    def run(batches):
        key, counter, best, history, out = None, None, None, [], []

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema=schema)
            out.clear()
            return made

        for arrived in batches:
            for r in arrived.to_pylist():
                if counter is None or r["conv_id"] != key:
                    if counter is not None:
                        out.extend(settle(key, counter, best, history))
                    key, counter, history = r["conv_id"], Counter(), []
                    best = [(0, Trail()), None, None, None]
                counter.add_turns(r["least"], r["largest"], r["distinct"])
                counter.add_neighbours(r["first"], r["last"], r["illegal"])
                for fault, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated")):
                    counter.faults[fault] += r[name]
                after, origin = [None] * 4, {}
                for move in r["moves"]:
                    held = best[move["start"]]
                    if held is not None:
                        cost, piece = held[0] + move["cost"], move["audit"]
                        if after[move["end"]] is not None and after[move["end"]][0] < cost:
                            continue
                        node = Trail(held[1], piece)
                        if after[move["end"]] is None or cost < after[move["end"]][0] or precedes(node, after[move["end"]][1]):
                            after[move["end"]] = (cost, node)
                            origin[move["end"]] = (move["start"], held[1], piece)
                history.append((r["part"], r["segment"], {id(after[e][1]): o for e, o in origin.items()}))
                best = after
                if len(out) >= SEGMENT:
                    yield batch()
        if counter is not None:
            out.extend(settle(key, counter, best, history))
        if out:
            yield batch()

    return run


def _pieces(conv_type: pa.DataType):
    """A segment's rows and its edits to its part of the repaired text."""
    schema = pa.schema([("conv_id", conv_type), ("part", pa.int64()), ("segment", pa.int64()), ("piece", pa.string())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        state, edits = next((r["state"], r["edits"]) for r in rows if r["edits"] is not None)
        rows = sorted((r for r in rows if r["role"] is not None), key=lambda r: r["place"])
        made = list(lines(edits, ((r["role"], r["text"]) for r in rows), state))
        piece = ("\n" if made and state != NONE else "") + "\n".join(made)
        return pa.table([pa.array([v], t) for v, t in zip([*(k.as_py() for k in key), piece], schema.types)], schema=schema)

    return run


def _digests(conv_type: pa.DataType):
    """Pieces in order to the SHA-256 of each conversation; one piece is held at a time."""
    schema = pa.schema([("conv_id", conv_type), ("repaired_sha256", pa.string())])

    def run(batches):
        key, digest = None, None
        for arrived in batches:
            done = []
            for conv, piece in zip(arrived.column("conv_id").to_pylist(), arrived.column("piece").to_pylist()):
                if digest is None or conv != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = conv, hashlib.sha256()
                digest.update(piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], conv_type), pa.array([digest.hexdigest()])], schema=schema)

    return run


def repair(rows: DataFrame) -> DataFrame:
    """Every conversation of ``rows`` (conv_id, turn, role, text, absent): conv_id, COUNTS, cost, audit, repaired_sha256."""
    kind = rows.schema["conv_id"].dataType
    conv, arrow = f"conv_id {kind.simpleString()}", to_arrow_type(kind)
    counts = ", ".join(f"{c} long" for c in [*COUNTS, "cost"])
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions(*order)
    found = materialize(ranged.mapInArrow(_finish_inside(arrow), f"{conv}, {counts}, audit string, repaired_sha256 string, part long, "
                                          "segment long, place long, turn long, role string, text string"), "conversations")
    inside = found.filter("part is null").select("conv_id", *COUNTS, "cost", "audit", "repaired_sha256")
    edge = found.filter("part is not null").select("conv_id", "part", "segment", "place", "turn", "role", "text")

    # rows whose role and text occur earlier in the conversation
    at = F.struct("part", "segment", "place")
    narrow = edge.select("conv_id", "part", "segment", "place", "turn", "role", F.sha2("text", 256).alias("sha"),
                         F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).alias("stop"))
    firsts = (narrow.filter("role is not null").groupBy("conv_id", "role", "sha").agg(F.min(at).alias("first"))
              .select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("sha").alias("f_sha"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("sha") == F.col("f_sha"))
    coded = narrow.join(firsts, same, "left").select(
        "conv_id", "part", "segment", "place", "turn", F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("stop") == "", "b").when(at > F.col("first"), "d").when(F.col("stop").isin(*STOPS), "").otherwise("t").alias("fault"))
    key = ["conv_id", "part", "segment"]
    tables = coded.groupBy(*key).applyInArrow(_segment_table(arrow), f"{conv}, {SEGMENT_SCHEMA}")
    joined = materialize(tables.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(
        _join_segments(arrow), f"{conv}, {counts}, audit string, part long, segment long, state long, edits string"), "conversation-edits")

    edits = joined.filter("part is not null").select(*key, F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("role"),
                                                     F.lit(None).cast("string").alias("text"), "state", "edits")
    both = edge.select(*key, "place", "role", "text", F.lit(None).cast("long").alias("state"), F.lit(None).cast("string").alias("edits")).unionByName(edits)
    pieces = both.groupBy(*key).applyInArrow(_pieces(arrow), f"{conv}, part long, segment long, piece string")
    digests = (pieces.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(_digests(arrow), f"{conv}, repaired_sha256 string")
               .withColumnRenamed("conv_id", "d_conv"))
    across = (joined.filter("part is null").join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")))
              .select("conv_id", *COUNTS, "cost", "audit", "repaired_sha256"))
    return inside.unionByName(across)
