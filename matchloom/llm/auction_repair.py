"""Repair of conversations at least cost: shortest paths by auction over a lattice of rows and states.

A repaired conversation has at most one system row first and then user and assistant rows in turn, ending with an assistant's. A node of the
lattice is a number of rows read and what stands last; its arcs keep, rerole, delete or insert a row. ``auction`` finds a shortest path as
Bertsekas does: every node has a price, a path starts at the origin, grows by the cheapest arc plus price while its last node's price allows, else that price
rises and the path shrinks by it. Prices stay under the cost of every arc plus the price behind it, so when the path has reached the goal, all
shortest paths, and they alone, run over tight arcs, where both are equal. Those are traced from the origin, by the least letter at
each step, keeping all nodes that share the least letters so far.

Conversations are cut into blocks of ``BLOCK`` rows. A block is solved from each state before it to each state behind it, and known again by the kinds
of its rows; blocks form a coarse lattice for the same auction, whose arcs carry the cost and the rank of the letters among
the block's. No letters of a block start with all of another's (each ends by reading the block's last row), so ranks decide ties as
letters would.

Rows are dealt by ranges of conversation and turn, so that one conversation of any size is spread over tasks. Conversations that
lie whole in a task are repaired there. The rest, at most the first and last of a task and those of over ``SEGMENT`` rows, are
cut into segments: repeated rows are found by a grouped join, each segment's costs and ranks (a few dozen numbers) are chained
in a conversation's order, and its choice comes back to the segment. What must be done in order, the SHA-256 over a
conversation's text, streams over sorted segments; only its audit, which is part of the result row, grows there.

Defined results: null roles and texts are one space; a null turn or ``conv_id`` is one space to the checksum, sorts first, and null is a
conversation of its own. Rows of one turn go by role and text (bytes), the repeated row behind the first. A role that is empty has no
initial: kept, it changes nothing. A system row that can not stand first is reroled or deleted. Fully repeated rows are rows. Very
long texts are read as they are. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import map_batches, ships
from matchloom.session import materialize

ships(__name__)

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
BLOCK = 12  # rows
SEGMENT = 240  # rows
SEGMENT_BYTES = 1 << 20  # of text, in a segment of more than one row
KEPT = 1 << 15  # solutions kept by a task

START, SYSTEM, USER, ASSISTANT = STATES = range(4)  # what stands last
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "-": {q: q for q in STATES}, "x": {}}
GOOD_ENDS = (START, ASSISTANT)
WORD_END = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")
FAR = 1 << 60

Arcs = dict[object, list[tuple[int, object, str | int]]]  # node: (cost, node behind, letter or rank)


def auction(arcs: Arcs, prices: dict, origin: object, goal: object) -> None:
    """Raise ``prices`` until a shortest path from ``origin`` to ``goal`` is tight. All nodes must reach the goal; prices that another run left
    for the same goal are a good start."""
    path = [origin]
    while path[-1] != goal:
        node = path[-1]
        best, to = FAR, None
        for cost, behind, _ in arcs[node]:
            if cost + prices[behind] < best:
                best, to = cost + prices[behind], behind
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def reaching(arcs: Arcs, goal: object) -> Arcs:
    """The arcs from nodes that reach the goal to nodes that do."""
    into: dict = {}
    for node, out in arcs.items():
        for _, behind, _ in out:
            into.setdefault(behind, []).append(node)
    seen, todo = {goal}, [goal]
    while todo:
        for node in into.get(todo.pop(), ()):
            if node not in seen:
                seen.add(node)
                todo.append(node)
    return {node: [arc for arc in out if arc[1] in seen] for node, out in arcs.items() if node in seen} | {goal: []}


def least_tight(arcs: Arcs, prices: dict, origin: object, goal: object) -> tuple[list, list]:
    """Labels and nodes of a shortest path, the least by its labels."""
    tight = reaching({node: [arc for arc in out if prices[node] == arc[0] + prices[arc[1]]] for node, out in arcs.items()}, goal)
    labels, fronts = [], [{origin: None}]
    while goal not in fronts[-1]:
        front = [(label, behind, node) for node in fronts[-1] for _, behind, label in tight[node]]
        least = min(label for label, _, _ in front)
        labels.append(least)
        fronts.append({behind: node for label, behind, node in front if label == least})
    nodes = [goal]
    for front in fronts[:0:-1]:
        nodes.append(front[nodes[-1]])
    return labels, nodes[::-1]


def shortest(arcs: Arcs, origins: list, goal: object) -> dict:
    """``origin``: (cost, labels, nodes), of the origins that reach the goal."""
    arcs = reaching(arcs, goal)
    prices, out = dict.fromkeys(arcs, 0), {}
    for origin in origins:
        if origin in arcs:
            auction(arcs, prices, origin, goal)
            out[origin] = (prices[origin] - prices[goal], *least_tight(arcs, prices, origin, goal))
    return out


def row_arcs(kinds: str) -> Arcs:
    """The lattice of a block: two letters a row, its initial (s, u, a, - for none, x for others) and d (must go), t (cut short) or k."""
    arcs: Arcs = {}
    for i in range(0, len(kinds), 2):
        n, initial, fault = i // 2, kinds[i], kinds[i + 1]
        extra = CUT_SHORT if fault == "t" else 0
        for q in STATES:
            out = arcs[n, q] = [(DELETE, (n + 1, q), "D")]
            for role in "ua":
                if q in NEXT[role]:
                    out.append((INSERT, (n, NEXT[role][q]), "I"))
                    if fault != "d":
                        out.append((REROLE + extra, (n + 1, NEXT[role][q]), "R"))
            if fault != "d" and q in NEXT[initial]:
                out.append((KEEP + extra, (n + 1, NEXT[initial][q]), "K"))
    return arcs


class Blocks:
    """Solved blocks, by the kinds of their rows; emptied at ``KEPT``."""

    def __init__(self):
        self.solved, self.whole = {}, {}

    def pairs(self, kinds: str) -> dict[tuple[int, int], tuple[int, str]]:
        """Cost and least letters from each state before the block to each behind it that can be reached."""
        if kinds not in self.solved:
            if len(self.solved) >= KEPT:
                self.solved.clear()
            arcs, n = row_arcs(kinds), len(kinds) // 2
            found = {}
            for x in STATES:
                for (_, e), (cost, letters, _) in shortest(arcs, [(0, e) for e in STATES], (n, x)).items():
                    found[e, x] = cost, "".join(letters)
            self.solved[kinds] = found
        return self.solved[kinds]

    def between(self, kinds: str) -> dict[tuple[int, int], tuple[int, str]]:
        """The same for any number of rows, over their blocks."""
        step = 2 * BLOCK
        if len(kinds) <= step:
            return self.pairs(kinds)
        parts = [self.pairs(kinds[i:i + step]) for i in range(0, len(kinds), step)]
        arcs = chained([ranked(p) for p in parts])
        found = {}
        for x in STATES:
            for (_, e), (cost, _, nodes) in shortest(arcs, [(0, e) for e in STATES], (len(parts), x)).items():
                found[e, x] = cost, "".join(p[a[1], b[1]][1] for p, a, b in zip(parts, nodes, nodes[1:]))
        return found

    def repair(self, kinds: str) -> tuple[int, str]:
        """Cost and audit of a whole conversation."""
        if kinds in self.whole:
            return self.whole[kinds]
        if len(self.whole) >= KEPT:
            self.whole.clear()
        n = len(kinds) // 2
        if n <= BLOCK:
            arcs = row_arcs(kinds)
            close(arcs, n)
            (cost, letters, _), = shortest(arcs, [(0, START)], "end").values()
            self.whole[kinds] = cost, "".join(letters)
        else:
            table = self.between(kinds)
            cost, path, tail = chain([ranked(table)])
            self.whole[kinds] = cost, table[path[0]][1] + tail
        return self.whole[kinds]


def ranked(table: dict[tuple[int, int], tuple[int, str]]) -> list[tuple[int, int, int, int]]:
    """State before, state behind, cost, rank of the letters."""
    order = {letters: i for i, letters in enumerate(sorted({letters for _, letters in table.values()}))}
    return [(e, x, cost, order[letters]) for (e, x), (cost, letters) in sorted(table.items())]


def chained(parts: list[list[tuple[int, int, int, int]]]) -> Arcs:
    return {(i, e): [(cost, (i + 1, x), rank) for a, x, cost, rank in part if a == e] for i, part in enumerate(parts) for e in STATES}


def close(arcs: Arcs, n: int, label: Callable[[str], str | int] = str) -> None:
    """What may be inserted behind the last row, and the end."""
    for q in STATES:
        arcs[n, q] = [(INSERT, (n, NEXT[role][q]), label("I")) for role in "ua" if q in NEXT[role]]
        if q in GOOD_ENDS:
            arcs[n, q].append((0, "end", label("")))


def chain(parts: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """Least cost of a conversation of such parts, the states before and behind each, and the letters after the last."""
    arcs, n = chained(parts), len(parts)
    close(arcs, n, lambda letter: 1 if letter else 0)
    (cost, labels, nodes), = shortest(arcs, [(0, START)], "end").values()
    states = [q for _, q in nodes[:-1]]
    return cost, list(zip(states, states[1:n + 1])), "I" * sum(labels[n:])


def initial(role: str) -> str:
    return "-" if not role else role[0] if role[0] in "sua" else "x"


def fault(text: str, again: bool) -> str:
    """The first fault: b(lank), d(uplicate), t(runcated), or k."""
    end = WORD_END.search(text) if len(text) < 64 else WORD_END.search(text, max(0, len(text.rstrip("\t\n\x0b\x0c\r ")) - 1))
    return "b" if end is None else "d" if again else "k" if end[0] in ".!?" else "t"


def kinds_of(roles: list[str], faults: str) -> str:
    return "".join(initial(r) + ("d" if f in "bd" else f) for r, f in zip(roles, faults))


def illegal(roles: list[str]) -> int:
    starts = [r[:1] for r in roles]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))


def lines(roles: list[str], texts: list[str], audit: str, state: int = START) -> Iterator[str]:
    """role:text of the rows that the audit leaves, from a state on."""
    i = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else (roles[i], texts[i])
        i += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == USER else "user"
        state = NEXT[initial(role)][state]
        yield f"{role}:{text}"


def key_of(role: str, text: str) -> bytes:
    """Names a role and a text."""
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
OPEN = "no int, roles array<string>, texts array<string>, keys array<binary>, low bigint, high bigint, turns bigint, first bigint, last bigint"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, a dropped one with null role and text (so that its conversation stays), a repeated one twice."""
    c = conversations.select("conv_id", "turn", *[F.coalesce(F.col(x), F.lit(" ")).alias(x) for x in ("role", "text")])
    shown = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    c = c.withColumn("kind", F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20)
    # One plain character at a time: the three signs go.
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    gone = F.col("kind") == 0
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(~gone, role).alias("role"), F.when(~gone, text).alias("text"),
                    F.explode(copies).alias("copy"))


class Turns:
    """Least, greatest and number of distinct turns of rows in order."""

    def __init__(self):
        self.low = self.high = None
        self.n = 0

    def add(self, turn: int | None) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.n = turn if self.low is None else self.low, turn, self.n + 1

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.n if self.n else 0


def solved(rows: list[tuple], blocks: Blocks) -> dict:
    """Everything of one whole conversation."""
    rows = [r for r in rows if r[1] is not None]
    turns, seen, faults = Turns(), set(), ""
    for turn, role, text in rows:
        turns.add(turn)
        faults += fault(text, (role, text) in seen)
        seen.add((role, text))
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    cost, audit = blocks.repair(kinds_of(roles, faults))
    return {"gaps": turns.gaps, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": illegal(roles),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines(roles, texts, audit)).encode()).hexdigest()}


def opened(no: int, rows: list[tuple]) -> dict:
    """A segment of a conversation that other segments may go before or follow."""
    rows = [r for r in rows if r[1] is not None]
    turns = Turns()
    for turn, _, _ in rows:
        turns.add(turn)
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    return {"no": no, "roles": roles, "texts": texts, "keys": [key_of(r, t) for r, t in zip(roles, texts)], "low": turns.low, "high": turns.high, "turns": turns.n,
            "first": turns.low, "last": turns.high}


def settled(conv: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order to conversations that lie whole in the task, and segments of the others."""
    schema = pa.schema([("conv_id", conv), ("done", arrow(COUNTS)), ("open", arrow(OPEN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, rows, size, held, no, now, first = Blocks(), [], 0, 0, 0, None, True
        out: list[dict] = []

        def flush(ends: bool):
            nonlocal rows, size, held, no
            whole = ends and not no and not first
            out.append({"conv_id": now, "done": solved(rows, blocks) if whole else None, "open": None if whole else opened(no, rows)})
            rows, size, held, no = [], 0, held + (0 if whole else size), no + 1

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv_id, turn, role, text in zip(*columns):
                if (rows or no) and conv_id != now:
                    flush(True)
                    no, first = 0, False
                elif rows and (len(rows) >= SEGMENT or size + len(text or "") > SEGMENT_BYTES):
                    flush(False)
                now = conv_id
                rows.append((turn, role, text))
                size += len(text or "")
                if len(out) >= 4096 or held > 4 * SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if rows:
            first = True  # the last one may go on in the next task
            flush(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def arrow(ddl: str) -> pa.DataType:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(T.StructType.fromDDL(ddl))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256`` of every conversation."""
    conv = conversations.schema["conv_id"].dataType.simpleString()
    rows = damaged(conversations).repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    table = rows.select("conv_id", "turn", "role", "text").mapInArrow(
        settled(arrow(f"c {conv}").field(0).type), f"conv_id {conv}, done struct<{struct(COUNTS)}>, open struct<{struct(OPEN)}>")
    table = materialize(table.withColumn("part", F.spark_partition_id()), "conversations")
    whole = table.filter("done IS NOT NULL").select("conv_id", "done.*")
    return whole.unionByName(joined_up(table.filter("open IS NOT NULL").select("conv_id", "part", "open.*"), conv))


def struct(ddl: str) -> str:
    return ", ".join(f"{name}:{kind}" for name, kind in (x.split(" ", 1) for x in ddl.split(", ")))


def joined_up(segments: DataFrame, conv: str) -> DataFrame:
    """The conversations of segments."""
    place = F.struct("part", "no", "at")
    keyed = segments.select("conv_id", "part", "no", F.posexplode("keys").alias("at", "key"))
    firsts = keyed.groupBy("conv_id", "key").agg(F.min(place).alias("f"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("_c"), F.col("key").alias("_k"), "f")
    again = keyed.join(firsts, same(F.col("conv_id"), F.col("_c")) & (F.col("key") == F.col("_k"))).filter(place != F.col("f")).groupBy(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("no").alias("_n")).agg(F.collect_list("at").alias("again"))
    here = same(F.col("conv_id"), F.col("_c")) & (F.col("part") == F.col("_p")) & (F.col("no") == F.col("_n"))
    known = segments.join(again, here, "left").drop("_c", "_p", "_n", "keys").withColumn("again", F.coalesce("again", F.array().cast("array<int>")))

    solver: list[Blocks] = []

    def blocks() -> Blocks:
        if not solver:
            solver.append(Blocks())
        return solver[0]

    def weighed(c):
        out = {k: c[k] for k in ("conv_id", "part", "no")} | {"faults": [], "part_arcs": []}
        for texts, roles, again in zip(c["texts"], c["roles"], c["again"]):
            again = set(again)
            faults = "".join(fault(t, i in again) for i, t in enumerate(texts))
            out["faults"].append(faults)
            out["part_arcs"].append([x for arc in ranked(blocks().between(kinds_of(roles, faults))) for x in arc] if texts else None)
        return out | {"starts": [[r[0][:1], r[-1][:1]] if r else None for r in c["roles"]], "illegal": [illegal(r) for r in c["roles"]]} | {
            k: c[k] for k in ("low", "high", "turns")}

    narrow = materialize(map_batches(known, weighed, f"conv_id {conv}, part int, no int, faults string, part_arcs array<bigint>, starts array<string>, illegal bigint, "
                                     "low bigint, high bigint, turns bigint"), "segments")
    blank, duplicate, truncated = (F.length("faults") - F.length(F.replace("faults", F.lit(x))) for x in "bdt")
    told = F.struct("part", "no", "part_arcs", "starts", "low", "high", "turns")
    gathered = narrow.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(told)).alias("parts"), F.sum(blank).alias("blank"), F.sum(duplicate).alias("duplicate"), F.sum(truncated).alias("truncated"),
        F.sum("illegal").alias("illegal"))

    def decided(c):
        out = {k: c[k] for k in ("conv_id", "blank", "duplicate", "truncated")} | {"illegal": [], "gaps": [], "cost": [], "tail": [], "chosen": []}
        for parts, wrong in zip(c["parts"], c["illegal"]):
            gaps = Turns()
            for p in parts:
                if p["turns"]:
                    gaps.n += p["turns"] - (p["low"] == gaps.high)
                    gaps.low, gaps.high = p["low"] if gaps.low is None else gaps.low, p["high"]
            full = [p for p in parts if p["part_arcs"]]
            seams = sum(a["starts"][1] + b["starts"][0] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
            cost, path, tail = chain([[tuple(p["part_arcs"][i:i + 4]) for i in range(0, len(p["part_arcs"]), 4)] for p in full])
            chosen = {(p["part"], p["no"]): states for p, states in zip(full, path)}
            out["chosen"].append([{"part": p["part"], "no": p["no"], "before": e, "behind": x, "last": p is parts[-1]}
                                  for p in parts for e, x in [chosen.get((p["part"], p["no"]), (0, 0))]])
            out["illegal"].append(wrong + seams)
            out["gaps"].append(gaps.gaps)
            out["cost"].append(cost)
            out["tail"].append(tail)
        return out

    decisions = map_batches(gathered, decided, f"conv_id {conv}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, gaps bigint, cost bigint, tail string, "
                            "chosen array<struct<part:int,no:int,before:int,behind:int,last:boolean>>")
    decisions = decisions.select(F.col("conv_id").alias("_c"), "blank", "duplicate", "truncated", "illegal", "gaps", "cost", "tail", F.inline("chosen")).withColumnsRenamed(
        {"part": "_p", "no": "_n"})
    faults = narrow.select(F.col("conv_id").alias("_fc"), F.col("part").alias("_fp"), F.col("no").alias("_fn"), "faults")
    ready = segments.select("conv_id", "part", "no", "roles", "texts").join(
        faults, same(F.col("conv_id"), F.col("_fc")) & (F.col("part") == F.col("_fp")) & (F.col("no") == F.col("_fn"))).join(decisions, here)
    columns = ["conv_id", "roles", "texts", "faults", "before", "behind", "last", "tail", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    sorted_rows = ready.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").select(*columns)
    return sorted_rows.mapInArrow(told_out(arrow(f"c {conv}").field(0).type), f"conv_id {conv}, {COUNTS}")


def told_out(conv: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments in order, with their choices, to results; a digest and an audit are all that is held of a conversation."""
    schema = pa.schema([("conv_id", conv), *arrow(COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, digest, audit, begun, state = Blocks(), hashlib.sha256(), [], False, START
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                edits = blocks.between(kinds_of(r["roles"], r["faults"]))[r["before"], r["behind"]][1] if r["roles"] else ""
                edits += r["tail"] if r["last"] else ""
                if r["roles"]:
                    state = r["before"]
                for line in lines(r["roles"], r["texts"], edits, state):
                    digest.update((("\n" if begun else "") + line).encode())
                    begun = True
                state = r["behind"] if r["roles"] else state
                audit.append(edits)
                if r["last"]:
                    out.append({n: r[n] for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {
                        "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                    digest, audit, begun, state = hashlib.sha256(), [], False, START
            yield pa.RecordBatch.from_pylist(out, schema)

    return run
