"""Conversation structure repair by an auction for the shortest path of edits.

A conversation is in order when its roles are nothing, or `user assistant` repeated, maybe behind a
`system`. Its rows span a lattice: layers between rows, a node per layer and state of the pattern, and
arcs for keeping, giving another role to, or deleting a row, and for inserting one. Integer costs make
an auction exact: a path grows from the start along its cheapest arc while prices agree and shrinks
where they do not, raising the price of its last node. With converged prices the arcs of cheapest
repairs are tight, and taking the first of them in the order of their labels traces the repair whose
labels come first.

Long conversations are cut into blocks of rows. The cheapest way through a block between any two states,
and the order of those ways by labels, is all that the blocks around it must know; blocks are combined
in groups of bounded size, level by level, and the states found on the way back fix each block's repair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.sequence import number_rows
from loadkit.llm.common import bounded_batches
from loadkit.session import materialise

#: Costs of the edits; a row that ends in the middle of a sentence and stays costs `CUT` more.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, behind `system`, behind `user`, behind `assistant`.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state behind the next turn of a dialogue, and the states in which a conversation may end.
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}

#: Rows and characters of a block, and blocks that are combined at a time.
BLOCK_ROWS, BLOCK_CHARS, FAN = 64, 1 << 20, 256

BLANK = r"[^\x20\x09-\x0D]"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"

Arc = tuple  # label, cost, head


def auction(arcs: Sequence[Sequence[Arc]], price: list[float], origin: int, end: int):
    """The cheapest path from `origin` to `end` whose labels come first: cost and arcs taken.

    `price` must not exceed what any arc costs plus the price of its head; it is raised in place. Arcs
    of a node are in the order of their labels, no circle costs nothing, and `end` can be reached from
    every node that can be reached. A node's cheapest arc that comes first in that order is the one the
    path grows by: arcs before it are not tight, so no cheapest path has them.
    """
    path, taken = [origin], []
    while (node := path[-1]) != end:
        best, choice = float("inf"), None
        for arc in arcs[node]:
            value = arc[1] + price[arc[2]]
            if value < best:
                best, choice = value, arc
        if choice is None:
            raise ValueError("no path")
        if price[node] < best:
            price[node] = best
            if node != origin:
                path.pop()
                taken.pop()
        else:
            path.append(choice[2])
            taken.append(choice)
    return sum(arc[1] for arc in taken), taken


def reaching(arcs: Sequence[Sequence[Arc]], end: int) -> list[list[Arc]]:
    """The arcs whose head can reach `end`."""
    into: list[list[int]] = [[] for _ in arcs]
    for node, out in enumerate(arcs):
        for _, _, head in out:
            into[head].append(node)
    seen, open_nodes = {end}, [end]
    while open_nodes:
        for node in into[open_nodes.pop()]:
            if node not in seen:
                seen.add(node)
                open_nodes.append(node)
    return [[arc for arc in out if arc[2] in seen] for out in arcs]


class Lattice:
    """Layers of states with arcs between them; `least` has the least cost of each layer's arcs.

    Labels of arcs are letters, or numbers that compare blocks.
    """

    def __init__(self, arcs: list[list[Arc]], least: list[int], letters: bool) -> None:
        self.arcs, self.letters = arcs, letters
        self.layers = len(least)
        floor = np.concatenate([np.cumsum(least[::-1])[::-1], [0]]).tolist() if least else [0]
        self.floor = [float(x) for x in floor for _ in range(STATES)] + [0.0]

    def path(self, entry: int, exits: Sequence[int]):
        """Cost and arcs of the cheapest path from a state before the first layer to one of `exits`
        behind the last; None when there is no path."""
        end = STATES * (self.layers + 1)
        arcs = self.arcs + [[]]
        for state in exits:
            node = STATES * self.layers + state
            # Ending comes before everything else that a node may do.
            arcs[node] = [("", 0, end), *arcs[node]]
        arcs = reaching(arcs, end)
        if not arcs[entry]:
            return None
        return auction(arcs, list(self.floor), entry, end)


def row_lattice(items: Sequence[tuple], last: bool) -> Lattice:
    """The lattice of a block. An item is (role initial, cut) for a row that may stay, or a number of
    rows that must go. Inserts stand before a row; behind the last one only at the conversation's end."""
    arcs, least = [], []
    for layer, item in enumerate(items):
        here, there = STATES * layer, STATES * (layer + 1)
        gone = item if isinstance(item, int) else 1
        for state in range(STATES):
            out = [("D" * gone, DELETE * gone, there + state), ("I", INSERT, here + NEXT[state])]
            if not isinstance(item, int):
                initial, cut = item
                kept = {"s": SYSTEM if state == START else None, "u": USER, "a": ASSISTANT}.get(initial)
                more = CUT if cut else 0
                if kept is not None and (kept == SYSTEM or kept == NEXT[state]):
                    out.append(("K", KEEP + more, there + kept))
                out.append(("R", REROLE + more, there + NEXT[state]))
            arcs.append(out)
        least.append(DELETE * gone if isinstance(item, int) else min(DELETE, CUT) if item[1] else KEEP)
    here = STATES * len(items)
    arcs += [[("I", INSERT, here + NEXT[state])] if last else [] for state in range(STATES)]
    return Lattice(arcs, least, True)


def block_lattice(costs: Sequence[Sequence[int]], ranks: Sequence[Sequence[int]]) -> Lattice:
    """The lattice of blocks in order; their ways are arcs, in the order of what is inside."""
    arcs, least = [], []
    for layer, (cost, rank) in enumerate(zip(costs, ranks, strict=True)):
        there = STATES * (layer + 1)
        for state in range(STATES):
            ways = range(STATES * state, STATES * (state + 1))
            out = [(rank[w], cost[w], there + w % STATES) for w in ways if cost[w] >= 0]
            arcs.append(sorted(out))
        least.append(min(c for c in cost if c >= 0))
    return Lattice(arcs + [[] for _ in range(STATES)], least, False)


def ways(lattice: Lattice) -> tuple[list[int], list[int]]:
    """Per entry and exit state the cost of the cheapest way, -1 if there is none, and its place among
    the ways from that entry by labels. Of two ways neither begins with the other's labels."""
    costs, ranks = [-1] * STATES**2, [-1] * STATES**2
    for entry in range(STATES):
        found = {}
        for leaving in range(STATES):
            if way := lattice.path(entry, [leaving]):
                costs[STATES * entry + leaving] = int(way[0])
                labels = [arc[0] for arc in way[1][:-1]]
                found[leaving] = "".join(labels) if lattice.letters else labels
        for place, leaving in enumerate(sorted(found, key=found.get)):
            ranks[STATES * entry + leaving] = place
    return costs, ranks


def damage_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Damage rows by a hash of conversation and turn: conv_id, turn, role, text, copies.

    A hash of 20 parts drops a row (0), empties its text (1), takes out its sentence ends (2), repeats
    it (3) or makes it the user's (4). Null roles and texts count as one space, also in the hash. A
    row dropped leaves a row without copies, so that its conversation is not forgotten.
    """
    space = F.lit(" ")
    parts = [F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col)]
    draw = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    role, text = F.coalesce(role_col, space), F.coalesce(text_col, space)
    dropped = draw == 0
    return turns.select(
        F.col(conv_col).alias("conv_id"),
        F.when(~dropped, F.col(turn_col)).cast("bigint").alias("turn"),
        F.when(dropped, "").when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(dropped | (draw == 1), "")
        .when(draw == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(dropped, 0).when(draw == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def turn_runs(turns: DataFrame) -> DataFrame:
    """Equal rows of a turn as one, with their number and whether role and text are new there.

    Rows are counted before they are shuffled, so one row repeated without end is no risk. Whether it
    is new comes from a join by all that tells rows apart, which no group of rows shares.
    """
    keyed = turns.withColumn("digest", F.unhex(F.sha2("text", 256)))
    # One column, null nowhere, that the join below finds the rows partitioned by.
    runs = keyed.groupBy(F.struct("conv_id", "turn", "role", "digest").alias("key")).agg(
        F.sum("copies").alias("copies"), F.max("text").alias("text")
    )
    earliest = keyed.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    earliest = earliest.select(
        F.struct(
            "conv_id", F.when(~F.col("unnumbered"), F.col("least")).alias("turn"), "role", "digest"
        ).alias("new")
    )
    return runs.join(earliest, F.col("key") == F.col("new"), "left").select(
        "key.*", "text", "copies", F.col("new").isNotNull().alias("first")
    )


ROW = "struct<turn:bigint,role:string,text:string,copies:bigint,first:boolean>"


def cut_blocks(runs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of a conversation in order, as blocks: conv_id, slice, at, rows.

    The order is that of turns, without a number first; rows of one turn are ordered by role and the
    digest of the text. (slice, at) orders the blocks of a conversation.
    """
    id_type = runs.schema["conv_id"].dataType.simpleString()
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    columns = ["turn", "role", "text", "copies", "first"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars, conv, at, kind = [], 0, None, 0, None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([at], pa.int32()), pa.array([rows], list_type)],
                ["conv_id", "at", "rows"],
            )

        fields = [("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
        list_type = pa.list_(pa.struct([*fields, ("copies", pa.int64()), ("first", pa.bool_())]))
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                full = len(rows) == block_rows or chars >= BLOCK_CHARS
                if rows and (full or row["conv_id"] != conv):
                    yield block()
                    rows, chars, at = [], 0, at + 1
                conv = row["conv_id"]
                rows.append({name: row[name] for name in columns})
                chars += len(row["text"])
        if rows:
            yield block()

    bounded_batches(runs.sparkSession)
    sorted_runs = runs.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"conv_id {id_type}, at int, rows array<{ROW}>"
    cut = sorted_runs.select("conv_id", *columns).mapInArrow(blocks, schema)
    return cut.withColumn("slice", F.spark_partition_id())


def is_blank(text: Column) -> Column:
    return ~text.rlike(BLANK)


def block_items(rows: Sequence[dict]) -> list[tuple | int]:
    """The items of a block's lattice; rows that must go stand together with their number."""
    items: list = []
    for row in rows:
        stays = 1 if row["copies"] and row["first"] and not row["blank"] else 0
        if stays:
            items.append((row["role"][:1], row["cut"]))
        if gone := row["copies"] - stays:
            items.append(gone)
    return items


def _judged(blocks: DataFrame) -> DataFrame:
    """Blocks whose rows say whether they are blank, and cut off in the middle of a sentence."""
    return blocks.withColumn(
        "rows",
        F.transform(
            "rows",
            lambda r: r.withField("blank", is_blank(r["text"])).withField("cut", ~r["text"].rlike(WHOLE)),
        ),
    )


def _summaries(blocks: DataFrame) -> DataFrame:
    """The ways through each block: conv_id, slice, at, cost, rank."""
    id_type = blocks.schema["conv_id"].dataType.simpleString()
    slim = F.transform(
        "rows",
        lambda r: F.struct(
            F.substring(r["role"], 1, 1).alias("role"), r["copies"].alias("copies"),
            r["first"].alias("first"), r["blank"].alias("blank"), r["cut"].alias("cut"),
        ),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                ways(row_lattice(block_items(rows), last))
                for rows, last in zip(
                    batch.column("rows").to_pylist(), batch.column("last").to_pylist(), strict=True
                )
            ]
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("conv_id", "slice", "at")],
                 pa.array([c for c, _ in found], numbers), pa.array([r for _, r in found], numbers)],
                ["conv_id", "slice", "at", "cost", "rank"],
            )

    schema = f"conv_id {id_type}, slice int, at int, cost array<bigint>, rank array<bigint>"
    return blocks.withColumn("rows", slim).select("conv_id", "slice", "at", "last", "rows").mapInArrow(run, schema)


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("no")
    cost, rank = ways(block_lattice(group["cost"].tolist(), group["rank"].tolist()))
    first = group.iloc[0]
    return pd.DataFrame([(first["conv_id"], first["no"], cost, rank)], columns=["conv_id", "no", "cost", "rank"])


def _split(group: pd.DataFrame) -> pd.DataFrame:
    """The states at which a path enters and leaves each of the blocks of a group."""
    group = group.sort_values("no")
    first = group.iloc[0]
    exits = ENDS if first["leaving"] < 0 else [int(first["leaving"])]
    lattice = block_lattice(group["cost"].tolist(), group["rank"].tolist())
    _, taken = lattice.path(int(first["entering"]), exits)
    leaving = [arc[2] % STATES for arc in taken[: len(group)]]
    entering = [int(first["entering"]), *leaving[:-1]]
    return pd.DataFrame(
        {"conv_id": group["conv_id"], "no": group["no"], "entering": entering, "leaving": leaving}
    )


def block_states(blocks: DataFrame, fan: int = FAN) -> DataFrame | None:
    """For the blocks of conversations that have several: conv_id, slice, at, entering, leaving, last.

    Groups hold at most `fan` neighbouring blocks, whatever the length of a conversation; each level
    has about that many times fewer rows. None if every conversation is a block.
    """
    counted = blocks.groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.struct("slice", "at")).alias("end"))
    many = materialise(counted.filter("n > 1").select(F.struct("conv_id").alias("key"), "end"), "many")
    if many.isEmpty():
        return None
    of_many = blocks.join(many, F.struct("conv_id") == F.col("key"))
    of_many = of_many.withColumn("last", F.struct("slice", "at") == F.col("end")).drop("key", "end")
    id_type = blocks.schema["conv_id"].dataType.simpleString()
    base = materialise(number_rows(_summaries(of_many), ["slice", "at"], "no"), "ways")
    summary = f"conv_id {id_type}, no bigint, cost array<bigint>, rank array<bigint>"
    found = f"conv_id {id_type}, no bigint, entering int, leaving int"
    level, levels = base.select("conv_id", "no", "cost", "rank"), []
    while True:
        # Numbered anew, neighbours of a conversation that a bound of groups parted meet in the end.
        dense = number_rows(level.withColumnRenamed("no", "old"), ["old"], "no")
        level = materialise(dense.withColumn("part", F.expr(f"no div {fan}")), "level")
        groups = level.select("conv_id", "no", "cost", "rank", "part").groupBy("conv_id", "part")
        levels.append(level)
        level = materialise(groups.applyInPandas(_combine, summary), "level")
        if level.count() == level.select("conv_id").distinct().count():
            break
    states = level.select("conv_id", "no", F.lit(START).alias("entering"), F.lit(-1).alias("leaving"))
    for level in reversed(levels):
        heads = level.groupBy("conv_id", "part").agg(F.min("no").alias("head"))
        heads = heads.join(states.select(F.col("no").alias("head"), "entering", "leaving"), "head")
        known = level.alias("l").join(
            heads.alias("h"),
            (F.col("l.part") == F.col("h.part")) & F.col("l.conv_id").eqNullSafe(F.col("h.conv_id")),
        ).select("l.*", "h.entering", "h.leaving")
        down = known.select("conv_id", "part", "no", "cost", "rank", "entering", "leaving")
        inside = down.groupBy("conv_id", "part").applyInPandas(_split, found)
        inside = inside.join(level.select("no", "old"), "no")
        states = materialise(inside.select("conv_id", F.col("old").alias("no"), "entering", "leaving"), "states")
    states = states.select("no", "entering", "leaving").join(base.select("no", "conv_id", "slice", "at"), "no")
    ends = F.struct("slice", "at") == F.col("end")
    return materialise(
        states.join(many, F.struct("conv_id") == F.col("key"))
        .select("slice", "at", "entering", "leaving", ends.alias("last"))
        .withColumn("many", F.lit(True)),
        "states",
    )


PIECE = (
    "audit string, turns array<struct<role:string,text:string>>, cost bigint, n_rows bigint,"
    " blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string,"
    " last_initial string, least_turn bigint, greatest_turn bigint, n_turns bigint"
)


def repair_block(rows: Sequence[dict], entering: int, exits: Sequence[int], last: bool) -> dict:
    """Trace the repair of a block and count its faults; rows without copies count for nothing."""
    rows = [r for r in rows if r["copies"]]
    cost, taken = row_lattice(block_items(rows), last).path(entering, exits)
    audit = "".join(arc[0] for arc in taken)
    free = iter([r for r in rows if r["first"] and not r["blank"]])
    turns, state, forced = [], entering, 0
    # Rows that must go are items of their own; of the others each edit but an insert takes one.
    items = iter(block_items(rows))
    for label, _, head in taken[:-1]:
        row = None
        if label != "I":
            item = next(items)
            row = None if isinstance(item, int) else next(free)
        state = head % STATES
        if label == "K":
            turns.append({"role": row["role"], "text": row["text"]})
        elif label == "R":
            turns.append({"role": ROLES[state], "text": row["text"]})
        elif label == "I":
            turns.append({"role": ROLES[state], "text": ""})
    initials = [r["role"][:1] for r in rows]
    numbered = [r["turn"] for r in rows if r["turn"] is not None]
    copies = sum(r["copies"] for r in rows)
    blank = sum(r["copies"] for r in rows if r["blank"])
    fresh = [r for r in rows if r["first"] and not r["blank"]]
    return {
        "audit": audit,
        "turns": turns,
        "cost": int(cost),
        "n_rows": copies,
        "blank": blank,
        "duplicate": copies - blank - len(fresh),
        "truncated": sum(r["cut"] for r in fresh),
        # Rows of one run have the same role, so any two of them side by side are illegal.
        "illegal": copies - len(rows) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0] if rows else None,
        "last_initial": initials[-1] if rows else None,
        "least_turn": min(numbered, default=None),
        "greatest_turn": max(numbered, default=None),
        "n_turns": len(set(numbered)),
    }


def repair_turns(turns: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """Repair conversations given as rows of conv_id, turn, role, text, copies.

    Returns a row per block, in the order of slice and at: conv_id, slice, at, `many` (whether its
    conversation has more blocks), the edits as `audit`, the repaired `turns`, their cost, and what
    was wrong in the block. Blank rows and rows whose role and text came earlier are deleted. Ties
    between repairs go to the audit that is first in ASCII. Null conversation ids are one conversation;
    rows without copies count for nothing, and a conversation with no others has an empty block. An
    empty table gives no blocks. A very long text is in a block of its own with at most 63 others.
    """
    blocks = materialise(cut_blocks(turn_runs(turns), block_rows), "blocks")
    judged = _judged(blocks)
    states = block_states(judged, fan)
    if states is None:
        known = judged.withColumns({"entering": F.lit(START), "leaving": F.lit(-1), "last": F.lit(True), "many": F.lit(False)})
    else:
        known = judged.join(states, ["slice", "at"], "left").withColumns(
            {
                "entering": F.coalesce("entering", F.lit(START)),
                "leaving": F.coalesce("leaving", F.lit(-1)),
                "last": F.coalesce("last", F.lit(True)),
                "many": F.coalesce("many", F.lit(False)),
            }
        )
    id_type = blocks.schema["conv_id"].dataType.simpleString()
    keys = f"conv_id {id_type}, slice int, at int, many boolean"
    out = T._parse_datatype_string(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows, entering, leaving, last in zip(
                *[batch.column(n).to_pylist() for n in ("rows", "entering", "leaving", "last")], strict=True
            ):
                exits = ENDS if leaving < 0 else [leaving]
                found.append(repair_block(rows, entering, exits, last))
            kept = [batch.column(n) for n in ("conv_id", "slice", "at", "many")]
            made = [pa.array([f[n] for f in found], kind) for n, kind in _arrow_types(out)]
            yield pa.RecordBatch.from_arrays([*kept, *made], ["conv_id", "slice", "at", "many", *out.names])

    bounded_batches(turns.sparkSession)
    known = known.select("conv_id", "slice", "at", "many", "rows", "entering", "leaving", "last")
    return known.mapInArrow(run, f"{keys}, {PIECE}")


def _arrow_types(schema: T.StructType) -> list[tuple[str, pa.DataType]]:
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return [(f.name, kinds.get(f.dataType.simpleString()) or pa.list_(turn)) for f in schema.fields]


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, slice, at, place, role, text; ordered by the three numbers."""
    return pieces.select("conv_id", "slice", "at", F.posexplode("turns").alias("place", "turn")).select(
        "conv_id", "slice", "at", "place", "turn.*"
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(pieces: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of `role:text` lines).

    Conversations of one block are summed up on the spot. Blocks of longer ones pass through a task in
    order, a batch at a time; of a conversation it keeps the edits and the state of a checksum.
    """
    line = lambda t: F.concat(t["role"], F.lit(":"), t["text"])
    # A block without rows is no line, but one empty line is.
    told = pieces.withColumn("lines", F.array_join(F.transform("turns", line), "\n"))
    told = told.withColumn("has_lines", F.size("turns") > 0).drop("turns")
    gaps = F.when(
        F.col("n_turns") > 0, F.col("greatest_turn") - F.col("least_turn") + 1 - F.col("n_turns")
    ).otherwise(F.lit(0))
    single = told.filter("NOT many").withColumn("gaps", gaps.cast("bigint")).select(
        "conv_id", *COUNTS, "audit", F.sha2("lines", 256).alias("repaired_sha256")
    )
    id_type = pieces.schema["conv_id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        kind = None

        def done() -> pa.RecordBatch:
            counts = [pa.array([state[n]], pa.int64()) for n in COUNTS]
            sha = state["sha"].hexdigest()
            return pa.RecordBatch.from_arrays(
                [pa.array([state["conv_id"]], kind), *counts, pa.array(["".join(state["audit"])]), pa.array([sha])],
                ["conv_id", *COUNTS, "audit", "repaired_sha256"],
            )

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != state["conv_id"]:
                    if state:
                        yield done()
                    state = {n: 0 for n in COUNTS} | {
                        "conv_id": row["conv_id"], "audit": [], "sha": hashlib.sha256(),
                        "lines": False, "initial": None, "least": None, "greatest": None,
                    }
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    state[name] += row[name]
                if row["n_rows"]:
                    joint = (state["initial"], row["first_initial"])
                    state["illegal"] += joint[0] is not None and "".join(joint) not in LEGAL
                    state["initial"] = row["last_initial"]
                if row["n_turns"]:
                    # Gaps of the block, and those between it and what came before.
                    least, greatest, before = row["least_turn"], row["greatest_turn"], state["greatest"]
                    state["gaps"] += greatest - least + 1 - row["n_turns"]
                    if before is not None and least > before:
                        state["gaps"] += least - before - 1
                    state["greatest"] = greatest
                state["audit"].append(row["audit"])
                if row["has_lines"]:
                    state["sha"].update((("\n" if state["lines"] else "") + row["lines"]).encode())
                    state["lines"] = True
        if state:
            yield done()

    bounded_batches(pieces.sparkSession)
    schema = f"conv_id {id_type}, " + ", ".join(f"{n} bigint" for n in COUNTS)
    in_order = told.filter("many").repartition("conv_id").sortWithinPartitions("conv_id", "slice", "at")
    many = in_order.mapInArrow(fold, f"{schema}, audit string, repaired_sha256 string")
    return single.unionByName(many)
