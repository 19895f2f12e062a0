"""Repair of conversation structure: the cheapest edits to the form ``(s?(ua)+)?``.

Every message is a symbol: the initial of its role and its fault. For a run of messages,
the costs and edits between any two states of the form make a matrix, and matrices of
adjacent runs multiply, with minimum for sum and sum for product. Frequent pairs of
adjacent symbols are replaced by new symbols (Re-Pair) over all conversations; each rule's
matrix is the product of two that are known, so what many conversations share is evaluated
once. The edits of an entry are a rope of two ropes, spelt out only where one must be
compared or told. Runs are cut into pieces of bounded length. A conversation may span
partitions: each partition reports the costs of its first and last run, the driver chains
these, and a second pass decodes each run between known ends.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import settled

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
GAPS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = ("su", "ua", "au")

#: States: nothing yet, after the system message, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ENDS = (START, ASSISTANT)
NEVER = 1 << 60
#: The role that an edit gives, by the state that follows.
ROLE_AFTER = {USER: "user", ASSISTANT: "assistant"}
TURN_TO = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

#: Symbols of messages that must go, and of others by initial and whether truncated.
GONE = 0
INITIALS = "sua?"
TERMINALS = 1 + 2 * len(INITIALS)
#: Symbols are bytes, the last of which separates; the others are for rules.
SEPARATOR = 255
ROUNDS, RULES_A_ROUND = 8, 16
#: Symbols of a piece at most.
PIECE = 512

#: A string of edits, or two ropes one after the other.
Rope = str | tuple
Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]


def symbol_of(initial: str, fault: str | None) -> int:
    if fault in (BLANK, DUPLICATE):
        return GONE
    place = INITIALS.index(initial) if initial in ("s", "u", "a") else len(INITIALS) - 1
    return 1 + 2 * place + (fault == TRUNCATED)


def spell(rope: Rope) -> str:
    """The edits of a rope, without recursion."""
    out: list[str] = []
    left: list[Rope] = [rope]
    while left:
        top = left.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            left.extend((top[1], top[0]))
    return "".join(out)


def better(first: Entry | None, second: Entry | None) -> Entry | None:
    """The cheaper entry, of equals the one spelt first. Both consume the same messages and
    end with one, so neither spelling begins the other, and the order survives products."""
    if first is None or second is None:
        return first or second
    if first[0] != second[0]:
        return min(first, second, key=lambda entry: entry[0])
    return min(first, second, key=lambda entry: spell(entry[1]))


def product(first: Matrix, second: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i, k, j in itertools.product(range(STATES), repeat=3):
        a, b = first[i][k], second[k][j]
        if a is not None and b is not None:
            out[i][j] = better(out[i][j], (a[0] + b[0], (a[1], b[1])))
    return out


def inserted(state: int, limit: int = 2) -> Iterator[tuple[int, int, str]]:
    """``state, cost, edits`` after 0, 1, ... insertions; more than two come round again."""
    edits = ""
    for count in range(limit + 1):
        yield state, INSERT_COST * count, edits
        state, edits = TURN_TO[state], edits + INSERT


def terminal(symbol: int) -> Matrix:
    """Insertions, then one message kept, given another role, or deleted."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    initial = INITIALS[(symbol - 1) // 2] if symbol else ""
    extra = TRUNCATED_COST if symbol and (symbol - 1) % 2 else 0
    for start in range(STATES):
        for state, cost, edits in inserted(start):
            steps = [(state, DELETE_COST, DELETE)]
            if symbol:
                steps.append((TURN_TO[state], REROLE_COST + extra, REROLE))
                if initial == "s" and state == START:
                    steps.append((SYSTEM, KEEP_COST + extra, KEEP))
                if initial in ("u", "a") and TURN_TO[state] == {"u": USER, "a": ASSISTANT}[initial]:
                    steps.append((TURN_TO[state], KEEP_COST + extra, KEEP))
            for end, more, edit in steps:
                out[start][end] = better(out[start][end], (cost + more, edits + edit))
    return out


def closing(state: int) -> tuple[int, str] | None:
    """Cost and edits of the insertions that end a conversation."""
    for at, cost, edits in inserted(state):
        if at in ENDS:
            return cost, edits
    return None


@dataclass
class Grammar:
    """Rules ``a, b`` for the symbols from ``TERMINALS`` on, and the matrix of each symbol."""

    rules: list[tuple[int, int]] = field(default_factory=list)
    matrices: list[Matrix] = field(default_factory=lambda: [terminal(s) for s in range(TERMINALS)])

    def add(self, pairs: list[tuple[int, int]]) -> None:
        for a, b in pairs:
            self.rules.append((a, b))
            self.matrices.append(product(self.matrices[a], self.matrices[b]))

    def compress(self, symbols: bytes) -> bytes:
        """The symbols with each rule applied from the left, in the order of the rules."""
        for at, (a, b) in enumerate(self.rules):
            symbols = symbols.replace(bytes((a, b)), bytes((TERMINALS + at,)))
        return symbols

    def matrix(self, symbols: bytes) -> Matrix:
        """The product over a piece."""
        parts = [self.matrices[symbol] for symbol in self.compress(symbols)]
        whole = parts[0]
        for part in parts[1:]:
            whole = product(whole, part)
        return whole


def pieces_of(symbols: bytes) -> list[bytes]:
    return [symbols[at : at + PIECE] for at in range(0, len(symbols), PIECE)]


def costs_of(matrix: Matrix) -> np.ndarray:
    return np.array([[entry[0] if entry else NEVER for entry in row] for row in matrix], np.int64)


def times(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The min-plus product of cost matrices (or of a matrix and a column)."""
    if second.ndim == 1:
        return np.minimum((first + second).min(axis=1), NEVER)
    return np.minimum((first[:, :, None] + second[None]).min(axis=1), NEVER)


#: Cost to the end of a conversation from each state, if no message follows.
CLOSING = np.array([close[0] if (close := closing(s)) else NEVER for s in range(STATES)], np.int64)
IDENTITY = np.where(np.eye(STATES, dtype=bool), 0, NEVER).astype(np.int64)


class Solver:
    """Cuts, matrices and repairs, each computed once per task for equal symbols."""

    HELD = 20_000

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.known: dict[bytes, tuple[Matrix, np.ndarray]] = {}

    def piece(self, symbols: bytes) -> tuple[Matrix, np.ndarray]:
        found = self.known.get(symbols)
        if found is None:
            if len(self.known) >= self.HELD:
                self.known.clear()
            matrix = self.grammar.matrix(symbols)
            found = self.known[symbols] = (matrix, costs_of(matrix))
        return found

    def through(self, symbols: bytes) -> np.ndarray:
        """Costs of a run between any two states."""
        whole = IDENTITY
        for piece in pieces_of(symbols):
            whole = times(whole, self.piece(piece)[1])
        return whole

    def solve(self, symbols: bytes, entry: int, to_go: np.ndarray) -> tuple[str, int]:
        """The edits of a run that begins in ``entry``, and the state it ends in, given the
        cost from each state to the end of the conversation after this run.

        Costs to the end are taken backwards over the pieces; then each piece takes, of
        the ways that keep the whole at its least, the one spelt first.
        """
        pieces = pieces_of(symbols)
        ahead = [to_go]
        for piece in reversed(pieces):
            ahead.append(times(self.piece(piece)[1], ahead[-1]))
        ahead.reverse()
        edits, state = [], entry
        for piece, after in zip(pieces, ahead[1:]):
            matrix, costs = self.piece(piece)
            totals = costs[state] + after
            ways = [(spell(matrix[state][j][1]), j) for j in np.flatnonzero(totals == totals.min())]
            told, state = min(ways)
            edits.append(told)
        return "".join(edits), int(state)


def count_pairs(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> np.ndarray:
    """How often each pair of symbols stands side by side in the weighted pieces, as
    compressed so far."""
    totals = np.zeros(1 << 16)
    for batch in batches:
        held = [grammar.compress(piece) + bytes((SEPARATOR,)) for piece in batch.column("symbols").to_pylist()]
        weights = np.repeat(batch.column("n").to_numpy().astype(float), [len(piece) for piece in held])
        symbols = np.frombuffer(b"".join(held), np.uint8).astype(np.int64)
        if len(symbols) > 1:
            totals += np.bincount(symbols[:-1] * 256 + symbols[1:], weights[:-1], minlength=1 << 16)
    by_symbol = totals.reshape(256, 256)
    by_symbol[SEPARATOR], by_symbol[:, SEPARATOR] = 0, 0
    return totals


def learn_grammar(pieces: DataFrame) -> Grammar:
    """Re-Pair over all pieces (``symbols, n``): in each of ``ROUNDS`` rounds the most
    frequent pairs become rules. Symbols that no rule covers stay as they are, so the
    grammar decides only how much is shared, not what comes out.
    """
    grammar = Grammar()
    for _ in range(ROUNDS):

        def run(batches: Iterator[pa.RecordBatch], known: Grammar = Grammar(list(grammar.rules), [])) -> Iterator[pa.RecordBatch]:
            totals = count_pairs(batches, known)
            seen = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int64()), pa.array(totals[seen].astype(np.int64))], names=["pair", "n"]
            )

        counted = pieces.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        most = counted.filter(F.col("n") > 1).orderBy(F.desc("n"), "pair").limit(RULES_A_ROUND).collect()
        if not most:
            break
        grammar.add([divmod(row["pair"], 256) for row in most])
    return grammar


# Messages in order, with their faults


def faulty(rows: DataFrame) -> DataFrame:
    """``conv_id, known, turn, role, text, initial, fault, at`` of the messages.

    The first of these faults counts: ``blank`` (nothing but gaps), ``duplicate`` (role and
    text stand earlier in the conversation), ``truncated`` (does not end with a stop).
    The first of equal messages is found by a partial aggregation, on digests, and only
    messages that repeat are joined with it.
    """
    base = settled(
        rows.select(
            "conv_id",
            F.col("turn").isNotNull().alias("known"),
            "turn",
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        ).withColumn("at", F.monotonically_increasing_id())
    )
    end = F.right(F.rtrim("text", F.lit(GAPS)), F.lit(1))
    judged = base.select(
        "*",
        F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"),
        (~end.isin(*STOPS)).alias("open"),
        F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("digest"),
    )
    place = F.struct("known", "turn", "at")
    repeated = (
        judged.filter(~F.col("blank"))
        .groupBy("conv_id", "digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter(F.col("times") > 1)
        .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("first.at").alias("first"))
    )
    joined = judged.join(repeated, judged["conv_id"].eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = F.col("first").isNotNull() & (F.col("first") != F.col("at")) & ~F.col("blank")
    fault = F.when(F.col("blank"), BLANK).when(later, DUPLICATE).when(F.col("open"), TRUNCATED)
    return joined.select("conv_id", "known", "turn", "role", "text", "initial", fault.alias("fault"), "digest", "at")


@dataclass
class Run:
    """Adjacent messages of one conversation in a partition."""

    conversation: object
    turns: list
    roles: list[str]
    texts: list[str]
    initials: list[str]
    faults: list[str | None]

    def symbols(self) -> bytes:
        return bytes(map(symbol_of, self.initials, self.faults))


COLUMNS = ("turn", "role", "text", "initial", "fault")


def runs_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...] = COLUMNS) -> Iterator[Run]:
    """One run at a time; columns that are not asked for stay empty."""
    held: Run | None = None
    for batch in batches:
        conversations = batch.column("conv_id").to_pylist()
        values = [batch.column(name).to_pylist() if name in columns else None for name in COLUMNS]
        start = 0
        for conversation, group in itertools.groupby(conversations):
            stop = start + sum(1 for _ in group)
            if held is not None and held.conversation != conversation:
                yield held
                held = None
            if held is None:
                held = Run(conversation, [], [], [], [], [])
            kept = (held.turns, held.roles, held.texts, held.initials, held.faults)
            for target, column in zip(kept, values):
                if column is not None:
                    target.extend(column[start:stop])
            start = stop
    if held is not None:
        yield held


def _part_of(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, Iterator[pa.RecordBatch]]:
    """The partition's number, and all its batches."""
    for batch in batches:
        if len(batch):
            return batch.column("part")[0].as_py(), itertools.chain([batch], batches)
    return None, iter(())


SHAPE = ("initial", "fault")


def _report(part: int, runs: Iterator[Run], solver: Solver) -> Iterator[tuple]:
    """``part, last, conversation, through, first initial, last initial`` of the first and
    the last run of a partition (one row if these are the same)."""
    first = last = next(runs)
    for last in runs:
        pass
    for run in [first] if last is first else [first, last]:
        costs = solver.through(run.symbols()).ravel().tolist()
        yield part, run is last, run.conversation, costs, run.initials[-1]


@dataclass
class Join:
    """What a partition must know of its neighbours: the state in which its first run
    begins, the costs from the end of its last run on, whether these runs go on beyond it,
    and the initial before the first message."""

    entry: int = START
    to_go: np.ndarray = field(default_factory=lambda: CLOSING)
    from_before: bool = False
    goes_on: bool = False
    initial: str | None = None


def chain(reports: list[tuple]) -> tuple[dict[int, Join], list[list[tuple]]]:
    """The joins of all partitions from their reports in order, but for the entries, and
    the runs that are linked."""
    joins = {report[0]: Join() for report in reports}
    chains: list[list[tuple]] = []
    for report in reports:
        before = chains[-1][-1] if chains else None
        if before and before[0] != report[0] and before[1] and before[2] == report[2]:
            chains[-1].append(report)
        else:
            chains.append([report])
    linked = [runs for runs in chains if len(runs) > 1]
    for runs in linked:
        ahead = CLOSING
        for place in range(len(runs) - 1, -1, -1):
            part, _, _, costs, _ = runs[place]
            if place + 1 < len(runs):
                joins[part].to_go, joins[part].goes_on = ahead, True
            if place:
                joins[part].from_before, joins[part].initial = True, runs[place - 1][4]
            ahead = times(np.array(costs).reshape(STATES, STATES), ahead)
    return joins, linked


def enter(joins: dict[int, Join], linked: list[list[tuple]], exits: dict[tuple[int, bool], list[int]]) -> None:
    """Set the entries: the state in which each linked run leaves, from the one it enters."""
    for runs in linked:
        state = START
        for place, (part, last, *_) in enumerate(runs):
            if place:  # the run that opens a chain may follow another chain's end in its partition
                joins[part].entry = state
            state = exits[part, last][state]


def _spans(join: Join, first: bool, last: bool) -> bool:
    return (first and join.from_before) or (last and join.goes_on)


def _marked(runs: Iterator[Run]) -> Iterator[tuple[Run, bool, bool]]:
    """Each run, and whether it is the first or the last."""
    run, first = next(runs, None), True
    while run is not None:
        following = next(runs, None)
        yield run, first, following is None
        run, first = following, False


def _exits(part: int, runs: Iterator[Run], join: Join, solver: Solver) -> Iterator[tuple]:
    """``part, last, states``: of the linked runs, the state each is left in by entry."""
    for run, first, last in _marked(runs):
        if _spans(join, first, last):
            to_go = join.to_go if last else CLOSING
            yield part, last, [solver.solve(run.symbols(), entry, to_go)[1] for entry in range(STATES)]


def _repaired(part: int, runs: Iterator[Run], join: Join, solver: Solver, spans: bool | None) -> Iterator[tuple]:
    """The rows of :func:`repair` of a partition; of runs that span partitions or not, or
    of all."""
    place = 0
    for run, first, last in _marked(runs):
        spanning = _spans(join, first, last)
        if spans is not None and spans != spanning:
            place += 3 * len(run.roles) + 3  # beyond what the run can need
            continue
        goes_on = last and join.goes_on
        state = join.entry if first else START
        before = join.initial if first else None
        edits, left = solver.solve(run.symbols(), state, join.to_go if last else CLOSING)
        if not goes_on:
            edits += closing(left)[1]
        at = 0
        for edit in edits:
            if edit == INSERT:
                state = TURN_TO[state]
                yield run.conversation, part, place, None, None, INSERT, INSERT_COST, False, ROLE_AFTER[state], "", spanning
                place += 1
                continue
            role, text, fault, initial = run.roles[at], run.texts[at], run.faults[at], run.initials[at]
            illegal = before is not None and before + initial not in LEGAL
            cost = {KEEP: KEEP_COST, REROLE: REROLE_COST, DELETE: DELETE_COST}[edit]
            if edit != DELETE:
                cost += TRUNCATED_COST if fault == TRUNCATED else 0
                state = SYSTEM if edit == KEEP and initial == "s" else TURN_TO[state]
                role = ROLE_AFTER[state] if edit == REROLE else role
            yield run.conversation, part, place, run.turns[at], fault, edit, cost, illegal, role, text, spanning
            place, at, before = place + 1, at + 1, initial


REPAIRED = "part int, place long, turn {turn}, fault string, edit string, cost int, illegal boolean, role string, text string, spans boolean"


@dataclass
class Repair:
    """Messages in order in their partitions, the grammar, and the joins."""

    parts: DataFrame
    grammar: Grammar
    joins: dict[int, Join]

    def rows(self, spans: bool | None = None) -> DataFrame:
        """One row per message and per inserted message: ``conv_id, part, place, turn, fault,
        edit, cost, illegal, role, text, spans``.

        ``part`` and ``place`` give the order in a conversation. ``edit`` is K, R, D or I;
        without the rows of ``D`` the conversation is the repaired one. ``illegal`` marks
        messages whose role may not follow that of the message before. ``spans`` says that the
        conversation spans partitions; only such, or only other rows are given on request.
        """
        grammar, joins = self.grammar, self.joins
        schema = T.StructType(
            [self.parts.schema["conv_id"], *T.StructType.fromDDL(REPAIRED.format(turn=_kind(self.parts, "turn"))).fields]
        )
        shape = pa.schema([pa.field(name, _arrow_type(self.parts, name, schema)) for name in schema.names])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, batches = _part_of(batches)
            if part is None:
                return
            found = _repaired(part, runs_of(batches), joins[part], Solver(grammar), spans)
            while held := list(itertools.islice(found, 4096)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*held), shape.types)], schema=shape
                )

        return self.parts.mapInArrow(run, schema)


def _kind(rows: DataFrame, name: str) -> str:
    return rows.schema[name].dataType.simpleString()


def _arrow_type(parts: DataFrame, name: str, schema: T.StructType) -> pa.DataType:
    if name in ("conv_id", "turn"):
        return parts.select(name).limit(0).toArrow().schema.field(name).type
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return kinds[schema[name].dataType.simpleString()]


def repair(conversations: DataFrame, partitions: int | None = None) -> Repair:
    """The cheapest repair of each conversation to the form ``(s?(ua)+)?`` of role initials.

    Costs: keep 0, another role (user or assistant) 2, delete 3, insert an empty message of
    user or assistant 2, and 1 for each truncated message that is not deleted. Blank and
    duplicate messages must go. Of equally cheap repairs the one whose edits, spelt K, R, D,
    I in order, come first in ASCII counts.

    ``conversations`` has ``conv_id, turn, role, text``; messages are read in order of turn,
    NULLs first, then of role and of the digest of the text. NULL roles and texts read as
    one space; roles other than by the initials s, u, a must be changed or go. NULL
    conversations make one. Repeated rows are duplicates; an empty table gives no rows;
    further columns are ignored. Very long conversations span partitions.
    """
    rows = faulty(conversations.select("conv_id", "turn", "role", "text"))
    order = ["conv_id", "known", "turn", "role", "digest", "at"]
    wide = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    parts = settled(
        wide.sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("conv_id", "turn", "role", "text", "initial", "fault", "part")
    )
    shapes = parts.select("conv_id", "initial", "fault", "part")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(batches, SHAPE)
        while held := list(itertools.islice(runs, 4096)):
            pieces = [piece for run in held for piece in pieces_of(run.symbols())]
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["symbols"])

    pieces = settled(shapes.mapInArrow(cut, "symbols binary").groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))
    grammar = learn_grammar(pieces)
    conv_type = parts.select("conv_id").limit(0).toArrow().schema.field("conv_id").type

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, batches = _part_of(batches)
        if part is not None:
            columns = zip(*_report(part, runs_of(batches, SHAPE), Solver(grammar)))
            kinds = [pa.int32(), pa.bool_(), conv_type, pa.list_(pa.int64()), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "last", "conv_id", "costs", "initial"])

    schema = f"part int, last boolean, conv_id {_kind(parts, 'conv_id')}, costs array<long>, initial string"
    joins, linked = chain(_tuples(shapes.mapInArrow(report, schema)))  # two rows per partition at most
    if linked:

        def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, batches = _part_of(batches)
            found = list(_exits(part, runs_of(batches, SHAPE), joins[part], Solver(grammar))) if part is not None else []
            if found:
                kinds = [pa.int32(), pa.bool_(), pa.list_(pa.int32())]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "last", "states"])

        found = _tuples(shapes.mapInArrow(leave, "part int, last boolean, states array<int>"))
        enter(joins, linked, {(part, last): states for part, last, states in found})
    return Repair(parts, grammar, joins)


def _tuples(rows: DataFrame) -> list[tuple]:
    """A bounded number of rows, in order of their first two columns."""
    found = rows.toArrow()
    columns = [found.column(name).to_pylist() for name in found.column_names]
    return sorted(zip(*columns), key=lambda row: row[:2])


SUMMARY = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summaries(repaired: Repair) -> DataFrame:
    """One row per conversation that has messages: ``conv_id``, how many are ``blank,
    duplicate, truncated, illegal``, ``cost, audit, repaired_sha256`` (of the repaired
    ``role:text``, joined by newlines).

    Conversations within a partition are read where they lie. SHA-256 cannot be merged, so the
    messages of one that spans partitions go through one task in order, a row at a time.
    """
    kind = repaired.parts.schema["conv_id"]
    schema = T.StructType([kind, *T.StructType.fromDDL(SUMMARY).fields])
    conv_type = _arrow_type(repaired.parts, "conv_id", schema)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held: _Summary | None = None

        def batch_of() -> pa.RecordBatch:
            kinds = [conv_type, *[pa.int64()] * 5, pa.string(), pa.string()]
            columns = [*zip(*done)]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=schema.names
            )

        for batch in batches:
            names = ("conv_id", "fault", "edit", "cost", "illegal", "role", "text")
            for conversation, *row in zip(*(batch.column(name).to_pylist() for name in names)):
                if held is None or held.conversation != conversation:
                    if held is not None:
                        done.append(held.row())
                    held = _Summary(conversation)
                held.add(*row)
            if len(done) >= 2048:
                yield batch_of()
        if held is not None:
            done.append(held.row())
        if done:
            yield batch_of()

    within = repaired.rows(False).mapInArrow(told, schema)
    if not any(join.from_before or join.goes_on for join in repaired.joins.values()):
        return within
    across = repaired.rows(True).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return within.unionByName(across.mapInArrow(told, schema))


class _Summary:
    def __init__(self, conversation: object):
        self.conversation = conversation
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal = self.cost = 0
        self.edits: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False

    def add(self, fault: str | None, edit: str, cost: int, illegal: bool, role: str, text: str) -> None:
        if fault:
            self.faults[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.edits.append(edit)
        if edit != DELETE:
            self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        return (
            self.conversation, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest()
        )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one message in five damaged, by the checksum of
    ``conv_id:turn``: lost, emptied, without stops, doubled, or given to the user."""

    def written(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return conversations.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(written("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(written("text"), STOPS, "")).otherwise(written("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def gaps_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps``: turns missing between the least and the greatest. Distinct turns
    are found before they are counted, so a conversation of any length spreads."""
    turns = conversations.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))
