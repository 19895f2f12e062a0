"""Transcripts to turns: a hidden Markov model recovers who speaks in each line.

States are roles. A line shows a speaker marker or none, its length, its last character
and whether it opens a message. Counts over a bounded labelled sample give the model.

Viterbi runs over conversations of any length: rows are put in global order by a range
partitioning, so a very long conversation covers several partitions. In a first pass every
partition reports, for its first and last conversation only, the best score from each
state before it to each state after it (a small matrix). The driver chains these few
matrices, which gives each partition the states at its two ends; the second pass decodes
between them and renders the turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import settled, whole

# Names by which speakers are marked at the start of a line.
MARKERS = {
    "user": ("user", "human", "question", "customer", "prompter", "q"),
    "assistant": ("assistant", "ai", "bot", "gpt", "answer", "agent", "model", "a"),
    "system": ("system", "instructions", "context"),
    "tool": ("tool", "function", "observation"),
}
_ROLE_OF = {name: role for role, names in MARKERS.items() for name in names}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
MARKER = re.compile(
    rf"\s*(?:<\|im_start\|>\s*({_NAMES})\b|<\|({_NAMES})\|>|\[({_NAMES})\]:?|\#{{2,}}\s*({_NAMES})\s*:?\s*$|\**({_NAMES})\**\s*:)\s*",
    re.IGNORECASE,
)

#: At most so many rows, of the conversations whose ids hash lowest, give the model.
TRAINING_ROWS = 20_000
LENGTHS = 12
ENDINGS = "?.!:,"
#: What a marker is worth in counts for the role that it names, and every count's start.
MARKER_PRIOR, PRIOR = 200.0, 0.5
#: Count that stands for a change of speaker inside a message without a marker.
SILENT_CHANGE = 1e-3

Line = tuple[int, int, int, bool]  # marker (0 for none), length, ending, opens a message


def lines_of(text: str) -> list[tuple[str, Line]]:
    """The lines of one message, without markers, and what they show. At least one."""
    out = []
    for at, line in enumerate(text.split("\n")):
        found = MARKER.match(line)
        marker = 0
        if found:
            marker = 1 + list(MARKERS).index(_ROLE_OF[next(filter(None, found.groups())).lower()])
            line = line[found.end() :]
        length = min(len(line).bit_length(), LENGTHS - 1)
        ending = 1 + ENDINGS.find(line.rstrip()[-1:] or " ")
        out.append((line, (marker, length, ending, at == 0 or marker > 0)))
    return out


@dataclass
class Model:
    """Logarithms: ``first`` and ``change`` at the start of a message, ``stay`` elsewhere;
    ``shows``: for each feature a table value x role."""

    roles: list[str]
    first: np.ndarray
    change: np.ndarray
    stay: np.ndarray
    shows: list[np.ndarray]

    def emission(self, line: Line) -> np.ndarray:
        return self.shows[0][line[0]] + self.shows[1][line[1]] + self.shows[2][line[2]]

    def step(self, line: Line) -> np.ndarray:
        """From each state before the line to each state in it."""
        return (self.change if line[3] else self.stay) + self.emission(line)[None, :]

    def passage(self, lines: list[Line]) -> tuple[np.ndarray, np.ndarray]:
        """Best scores through the lines: from the start of a conversation (a row) and
        from each state before them (a matrix), to each state of the last line."""
        start, through = self.first + self.emission(lines[0]), self.step(lines[0])
        for line in lines[1:]:
            step = self.step(line)
            start = (start[:, None] + step).max(axis=0)
            through = (through[:, :, None] + step[None]).max(axis=1)
        return start, through

    def decode(self, lines: list[Line], before: int | None, last: int | None) -> list[int]:
        """Viterbi; ``before``: state ahead of the lines, ``last``: that of the last line."""
        score = self.first + self.emission(lines[0]) if before is None else self.step(lines[0])[before]
        back = []
        for line in lines[1:]:
            total = score[:, None] + self.step(line)
            back.append(total.argmax(axis=0))
            score = total.max(axis=0)
        state = int(score.argmax()) if last is None else last
        path = [state]
        for choice in reversed(back):
            state = int(choice[state])
            path.append(state)
        return path[::-1]


def fit_model(rows: list[tuple[object, str | None, str]]) -> Model:
    """``rows``: conversation, role and text, in order. Roles are lower-cased; rows with no
    role count for nothing. Without any role, the roles of ``MARKERS`` are assumed."""
    seen = sorted({role.lower() for _, role, _ in rows if role})
    roles = seen or list(MARKERS)
    size = len(roles)
    first, change = np.full(size, PRIOR), np.full((size, size), PRIOR)
    stay = np.eye(size) + SILENT_CHANGE
    shows = [np.full((len(MARKERS) + 1, size), PRIOR), np.full((LENGTHS, size), PRIOR)]
    shows.append(np.full((len(ENDINGS) + 1, size), PRIOR))
    shows[0][0] += MARKER_PRIOR
    for at, name in enumerate(MARKERS):
        if name in roles:
            shows[0][at + 1, roles.index(name)] += MARKER_PRIOR
    conversation, before = object(), None
    for key, role, text in rows:
        starts = key != conversation
        if starts:
            conversation, before = key, None
        if not role:
            before = None
            continue
        state = roles.index(role.lower())
        if starts:
            first[state] += 1
        elif before is not None:
            change[before, state] += 1
        before = state
        for _, (marker, length, ending, _) in lines_of(text):
            for table, value in zip(shows, (marker, length, ending)):
                table[value, state] += 1
    return Model(
        roles,
        np.log(first / first.sum()),
        np.log(change / change.sum(axis=1, keepdims=True)),
        np.log(stay / stay.sum(axis=1, keepdims=True)),
        [np.log(table / table.sum(axis=0)) for table in shows],
    )


def is_held_out(conversation: Column) -> Column:
    """A third of the conversations, by the checksum of the id as text."""
    checksum = F.crc32(conversation.cast("string").cast("binary"))
    return F.coalesce(checksum % 3 == 1, F.lit(False))


def learn(conversations: DataFrame, training_rows: int = TRAINING_ROWS) -> Model:
    """A model from at most ``training_rows`` rows, none of them held out."""
    sample = (
        conversations.filter(~is_held_out(F.col("conv_id")))
        .select(F.xxhash64("conv_id").alias("h"), "conv_id", "turn", "role", whole("text").alias("text"))
        .orderBy("h", "conv_id", "turn", "text", "role")
        .limit(training_rows)
        .select("conv_id", "role", "text")
        .toArrow()
    )
    return fit_model([*zip(*(sample.column(name).to_pylist() for name in sample.column_names))])


Row = tuple[object, object, str]  # conversation, turn, text


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Row]]:
    """The rows of a partition, one conversation at a time."""
    run: list[Row] = []
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "turn", "text"))):
            if run and row[0] != run[-1][0]:
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _lines(run: list[Row]) -> list[Line]:
    return [line for _, _, text in run for _, line in lines_of(text)]


def _ends(model: Model, part: int, batches: Iterator[pa.RecordBatch]) -> list[tuple]:
    """Part, 0 or 1 for first and last, conversation, and the scores through its lines.
    A partition with one conversation has one entry, 0."""
    ends: dict[int, list[Row]] = {}
    for run in _runs(batches):
        ends[min(len(ends), 1)] = run
    out = []
    for place, run in sorted(ends.items()):
        start, through = model.passage(_lines(run))
        out.append((part, place, run[0][0], start.tolist(), through.ravel().tolist()))
    return out


def chain(ends: list[tuple], model: Model) -> dict[int, tuple[int | None, int | None, bool]]:
    """For each partition: the state before its first line (None: a conversation starts
    there), the state of its last line (None: free), and whether that goes on after it."""
    ends = sorted(ends, key=lambda end: end[:2])
    last_of = {part: place for part, place, *_ in ends}
    known: dict[int, list] = {part: [None, None, False] for part in last_of}
    size, at = len(model.roles), 0
    while at < len(ends):
        stop = at + 1
        while (
            stop < len(ends)
            and ends[stop][1] == 0
            and ends[stop - 1][1] == last_of[ends[stop - 1][0]]
            and ends[stop][2] == ends[stop - 1][2]
        ):
            stop += 1
        group = ends[at:stop]
        scores = [np.array(group[0][3])]
        for end in group[1:]:
            scores.append((scores[-1][:, None] + np.array(end[4]).reshape(size, size)).max(axis=0))
        state = int(scores[-1].argmax())
        for place in range(len(group) - 1, 0, -1):
            part, before = group[place][0], group[place - 1][0]
            if group[place][1] == last_of[part]:
                known[part][1] = state
            through = np.array(group[place][4]).reshape(size, size)
            exits = state
            state = int((scores[place - 1] + through[:, exits]).argmax())
            known[part][0] = state
            known[before][1], known[before][2] = state, True
        at = stop
    return {part: tuple(value) for part, value in known.items()}


TURN_END = "<|end|>\n"


def render(model: Model, runs: Iterator[list[Row]], ends: tuple[int | None, int | None, bool]) -> Iterator[tuple]:
    """``conv_id, turn, segment, role, opens, text, rendered`` of a partition's rows.

    The rendered pieces of a conversation, in order, make its canonical transcript.
    """
    before, last, goes_on = ends
    run, first = next(runs, None), True
    while run is not None:
        following = next(runs, None)
        final = following is None
        cut = [lines_of(text) for _, _, text in run]
        entry = before if first else None
        path = iter(
            model.decode([line for part in cut for _, line in part], entry, last if final and goes_on else None)
        )
        held = entry
        for at, ((conversation, turn, _), part) in enumerate(zip(run, cut)):
            pieces: list[tuple[int, list[str]]] = []
            for line, _ in part:
                state = next(path)
                if not pieces or pieces[-1][0] != state:
                    pieces.append((state, []))
                pieces[-1][1].append(line)
            for segment, (state, lines) in enumerate(pieces):
                opens = state != held
                text = "\n".join(lines)
                head = (TURN_END if held is not None else "") + f"<|{model.roles[state]}|>\n" if opens else ""
                ends_here = at == len(run) - 1 and segment == len(pieces) - 1 and not (final and goes_on)
                tail = "\n" + (TURN_END if ends_here else "")
                yield conversation, turn, segment, model.roles[state], opens, text, head + text + tail
                held = state
        run, first = following, False


def parse_transcripts(
    conversations: DataFrame, model: Model | None = None, partitions: int | None = None
) -> DataFrame:
    """One row per message and speaker in it: ``conv_id, turn, segment, held_out, role,
    opens, text, rendered``.

    ``conversations`` has ``conv_id, turn, role, text``; messages are read in order of
    turn, and the role is only learned from, never used to decode. ``text`` lacks speaker
    markers; ``opens`` tells where a new speaker takes over, and the ``rendered`` pieces
    of a conversation in order are its canonical transcript.

    A NULL or empty text is one empty line. Messages of equal turn are ordered by text;
    repeated rows stay. NULL turns come first; NULL conversations make one conversation.
    An empty table gives no rows; further columns are ignored. Of equally good role
    sequences the alphabetically first role counts, from the end backwards.
    """
    rows = conversations.select("conv_id", "turn", whole("text").alias("text"))
    model = model or learn(conversations)
    order = ["conv_id", "turn", "text", "tie"]
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    wide = spread.repartitionByRange(partitions, *order) if partitions else spread.repartitionByRange(*order)
    parts = settled(
        wide.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("tie")
    )

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = _peek_part(batches)
        if part is not None:
            columns = [*zip(*_ends(model, part, rows))]
            kinds = [pa.int32(), pa.int32(), conv_type, pa.list_(pa.float64()), pa.list_(pa.float64())]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "place", "conv_id", "start", "through"])

    conv_type = parts.select("conv_id").limit(0).toArrow().schema.field("conv_id").type
    turn_type = parts.select("turn").limit(0).toArrow().schema.field("turn").type
    conv, turn = parts.schema["conv_id"], parts.schema["turn"]
    kind = conv.dataType.simpleString()
    schema = f"part int, place int, conv_id {kind}, start array<double>, through array<double>"
    found = parts.mapInArrow(report, schema).toArrow()  # two rows per partition at most
    ends = [*zip(*(found.column(name).to_pylist() for name in found.column_names))]
    known = chain(ends, model)
    out = T.StructType(
        [
            conv,
            turn,
            T.StructField("segment", T.IntegerType()),
            T.StructField("role", T.StringType()),
            T.StructField("opens", T.BooleanType()),
            T.StructField("text", T.StringType()),
            T.StructField("rendered", T.StringType()),
        ]
    )
    arrow_kinds = [conv_type, turn_type, pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = _peek_part(batches)
        if part is None:
            return
        held: list[tuple] = []
        for piece in render(model, _runs(rows), known[part]):
            held.append(piece)
            if len(held) == 5000:
                yield _batch(held, out.names, arrow_kinds)
                held = []
        if held:
            yield _batch(held, out.names, arrow_kinds)

    return parts.mapInArrow(decode, out).select(
        "conv_id",
        "turn",
        "segment",
        is_held_out(F.col("conv_id")).alias("held_out"),
        "role",
        "opens",
        "text",
        "rendered",
    )


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names
    )


def _peek_part(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, Iterator[pa.RecordBatch]]:
    """The partition's number, and all its batches."""
    for batch in batches:
        if len(batch):

            def again(first: pa.RecordBatch = batch) -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            return batch.column("part")[0].as_py(), again()
    return None, iter(())
