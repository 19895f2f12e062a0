"""Repairs against a plain search over all edits, whole tables and odd ones."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from folioscope.llm import queries, repair

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, at long, part int, digest string"
WHITE = " \t\n\x0b\x0c\r"


def harmed(rows):
    """By conversation, the damaged rows in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # conversations without rows count
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for found in out.values():
        # Ties of turn are ordered by role and digest, which the contract leaves open.
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.strip(WHITE)[-1:]
        if not end:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif end not in ".!?":
            out.append("truncated")
        else:
            out.append(None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """``cost, audit, lines`` by going through the messages with all ways that are least
    for the state reached."""
    turns = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def add(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def spread(ways):
        for _ in range(3):
            for state, (cost, audit, lines) in list(ways.items()):
                add(ways, turns[state], (cost + 2, audit + "I", [*lines, f"{names[turns[state]]}:"]))
        return ways

    ways = spread({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in ways.items():
            add(after, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            to = turns[state]
            add(after, to, (more + 2, audit + "R", [*lines, f"{names[to]}:{text}"]))
            initial = role[:1]
            if (initial == "s" and state == "") or (initial in ("u", "a") and initial == to):
                add(after, initial, (more, audit + "K", [*lines, f"{role}:{text}"]))
        ways = spread(after)
    return min(ways[state] for state in ("", "a") if state in ways)


def expected(rows):
    out = {}
    for conv, found in harmed(rows).items():
        faults = faults_of(found)
        known = [turn for turn, _, _ in found if turn is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [role[:1] for _, role, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(found, faults)
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def told(frame):
    rows = frame.collect()
    assert len(rows) == len({row.conv_id for row in rows})
    return {row.conv_id: tuple(row[name] for name in NAMES) for row in rows}


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.1"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.op13_repair(spark, folder)) == expected(rows)


def random_rows(seed, sizes):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "What?", "well", "so it goes", "", " \t ", "A longer answer.\nThat ends.", "Yes. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]
    return [
        (conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice([*texts, None, f"Number {turn}.", f"open {turn}"]))
        for conv, size in enumerate(sizes)
        for turn in range(size)
    ]


def run_on(spark, tmp_path, rows, **options):
    data = [(*row, 1, 2, "x") for row in rows]
    spark.createDataFrame(data, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    return told(queries.op13_repair(spark, str(tmp_path)))


def test_odd_conversations(spark, tmp_path):
    rows = random_rows(1, [1, 2, 3, 5, 8, 13, 30, 2, 4, 4, 4, 9, 40] * 5)
    rows += [(None, 3, "user", "Hm."), (None, None, "assistant", "Yes."), (None, None, None, None)]
    rows += [(900, None, "user", "x.")] * 7 + [(901, 5, "assistant", "long " * 30_000 + ".")]
    assert run_on(spark, tmp_path, rows) == expected(rows)


def test_conversations_across_partitions(spark):
    """A conversation that holds most rows, cut into pieces and partitions."""
    rows = random_rows(2, [7, 3000, 2, 1500, 5, 9])
    frame = spark.createDataFrame([(*row, 1, 2, "x") for row in rows], SCHEMA)
    fixed = repair.repair(repair.damaged(frame), partitions=13)
    assert sum(join.from_before for join in fixed.joins.values()) >= 8
    found = {r.conv_id: tuple(r[n] for n in NAMES[1:]) for r in repair.summaries(fixed).collect()}
    assert found == {conv: row[1:] for conv, row in expected(rows).items()}
    # The repaired messages are the operator's output; they have the form.
    kept = defaultdict(list)
    for row in fixed.rows().filter("edit <> 'D'").orderBy("part", "place").collect():
        kept[row.conv_id].append(row.role[:1])
    for roles in kept.values():
        shape = "".join(roles).removeprefix("s")
        assert shape == "ua" * (len(shape) // 2)


def test_partitions_between_two_conversations(spark):
    """Partitions that begin within one conversation and end within the next."""
    rows = random_rows(4, [30] * 40)
    frame = spark.createDataFrame([(*row, 1, 2, "x") for row in rows], SCHEMA)
    fixed = repair.repair(repair.damaged(frame), partitions=31)
    assert sum(join.from_before and join.goes_on for join in fixed.joins.values()) >= 10
    found = {r.conv_id: tuple(r[n] for n in NAMES[1:]) for r in repair.summaries(fixed).collect()}
    assert found == {conv: row[1:] for conv, row in expected(rows).items()}


def test_grammar_decides_nothing(spark):
    rng = random.Random(3)
    sequences = ["".join(rng.choices("\0\1\2\3\4\5\6\7\x08", k=n)).encode() for n in (1, 2, 5, 40, 700, 1300)] * 3
    sequences.append(bytes([3, 5]) * 800)
    pieces = [(bytearray(piece), 2) for s in sequences for piece in repair.pieces_of(s)]
    grammar = repair.learn_grammar(spark.createDataFrame(pieces, "symbols binary, n long"))
    assert len(grammar.rules) > 50
    plain, shared = repair.Solver(repair.Grammar()), repair.Solver(grammar)
    for sequence in sequences:
        assert len(grammar.compress(sequence)) <= len(sequence)
        for entry in range(repair.STATES):
            assert plain.solve(sequence, entry, repair.CLOSING) == shared.solve(sequence, entry, repair.CLOSING)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    fixed = repair.repair(frame)
    assert fixed.rows().count() == 0 and repair.summaries(fixed).count() == 0
