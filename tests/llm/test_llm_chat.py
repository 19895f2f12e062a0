"""Roles by Viterbi: against all paths, in one piece and in many, and by held-out accuracy."""

from itertools import product

import numpy as np
import pytest

from folioscope.llm import chat, queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, part int, segment string, rendered int"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "s", 2) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    return chat.learn(spark.read.parquet(f"{FOLDER}/conversations.parquet"))


def test_query_recovers_held_out_roles(spark):
    truth = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()}
    rows = queries.op1_chat(spark, FOLDER).collect()
    assert {(r.conv_id, r.turn) for r in rows} == set(truth)
    held = [r.role == truth[r.conv_id, r.turn] for r in rows if r.held_out and r.segment == 0]
    assert len(held) > 100 and np.mean(held) > 0.93


def test_decoding_is_the_best_of_all_paths(model):
    rng = np.random.default_rng(3)
    size = len(model.roles)
    for _ in range(30):
        lines = [(int(rng.integers(5)), int(rng.integers(12)), int(rng.integers(6)), bool(rng.integers(2))) for _ in range(5)]

        def score(path):
            total = model.first[path[0]] + model.emission(lines[0])[path[0]]
            for at in range(1, 5):
                total += model.step(lines[at])[path[at - 1], path[at]]
            return total

        best = max(product(range(size), repeat=5), key=score)
        assert score(tuple(model.decode(lines, None, None))) == pytest.approx(score(best))
        start, _ = model.passage(lines)
        assert start.max() == pytest.approx(score(best))


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_partitions_do_not_matter(spark, model, parts):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    one = rows.selectExpr("42L AS conv_id", "conv_id * 100 + turn AS turn", "role", "text")
    for data in (rows, one):
        def transcript(count):
            found = chat.parse_transcripts(data, model, count).orderBy("conv_id", "turn", "segment").collect()
            return [(r.conv_id, r.turn, r.segment, r.role, r.opens, r.text, r.rendered) for r in found]

        assert transcript(parts) == transcript(2)


def test_markers_decide_and_are_stripped(spark, model):
    text = "User: hi there\nAssistant: hello\nmore of it\n### System\n<|user|> and now?"
    rows = chat.parse_transcripts(frame(spark, [(1, 0, None, text)]), model).collect()
    assert [(r.segment, r.role, r.text) for r in sorted(rows, key=lambda r: r.segment)] == [
        (0, "user", "hi there"),
        (1, "assistant", "hello\nmore of it"),
        (2, "system", ""),
        (3, "user", "and now?"),
    ]
    assert "".join(r.rendered for r in sorted(rows, key=lambda r: r.segment)) == (
        "<|user|>\nhi there\n<|end|>\n<|assistant|>\nhello\nmore of it\n<|end|>\n<|system|>\n\n<|end|>\n"
        "<|user|>\nand now?\n<|end|>\n"
    )


def test_every_transcript_is_closed_once(spark, model):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    pieces: dict = {}
    for r in chat.parse_transcripts(rows, model, 9).orderBy("conv_id", "turn", "segment").collect():
        pieces.setdefault(r.conv_id, []).append(r)
    for found in pieces.values():
        whole = "".join(r.rendered for r in found)
        assert whole.endswith(chat.TURN_END)
        assert whole.count(chat.TURN_END) == sum(r.opens for r in found)
        assert found[0].opens


def test_odd_rows(spark, model):
    rows = [
        (None, None, None, None),
        (None, None, "user", ""),
        (1, 0, "USER", "x" * 100_000),
        (1, 0, "USER", "x" * 100_000),
        (1, None, None, "\n\n"),
        (2, 5, "odd role", "text"),
    ]
    found = chat.parse_transcripts(frame(spark, rows).repartition(3), partitions=3).collect()
    assert sorted((r.conv_id or 0, r.turn or 0, r.text) for r in found) == sorted(
        (i or 0, turn or 0, text or "") for i, turn, _, text in rows
    )
    assert {r.role for r in found} <= {"user", "odd role"}
    assert chat.parse_transcripts(frame(spark, [])).collect() == []
    unlabelled = [(1, 0, None, "hi"), (1, 1, None, "Bot: yes")]
    assert [r.role for r in chat.parse_transcripts(frame(spark, unlabelled)).orderBy("turn").collect()][1] == "assistant"
