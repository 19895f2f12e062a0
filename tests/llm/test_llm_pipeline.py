"""The pipeline, stage by stage, against brute force on a small folder of tables."""

import odd
import tiktoken
import numpy as np
import public_tokenizers
import pytest
from test_llm_decontaminate import planted, prose  # noqa: F401
from test_llm_simhash import plain_components

import corpus_pipeline
from folioscope.llm import bpe

HEX = "0123456789abcdef0123456789abcdef"


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("tables"))
    items, rows, leaks = planted(prose)
    rows += [(500 + k, rows[k][1], "en", "copy") for k in range(5)]  # exact copies
    rows += [(600, None, "en", "s"), (601, "12 34 !", "en", "s"), (602, rows[7][1] + f" token={HEX}", "en", "s")]
    odd.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    bench = [(at, " ".join(item)) for at, item in enumerate(items)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, {doc for doc, _ in leaks}


def test_stages(spark, folder, tmp_path):
    path, rows, leaks = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, texts = docs.columns, {i: text for i, text, _, _ in rows}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "secrets", "tokens"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        assert docs.columns == (columns if name != "tokens" else ["doc_id", "n_tokens", "ids"])

    spoken = {i for i in texts if i not in (600, 601)}
    assert {r.doc_id for r in seen["language"]} == spoken
    left = [(i, texts[i]) for i in sorted(spoken)]
    single = {component for _, _, component in plain_components(left)}
    assert {r.doc_id for r in seen["near_duplicates"]} == single
    assert not any(500 <= i < 505 for i in single)
    clean = single - leaks
    assert {r.doc_id for r in seen["decontamination"]} == clean
    changed = {i: text.replace(f"token={HEX}", "[secret]") for i, text in texts.items() if i in clean}
    assert {r.doc_id: r.text for r in seen["secrets"]} == changed
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in seen["tokens"]}
    assert tokens == {i: library.encode_ordinary(text) for i, text in changed.items()}


def test_run_gives_the_last_stage(spark, folder):
    path, _, _ = folder
    rows = corpus_pipeline.run(spark, path)
    assert rows.columns == ["doc_id", "n_tokens", "ids"]
    assert rows.count() > 50


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    odd.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
