"""A task of the BPE query encodes and decodes in one Python worker."""

from __future__ import annotations

import public_tokenizers

from nimbra.llm import op3_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_one_worker_does_what_two_did(spark, hard, tmp_path):
    hard.write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_bpe.query(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    args = (RANKS, public_tokenizers.PATTERN)
    rows = lambda df: sorted((str(r["id"]), r["ids"], bytes(r["bytes"])) for r in df.collect())
    assert rows(op3_bpe.encode_and_decode(hard, *args)) == rows(op3_bpe.decode(op3_bpe.encode(hard, *args), *args))
    assert got.count() == hard.count()
