"""The pipeline and its registration, against brute force per stage."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers as P
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_decontaminate import brute
from tests.llm.test_dedup import clusters, plain_fingerprint
from tillroll.llm import packing, queries
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"
    ]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    ok, said = compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLE_SQL[name], SF)
    assert ok, said


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in queries.QUERIES["op3_toxicity"](spark, SF).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    last = {t: d for d, t in sorted(rows)}
    rows = sorted((d, t) for t, d in last.items())
    member = clusters([plain_fingerprint(t) for _, t in rows], 3)
    rows = [r for i, r in enumerate(rows) if member.index(member[i]) == i]
    leaks = {d for d, *_ in brute(rows, items)}
    rows = [r for r in rows if r[0] not in leaks]
    bpe = packing.encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {d: bpe.encode_ordinary(t) for d, t in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id for r in docs.collect()} == set(got)


def test_awkward_rows_pass_through(spark, docs, empty, labels, benchmark, tmp_path):
    for part in (docs, empty):
        root = tmp_path / ("rows" if part is docs else "none")
        for name, df in (("documents", part), ("labels", labels), ("benchmark", benchmark)):
            df.write.parquet(str(root / f"{name}.parquet"))
        out = corpus_pipeline.run(spark, str(root)).collect()
        assert bool(out) == (part is docs)
