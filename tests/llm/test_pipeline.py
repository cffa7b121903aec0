"""The corpus pipeline: stages on what their predecessors kept, against brute force where that is possible."""

from __future__ import annotations

import hashlib

import corpus_pipeline as pipeline
from docsync.llm import mixing, queries
from tests.conftest import DATA
from tests.llm.test_operators import ODD, brute_components, documents


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_dedup", "source_mix", "bpe"]

    known = stages["language_id"](spark, docs, DATA)
    assert known.schema == docs.schema
    lettered = [r for r in rows if any(c.isalpha() for c in r.text)]
    assert sorted(r.doc_id for r in known.collect()) == sorted(r.doc_id for r in lettered)

    single = stages["exact_dedup"](spark, known, DATA)
    last = {r.text: r for r in sorted(lettered, key=lambda r: r.doc_id)}
    assert sorted(r.doc_id for r in single.collect()) == sorted(r.doc_id for r in last.values())

    near = stages["minhash_dedup"](spark, single, DATA)
    kept = sorted(last.values(), key=lambda r: r.doc_id)
    _, component = brute_components([r.text for r in kept], 80)
    firsts = [r for i, r in enumerate(kept) if component[i] == i]
    assert sorted(r.doc_id for r in near.collect()) == [r.doc_id for r in firsts]

    mixed = stages["source_mix"](spark, near, DATA)
    copies = {r.doc_id: r.copies for r in mixing.mixing_plan(near).collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))

    ids = {r.doc_id: r.text for r in firsts}
    coded = stages["bpe"](spark, mixed, DATA).collect()
    assert len(coded) == sum(copies.values())
    assert all(r.decoded_sha256 == hashlib.sha256(ids[r.doc_id].encode()).hexdigest() for r in coded)
    assert sorted(map(tuple, pipeline.run(spark, DATA).collect())) == sorted(map(tuple, coded))


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (documents(spark, ODD), documents(spark, ODD).filter("doc_id < 0")):
        plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, plain, DATA)
            assert out.columns == plain.columns, name
            plain = out
        assert pipeline.STAGES[-1][1](spark, plain, DATA).count() == plain.count()


def test_registered():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and set(queries.queries()) <= set(entry.queries())
    assert sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()) == 13
