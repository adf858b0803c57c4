"""The pipeline's stages, each judged on its own input."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import queries as Q
from strata.llm.common import stored, table
from tests.conftest import SMOKE_SF

from .conftest import EDGE_ROWS
from .test_documents import (
    components_by_hand,
    fingerprint_by_hand,
    lines_by_hand,
    phrases_by_hand,
    tokens_by_hand,
)


def test_stages_against_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    docs = table(spark, SMOKE_SF, "documents")
    columns = docs.columns
    kept_ids = {r.doc_id for r in Q.op8_quality_rules(spark, SMOKE_SF).where("kept").collect()}
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SMOKE_SF), f"test-{name}"))
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames[:-1]]
    assert all(f.columns == columns for f in frames[:-1])

    assert texts[1] == {i: t for i, t in texts[0].items() if i in kept_ids}
    gone = lines_by_hand(texts[1].items())
    assert texts[2] == {
        i: "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in gone) for i, t in texts[1].items()
    }
    groups = components_by_hand({i: fingerprint_by_hand(t) for i, t in texts[2].items()})
    assert texts[3] == {i: t for i, t in texts[2].items() if groups[i] == i}
    items = [(r.item_id, r.text) for r in table(spark, SMOKE_SF, "benchmark").collect()]
    bad = {x[0] for x in phrases_by_hand(texts[3].items(), items) if x[-1]}
    assert texts[4] == {i: t for i, t in texts[3].items() if i not in bad}
    out = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in frames[5].collect()}
    assert out == dict(zip(texts[4], tokens_by_hand(texts[4].values()), strict=True))
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SMOKE_SF).collect()}
    assert whole == {i: x[1] for i, x in out.items()}


def test_stages_on_edge_cases(spark, edge, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMOKE_SF).count() == 0
        assert stage(spark, edge, SMOKE_SF).count() <= len(EDGE_ROWS)
