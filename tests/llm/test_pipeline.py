"""The corpus pipeline, stage by stage, against brute force."""

import re

import corpus_pipeline
from terrapanel.llm.common import documents, materialise
from tests.conftest import SF001
from tests.llm import brute, fixtures
from tests.llm.test_text_ops import check_packing


def test_stages(spark):
    docs = documents(spark, SF001)
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, SF001))
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in seen[name][1])
    before, after = seen["language"]
    assert {r.doc_id for r in after} == {i for i, r in before.items() if any(c.isalpha() for c in r.text)}
    before, after = seen["near_duplicates"]
    expected = brute.components([(i, r.text) for i, r in before.items()])
    assert {r.doc_id for r in after} == {i for i, (_, c) in expected.items() if c == i}
    assert all(before[r.doc_id] == r for r in after)
    before, after = seen["substring_dedup"]
    rows = [(i, r.text) for i, r in before.items()]
    masks = {i: m for (i, _), m in zip(rows, brute.removed_mask(rows), strict=True)}
    assert {r.doc_id for r in after} == set(before)
    for r in after:
        w, gone = masks[r.doc_id]
        assert brute.words(r.text) == [x for x, g in zip(w, gone, strict=True) if not g]
        assert any(gone) or r.text == before[r.doc_id].text
    before, after = seen["personal_data"]
    assert {r.doc_id for r in after} == set(before)
    for r in after:
        spans = brute.base_spans(before[r.doc_id].text)
        assert spans or r.text == before[r.doc_id].text
        assert not spans or re.search("<(EMAIL|IP|CARD|PHONE)>", r.text)
        assert not any(before[r.doc_id].text[a:b] in r.text for k, a, b in spans if k in ("email", "card"))
    before, after = seen["packing"]
    assert {r.doc_id for r in after} == set(before)
    assert check_packing(after, 2048) <= 1.02 * brute.best_fit_decreasing([r.length for r in after], 2048) + 1


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substring_dedup", "personal_data", "packing"]


def test_awkward_rows_pass_every_stage(spark):
    for docs in (fixtures.awkward(spark), fixtures.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SF001))
        docs.collect()


def test_arrow_batches_are_short(spark):
    """Workers get at most ARROW_BATCH_ROWS rows at a time; a lower bound of the session stays."""
    from terrapanel.llm.common import ARROW_BATCH_ROWS, map_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def lengths(frames):
        for frame in frames:
            yield frame.head(1).assign(id=len(frame))

    try:
        spark.conf.set(name, "10000")
        rows = spark.range(0, 3 * ARROW_BATCH_ROWS, 1, 1)
        assert [r.id for r in map_batches(rows, lengths, "id long").collect()] == [ARROW_BATCH_ROWS] * 3
        spark.conf.set(name, "100")
        assert {r.id for r in map_batches(rows, lengths, "id long").collect()} == {100}
    finally:
        spark.conf.set(name, before)
