import pytest

import __spark_entry__ as e
from quire.llm.mixing import water_fill

DATA = "/root/testdata/sf0.01"


def test_capped_sources_leave_their_lack_to_the_others():
    assert water_fill([0.5, 0.25, 0.25], [10, 100, 100], 100) == pytest.approx([10, 45, 45])
    assert water_fill([0.5, 0.5], [10, 20], 100) == [10, 20]
    assert water_fill([0.5, 0.5], [0, 200], 100) == pytest.approx([0, 100])


def test_shares_reached_over_all_documents(spark):
    counted, longest = {}, 0
    for r in e.queries()["p7_ids"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source"), "doc_id").collect():
        counted[r.source] = counted.get(r.source, 0) + len(r.ids)
        longest = max(longest, len(r.ids))
    rows = e.queries()["p8_shares"](spark, DATA).collect()
    targets = {r.source: r for r in spark.read.parquet(f"{DATA}/source_targets.parquet").collect()}
    assert {r.source: r.n_tokens for r in rows} == {s: counted.get(s, 0) for s in targets} and len(rows) == len(targets)
    want = dict(zip(targets, water_fill([t.target_share for t in targets.values()], [counted.get(s, 0) * t.max_repeats for s, t in targets.items()], sum(counted.get(s, 0) for s in targets))))
    for r in rows:
        assert r.used_tokens <= r.n_tokens * r.max_repeats
        assert abs(r.used_tokens - want[r.source]) <= longest / 2  # whole documents are used
    assert sum(r.share for r in rows) == pytest.approx(1)


def test_no_document_is_used_too_often(spark):
    limit = {r.source: r.max_repeats for r in spark.read.parquet(f"{DATA}/source_targets.parquet").collect()}
    rows = e.queries()["p8_mix"](spark, DATA).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 0
    assert all(0 <= r.repeats <= limit[r.source] for r in rows)
