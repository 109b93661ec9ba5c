import re

import __spark_entry__ as E

SHARED = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in E.queries()) if m)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stages_take_and_return_documents(spark):
    import corpus_pipeline as P
    from tokenmill.llm import tables as T
    from tests.llm.brute import near_components

    docs = T.read(spark, SHARED, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        rows = docs.collect()
        docs = T.store(stage(spark, docs, SHARED), name)
        seen[name] = (rows, docs.collect())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = seen["language_id"]
    kept = {r.doc_id for r in after}
    assert all(r.doc_id in kept for r in before if any(c.isalpha() for c in r.text or "") and len(r.text) > 60)
    before, after = seen["exact_dedup"]
    last = {}
    for r in before:
        last[r.text] = max(last.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(last.values())
    before, after = seen["jaccard_join"]
    want = near_components([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c) in want.items() if c == i)
    before, after = seen["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = seen["sentencepiece"]
    assert len(before) == len(after) and all(r.exact for r in after)
