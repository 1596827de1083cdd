"""The pipeline: its stages, one after another and against the operators' brute-force versions."""

import os
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))
import corpus_pipeline  # noqa: E402
from odd_rows import no_documents, odd_documents  # noqa: E402
from test_pii import plain_spans  # noqa: E402
from test_simhash import plain_components, plain_fingerprint  # noqa: E402

from tidesync.llm import bpe, quality  # noqa: E402
from tidesync.llm.common import land  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["good_quality", "near_duplicates", "without_personal_data", "mixed", "tokens"]
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(land(stage(spark, steps[-1], SF), name))
    assert all(s.columns == docs.columns for s in steps[:5])
    raw, good, apart, clean, mixed = [s.collect() for s in steps[:5]]
    model = quality.learned(spark, docs, SF)
    assert {r.doc_id for r in good} == {r.doc_id for r in raw if model.score(r.text) >= quality.THRESHOLD}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in good}
    group, least = plain_components(prints.values()), {}
    for i, p in prints.items():
        least[group[p]] = min(least.get(group[p], i), i)
    assert sorted(r.doc_id for r in apart) == sorted(least.values())
    texts = {r.doc_id: r.text for r in apart}
    assert sorted(r.doc_id for r in clean) == sorted(texts)
    for r in clean:
        assert (r.text != texts[r.doc_id]) == bool(plain_spans(texts[r.doc_id])) and not plain_spans(r.text)
        assert r.n_chars == len(r.text)
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= {r.doc_id for r in clean} and max(times.values()) <= 3
    assert sorted(r.doc_id for r in steps[5].collect()) == sorted(r.doc_id for r in mixed)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, steps[5].collect()))


def test_stages_take_odd_and_no_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = land(stage(spark, docs, SF), name)
            assert out.count() <= 3 * max(1, docs.count())
            if name != "tokens":
                assert out.columns == docs.columns
    assert bpe.digests(no_documents(spark), *bpe.byte_vocabulary()).columns[0] == "doc_id"
