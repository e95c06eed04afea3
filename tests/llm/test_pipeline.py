import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_near_duplicates import by_force as groups_by_force
from test_repeats import passages_by_force

import corpus_pipeline
from paylode.llm import bpe, mixing, toxicity
from paylode.llm.common import table
from paylode.session import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "byte_level_bpe"]
    assert all(s.dtypes == stages[0].dtypes for s in stages[1:-1])


def test_toxic_documents_go(spark, stages):
    labels = table(spark, SF, "labels").where(~toxicity.held_out())
    scores = toxicity.score(stages[0], toxicity.train(stages[0], labels)).collect()
    assert sorted(i for i, _ in rows(stages[1])) == sorted(r.doc_id for r in scores if not r.predicted)


def test_one_of_each_group_of_near_copies_stays(stages):
    _, lowest = groups_by_force(rows(stages[1]), 80)
    assert sorted(i for i, _ in rows(stages[2])) == sorted(set(lowest.values()))


def test_passages_of_over_fifty_words_are_cut(stages):
    """Whatever repeats over 51 words goes, and nothing else."""
    before, after = rows(stages[2]), rows(stages[3])
    assert sorted(after, key=str) == passages_by_force(before, 51)
    assert sum(dict(after)[doc] != text for doc, text in before) > 5


def test_sources_are_mixed(stages):
    copies = {r.doc_id: r.copies for r in mixing.draws(stages[3]).collect() if r.size}
    counts = {}
    for doc, _ in rows(stages[4]):
        counts[doc] = counts.get(doc, 0) + 1
    assert counts == {doc: n for doc, n in copies.items() if n}


def test_tokens_are_those_of_the_texts(stages):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = dict(rows(stages[4]))
    found = stages[5].collect()
    assert len(found) == stages[4].count()
    for r in found:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == own.encode_ordinary(texts[r.doc_id] or "") and r.round_trip


def test_run_is_the_stages_one_after_another(spark, stages):
    key = lambda r: (r.doc_id, r.source, r.n_tokens, bytes(r.ids))
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[-1].collect()))
