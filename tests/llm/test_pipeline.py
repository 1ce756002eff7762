import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from quern.llm import bpe, mixing, quality, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, work in corpus_pipeline.STAGES:
        out.append(spark.createDataFrame((x := work(spark, out[-1], FOLDER)).collect(), x.schema))
    return out


def test_columns(stages):
    assert [s.columns for s in stages[:-1]] == [COLUMNS] * 5


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r.doc_id for r in stages[1].collect()}
    told = {r.doc_id: r.quality for r in labels.collect()}
    right = sum((i in kept) == (q == 1) for i, q in told.items())
    assert right >= 0.9 * len(told)  # a fifth of these 87 labels is held out
    model = quality.fit(stages[0], labels, "quality", corpus_pipeline.HELD_OUT)
    assert kept == {r.id for r in quality.scores(stages[0], model).collect() if r.score >= 0.3}


def test_dedup_stage(stages):
    from test_texts import plain_components, plain_fingerprint

    texts = {r.doc_id: r.text for r in stages[1].collect()}
    groups = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(groups.values()))


def test_dedup_stage_keeps_different_texts_of_one_id(spark, docs_of):
    near = "one two three four five six seven eight nine ten eleven twelve"
    other = "an unrelated text of quite different words that shares nothing with any other row here"
    rows = [(5, near), (5, other), (5, other), (7, near), (None, other), (3, "third text, found once only, of its own")]
    for parts in (1, 5):
        kept = corpus_pipeline.one_of_each_group(spark, docs_of(*rows).repartition(parts), FOLDER)
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, near), (5, other), rows[-1]])


def test_pii_stage(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[2:4])
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i] != after[i]]
    assert changed and all(any(c.isdigit() for c in before[i]) for i in changed)


def test_mixing_stage(stages):
    taken = {r.id: r.taken // r.size for r in mixing.mix(stages[3]).collect() if r.taken}
    assert Counter(r.doc_id for r in stages[4].collect()) == Counter(taken)


def test_bpe_stage(stages):
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, stages[5].collect()))


def test_stages_take_awkward_rows(spark, awkward, empty, clashing):
    for docs in (awkward, empty, clashing):
        for _, work in corpus_pipeline.STAGES[:-1]:
            out = work(spark, docs, FOLDER)
            assert out.columns == docs.columns
            assert out.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))
