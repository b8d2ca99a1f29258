"""The corpus pipeline, stage by stage, against what its operators must leave."""

import zlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from netvigil.llm import pu_toxicity, quality_gam
from netvigil.llm.chunks import load_tokenizer
from netvigil.llm.common import ARROW_BYTES, read_table, small_batches
from tests.llm.test_joins import brute_force

SF_DIR = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    docs = read_table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r for r in read_table(spark, SF_DIR, "labels").collect()}
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        assert docs.columns == columns
        left.append({r.doc_id: r.text for r in docs.collect()})
    quality, toxicity, exact, near = left

    judged = [d for d in labels if zlib.crc32(str(d).encode()) % quality_gam.MODULUS == quality_gam.REMAINDER]
    assert np.mean([(d in quality) == bool(labels[d].quality) for d in judged]) > 0.97
    judged = [d for d in labels if zlib.crc32(str(d).encode()) % pu_toxicity.MODULUS == pu_toxicity.REMAINDER and d in quality]
    assert np.mean([(d in toxicity) != bool(labels[d].toxic) for d in judged]) > 0.9  # about 40 toxic texts to learn from

    largest = {}
    for doc_id, text in toxicity.items():
        largest[text] = max(doc_id, largest.get(text, -1))
    assert exact.keys() == set(largest.values())
    assert near.keys() == {i for i, _, c in brute_force(list(exact.items())) if i == c}

    got = corpus_pipeline.packed(spark, docs, SF_DIR).collect()
    tokenizer = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in near.items()}
    sums = {}
    for r in got:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert sums == want


def test_whole_run_and_empty_documents(spark, tmp_path):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    for name in ("documents", "labels"):
        read_table(spark, SF_DIR, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_on_held_out_labels(spark):
    docs, labels = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels")
    model = pu_toxicity.train(docs, labels)
    scores = {r.doc_id: r.score for r in pu_toxicity.score(docs, model).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[d] >= 0.5) == bool(t) for d, t in known.items()]) > 0.9


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"plain words number {i}", 0) for i in range(200)] + [(300 + i, f"plain vile{i} words", 1) for i in range(60)]
    rows += [(None, "vile99", 1), (900, None, 0), (901, "", 0), (902, "vile " * 50_000, 1), (902, "vile " * 50_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i is not None and i >= 300 and i < 900)) for i, _, _ in rows] + [(5, None)],
                                   "doc_id long, toxic int")
    model = pu_toxicity.train(docs, labels)
    got = {(r.doc_id, r.score) for r in pu_toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) - 1
    empty, = {s for d, s in got if d == 901}
    assert {s for d, s in got if d == 900} == {empty}
    assert min(s for d, s in got if d in range(300, 360)) > 0.5 > max(s for d, s in got if d in range(200))
    assert pu_toxicity.not_toxic(docs, model).columns == docs.columns
    none = pu_toxicity.train(docs, labels.where("toxic = 0"))
    assert max(r.score for r in pu_toxicity.score(docs, none).collect()) < 1e-9
    assert pu_toxicity.score(docs.limit(0), model).count() == 0


def test_risk_never_learns_unlabelled_toxic_by_heart():
    """Half of the unlabelled texts are toxic; with the right prior the model still finds them."""
    model = pu_toxicity.fit([[0]] * 200 + [[1]] * 100, np.array([True] * 100 + [False] * 200), ["bad", "good"], prior=0.5)
    assert model.score("bad") > 0.5 > model.score("good")


def batch_bytes(docs):
    """The bytes of the Arrow batches in which the rows reach Python, largest first."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    return sorted((r["bytes"] for r in docs.mapInArrow(run, "bytes long").collect()), reverse=True)


@pytest.mark.parametrize("name", ["quality", "toxicity", "near_dedup", "packing"])
def test_long_texts_reach_python_in_small_batches(spark, name, tmp_path):
    own = spark.newSession()  # without settings of other tests
    own.range(4).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "cast(id % 2 AS int) AS toxic").write.parquet(
        f"{tmp_path}/labels.parquet")
    few = own.range(4).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text")
    dict(corpus_pipeline.STAGES)[name](own, few, str(tmp_path))
    long_texts = own.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('a long text of words ', 500) AS text")
    found = batch_bytes(long_texts)
    assert sum(found) > 20_000_000 and found[0] < 6_000_000


def test_a_limit_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(ARROW_BYTES, "1m")
    small_batches(own)
    assert own.conf.get(ARROW_BYTES) == "1m"
