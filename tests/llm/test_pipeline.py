import hashlib

import numpy as np

import corpus_pipeline as P
from shelfline.llm import bpe
from tests.conftest import SF_SMALL
from tests.llm.test_bpe import ENC
from tests.llm.test_decontam import best, words
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_suffix import brute as brute_repeats

import __spark_entry__ as E


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_and_the_run(spark):
    """Each stage against a brute-force version on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stage, names = dict(P.STAGES), docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    scores = {r.doc_id: r.predicted for r in E.queries()["op1_quality_ranking"](spark, SF_SMALL).collect()}

    one = stage["quality classifier"](spark, docs, SF_SMALL).checkpoint()
    assert one.columns == names and set(by_id(one)) == {i for i, p in scores.items() if p}
    kept = [scores[i] for i, q in labels.items() if q == 1]
    assert np.mean(kept) > 0.97 and sum(scores[i] for i, q in labels.items() if q == 0) <= 1

    two = stage["simhash near-dedup"](spark, one, SF_SMALL).checkpoint()
    fps = {i: brute_fp(r.text) for i, r in by_id(one).items()}
    assert two.columns == names and set(by_id(two)) == set(brute_components(fps).values())
    assert by_id(two).items() <= by_id(one).items()

    three = stage["suffix-array dedup"](spark, two, SF_SMALL).checkpoint()
    want = brute_repeats(sorted((i, r.text) for i, r in by_id(two).items()))
    got = by_id(three)
    assert three.columns == names and got.keys() == want.keys()
    for i, r in got.items():
        assert r.text == want[i][3].decode("utf-8", "ignore")
        assert r.n_chars == (len(r.text) if want[i][2] else by_id(two)[i].n_chars)

    four = stage["benchmark decontamination"](spark, three, SF_SMALL).checkpoint()
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    grams = {tuple(b[k:k + 4]) for b in items for k in range(len(b) - 3)}
    bad = set()
    for i, r in got.items():
        a = words(r.text)
        if any(tuple(a[k:k + 4]) in grams for k in range(len(a) - 3)) and any(best(a, b)[0] for b in items):
            bad.add(i)
    assert four.columns == names and set(by_id(four)) == got.keys() - bad and bad

    rows = by_id(P.run(spark, SF_SMALL))
    assert rows.keys() == by_id(four).keys()
    for i, r in rows.items():
        text = by_id(four)[i].text
        ids = np.array(ENC.encode_ordinary(text), "<u4").tobytes()
        assert tuple(r) == (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.VOCABULARY == "byte_bpe_50k.tiktoken"


def test_edges_of_the_input(spark, documents):
    prose = " ".join(f"word{k % 37} and{k}" for k in range(80))
    docs = documents([(1, None), (1, None), (2, ""), (None, prose), (4, prose), (4, prose), (5, prose + " more"), (6, "é" * 300),
                      (7, "xé" + "é" * 200)])
    names = docs.columns
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == names and out.schema == docs.schema
        assert stage(spark, documents([]), SF_SMALL).count() == 0
    assert P.STAGES[-1][1](spark, docs, SF_SMALL).count() == 9
    near = P.near_duplicates(spark, docs, SF_SMALL)
    assert sorted(r.doc_id or 0 for r in near.collect()) == [1, 4, 5, 6, 7]
    cut = {r.doc_id: r.text for r in P.repeated_passages(spark, docs, SF_SMALL).collect()}
    assert cut[4] == "" and cut[2] == "" and cut[1] is None and cut[None] == prose and set(cut[6]) == {"é"} and cut[7].startswith("x")
