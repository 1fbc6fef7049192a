import numpy as np
from zlib import crc32

import __spark_entry__ as E
from shelfline.llm import quality as Q
from tests.conftest import SF_CHECK


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in E.queries()["op1_quality_ranking"](spark, SF_CHECK).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows.values():
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [i for i in labels if rows[i].held_out]
    right = np.mean([rows[i].predicted == labels[i] for i in held])
    assert len(held) > 50 and right >= 0.95
    good, bad = ([rows[i].score for i in held if labels[i] == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_the_held_out_fold_is_never_learned_from(spark):
    docs = spark.createDataFrame([(i, "x " * i) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    turned = spark.createDataFrame([(i, 1 - i % 2 if crc32(str(i).encode()) % 4 == 2 else i % 2) for i in range(200)],
                                   "doc_id long, quality int")
    a, b = Q.train(docs, labels), Q.train(docs, turned)
    assert (a.weights == b.weights).all() and a.cut == b.cut


def test_fit_orders_the_pairs():
    r = np.random.default_rng(1)
    good = r.random(300) < 0.8
    x = r.normal(size=(300, Q.BASIC))
    x[:, 3] += 3 * good
    m = Q.fit(x, good)
    s = m.latent(x)
    assert np.mean(s[good][:, None] > s[~good][None, :]) > 0.97
    assert ((s >= 0) == good).mean() > 0.9
    # the weights are a minimum of the logistic loss of the pairs: the reversed labels reverse them
    assert np.sign(Q.fit(x, ~good).weights[3]) == -np.sign(m.weights[3])


def test_edges_of_the_input(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "good text here. And more."), (3, "good text here. And more."), (None, "no id"),
                      (5, "BAD!! " * 200_000), (7, "BAD!! BAD!!")])
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (5, 0, 0), (7, 0, 1), (7, 1, 1), (None, 1, 0), (2, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, text int")
    out = Q.score(docs, Q.train(docs, labels))
    assert out.columns == docs.columns + ["score"]
    rows = out.collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    none = Q.score(docs, Q.train(docs, labels.limit(0))).collect()
    assert all(r.score == Q.CUT for r in none)
    assert Q.score(documents([]), Q.train(documents([]), labels)).count() == 0
