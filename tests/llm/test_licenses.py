import random
import re

import numpy as np
import pytest

import __spark_entry__ as E
from shelfline.llm import licenses as L
from tests.conftest import SF_SMALL

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    """(places, labels) of the phrases."""
    w, at, labels = words(text), [], set()
    for label, phrase in PHRASES.items():
        p = phrase.split()
        mine = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        at += mine
        labels |= {label} if mine else set()
    return at, labels


def fewest_edits(pattern, span):
    """Plain table: the pattern against any stretch of the span."""
    row = [0] * (len(span) + 1)
    for i, x in enumerate(pattern):
        new = [i + 1]
        for j, y in enumerate(span):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(text):
    w = words(text)
    at, labels = base(text)
    named, score = set(labels), 1.0 if at else 0.0
    for t in L.NOTICES:
        p = words(t.text)
        e = fewest_edits(p, w)
        if e <= int(0.2 * len(p)):
            named.add(t.label)
            score = max(score, 1 - e / len(p))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(named)), score)


def check(rows, docs):
    want = {i: brute(t) for i, t in docs}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in rows}
    assert got == {i: v[:6] for i, v in want.items()} and len(rows) == len(docs)
    assert all(abs(r.score - want[r.doc_id][6]) < 1e-9 for r in rows)
    return want


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = check(E.queries()["op11_license_scan"](spark, SF_SMALL).collect(), docs)
    assert len({v[5] for v in want.values()}) > 3


def scanned(spark, tmp_path, docs):
    spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, scan string, id string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return E.queries()["op11_license_scan"](spark, str(tmp_path)).collect()


def test_edited_notices(spark, tmp_path):
    """Words replaced, inserted and left out, up to the limit and one beyond."""
    r, docs = random.Random(5), []
    filler = lambda n: " ".join(f"{r.choice('abcdefg')}{r.randrange(10**6)}" for _ in range(n))
    for t in L.NOTICES:
        p = words(t.text)
        for e in (0, 1, int(0.2 * len(p)), int(0.2 * len(p)) + 1):
            for _ in range(3):
                w = list(p)
                for k in sorted(r.sample(range(1, len(w) - 1), e), reverse=True):
                    w[k:k + 1] = r.choice([[], ["zz"], [w[k], "yy"]])
                docs.append((len(docs), f"{filler(9)} {' '.join(w)} {filler(5)}"))
    docs.append((len(docs), f"cc by nc, {L.NOTICES[0].text}! {filler(700)} {L.NOTICES[0].text} CC-BY-NC under the\nMIT license."))
    want = check(scanned(spark, tmp_path, docs), docs)
    assert sum(v[5] != "" for v in want.values()) >= len(L.NOTICES) * 9


def test_edges_of_the_input(spark, tmp_path):
    far = "é " * 300_000 + "Under the MIT license"
    docs = [(1, None), (2, ""), (3, "under the mit"), (4, "cc by nc cc by nc by nc CC-BY-NC"), (5, far), (6, "UNDER.THE/MIT+LICENSEé under the mit license"),
            (7, "under the mit"), (8, "license apache license version 2.0 2"), (9, "\x00 \x7f ++")]
    check(scanned(spark, tmp_path, docs), docs)
    rows = L.scan(spark.createDataFrame([(None, "cc by nc", "x", 1), (4, "cc by nc", "x", 2), (4, "cc by nc", "x", 2), (None, "cc by", None, 3)],
                                        "doc_id long, text string, scan_id string, tag int")).collect()
    assert sorted(len(r.scan.spans) for r in rows) == [0, 1, 1, 1] and "scan_id" in rows[0].asDict()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(empty).count() == 0


def test_alignment():
    r = random.Random(2)
    for _ in range(300):
        p = r.choices([b"a", b"b", b"c"], k=r.randint(1, 9))
        s = r.choices([b"a", b"b", b"c", b"d"], k=r.randint(0, 14))
        assert L.best_alignment(p, s)[0] == fewest_edits(p, s)


def test_words_end_with_their_text():
    data = np.frombuffer(b"ab cd" + b"ef" + b"" + b" g", np.uint8)
    low, starts, ends, first = L.word_places(data, np.array([0, 5, 7, 7, 9]))
    assert [low[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"cd", b"ef", b"g"] and first.tolist() == [0, 2, 3, 3, 4]


def test_templates_are_checked(spark):
    with pytest.raises(ValueError):
        L._template_table(spark, [L.Template("x", "one two", True)], 3)
