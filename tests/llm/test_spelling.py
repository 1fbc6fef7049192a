import random
import re
import zlib
from collections import Counter

import numpy as np

import __spark_entry__ as E
from shelfline.llm import spelling as S
from tests.conftest import SF_SMALL


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(docs, min_count=5, min_length=6, one_in=199):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if c >= min_count and len(w) >= min_length}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, near = {}, {}
    for w, c in words.items():
        mine = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_edit(w, v)]
        near[w] = len(mine)
        top = min(mine, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 5 * c else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], near[w], words[form[w]] if form[w] else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = result(E.queries()["op12_spelling_variants"](spark, SF_SMALL))
    want = brute(docs)
    assert got == want and len(want) > 50


def made(seed):
    """Texts of a small alphabet, full of runs of equal letters, chains of forms and ties."""
    r = random.Random(seed)
    stems = ["".join(r.choices("aabé", k=r.randint(6, 8))) for _ in range(40)]
    words = [w for k, w in enumerate(stems) for _ in range(r.choice([5, 5, 6, 25, 130]))]
    for w in stems:
        for _ in range(4):
            k = r.randrange(len(w))
            v = r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("abÿ×") + w[k:], w[:k] + r.choice("abé") + w[k + 1:]])
            words += [v] * r.choice([1, 5, 5, 26, 130])
    r.shuffle(words)
    return [(k, " ".join(x.upper() if r.random() < 0.3 and x.isascii() else x for x in words[k::30])) for k in range(30)]


def test_made_words(spark, documents):
    docs = made(1)
    want = brute(docs)
    assert result(S.variants(documents(docs).repartition(4))) == want
    chains = sum(v[0] is not None and v[0] != v[1] for v in want.values())
    assert chains > 0 and sum(v[3] > 1 for v in want.values()) > 20


def test_edges_of_the_input(spark, documents):
    long = "xy" * 3000 + "é"
    docs = [(1, None), (2, ""), (3, "12 + 3 §"), (None, "winter wintér WINTER winter"), (4, "winter " * 9), (4, "winter " * 9), (5, " ".join([long] * 5)),
            (6, " ".join([long[1:]] * 30)), (7, "Ñandúes÷Ñandúes " * 4)]
    assert result(S.variants(documents(docs))) == brute(docs)
    got = result(S.variants(documents(docs), one_in=1))                  # every word loses a letter
    assert got == brute(docs, one_in=1)
    assert S.variants(documents([])).count() == 0


def test_nodes_are_numbered_once(spark, monkeypatch):
    words = spark.createDataFrame([(k, 5, w) for k, w in enumerate(["abcdef", "abcdeg", "zbcdef", "a" * 9])], "number long, n long, word string")
    seed = S.numbering(words)
    rows = S.nodes(words, seed).distinct().collect()
    texts = {("abcdef", "abcdeg", "zbcdef", "a" * 9)[k] for k in range(4)}
    assert len([r for r in rows if r.side == 0]) == len({w[:k] for w in texts for k in range(len(w) + 1)})
    assert len([r for r in rows if r.side == 1]) == len({w[k:] for w in texts for k in range(len(w) + 1)})
    real = S.walk
    # a seed that numbers every node alike is given up
    monkeypatch.setattr(S, "walk", lambda letters, seed: real(letters, seed) * np.int64(seed != 1))
    monkeypatch.setattr(S, "_by_word", lambda w, f, schema: spark.createDataFrame(
        [tuple(x.item() for x in y) for r in w.collect() for y in zip(*f(r.number, r.n, S._letters(r.word)))], schema))
    assert S.numbering(words, 1) == 3
