import itertools
import random
import re
import unicodedata

import numpy as np

import __spark_entry__ as E
from shelfline.llm import decontam as D
from tests.conftest import SF_SMALL


def words(t):
    return [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())]


def best(a, b, need=13, share=0.8):
    """Longest good stretch over all alignments, by trying every pair of ends."""
    need, out = min(need, len(b)), (0, 0)
    for shift in range(-len(b) + 1, len(a)):
        k0, k1 = max(0, -shift), min(len(b), len(a) - shift)
        same = [a[k + shift] == b[k] for k in range(k0, k1)]
        tot = np.concatenate(([0], np.cumsum(same)))
        for i, j in itertools.combinations_with_replacement([k for k, s in enumerate(same) if s], 2):
            n, e = j - i + 1, int(tot[j + 1] - tot[i])
            if n >= need and e >= share * n - 1e-9:
                out = max(out, (n, e))
    return out


def test_masks_tolerate_two_substitutions():
    for c in itertools.combinations(range(13), 2):
        assert any(all(not (0 <= x - o < D.SPAN) or m[x - o] == "0" for x in c) for m in D.MASKS for o in range(13 - D.SPAN + 1))


def test_query_matches_brute_force(spark):
    rows = E.queries()["op8_spaced_seed_decontam"](spark, SF_SMALL).collect()
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    want = set()
    for i, a in docs.items():
        grams = {tuple(a[k:k + 4]) for k in range(len(a) - 3)}
        for j, b in items.items():
            # 13 tokens with at most two substitutions hold four in a row that are equal
            if any(tuple(b[k:k + 4]) in grams for k in range(len(b) - 3)):
                got = best(a, b)
                if got[0]:
                    want.add((i, j, *got, len(b)))
    assert {tuple(r) for r in rows} == want and want


def test_substituted_passages(spark, documents):
    r = random.Random(2)
    vocab = [f"tok{k}é" for k in range(5000)]
    item = r.sample(vocab, 40)
    prose = lambda n: r.choices(vocab[2500:], k=n)
    docs, want = [], set()
    for i in range(60):
        n = r.randint(13, 40)
        part = item[:n]
        for k in r.sample(range(1, n - 1), 2 if i % 2 else 0):
            part[k] = "other"
        docs.append((i, " ".join(prose(30) + part + prose(30)).upper().replace("É", "é")))
        want.add(i)
    docs += [(100 + i, " ".join(prose(200))) for i in range(20)] + [(200, " ".join(item[:12])), (201, " ".join(item[::2]))]
    test = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (None, None), (3, ""), (None, " ".join(item[5:30]))],
                                 "item_id long, text string")
    got = D.contaminated(documents(docs), test).collect()
    assert {x.row_id for x in got if x.item == 1} == want
    assert {x.row_id for x in got} <= want
    by = {x.row_id: x for x in got if x.item == 1}
    for i, t in docs:
        if i in want:
            assert (by[i].n_tokens, by[i].n_equal) == best(words(t), words(" ".join(item)))


def test_edges_of_the_input(spark, documents):
    item = " ".join(f"w{k}" for k in range(20))
    long = " ".join(f"v{k}" for k in range(300_000))
    docs = documents([(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, long + " " + item + " " + long), (5, "w0 w1 w2"),
                      (6, "short one"), (7, "w" * 100_000)])
    test = spark.createDataFrame([(1, item, 5), (2, "Short, one!", 6)], "item_id long, text string, key int")
    got = {(r.row_id, r.item, r.n_tokens, r.n_item) for r in D.contaminated(docs, test).collect()}
    assert got == {(3, 1, 20, 20), (None, 1, 20, 20), (4, 1, 20, 20), (6, 2, 2, 2)}
    kept = D.without_contaminated(docs, test)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 7]
    assert D.contaminated(documents([]), test).count() == 0
    assert D.contaminated(docs, test.limit(0)).count() == 0 and D.without_contaminated(docs, test.limit(0)).count() == docs.count()


def test_masks_find_every_good_stretch():
    """Every way to substitute a fifth of 11 to 29 tokens (the ends equal) leaves some mask a place."""
    masks = [sum(1 << i for i, c in enumerate(m) if c == "1") for m in D.MASKS]
    for n in range(11, 30):
        gone = np.array([sum(1 << x for x in c) for c in itertools.combinations(range(1, n - 1), n // 5)])
        found = np.zeros(len(gone), bool)
        for m in masks:
            for o in range(n - D.SPAN + 1):
                found |= gone >> o & m == 0
        assert found.all()


def test_three_substitutions_in_fifteen(spark, documents):
    item = [f"w{k}" for k in range(15)]
    part = [w if k not in (3, 7, 11) else "other" for k, w in enumerate(item)]
    test = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = D.contaminated(documents([(7, "a b c " + " ".join(part) + " d e f")]), test).collect()
    assert [(r.row_id, r.n_tokens, r.n_equal) for r in got] == [(7, 15, 12)]


def test_letter_case_and_punctuation_of_unicode(spark, documents):
    item = "déjà vu à l été où naïve Größe señor über çà fête château forêt élève"
    test = spark.createDataFrame([(1, item)], "item_id long, text string")
    apart = "\u201c" + item.replace(" ", "\u00a0\u2014") + "\u201d"
    forms = [item.upper(), apart, unicodedata.normalize("NFD", item), "x " + item.title() + "\u2026 y", "nothing of this kind"]
    got = D.contaminated(documents(list(enumerate(forms))), test).collect()
    assert {(r.row_id, r.n_tokens, r.n_equal) for r in got} == {(k, 15, 15) for k in range(4)}


def test_copies_of_a_text_are_verified_once(spark, monkeypatch):
    item = " ".join(f"item{i}" for i in range(20))
    hot = "before it all " + item + " after it all"
    rows = [(i, hot) for i in range(90)] + [(90, None), (91, hot + " and more"), (None, hot)] + [(100 + i, f"plain text number {i} of many") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    test = spark.createDataFrame([(1, item), (2, item), (3, "nothing of the kind is in there " * 3)], "item_id long, text string")
    seen = {}

    def keep(df, label):
        seen[label] = stored(df, label)
        return seen[label]
    stored = D.stored
    monkeypatch.setattr(D, "stored", keep)
    got = {(r.row_id, r.item): r for r in D.contaminated(docs, test).collect()}
    assert set(got) == {(i, k) for i in [*range(90), 91, None] for k in (1, 2)}
    assert {(r.n_tokens, r.n_equal) for r in got.values()} == {(20, 20)}
    assert seen["spaced-train"].count() == 92 and seen["spaced-parts"].count() == 2
    left = {r.doc_id for r in D.without_contaminated(docs, test).collect()}
    assert left == {90, *range(100, 190)}
