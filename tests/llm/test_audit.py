from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa

import __spark_entry__ as E
from shelfline.llm import audit as A
from shelfline.llm.common import range_hashes
from tests.compare import compare
from tests.conftest import SF_SMALL


def brute(docs, labels):
    """(id, text, source) rows and (id, quality, toxic) rows -> the audit, by applying every order."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = t.encode().split()
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and first[t] < i)) if bad}
        parts[s or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        by_filter = Counter()
        for o in permutations("ABCDE"):
            live = rows
            for k, f in enumerate(o):
                gone = [r for r in live if f in r[0]]
                by_filter[f] += len(gone)
                live = [r for r in live if f not in r[0]]
                out[part, "".join(o), k + 1] = [len(live), len(gone), sum(f in r[0] for r in rows) - len(gone),
                                                sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, o, k), v in out.items():
            if p == part:
                v.append(by_filter[o[k - 1]])
    return out


def result(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def test_query_matches_sql_and_brute_force(spark, duck_small):
    df = E.queries()["op13_filter_audit"](spark, SF_SMALL)
    got = result(df)
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()]
    assert got == brute(docs, labels)
    assert compare(df, duck_small, E.oracle_sql()["op13_filter_audit"]) is None


def made(spark):
    rows = [(1, "word " * 300, "a"), (2, "word " * 300, "a"), (2, "word " * 300, "a"), (None, "word " * 300, "b"), (3, None, None), (4, "", None),
            (5, " ".join(f"w{k}" for k in range(250)), "b"), (6, "A#b \x0b\x0c c", "b"), (7, " ".join(f"x{k}é" for k in range(400_000)), "b"),
            (8, "ÀÉ CAPS", ""), (0, "word " * 300, "c")]
    docs = spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows],
                                 "doc_id long, text string, source string, digest string, shard long")
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (7, 1, None), (99, 1, 1)]
    return rows, docs, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edges_of_the_input(spark):
    """Nulls, empty and long texts, repeated rows, clashing names, labels of unknown ids."""
    rows, docs, labels, table = made(spark)
    got = result(A.interactions(A.failures(docs.repartition(3)), table))
    assert got == brute(rows, [x for x in labels if x[0] is not None])
    assert A.interactions(A.failures(docs.limit(0)), table).count() == 0
    assert len(result(A.interactions(A.failures(docs), table.limit(0)))) == 4 * 600


def test_matrix_holds_the_words_by_global_ids(spark, monkeypatch):
    """The rows of all shards, decoded through one dictionary, are the words of the documents."""
    monkeypatch.setattr(A, "SHARD_BYTES", 60)
    texts = ["b a b", "", "  c\ta  ", "a" * 200, "d e f g h i j k l m n o p q r s t u v w x y z", "b b b"]
    docs = spark.createDataFrame([(k, "p", bytes([k]), t) for k, t in enumerate(texts)], "id long, part string, digest binary, body string")
    shards = A._shards(docs.coalesce(1)).checkpoint()
    ids = A.word_ids(shards, 5).checkpoint()
    place = {(r.shard, p): i for r in ids.collect() for p, i in zip(r.pos, r.ids)}
    word, seen = {}, {}
    for r in shards.collect():
        for p, w in enumerate(r.words):
            assert word.setdefault(place[r.shard, p], w) == w                       # an id names one word
        for k, (a, b) in enumerate(zip(r.indptr, r.indptr[1:])):
            seen[r.ids_of[k]] = sorted((word[place[r.shard, i]], n) for i, n in zip(r.indices[a:b], r.counts[a:b]))
    assert shards.count() > 2 and len(set(word.values())) == len(word) == len({w for t in texts for w in t.split()})
    assert seen == {k: sorted(Counter(t.split()).items()) for k, t in enumerate(texts)}


def test_encoded_rows_ascend():
    column, counts = A.encode_block(np.array([0, 2, 3]), np.array([0, 1, 1]), np.array([5, 6, 7]), np.array([9, 4]))
    assert column.tolist() == [4, 9, 4] and counts.tolist() == [6, 5, 7]


def test_row_sums():
    assert A.row_sums(np.array([0, 0, 2, 3]), np.array([4, 5, 6])).tolist() == [0, 9, 6]
    indptr, indices, counts, words = A.term_block(pa.array(["b a b", "", None, " a"]))
    assert indptr.tolist() == [0, 2, 2, 2, 3] and [words[i].as_py() for i in indices] == ["b", "a", "a"] and counts.tolist() == [2, 1, 1]


def test_hashes_do_not_depend_on_the_place():
    data = np.frombuffer(b"abcabc bc", np.uint8)
    h = range_hashes(data, np.array([0, 3, 1, 7, 0, 5]), np.array([3, 6, 3, 9, 0, 5])).tolist()
    assert h[0] == h[1] and h[2] == h[3] and h[4] == h[5] and len(set(h)) == 3


def test_numbers_and_words_of_a_shard_are_one_value_each(spark, monkeypatch):
    """The matrix crosses Spark as bytes, and holds the words of the documents."""
    monkeypatch.setattr(A, "SHARD_BYTES", 60)
    texts = ["b a b", "", "  c\ta  é", "a" * 200, "é f a \x0b b", None, "b b b"]
    docs = spark.createDataFrame([(k, "p", bytes([k]), t or "") for k, t in enumerate(texts)], "id long, part string, digest binary, body string")
    matrix = A.document_terms(docs.coalesce(1), 5)
    kinds = {f.name: f.dataType.simpleString() for f in matrix.schema}
    assert {kinds[n] for n in ("indptr", "indices", "counts")} == {"binary"} and kinds["pos"] == kinds["ids"] == "array<binary>"
    shards = {r.shard: r for r in A._shards(docs.coalesce(1)).collect()}
    word, seen = {}, {}
    for b in matrix.toArrow().to_batches():
        for row, indptr, column, counts in A.blocks(b):
            own = shards[row["shard"].as_py()]
            assert indptr.tolist() == own.indptr and len(column) == len(own.indices)
            for d, a, z in zip(row["ids_of"].as_py(), indptr, indptr[1:]):
                assert (np.diff(column[a:z]) > 0).all()
                seen[d] = dict(zip(column[a:z].tolist(), counts[a:z].tolist()))
    for d, t in enumerate(texts):
        assert sorted(seen[d].values()) == sorted(Counter((t or "").split()).values())
    for a, b in ((0, 6), (0, 4), (2, 4)):                       # equal words have equal ids in any shard
        common = set(texts[a].split()) & set(texts[b].split())
        assert common and len(seen[a].keys() & seen[b].keys()) == len(common)
    assert len(shards) > 2 and len(set().union(*seen.values())) == len({w for t in texts if t for w in t.split()})


def test_packed_lists_are_the_lists():
    values, cut = np.arange(6, dtype=np.int64) << 40, np.array([0, 2, 2, 6])
    cells = A.packed_ints(values, cut)
    assert A.ints_of(cells, np.int64).tolist() == values.tolist()
    assert [A.ints_of(cells.slice(k, 1), np.int64).tolist() for k in range(3)] == [values[a:b].tolist() for a, b in zip(cut, cut[1:])]
    assert A.ints_of(pa.array([[1, 2], [], [3]]), np.int64).tolist() == [1, 2, 3]
    words = pa.array([["a", "é"], ["b"]])
    assert A.words_of(A.packed_words(words)).to_pylist() == A.words_of(words).to_pylist() == words.to_pylist()
