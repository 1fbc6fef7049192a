import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfline.llm import suffix as S
from tests.conftest import SF_SMALL


def brute(docs, length=100):
    """(id, text) in document order -> (n_bytes, n_removed, n_spans, kept)."""
    seen, out = set(), {}
    for i, t in docs:
        b = (t or "").encode()
        hit = np.zeros(len(b) + 1, np.int64)
        for a in range(len(b) - length + 1):
            w = b[a:a + length]
            if w in seen:
                hit[a] += 1
                hit[a + length] -= 1 if a + length <= len(b) else 0
            else:
                seen.add(w)
        cov = np.cumsum(hit)[:len(b)] > 0
        out[i] = (len(b), int(cov.sum()), int((np.diff(np.concatenate(([0], cov.astype(int)))) == 1).sum()),
                  bytes(x for x, c in zip(b, cov) if not c))
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"a" * 300, b"ab\0\0ab\0\0ab\0\0\0", b"abcab" * 60 + b"xyz" * 50,
                                  bytes(random.Random(1).choices(b"ab", k=700))])
def test_suffix_array_and_prefixes(text):
    t = np.frombuffer(text, np.uint8)
    sa, rank = S.suffix_array(t)
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert sa.tolist() == want and [want[r] for r in rank] == list(range(len(text)))

    def lcp(a, b):
        n = 0
        while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n
    assert S.common_prefixes(t, sa, rank).tolist() == [0 if not k else lcp(want[k - 1], want[k]) for k in range(len(want))]


def test_query_matches_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    want = {i: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for i, v in brute(docs).items()}
    rows = E.queries()["op4_suffix_dedup"](spark, SF_SMALL)
    assert result(rows) == want and sum(v[1] for v in want.values()) > 0


def made(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghé", k=r.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choices(words, k=n))
    shared = [prose(r.randint(12, 60)) for _ in range(6)]
    docs = []
    for i in range(60):
        t = prose(r.randint(0, 120))
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            t += " " + p[r.randint(0, 9):len(p) - r.randint(0, 9)] + " " + prose(r.randint(0, 10))
        docs.append(t)
    docs += [docs[3], docs[3], docs[7] + " end", "z" * 950, "xy" * 400 + "z" * 300, docs[9][:99], docs[9][:100], ""]
    ids = r.sample(range(1000), len(docs))
    return list(zip(ids, docs))


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_made_documents(spark, documents, monkeypatch, seed, small):
    """Whole shards, and (tiny limits, in this process) many shards and merges for the same result."""
    docs = made(seed)
    want = brute(sorted(docs))
    df = documents(docs)
    if small:
        got = locally(docs, monkeypatch)
    else:
        got = {r.doc_id: (len(r.text.encode()), len(r.text.encode()) - len(r.kept), r.n_spans, bytes(r.kept))
               for r in S.remove_repeats(df.repartition(5)).collect()}
    assert got == want


def locally(docs, monkeypatch, length=100):
    """The steps of the operator in one process, with shards of 600 bytes and merges of 40 windows."""
    import pyarrow as pa
    monkeypatch.setattr(S, "SHARD_BYTES", 700)
    monkeypatch.setattr(S, "SLICE_BYTES", 3000)
    monkeypatch.setattr(S, "WINDOWS_AT_ONCE", 40)

    class Frame:
        def __init__(self, batches):
            self.batches = batches

        def mapInArrow(self, f, schema):
            return Frame(list(f(self.batches)))

        def select(self, *names):
            return Frame([b.select(list(names)) for b in self.batches])

        def repartition(self, *_):
            return self

        def sortWithinPartitions(self, *keys):
            t = pa.Table.from_batches(self.batches).sort_by([(k, "ascending") for k in keys])
            return Frame(t.to_batches(max_chunksize=7))

    class Words:
        value = np.full(1 << 10, ~np.uint64(0))
    batch = pa.RecordBatch.from_pydict({"id": [i for i, _ in docs], "tag": [0] * len(docs), "body": [t for _, t in docs]})
    first = Frame([batch])
    first = S._shards(first, length, 1 << 16, Words)
    t = pa.Table.from_batches(first.batches)
    assert len(first.batches) > 20
    sent = Frame(t.filter(pa.compute.is_valid(t["body"])).to_batches())
    marks = t.filter(pa.compute.is_null(t["body"])).select(["id", "start", "last"]).to_pylist()
    for b in S._across(sent, length).batches:
        marks += b.select(["id", "start", "last"]).to_pylist()
    out = {}
    for i, text in docs:
        body = text.encode()
        kept, runs = S.cut(body, sorted({(m["start"], m["last"]) for m in marks if m["id"] == i}), length)
        out[i] = (len(body), len(body) - len(kept), runs, kept)
    return out


def test_edges_of_the_input(spark, documents):
    rnd = random.Random(3)
    long = " ".join(f"{rnd.getrandbits(40):x}" for _ in range(250_000))          # 2.6 MB: more than a shard
    docs = documents([(5, None), (4, ""), (2, long), (3, "A" + long), (None, "B" + long[:500]), (8, "dup " * 40), (8, "dup " * 40),
                      (9, "x" * 99)])
    got = S.remove_repeats(docs)
    assert got.columns == docs.columns + ["kept", "n_spans"]
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, bytes(r.kept), r.n_spans) for r in got.collect()), key=str)
    want = brute([(-1, "B" + long[:500]), (2, long), (3, "A" + long), (8, "dup " * 40), (9, "x" * 99)])
    mine = [(i, v[3], v[2]) for i, v in want.items()]
    mine += [mine[3], (5, b"", 0), (4, b"", 0)]
    assert rows == sorted(mine, key=str)
    empty = documents([])
    assert S.remove_repeats(empty).count() == 0


def test_copies_are_emptied(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, text)
                                    .otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    got = S.remove_repeats(docs)
    assert got.where("doc_id % 3 = 0 AND length(kept) = 0 AND n_spans = 1").count() == 999
    assert got.where("length(kept) = octet_length(text) AND n_spans = 0").count() == 2001


def test_common_line_in_every_document(spark, documents, monkeypatch):
    """A short common line has another context in every document: its anchor must not fill one task."""
    monkeypatch.setattr(S, "HOT_STRETCHES", 100, raising=False)
    line, passage = "a line of 50 bytes that each document has somewhere", " ".join(f"passage{k}" for k in range(30))
    own = lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    docs = [(k, f"{own(k)} {own(-k)} {line} {own(k + 9000)} {own(k + 99000)}" + (f" {passage} {own(k % 40)}{line}{own(k % 50)}" if k % 3 else ""))
            for k in range(600)]
    sizes, real = [], S._across

    def across(sent, length):
        sizes.append(sent.where("body IS NOT NULL").groupBy("h").count().agg(F.max("count")).first()[0] or 0)
        return real(sent, length)
    monkeypatch.setattr(S, "_across", across)
    rows = S.remove_repeats(documents(docs).repartition(40)).collect()
    want = brute(docs)
    assert {r.doc_id: (r.n_spans, bytes(r.kept)) for r in rows} == {i: v[2:] for i, v in want.items()}
    assert max(sizes) <= 100


def test_every_anchor_hot(spark, documents, monkeypatch):
    """All windows by their digests: the same marks, copies of one row included."""
    monkeypatch.setattr(S, "HOT_STRETCHES", 0, raising=False)
    docs = made(4)
    want = brute(sorted(docs))
    rows = S.remove_repeats(documents(docs + docs[:5]).repartition(7)).collect()
    assert len(rows) == len(docs) + 5
    assert all((r.n_spans, bytes(r.kept)) == want[r.doc_id][2:] for r in rows)


def test_common_keys_are_dealt_out(spark, documents, monkeypatch):
    """Every key over the limit: copies meet in parts of the documents, then their firsts."""
    monkeypatch.setattr(S, "HOT_STRETCHES", 1)
    docs = made(6)
    want = brute(sorted(docs))
    rows = S.remove_repeats(documents(docs + docs[:5]).repartition(7)).collect()
    assert len(rows) == len(docs) + 5
    assert all((r.n_spans, bytes(r.kept)) == want[r.doc_id][2:] for r in rows)


@pytest.mark.parametrize("width", [80, 16, 2])
def test_runs_cut_at_offsets(width):
    """The pieces of a run are its windows, each piece inside one interval, and the core lies in all of them."""
    r = random.Random(width)
    anchor = np.array([r.randint(200, 400) for _ in range(50)])
    begin = anchor - np.array([r.randint(0, 76) for _ in range(50)])
    end = np.minimum(begin + np.array([r.randint(0, 76) for _ in range(50)]), anchor)
    run, a, z, k = S.interval_runs(begin, end, anchor, width)
    for i in range(50):
        mine = [(x, y, v) for w, x, y, v in zip(run, a, z, k) if w == i]
        assert [s for x, y, _ in mine for s in range(x, y + 1)] == list(range(begin[i], end[i] + 1))
        assert all((anchor[i] - s) // width == v for x, y, v in mine for s in range(x, y + 1))
    data = np.frombuffer(r.randbytes(600), np.uint8)
    one = np.full(50, int(width < 80))
    twice = np.concatenate((data, data))
    assert S.core_keys(twice, anchor, one, width, 100).tolist() == S.core_keys(twice, anchor + 600, one, width, 100).tolist()
