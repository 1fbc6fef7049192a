import hashlib
import re
import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfline.llm import sketch as S
from tests.conftest import SF_SMALL


def h64(data, seed=42):
    v = xxhash.xxh64_intdigest(data, seed)
    return v - 2**64 if v >> 63 else v


def brute_sketch(text, words=S.WORDS, scale=S.SCALE):
    """Shingle hashes as the SQL function makes them: each word's hash seeds the next one's."""
    w = [h64(x.encode()) for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    if not w:
        return []
    out = set()
    for i in range(max(1, len(w) - words + 1)):
        seed = 42
        for x in w[i:i + words]:
            seed = h64(struct.pack("<q", x), seed % 2**64)
        out.add(seed)
    return sorted(v for v in out if v < S.LOW + 2**64 // scale)


def near(a, b):
    if a == b:
        return 1.0
    n = min(len(a), len(b))
    return len(set(a) & set(b)) / n if n else 0.0


def hexed(a):
    return "".join(f"{v % 2**64:016x}" for v in a)


def brute(pairs):
    """(id, text) -> the contract's columns; ids are distinct."""
    order = sorted(pairs, reverse=True)
    out = {}
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        e = t[:len(t) - k] + u[:k]
        a, b, c = brute_sketch(t), brute_sketch(e), brute_sketch(u)
        out[i] = (i, len(t), hashlib.sha256(e.encode()).hexdigest(), hexed(a), hexed(b), near(a, b), near(a, c))
    return out


def test_query_matches_brute_force(spark):
    rows = E.queries()["op9_scaled_sketch"](spark, SF_SMALL).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(docs)
    assert {r.doc_id: tuple(r) for r in rows} == want and len(rows) == len(docs)
    long = [r for r in rows if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > 0.5 > 0.2 > np.mean([r.near_next for r in long])


def test_containment_of_unequal_documents(spark):
    words = [f"w{k}" for k in range(40_000)]
    df = spark.createDataFrame([(" ".join(words[:1000]), " ".join(words)), (" ".join(words[:1000]), " ".join(words[500:]))],
                               "a string, b string")
    got = [r[0] for r in df.select(S.containment(S.sketch(F.col("a")), S.sketch(F.col("b")))).collect()]
    assert got[0] == 1.0 and abs(got[1] - 0.5) < 0.1
    parts = df.select(S.merged(S.sketch(F.col("a")), S.sketch(F.col("b"))).alias("m"), S.sketch(F.col("b")).alias("b")).first()
    assert set(parts.b) <= set(parts.m)


def test_edges_of_the_input(spark, documents):
    long = "ünder Öl " * 100_000
    docs = documents([(1, None), (2, ""), (4, "One two three"), (4, "One two three"), (4, "other text of four"), (None, "x"), (5, long)])
    cols = ["doc_id", "n_chars", "edited", "own", "edited_hashes", "next_hashes"]
    out = S.compared_with_edits(docs)
    assert out.columns == cols
    rows = out.collect()
    assert len(rows) == 7
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].edited == "" and by[2][0].edited == "" and by[1][0].own == []
    assert by[None][0].edited == "x" and by[None][0].n_chars == 1
    assert len({(r.n_chars, r.edited) for r in by[4] if r.n_chars == 13}) == 1 and len(by[4]) == 3
    assert by[5][0].own == brute_sketch(long) and by[5][0].next_hashes in ([*brute_sketch("One two three")], brute_sketch("other text of four"))
    assert S.compared_with_edits(documents([])).count() == 0
    one = S.compared_with_edits(documents([(1, "abc def")])).first()
    assert one.edited == "abc dab"
    assert spark.range(1).select(S.containment(F.array().cast("array<bigint>"), F.array().cast("array<bigint>"))).first()[0] == 1.0


def test_successors_over_many_ranges(spark):
    keys = spark.range(5000).select((F.col("id") * 7 - 900).alias("id"), F.xxhash64("id").alias("tag"), F.lit(1).cast("long").alias("n"))
    got = {r.id: r.next_id for r in S.successors(keys).collect()}
    ids = sorted(got, reverse=True)
    assert len(ids) == 5000 and [got[i] for i in ids] == ids[1:] + ids[:1]
