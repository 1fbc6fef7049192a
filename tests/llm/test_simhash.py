import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfline.llm import simhash as S
from shelfline.llm.common import star_components
from tests.conftest import SF_SMALL


def brute_fp(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    ones = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(sh))


def brute_components(fps, bits=4):
    ids = sorted(fps)
    comp = {i: i for i in ids}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for x in range(len(ids)):
        for y in range(x):
            if (fps[ids[x]] ^ fps[ids[y]]).bit_count() <= bits:
                a, b = find(ids[x]), find(ids[y])
                comp[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_matches_brute_force(spark):
    rows = E.queries()["op7_simhash"](spark, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    fps = {i: brute_fp(t) for i, t in docs.items()}
    comp = brute_components(fps)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{fps[i]:016x}", comp[i]) for i in docs}
    assert len(rows) == len(docs)


@pytest.mark.parametrize("max_group", [4096, 3])
def test_links_of_random_fingerprints(spark, max_group):
    """Chains of small flips, compared in the keys or (tiny limit) by the linear way."""
    r = random.Random(5)
    fps = set()
    for _ in range(20):
        f = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            fps.add(f)
            for b in r.sample(range(64), r.randint(1, 6)):
                f ^= 1 << b
    base = r.getrandbits(64)
    fps |= {base ^ (1 << b) for b in range(20)} | {(1 << 64) - 1, 0}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = S._block_links(df, 4, max_group)
    crowded = links.where("b IS NULL").select("a").distinct()
    assert crowded.isEmpty() == (max_group == 4096)
    edges = links.where("b IS NOT NULL").union(S._wide_links(crowded, 4))
    got = {x.node % 2**64: x.root % 2**64 for x in star_components(edges, "t").collect()}
    want = brute_components({f: f for f in fps})
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_edges_of_the_input(spark, documents):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    docs = documents([(5, None), (4, ""), (3, " \n\t"), (9, "One two"), (8, "one TWO"), (7, long), (7, long), (6, "Ä b c d e"),
                      (None, "one two")])
    got = {(r.doc_id, r.component) for r in S.near_duplicates(docs).collect()}
    assert got == {(5, 3), (4, 3), (3, 3), (9, 8), (8, 8), (7, 7), (6, 6), (None, 8)}
    assert S.near_duplicates(docs).where("doc_id = 7").count() == 2
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [3, 6, 7, 8]
    assert kept.where("doc_id IS NULL").count() == 0                 # a copy of 8
    empty = documents([])
    assert S.near_duplicates(empty).count() == 0 and S.keep_one(empty).count() == 0


def test_one_row_of_a_group_stays(spark):
    """Keys first, rows without one last; one key with several texts; rows that differ beside the text; repeated rows."""
    a, b, c = "one two three four five", "six seven eight nine ten", "other words stand here alone"
    rows = [(5, a, "x"), (5, b, "x"), (7, b, "y"), (None, a, "x"), (None, c, "y"), (None, c, "x"), (4, a, "y"), (4, a, "x"),
            (9, "", "x"), (9, "", "x"), (None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("m", F.create_map(F.lit("k"), "lang"))
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    # 5 has a copy of 4's text and one of its own; neither text decides for the other
    assert got == [(0, c), (4, a), (5, b), (9, "")]
    for n in (1, 6):                                                  # the choice does not depend on the partitions
        again = S.keep_one(docs.repartition(n))
        assert sorted(str(r) for r in again.collect()) == sorted(str(r) for r in kept.collect())


def test_one_hot_fingerprint(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words here today again")
                                    .otherwise(F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(str(k))), 256) for k in range(6)]))
                                    .alias("text"))
    got = S.near_duplicates(docs)
    assert got.where("doc_id % 3 = 0 AND component = 0").count() == 1000
    assert got.where("doc_id % 3 <> 0 AND component = doc_id").count() == 2000


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = star_components(edges, "chain").collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(300)}
