"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints that differ in at most ``max_bits`` of 64 bits are linked.
Cutting the 64 bits into ``max_bits + 3`` blocks leaves at least three equal
blocks in every linked pair, so each distinct fingerprint is sent once for
every choice of three blocks (about 27 key bits at ``max_bits = 4``) and only
fingerprints that share such a key are compared. A task streams its keys in
sorted order, verifies the Hamming distance with numpy and emits one edge per
merged pair (a spanning forest of the key's links), never all pairs. A key
with more than ``max_group`` fingerprints is not compared there: its members
take an exact linear way instead (``_wide_links``).

Defined cases: a null or empty text and a text without words have fingerprint
zero, linked like any other; a text of fewer than ``words`` words is one
shingle; repeated rows share a fingerprint and a component; null ids stay in
the result, take no part in the smallest id, and get a null component only if
no row of their component has an id; extra columns pass through ``fingerprints``
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from shelfline.llm.common import byte_slices, free_name, star_components, stored, tidy

SLICE_BYTES = 2 << 20


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of one text (a bit is 1 if set in over half the shingle hashes)."""
    low = text.lower().split()          # bytes: A-Z only; blanks are 0x20 and 0x09-0x0D
    if not low:
        return 0
    joined = b" ".join(low)
    ends = np.cumsum([len(w) + 1 for w in low]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(low) - words + 1)
    last = ends[min(words, len(low)) - 1:]
    h = xxhash.xxh64_intdigest
    ones, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, n, step):
        hashes = np.fromiter((h(joined[a:b], seed) for a, b in zip(starts[k:k + step].tolist(), last[k:k + step].tolist())),
                             "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` without its text column, plus ``out``: the fingerprint as a signed long."""
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep).withColumn(out, F.lit(0).cast("long")).schema

    @tidy
    def run(batches):
        for b in byte_slices(batches, text, SLICE_BYTES):
            col = b.column(b.schema.get_field_index(text)).cast(pa.binary())
            fps = np.fromiter((fingerprint(v.as_buffer().to_pybytes() if v.is_valid else b"", words) for v in col),
                              np.uint64, len(col)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array(fps)],
                                             names=keep + [out])

    return docs.select(*keep, text).mapInArrow(run, schema)


def block_masks(max_bits: int) -> list[int]:
    """Masks of three of ``max_bits + 3`` blocks that together cover 64 bits."""
    n = max_bits + 3
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y | z for x, y, z in combinations(blocks, 3)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among the distinct ``fps``.

    Each round takes one unlabelled fingerprint and grows its component with
    one vectorised comparison per member, so memory stays linear.
    """
    left, a, b = np.arange(len(fps)), [], []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            u = todo.pop()
            near = np.bitwise_count(fps[left] ^ fps[u]) <= max_bits
            for v in left[near].tolist():
                a.append(v)
                b.append(u)
                todo.append(v)
            left = left[~near]
    return fps[np.array(a, np.int64)], fps[np.array(b, np.int64)]


def _block_links(fps: DataFrame, max_bits: int, max_group: int) -> DataFrame:
    """(a, b): linked fingerprints; (a, null): a member of a key with more than ``max_group``."""
    masks = [_signed(m) for m in block_masks(max_bits)]
    keyed = (fps.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("k", "mask"))
             .select(F.xxhash64("k", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"))

    @tidy
    def run(batches):
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        wide = None                                  # key whose members go the other way

        def flush(keys, vals, upto):
            nonlocal wide
            out_a, out_b, over = [], [], []
            edge = np.flatnonzero(np.diff(keys[:upto])) + 1
            starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [upto]))
            many = np.flatnonzero((ends - starts > 1) | (keys[starts] == wide if wide is not None else False))
            for s, e in zip(starts[many].tolist(), ends[many].tolist()):
                if e - s > max_group or (wide is not None and keys[s] == wide):
                    over.append(vals[s:e])
                    continue
                x, y = _forest(vals[s:e], max_bits)
                out_a.append(x)
                out_b.append(y)
            a = np.concatenate([*out_a, *over, np.zeros(0, np.uint64)]).view(np.int64)
            b = np.concatenate([*out_b, np.zeros(0, np.uint64)]).view(np.int64)
            n = len(a) - len(b)
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(np.concatenate((b, np.zeros(n, np.int64))), mask=np.arange(len(a)) >= len(b))],
                names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held_k = np.concatenate((held_k, batch.column(0).to_numpy()))
            held_f = np.concatenate((held_f, batch.column(1).to_numpy().view(np.uint64)))
            upto = int(np.searchsorted(held_k, held_k[-1]))       # the last key may go on
            if upto == 0 and len(held_k) > max_group:             # a wide key is passed on piece by piece
                wide, upto = held_k[-1], len(held_k)
            if upto:
                yield flush(held_k, held_f, upto)
                held_k, held_f = held_k[upto:], held_f[upto:]
                if len(held_k) and wide is not None and held_k[-1] != wide:
                    wide = None
        if len(held_k):
            yield flush(held_k, held_f, len(held_k))

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _wide_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among crowded fingerprints without pairs, exact and linear.

    Fingerprints at most ``max_bits`` apart share a value that is at most
    ``max_bits / 2`` (rounded up on one side) flips from each. Every
    fingerprint is sent to all such values; those that meet are linked to the
    least of them and the distance is verified. For an even ``max_bits`` all
    that meet are linked to each other, so the star loses nothing.
    """
    if max_bits % 2:
        raise ValueError("an even bit distance is needed")
    flips = [0]
    for k in range(1, max_bits // 2 + 1):
        flips += [_signed(sum(1 << i for i in c)) for c in combinations(range(64), k)]
    table = fps.sparkSession.createDataFrame([(v,) for v in flips], "flip long")   # 2,081 rows at four bits
    sent = fps.select(F.col("a").alias("fp")).join(F.broadcast(table)).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"), "fp")
    least = sent.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (sent.join(least, "mid").where("fp <> b").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits)
            .select(F.col("fp").alias("a"), "b").distinct())


def _rooted(by_fp: DataFrame, max_bits: int, max_group: int) -> DataFrame:
    """``by_fp`` (one row per fingerprint ``fp``) with ``root``, a fingerprint that names its component."""
    links = stored(_block_links(by_fp.select("fp"), max_bits, max_group), "simhash-links")
    edges = links.where("b IS NOT NULL")
    crowded = links.where("b IS NULL").select("a").distinct()
    if not crowded.isEmpty():
        edges = edges.union(_wide_links(crowded, max_bits))
    comp = star_components(edges, "simhash-cc")
    return by_fp.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4,
                    max_group: int = 4096) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fp`` (signed long), ``component`` (smallest reachable key)."""
    base = docs.select(F.col(key).alias("id"), F.col(text).alias("body"))
    prints = stored(fingerprints(base, "body", words), "simhash-fp")
    by_fp = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    rooted = stored(_rooted(by_fp, max_bits, max_group).select("fp", "first", "root"), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return prints.join(named, "fp").select(F.col("id").alias(key), "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4,
             max_group: int = 4096) -> DataFrame:
    """One row of ``docs`` for each near-duplicate component.

    The row with the smallest key stays; rows without a key come after all
    others, and of rows with one key the one with the least hash over its columns
    (maps left out) stays. Rows equal in all of these count once. The least row
    travels with the grouping by fingerprint and by component, which combines
    before it shuffles, so no row of a large group is joined to its component.
    """
    hashed = [F.col(f.name) for f in docs.schema if not isinstance(f.dataType, MapType)]
    row = F.xxhash64(*hashed)
    base = docs.select(F.col(key).alias("id"), F.col(text).alias("body"), row.alias("row"))
    prints = stored(fingerprints(base, "body", words), "simhash-fp")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    by_fp = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "simhash-distinct")
    least = _rooted(by_fp, max_bits, max_group).groupBy("root").agg(F.min("first").alias("first"))
    names = [free_name(docs.columns, n) for n in ("kept_key", "kept_row", "row_hash")]
    kept = least.select(F.col("first.id").alias(names[0]), F.col("first.row").alias(names[1]))
    tagged = docs.withColumn(names[2], row)
    return (tagged.join(kept, tagged[key].eqNullSafe(F.col(names[0])) & (F.col(names[2]) == F.col(names[1])))
            .dropDuplicates([key, names[2]]).drop(*names))
