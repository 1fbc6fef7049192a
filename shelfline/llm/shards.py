"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a sort key (here the hash of the group, then the id). The
splitters between shards are found without sorting: every round counts, in all
partitions at once, the exact bytes and rows between candidate keys (probes).
A splitter whose byte rank meets the tolerance is settled; around the others
the probes are refined inside the interval that holds the target, until the
tolerance is met or the interval has one key. Only the counts of the probes
reach the driver (at most ``PROBES_A_ROUND`` a round). The rows are then
exchanged once.

A group (equal texts) has one hash, so it lies together in the order, and a
boundary is put between groups whenever that meets the tolerance; only a group
too large for that is split, by its ids.

Every shard is cut into ``pieces`` of near-equal bytes in the same way, and the
exchange deals out pieces: no task holds a whole shard. A row's slot is its
place in its piece plus the rows of the pieces before, known from the counts.

Everything is made of DataFrame functions. Defined cases: a null text counts
as empty; a null id sorts first; rows that agree in all keys stay together, in
the order of their remaining columns; an empty table gives an empty result;
extra columns pass through.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import free_name, stored

PROBES = 15                    # candidate keys between two known keys of an open splitter
PROBES_A_ROUND = 480           # candidate keys that one round counts
TOLERANCE = 0.002              # of a shard's share of the bytes
MAX_PIECES = 256               # of one shard
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def between(lo: tuple[int, int], hi: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to ``n`` keys inside (lo, hi): spread over the first component while it differs, else over the second."""
    if hi[0] - lo[0] > 1:
        span = hi[0] - lo[0]
        return sorted({(lo[0] + max(1, span * k // (n + 1)), LOW) for k in range(1, n + 1)} - {lo, hi})
    if hi[0] > lo[0]:
        step = [(lo[0], lo[1] + (HIGH - lo[1]) * k // (n + 1)) for k in range(1, n)] + [(hi[0], LOW)]
    else:
        step = [(lo[0], lo[1] + (hi[1] - lo[1]) * k // (n + 1)) for k in range(1, n + 1)]
    return sorted({k for k in step if lo < k < hi})


def after(key: tuple[int, int]) -> tuple[int, int]:
    """The next key."""
    return (key[0], key[1] + 1) if key[1] < HIGH else (key[0] + 1, LOW)


def rank_below(keys: list[tuple[int, int]], a: Column, b: Column) -> Column:
    """How many of the sorted ``keys`` are at most (a, b): a binary search as nested conditions."""
    def search(i: int, j: int) -> Column:
        if i == j:
            return F.lit(i)
        m = (i + j) // 2
        x, y = (F.lit(v).cast("long") for v in keys[m])
        below = (a < x) if keys[m][1] == LOW else (a < x) | ((a == x) & (b < y))
        return F.when(below, search(i, m)).otherwise(search(m + 1, j))
    return search(0, len(keys))


def _histogram(df: DataFrame, keys: list[tuple[int, int]]) -> list[tuple]:
    """For each interval between ``keys``: (bytes, rows, least key, greatest key), zeros where it is empty."""
    key = F.struct("a", "b")
    rows = (df.groupBy(rank_below(keys, F.col("a"), F.col("b")).alias("k"))
            .agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect())
    out = [(0, 0, None, None)] * (len(keys) + 1)
    for r in rows:
        out[r.k] = (int(r.w), r.n, tuple(r.lo), tuple(r.hi))
    return out


def splitters(df: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(keys, counts) for rows ``df(a, b, w)`` of two long keys and a weight.

    ``keys`` are ``shards - 1`` sorted keys, the first of its shard each (a
    key may repeat: the shard between is empty). ``counts`` are the exact
    (bytes, rows) of the shards.
    """
    total, rows, low, high = _histogram(df, [])[0]
    if not rows:
        return [(HIGH, HIGH)] * (shards - 1), [(0, 0)] * shards
    targets = [total * k / shards for k in range(1, shards)]
    slack = tolerance * total / shards
    # exact (bytes, rows) below a key; a target lies between two neighbours
    known = {(low[0], LOW): (0, 0), after(high): (total, rows)}
    single = set()                                          # least keys of intervals without a second key
    while True:
        order = sorted(known)
        ranks = [known[k][0] for k in order]
        open_ = []
        for t in targets:
            j = min(bisect.bisect_left(ranks, t), len(order) - 1)
            i = max(j - 1, 0)
            if min(abs(ranks[i] - t), abs(ranks[j] - t)) > slack and order[i] not in single:
                open_.append((order[i], order[j]))
        open_ = sorted(set(open_))
        if not open_:
            break
        open_ = open_[::-(-len(open_) // (PROBES_A_ROUND // 3))]      # spread over all; the others wait for a later round
        before = len(known) + len(single)
        each = max(2, min(probes, PROBES_A_ROUND // len(open_)))
        keys = sorted({k for lo, hi in open_ for k in (lo, *between(lo, hi, each), hi)})
        w, n = 0, 0
        for key, (x, y, lo, hi) in zip([None, *keys], _histogram(df, keys)):
            if key is not None:
                known[key] = (w, n)
            if y:                                           # the first and last keys that are really there
                start = (lo[0], LOW) if key is None or key[1] == LOW or lo[0] > key[0] else lo
                known[start], known[after(hi)] = (w, n), (w + x, n + y)
                if lo == hi:
                    single.add(start)
            w, n = w + x, n + y
        if len(known) + len(single) == before:
            raise RuntimeError("splitters did not settle")
    order = sorted(known)
    ranks = [known[k][0] for k in order]
    keys = []
    for t in targets:
        j = min(bisect.bisect_left(ranks, t), len(order) - 1)
        i = max(j - 1, 0)
        near = [k for k in order[i:j + 1] if abs(known[k][0] - t) <= slack]
        # a boundary between groups, if one is near enough
        keys.append(min(near or order[i:j + 1], key=lambda k: (bool(near) and k[1] != LOW, abs(known[k][0] - t))))
    keys = sorted(keys)
    marks = [(0, 0), *(known[k] for k in keys), (total, rows)]
    return keys, [(q[0] - p[0], q[1] - p[1]) for p, q in zip(marks, marks[1:])]


def histogram_shards(df: DataFrame, group: Column, key: str, size: Column, shards: int = 16, piece_bytes: int = 32 << 20,
                     tolerance: float = TOLERANCE, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` plus ``shard`` and ``slot``, in ``shards`` shards of near-equal sums of ``size``.

    ``group`` is a long that rows of one group share; ``key`` orders inside.
    ``piece_bytes`` is the size that one task of the exchange gets.
    """
    names = df.columns
    a, b, p, base = (free_name(names, x) for x in ("sort_group", "sort_key", "sort_piece", "sort_base"))
    whole = df.withColumns({a: group, b: F.coalesce(F.col(key).cast("long"), F.lit(LOW))})
    slim = stored(whole.select(F.col(a).alias("a"), F.col(b).alias("b"), size.cast("long").alias("w")), "histogram-keys")
    total = slim.agg(F.sum("w")).first()[0] or 0
    pieces = max(1, min(MAX_PIECES, total // (shards * piece_bytes)))
    keys, counts = splitters(slim, shards * pieces, tolerance)
    rows, first = 0, []
    for k, (_, n) in enumerate(counts):
        if k % pieces == 0:
            rows = 0
        first.append(rows)
        rows += n
    bases = F.array(*[F.lit(x).cast("long") for x in first])
    placed = whole.withColumn(p, rank_below(keys, F.col(a), F.col(b)))
    rest = [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    own = Window.partitionBy(p).orderBy(a, b, *rest)
    return (placed.withColumn(slot, F.row_number().over(own) - 1)
            .withColumn(slot, (F.col(slot) + F.element_at(bases, F.col(p) + 1)).cast("long"))
            .withColumn(shard, F.floor(F.col(p) / pieces).cast("int"))
            .select(*names, shard, slot))
