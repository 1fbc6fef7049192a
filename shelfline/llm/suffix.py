"""Removal of repeated byte strings with per-shard suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it also starts
earlier (smaller document, or same document and earlier start). All strings
are judged on the input. The work is split into shards as follows.

1. *Anchors.* Every window of ``length`` bytes names one anchor: the leftmost
   least hash among the 24-byte strings inside it. Equal windows name equal
   anchors at equal offsets, so a window can only repeat if its anchor hash
   occurs twice. The hashes are counted over the whole corpus, and those that
   repeat set bits of a filter of fixed size (``filter_bits``). A full filter
   lets more windows through; it never loses one.
2. *Shards.* The second pass collects the runs of windows whose anchor passes
   the filter into shards of at most ``SHARD_BYTES``. Each shard is sorted by
   Larsson-Sadakane refinement (groups of equal prefixes are refined by the
   ranks of the suffixes behind them, doubling the depth, until every group is
   single), and Kasai's relation gives the common prefixes. Suffixes that share
   ``length`` bytes form one block; all but its earliest window repeat.
3. *Across shards.* The windows that are first in their shard go on as runs
   around an anchor, keyed by its hash. A shard sends a window once however often it
   holds it. The runs of a key come in document order; equal ones are known by
   their bytes, and the windows of different ones are merged by binary search in
   the sorted windows seen so far.
   A key with over ``HOT_STRETCHES`` runs (a common line has another context in
   every document) does not go to one task. The copies of its runs are marked
   first, in two rounds: parts of the documents, then their firsts. What is left
   is cut where the anchor's offset in the window passes a multiple of 16, then
   of 2. The windows of such an interval share a core of 85, then 99 bytes, and
   equal windows share their interval and so the core, whose hash is the new
   key; runs whose key occurs once repeat nothing and are done. In the end the
   runs of a key have at most a byte before and one behind the core (65,536
   different ones), and are merged in the same way.
4. The marks of all steps meet the text of their document, which is cut.

Windows never cross documents. A document may be cut over many shards, and a
text longer than a slice is read in pieces that share ``length - 1`` bytes, so
long texts need no more working memory than short ones.

Defined cases: a null text is empty; null ids come first in document order;
rows of one id are ordered by a hash of their text, and rows equal in both are
one document (neither repeats the other, each gets the same result); extra
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, free_name, mixed, range_hashes, stored, tidy, value_bytes

GRAM = 24
SLICE_BYTES = 2 << 20
SHARD_BYTES = 1 << 21           # positions of a shard fit 21 bits (see suffix_array)
FILTER_BITS = 1 << 26
WIDTHS = (16, 2)                # of the offsets that the runs of hot keys may have; each divides the one before
HOT_STRETCHES = 1024            # of one key that go to one task
FIRST_ID = -(1 << 63)


# ---------------------------------------------------------------- suffix arrays

def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of at most 2**21 bytes by Larsson-Sadakane refinement.

    Sort keys are packed with the position into one 64-bit word and sorted as
    values. A suffix that ends before the depth sorts before all longer ones,
    the shorter the earlier.
    """
    n = len(text)
    if n > SHARD_BYTES:
        raise ValueError("shard too large")
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    pad = np.concatenate((text, np.zeros(4, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(5):
        key = key << np.uint64(8) | pad[k:k + n]
    low = np.uint64(21)
    mask = np.uint64((1 << 21) - 1)
    packed = np.sort(key << low | np.arange(n, dtype=np.uint64))
    sa = (packed & mask).astype(np.int32)
    head = np.concatenate(([True], (packed[1:] >> low) != (packed[:-1] >> low)))
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), np.int32(0)))
    single = head & np.concatenate((head[1:], [True]))
    slots = np.flatnonzero(~single).astype(np.int32)    # places of the array that are not settled
    first = head[slots]                                 # where their groups begin
    depth = 5
    while len(slots):
        pos = sa[slots]
        behind = pos + np.int32(depth)
        second = rank.take(behind, mode="clip") + np.int32(n)
        over = behind >= n
        if over.any():
            second[over] = 2 * n - 1 - behind[over]
        # at most 2**20 groups of two or more, 2**22 second ranks, 2**21 places: 63 bits
        packed = np.cumsum(first, dtype=np.uint64) << np.uint64(22) | second.astype(np.uint64)
        packed = np.sort(packed << low | np.arange(len(slots), dtype=np.uint64))
        pos = pos[packed & mask]
        sa[slots] = pos
        fresh = np.concatenate(([True], (packed[1:] >> low) != (packed[:-1] >> low)))
        rank[pos] = np.maximum.accumulate(np.where(fresh, slots, np.int32(0)))
        rest = ~(fresh & np.concatenate((fresh[1:], [True])))
        slots, first = slots[rest], fresh[rest]
        depth *= 2
    return sa, rank


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """lcp[j] of the suffixes at sa[j-1] and sa[j] by Kasai's relation.

    With p(i) the suffix sorted just before i, lcp(i) = lcp(i-1) - 1 whenever
    the bytes before i and p(i) are equal; only the other positions compare
    bytes, and their total length is O(n log n).
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32)
    prev = np.empty(n, np.int32)
    prev[sa[1:]] = sa[:-1]
    prev[sa[0]] = -1
    behind = np.concatenate((text[-1:], text))           # behind[i] is the byte before i
    chained = behind[:n] == behind.take(prev, mode="wrap")
    chained &= prev > 0
    chained[0] = False
    own = np.flatnonzero(~chained & (prev >= 0)).astype(np.int32)
    pad = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.ndarray((n + 1,), np.uint64, pad.tobytes(), strides=(1,))      # unaligned 8-byte words
    lcp = np.zeros(n, np.int32)
    live, a, b = own, own.copy(), prev[own]
    while len(live):
        diff = words[a] ^ words[b]
        same = np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)) >> 3      # 8 if equal
        step = np.minimum(same.astype(np.int32), n - np.maximum(a, b))
        lcp[live] += step
        more = step == 8
        live, a, b = live[more], a[more] + np.int32(8), b[more] + np.int32(8)
    i = np.arange(n, dtype=np.int32)
    base = np.maximum.accumulate(np.where(chained, np.int32(0), i))
    return (lcp[base] - (i - base))[sa]


def shard_repeats(text: np.ndarray, order: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """True at each valid window start whose bytes also start, in the shard, at a smaller ``order``."""
    sa, rank = suffix_array(text)
    lcp = common_prefixes(text, sa, rank)
    block = np.cumsum(lcp < length)
    keep = valid[sa]
    block, pos = block[keep], sa[keep]
    out = np.zeros(len(text), bool)
    if not len(pos):
        return out
    edge = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1))
    least = np.minimum.reduceat(order[pos], edge)
    out[pos] = order[pos] > np.repeat(least, np.diff(np.concatenate((edge, [len(pos)]))))
    return out


# ---------------------------------------------------------------- anchors

_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)   # odd multipliers


def anchor_runs(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of one document that share an anchor: (document, first start, last start, hash, anchor).

    Starts and anchors are positions in ``data``. A document names each anchor in one run.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    n = len(data)
    if n < length:
        return none
    words = np.ndarray((n - 7,), np.uint64, data.tobytes(), strides=(1,))
    m = n - GRAM + 1
    h = words[:m] * _M[0]
    h ^= h >> np.uint64(29)
    h += words[8:8 + m]
    h *= _M[1]
    h ^= h >> np.uint64(32)
    h += words[16:16 + m]
    h *= _M[2]
    h ^= h >> np.uint64(29)
    h *= _M[0]
    best = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)     # slices stay below 2**32 bytes
    span, have = length - GRAM + 1, 1
    while have < span:                                 # leftmost least over ``span`` grams by doubling
        step = min(have, span - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(off)
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return none
    first, last = off[long], off[long + 1] - length    # valid windows of each document
    ok = np.zeros(n + 1, np.int64)
    np.add.at(ok, first, 1)
    np.add.at(ok, last + 1, -1)
    ok = np.cumsum(ok)[:len(at)] > 0
    new = np.concatenate(([True], at[1:] != at[:-1])) & ok
    new[first] = True
    begin = np.flatnonzero(new)
    doc = np.searchsorted(off, begin, side="right") - 1
    # empty documents share an offset: the last one that starts here holds the bytes
    end = np.minimum(np.concatenate((begin[1:] - 1, [n])), off[doc + 1] - length)
    return doc, begin, end, h[at[begin]].view(np.int64), at[begin]


def interval_runs(begin: np.ndarray, end: np.ndarray, anchor: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(run, begin, end, interval): the runs cut where the anchor's offset in a window passes a multiple of ``width``."""
    high, low = (anchor - begin) // width, (anchor - end) // width
    n = high - low + 1
    run = np.repeat(np.arange(len(begin)), n)
    k = high[run] - (np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n))
    return run, np.maximum(begin[run], anchor[run] - (k * width + width - 1)), np.minimum(end[run], anchor[run] - k * width), k


def core_keys(data: np.ndarray, anchor: np.ndarray, interval: np.ndarray, width: int, length: int) -> np.ndarray:
    """Hash of the bytes that all windows of an interval share."""
    low = interval * width
    high = np.minimum(low + width - 1, length - GRAM)
    h = range_hashes(data, anchor - low, anchor - high + length)
    return mixed(h ^ interval.astype(np.uint64)).view(np.int64)


def pieces(batches, length: int):
    """(batch, place, data, offsets): slices of documents; a long one comes in pieces that share ``length - 1`` bytes.

    ``place`` is where the piece lies in its document, 0 for whole ones.
    """
    for b in byte_slices(batches, "body", SLICE_BYTES):
        data, off = value_bytes(b.column(b.schema.get_field_index("body")))
        if b.num_rows > 1 or len(data) <= SLICE_BYTES:
            yield b, 0, data, off
            continue
        for k in range(0, len(data) - length + 1, SLICE_BYTES):
            part = data[k:k + SLICE_BYTES + length - 1]
            yield b, k, part, np.array([0, len(part)])


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tag, body): the order of documents and the bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(FIRST_ID)).alias("id"), F.xxhash64(body).alias("tag"),
                       body.alias("body"))


def _filter(keyed: DataFrame, length: int, bits: int) -> np.ndarray:
    """Bit map (uint64 words) of the anchor hashes that occur twice or more; ``bits`` is its fixed size."""
    @tidy
    def hashes(batches):
        for _, _, data, off in pieces(batches, length):
            h, n = np.unique(anchor_runs(data, off, length)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

    repeated = (keyed.select("body").mapInArrow(hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
                .where("n > 1").select(F.pmod("h", F.lit(bits)).alias("bit")))
    words = (repeated.groupBy(F.shiftright("bit", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v"))).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return out


# ---------------------------------------------------------------- shards

class _Shard:
    """Collects stretches of windows; ``solve`` gives marks and the stretches to send on."""

    def __init__(self, length: int):
        self.length, self.size, self.parts, self.runs = length, 0, [], []

    def room(self) -> int:
        return SHARD_BYTES - self.size

    def add(self, who: tuple[int, int], at: int, body: np.ndarray, begin: np.ndarray, end: np.ndarray, h: np.ndarray, anchor: np.ndarray) -> None:
        """``body`` lies at ``at`` in its document; the runs are counted from the start of ``body``."""
        self.runs.append((begin + self.size, end + self.size, h, anchor + self.size))
        self.parts.append((*who, at, body))
        self.size += len(body)

    def solve(self) -> pa.RecordBatch:
        length = self.length
        text = np.concatenate([p[3] for p in self.parts])
        starts = np.cumsum([0] + [len(p[3]) for p in self.parts])
        ids, tags, at = (np.array([p[k] for p in self.parts], np.int64) for k in range(3))
        begin, end, h, anchor = (np.concatenate([r[k] for r in self.runs]) for k in range(4))
        self.size, self.parts, self.runs = 0, [], []
        rows = np.lexsort((tags, ids))
        step = (np.diff(ids[rows]) != 0) | (np.diff(tags[rows]) != 0)
        number = np.empty(len(rows), np.int64)
        number[rows] = np.concatenate(([0], np.cumsum(step)))        # equal identities share a number
        shift = at - starts[:-1]                                     # place in the document less place in the shard
        order = np.repeat((number << 40) + shift, np.diff(starts)) + np.arange(len(text))
        edge = np.zeros(len(text) + 1, np.int8)
        edge[begin] += 1
        edge[end + 1] -= 1
        repeat = shard_repeats(text, order, np.cumsum(edge[:-1], dtype=np.int8) > 0, length)
        # the last length - 1 places of a part are no windows, so no run of marks crosses parts
        first, last = true_runs(repeat)
        k = np.searchsorted(starts, first, side="right") - 1
        fresh = edge[:-1].cumsum(dtype=np.int8) > 0                  # windows that are first in this shard
        fresh &= ~repeat
        head = fresh & ~np.concatenate(([False], fresh[:-1]))
        head[begin] = fresh[begin]
        tail = fresh & np.concatenate((head[1:] | ~fresh[1:], [True]))
        run = np.searchsorted(begin, np.flatnonzero(head), side="right") - 1
        begin, end, h, anchor = np.flatnonzero(head), np.flatnonzero(tail), h[run], anchor[run]
        j = np.searchsorted(starts, begin, side="right") - 1
        raw = text.tobytes()
        bodies = [raw[x:y] for x, y in zip(begin.tolist(), (end + length).tolist())]
        off = (anchor - begin).astype(np.int32)
        both = lambda x, y: np.concatenate((x, y))
        is_mark = np.arange(len(first) + len(begin)) < len(first)
        # marks go by a hash of their own, which spreads them
        spread = (first + shift[k]) * 0x9E3779B1 + ids[k] * 0x85EBCA6B
        return pa.RecordBatch.from_arrays(
            [pa.array(both(spread, h)), pa.array(both(ids[k], ids[j])), pa.array(both(tags[k], tags[j])),
             pa.array(both(first + shift[k], begin + shift[j])),
             pa.array(both(last + shift[k], np.zeros(len(begin), np.int64)), mask=~is_mark),
             pa.array([None] * len(first) + bodies, pa.binary()),
             pa.array(both(np.zeros(len(first), np.int32), off))], schema=SENT)


def true_runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2] - 1


SENT = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("last", pa.int64()),
                  ("body", pa.binary()), ("off", pa.int32())])


def _shards(keyed: DataFrame, length: int, bits: int, words) -> DataFrame:
    """Rows with a body are runs to compare across shards, the others are marks (id, tag, start, last)."""
    @tidy
    def run(batches):
        shard, passes = _Shard(length), words.value
        for b, place, data, off in pieces(batches, length):
            ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy()
            doc, begin, end, h, anchor = anchor_runs(data, off, length)
            bit = h % bits                                # numpy's modulo is pmod
            hit = (passes[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            doc, begin, end, h, anchor = (x[hit] for x in (doc, begin, end, h, anchor))
            apart = np.flatnonzero((np.diff(doc) != 0) | (begin[1:] != end[:-1] + 1)) + 1
            for k, stop in zip([0, *apart.tolist()] if len(doc) else [], [*apart.tolist(), len(doc)]):
                while k < stop:                           # runs that join, as many as the shard still takes
                    n = int(np.searchsorted(end[k:stop], begin[k] + shard.room() - length, side="right"))
                    if n == 0:
                        yield shard.solve()
                        continue
                    d, a, z = doc[k], begin[k], end[k + n - 1] + length
                    shard.add((ids[d], tags[d]), int(place + a - off[d]), data[a:z], begin[k:k + n] - a, end[k:k + n] - a,
                              h[k:k + n], anchor[k:k + n] - a)
                    k += n
        if shard.parts:
            yield shard.solve()

    return keyed.mapInArrow(run, "h long, id long, tag long, start long, last long, body binary, off int")


# ---------------------------------------------------------------- across shards

WINDOWS_AT_ONCE = 1 << 16


def merge_windows(seen: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flags, merged): which of ``new`` (in document order) are in sorted ``seen`` or earlier in ``new``.

    Both hold byte strings of one length; the search is binary.
    """
    uniq, first = np.unique(new, return_index=True)
    flag = np.ones(len(new), bool)
    flag[first] = False
    if len(seen):
        at = np.searchsorted(seen, uniq)
        known = seen[np.minimum(at, len(seen) - 1)] == uniq
        flag[first[known]] = True
        merged = np.insert(seen, at[~known], uniq[~known])
    else:
        merged = uniq
    return flag, merged


def _windows(bodies: list[bytes], heads: list[bytes], length: int) -> np.ndarray:
    """All windows of all bodies, each behind its 8-byte head, as fixed-size byte strings."""
    out = []
    for head, body in zip(heads, bodies):
        n = len(body) - length + 1
        rows = np.empty((n, length + 8), np.uint8)
        rows[:, :8] = np.frombuffer(head, np.uint8)
        rows[:, 8:] = np.lib.stride_tricks.sliding_window_view(np.frombuffer(body, np.uint8), length)
        out.append(rows)
    flat = np.concatenate(out)
    return flat.reshape(-1).view(f"S{length + 8}")


def _across(sent: DataFrame, length: int) -> DataFrame:
    """Marks (id, tag, start, last): those of the shards, and windows that an earlier shard or document has.

    Rows arrive sorted by (h, id, tag, start): what is seen first is earliest.
    Rows of one document that overlap come from rows that repeat it: a window
    is looked at once.
    """
    @tidy
    def run(batches):
        h, known, seen = None, set(), np.zeros(0, f"S{length + 8}")
        waiting, load = [], 0                   # distinct stretches of many hashes, and their windows

        def settle():
            """Merge the waiting windows; a hash that goes on keeps what was seen of it."""
            nonlocal waiting, load, seen
            if not waiting:
                return []
            wins = _windows([w[4] for w in waiting], [w[0] for w in waiting], length)
            flag, merged = merge_windows(seen, wins)
            out, at = [], 0
            for head, i, t, a, body in waiting:
                n = len(body) - length + 1
                if flag[at:at + n].any():
                    out += [(i, t, a + x, a + y) for x, y in zip(*map(np.ndarray.tolist, true_runs(flag[at:at + n])))]
                at += n
            head = waiting[-1][0]
            seen = merged[np.searchsorted(merged, head):np.searchsorted(merged, head + b"\xff" * length, side="right")]
            waiting, load = [], 0
            return out

        first = None                            # the first stretch of the present hash, not yet waiting
        held, upto = None, 0                    # the present hash and document, and its last window so far
        for b in batches:
            marks = []
            for x, i, t, a, z, body in zip(*(b.column(k).to_pylist() for k in range(6))):
                if body is None:
                    marks.append((i, t, a, z))
                    continue
                if x != h:
                    h, known, first = x, set(), None
                if held == (x, i, t) and a <= upto:
                    body, a = body[upto + 1 - a:], upto + 1
                    if len(body) < length:
                        continue
                held, upto = (x, i, t), a + len(body) - length
                if body in known:
                    marks.append((i, t, a, upto))
                    continue
                known.add(body)
                head = x.to_bytes(8, "big", signed=True)
                if len(known) == 1:
                    first = (head, i, t, a, body)
                    continue
                if first is not None:
                    waiting.append(first)
                    load += len(first[4]) - length + 1
                    first = None
                waiting.append((head, i, t, a, body))
                load += len(body) - length + 1
                if load >= WINDOWS_AT_ONCE:
                    marks += settle()
            yield _marks(marks)
        yield _marks(settle())

    return (sent.repartition("h")
            .sortWithinPartitions("h", "id", "tag", "start").mapInArrow(run, "id long, tag long, start long, last long"))


def _marks(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "tag", "start", "last"])


def _cut_again(runs: DataFrame, width: int, length: int) -> DataFrame:
    """The runs cut at multiples of ``width``, with the keys of their new cores."""
    @tidy
    def run(batches):
        for b in byte_slices(batches, "body", SLICE_BYTES):
            data, off = value_bytes(b.column(5))
            anchor = off[:-1] + b.column(6).to_numpy()
            row, begin, end, interval = interval_runs(off[:-1], off[1:] - length, anchor, width)
            raw, anchor, at = data.tobytes(), anchor[row], pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(core_keys(data, anchor, interval, width, length)), b.column(1).take(at), b.column(2).take(at),
                 pa.array(b.column(3).to_numpy()[row] + begin - off[row]), pa.nulls(len(row), pa.int64()),
                 pa.array([raw[x:y] for x, y in zip(begin.tolist(), (end + length).tolist())], pa.binary()),
                 pa.array((anchor - begin).astype(np.int32))], schema=SENT)

    return runs.mapInArrow(run, "h long, id long, tag long, start long, last long, body binary, off int")


def _copies(runs: DataFrame, length: int) -> DataFrame:
    """The runs without their copies, and the copies as marks (without a body).

    A copy is a run that an earlier document, or the same at an earlier place,
    has too. Of rows at one place one is kept: they are one document. The first
    round is dealt out by parts of the documents, as many as the key's count
    ``n`` asks for; what is a copy there goes through the second round by a hash
    of its own.
    """
    last = (F.col("start") + F.octet_length("body") - length).alias("last")
    salt = F.pmod(F.xxhash64("id", "tag"), 1 + F.expr(f"n div {max(1, HOT_STRETCHES)}")).alias("salt")

    def ranked(rows, *group):
        w = Window.partitionBy(*group).orderBy("id", "tag", "start")
        rows = rows.withColumn("place", F.row_number().over(w)).withColumn("copy", F.rank().over(w) > 1).where("copy OR place = 1")
        return rows.select(F.when(F.col("copy"), F.xxhash64("id", "start")).otherwise(F.col("h")).alias("h"), "id", "tag", "start", "last",
                           F.when(~F.col("copy"), F.col("body")).alias("body"), "off")

    firsts = ranked(runs.select("h", "id", "tag", "start", last, "body", "off", salt), "h", "off", "body", "salt")
    # marks of the first round are alone in their group
    alone = F.when(F.col("body").isNull(), F.struct("id", "tag", "start"))
    return ranked(firsts.withColumn("alone", alone), "h", "off", "body", "alone")


def _counts(runs: DataFrame, more_than: int) -> DataFrame:
    """(h, n) of the keys with over ``more_than`` runs: at most as many as runs over that number."""
    return stored(runs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than), "suffix-hot")


def _all_marks(sent: DataFrame, length: int) -> DataFrame:
    """Marks (id, tag, start, last) of the shards and across them."""
    sent = stored(sent, "suffix-sent")
    marks = sent.where("body IS NULL").select("id", "tag", "start", "last")
    runs = sent.where("body IS NOT NULL")
    hot = _counts(runs, HOT_STRETCHES)
    if hot.isEmpty():
        return marks.union(_across(runs, length))
    marks = marks.union(_across(runs.join(F.broadcast(hot), "h", "left_anti").select(*SENT.names), length))
    runs = runs.join(F.broadcast(hot), "h")
    for width in WIDTHS:
        seen = stored(_copies(runs, length), "suffix-seen")
        marks = marks.union(seen.where("body IS NULL").select("id", "tag", "start", "last"))
        runs = stored(_cut_again(seen.where("body IS NOT NULL"), width, length), "suffix-runs")
        runs = runs.join(runs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "h")     # one run repeats nothing
    seen = stored(_copies(runs, length), "suffix-seen")
    marks = marks.union(seen.where("body IS NULL").select("id", "tag", "start", "last"))
    return marks.union(_across(seen.where("body IS NOT NULL"), length))


# ---------------------------------------------------------------- the operator

def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100,
            filter_bits: int = FILTER_BITS) -> DataFrame:
    """(id, tag, marks): the runs of window starts that repeat, for documents that have any."""
    keyed = _keyed(docs, key, text)
    words = docs.sparkSession.sparkContext.broadcast(_filter(keyed, length, filter_bits))
    return (_all_marks(_shards(keyed, length, filter_bits, words), length).groupBy("id", "tag")
            .agg(F.sort_array(F.collect_set(F.struct("start", "last"))).alias("marks")))


def cut(body: bytes, marks, length: int) -> tuple[bytes, int]:
    """``body`` without the bytes that the marked windows cover, and the number of maximal removed runs."""
    out, at, runs = [], 0, 0
    for a, b in marks:
        if a > at or runs == 0:
            runs += 1
            out.append(body[at:a])
        at = max(at, b + length)
    out.append(body[at:])
    return b"".join(out), runs


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100, kept: str = "kept",
                   n_spans: str = "n_spans", filter_bits: int = FILTER_BITS, characters: bool = False) -> DataFrame:
    """``docs`` plus ``kept`` (binary, the bytes that are left) and ``n_spans`` (maximal removed runs).

    With ``characters`` ``kept`` is a string, without the bytes of characters
    that a cut has torn, and null where the text is null.
    """
    marked = stored(repeats(docs, key, text, length, filter_bits), "suffix-marks")
    names = docs.columns
    i, t, m = (free_name(names, x) for x in ("mark_id", "mark_tag", "mark_runs"))
    marked = marked.select(F.col("id").alias(i), F.col("tag").alias(t), F.col("marks").alias(m))
    body = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(marked, (F.coalesce(F.col(key).cast("long"), F.lit(FIRST_ID)) == F.col(i))
                       & (F.xxhash64(body) == F.col(t)), "left").drop(i, t)

    def one(v, w):
        if w is None:
            return None, 0
        left, runs = cut(v, [(r["start"], r["last"]) for r in w], length)
        return left.decode("utf-8", "ignore") if characters else left, runs

    @F.pandas_udf(f"kept {'string' if characters else 'binary'}, n_spans long")
    def cutting(bodies, marks):
        return pd.DataFrame([one(v, w) for v, w in zip(bodies, marks)], columns=["kept", "n_spans"])

    r = free_name(joined.columns, "cutting")
    # texts without a mark stay out of Python
    done = joined.withColumn(r, cutting(F.when(F.col(m).isNotNull(), F.encode(body, "utf-8")), F.col(m)))
    whole = F.col(text) if characters else F.encode(body, "utf-8")
    return done.select(*names, F.coalesce(F.col(f"{r}.kept"), whole).alias(kept),
                       F.coalesce(F.col(f"{r}.n_spans"), F.lit(0)).alias(n_spans))
