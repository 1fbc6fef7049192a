"""Benchmark decontamination by spaced-seed hashing.

Texts are normalised (Unicode's NFKC, lower case, ß as ss; a character above
127 that is no letter, mark or number is a blank) and become tokens (maximal
runs of letters, digits and marks). Fixed masks of ``SPAN`` tokens hash the
positions they name and ignore the others, so a hash survives substituted
tokens at ignored positions. Training hashes meet the test hashes in a join;
around every hit the aligned tokens of both sides are compared, and the hit
counts if some stretch of at least ``min_tokens`` aligned tokens (the whole
item if it is shorter) agrees in at least ``min_share`` of its positions.

The test side is hashed once. Its hashes also set bits in a filter of fixed
size (``FILTER_BITS``), so that the training side hands to the join only hashes
that can meet one; a full filter lets more through and loses none. Neither side
is ever sent whole to the driver or to all executors: the join partner is
chosen by Spark's own size check.

Defined cases: null and empty texts have no tokens and match nothing; an item
of fewer than ``min_tokens`` tokens counts when its whole length agrees, and an
item shorter than ``SPAN`` tokens when it is there word for word; a row
repeated in either table gives the same pair once; rows with a null id are
judged, and shown with a null id; extra columns do no harm.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, free_name, stored, tidy, value_bytes

#: 1: the position counts, 0: it is ignored. For any two substitutions inside 13
#: aligned tokens, some mask of the first four at some offset ignores both. With
#: the others this holds for every stretch of 11 to 29 tokens that begins and
#: ends equal with at most a fifth substituted, so for longer ones too: cut into
#: parts of 15 to 29 tokens, some part has at most a fifth.
MASKS = ("10110110101", "10001111011", "11111001001", "11010100111", "11110111000", "11100011101", "10010011111",
         "11111100001", "10101101110", "11001110101", "11111010100")
SPAN = 11
MIN_TOKENS = 13
MIN_SHARE = 0.8
AROUND = 64                    # tokens kept on each side of a hit
SALTS = 16                     # tasks that the rows of one text are spread over
FILTER_BITS = 1 << 26
SLICE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)                   # odd, so it has an inverse modulo 2**64
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; the longest table so far is kept."""
    have = _TABLES.get(int(base))
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[:1] = 1
        _TABLES[int(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, n + 1 token offsets of the documents)."""
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True                                   # tokens end with their document
    prior = np.concatenate(([False], word[:-1]))
    start = np.flatnonzero(word & (~prior | edge))
    end = np.flatnonzero(prior & (~word | edge))
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOW[data].astype(np.uint64) + np.uint64(1)) * _powers(_P, n), out=total[1:])
    back = _powers(_P_INV, n)
    h = (total[end] - total[start]) * back[start]
    return _mix(h + (end - start).astype(np.uint64)), np.searchsorted(start, off)


def folded(texts: pa.Array) -> pa.Array:
    """Texts in one letter case and Unicode form, with blanks for separators above 127; ASCII ones are left to ``tokens``."""
    plain = pc.string_is_ascii(texts)
    if pc.all(plain).as_py() is not False:
        return texts
    # composed once more: the lower case of a letter may be several characters
    low = pc.utf8_normalize(pc.utf8_lower(pc.utf8_normalize(texts, "NFKC")), "NFKC")
    low = pc.replace_substring(pc.replace_substring(low, "ß", "ss"), "ς", "σ")
    return pc.replace_substring_regex(low, r"[^\x00-\x7F\pL\pM\pN]+", " ")


def seeds(tok: np.ndarray, off: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of ``mask`` at every place where it fits into one document."""
    span = len(mask)
    if len(tok) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(tok) - span + 1
    h = np.full(m, number + 1, np.uint64)
    for k in range(span):
        if mask[k] == "1":
            h = (h ^ tok[k:k + m]) * _P
    last = np.repeat(off[1:], np.diff(off))[:m]
    at = np.flatnonzero(np.arange(m) + span <= last)
    return at, _mix(h[at])


def _common(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(key).cast("long").alias("row_id"), F.xxhash64(body).alias("row_tag"), F.make_valid_utf8(body).alias("body"))


def _items(test: DataFrame, key: str, text: str) -> DataFrame:
    """(row_id, row_tag, toks): the token hashes of every test item that has any."""
    @tidy
    def run(batches):
        for b in byte_slices(batches, "body", SLICE_BYTES):
            tok, off = tokens(*value_bytes(folded(b.column(2))))
            rows = np.flatnonzero(np.diff(off))
            toks = [tok[off[k]:off[k + 1]].tobytes() for k in rows.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)),
                                              pa.array(toks, pa.binary())], names=["row_id", "row_tag", "toks"])

    return _common(test, key, text).distinct().mapInArrow(run, "row_id long, row_tag long, toks binary")


def _item_seeds(items: DataFrame) -> DataFrame:
    """(h, item, item_tag, t_at) of every seed of every item; a short item has one seed, its whole."""
    @tidy
    def run(batches):
        for b in batches:
            out = []
            for i, t, toks in zip(*(b.column(k).to_pylist() for k in range(3))):
                tok = np.frombuffer(toks, np.uint64)
                off = np.array([0, len(tok)])
                own = list(enumerate(MASKS)) if len(tok) >= SPAN else [(len(MASKS) + len(tok), "1" * len(tok))]
                for number, mask in own:
                    at, h = seeds(tok, off, mask, number)
                    out += [(x, i, t, y) for x, y in zip(h.view(np.int64).tolist(), at.tolist())]
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                                             names=["h", "item", "item_tag", "t_at"])

    return items.mapInArrow(run, "h long, item long, item_tag long, t_at int")


def _spots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the filter for each hash."""
    low = np.uint64(bits - 1)
    return h & low, (h >> np.uint64(32)) & low


def _filter(probes: DataFrame, bits: int) -> np.ndarray:
    """Bit map of the places that the test hashes name; ``bits`` (a power of two) is its size."""
    spot = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)),
                             F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1)))).alias("bit")
    words = (probes.select(spot).groupBy(F.shiftright("bit", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v"))).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return out


def _stretches(keyed: DataFrame, passes, short: list[int]) -> DataFrame:
    """Parts of texts around seeds that pass the filter: tokens and the (hash, place) of their seeds.

    Places are counted from the stretch's first token. Seeds nearer than
    ``2 * AROUND`` tokens share a stretch.
    """
    masks = list(enumerate(MASKS)) + [(len(MASKS) + n, "1" * n) for n in short]

    @tidy
    def run(batches):
        bits = passes.value
        for b in byte_slices(batches, "body", SLICE_BYTES):
            tok, off = tokens(*value_bytes(folded(b.column(2))))
            found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
            for number, mask in masks:
                at, h = seeds(tok, off, mask, number)
                for k in range(2):
                    spot = _spots(h, len(bits) * 64)[k]
                    hit = (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
                    at, h = at[hit], h[hit]
                found.append((at, h))
            at = np.concatenate([x[0] for x in found])
            h = np.concatenate([x[1] for x in found])
            o = np.argsort(at, kind="stable")
            at, h = at[o], h[o]
            doc = np.searchsorted(off, at, side="right") - 1
            new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (np.diff(at) > 2 * AROUND)))) if len(at) else at
            end = np.append(new[1:], len(at))
            rows, toks, found = [], [], []
            for a, z in zip(new.tolist(), end.tolist()):
                d = doc[a]
                first, last = max(off[d], at[a] - AROUND), min(off[d + 1], at[z - 1] + SPAN + AROUND)
                rows.append(d)
                toks.append(tok[first:last].tobytes())
                found.append([{"h": x, "at": y} for x, y in zip(h[a:z].view(np.int64).tolist(), (at[a:z] - first).tolist())])
            base = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(base), b.column(1).take(base), pa.array(toks, pa.binary()),
                 pa.array(found, pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))],
                names=["row_id", "row_tag", "toks", "seeds"])

    return keyed.mapInArrow(run, "row_id long, row_tag long, toks binary, seeds array<struct<h: long, at: int>>")


def overlap(train: np.ndarray, test: np.ndarray, shift: int, min_tokens: int, min_share: float) -> tuple[int, int]:
    """(tokens, equal tokens) of the longest good stretch when ``train[k + shift]`` meets ``test[k]``, or zeros.

    A stretch is good if it has at least ``min_tokens`` positions (all of a
    shorter test item), begins and ends with equal tokens, and agrees in at
    least ``min_share`` of them.
    """
    a, b = train[max(shift, 0):], test[max(-shift, 0):]
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    ends = np.flatnonzero(same)
    if not len(ends):
        return 0, 0
    # with gain = equal - min_share each: the first place whose running gain is not above the end's
    gain = np.concatenate(([0.0], np.cumsum(same - min_share)))
    least = np.minimum.accumulate(gain[ends])
    begin = ends[np.searchsorted(-least, -(gain[ends + 1] + 1e-9))]
    size = ends - begin + 1
    total = np.concatenate(([0], np.cumsum(same)))
    equal = total[ends + 1] - total[begin]
    best = np.lexsort((equal, size))[-1]
    return (int(size[best]), int(equal[best])) if size[best] >= min(min_tokens, len(test)) else (0, 0)


def contaminated(docs: DataFrame, test: DataFrame, key: str = "doc_id", text: str = "text", test_key: str = "item_id",
                 test_text: str = "text", min_tokens: int = MIN_TOKENS, min_share: float = MIN_SHARE) -> DataFrame:
    """(row_id, row_tag, item, n_tokens, n_equal, n_item): pairs of a document and a test item that it holds.

    ``row_tag`` is the hash of the text. One row a pair: its longest stretch.
    """
    spark = docs.sparkSession
    items = stored(_items(test, test_key, test_text), "spaced-items")
    probes = stored(_item_seeds(items), "spaced-seeds")
    length = (F.octet_length("toks") / 8).cast("int")
    short = sorted(r[0] for r in items.where(length < SPAN).select(length).distinct().collect())     # at most SPAN - 1 values
    passes = spark.sparkContext.broadcast(_filter(probes, FILTER_BITS))
    train = stored(_stretches(_common(docs, key, text), passes, short).withColumn("part", F.xxhash64("toks")), "spaced-train")
    # copies of a text agree in all their parts: each is met and verified once, whatever the number of its rows
    parts = stored(train.groupBy("row_tag", "part").agg(F.first("seeds").alias("seeds"), F.first("toks").alias("a")), "spaced-parts")
    met = (parts.select("row_tag", "part", F.explode("seeds").alias("s"))
           .select("row_tag", "part", F.col("s.h").alias("h"), F.col("s.at").alias("at")).join(probes, "h")
           .select("row_tag", "part", "item", "item_tag", (F.col("at") - F.col("t_at")).alias("shift")).distinct())
    tests = items.select(F.col("row_id").alias("i2"), F.col("row_tag").alias("item_tag"), F.col("toks").alias("b"))
    pairs = (met.join(parts.select("row_tag", "part", "a"), ["row_tag", "part"]).join(tests, ["item_tag"])
             .where(F.col("item").eqNullSafe(F.col("i2"))))

    @F.pandas_udf("n_tokens int, n_equal int")
    def verified(a, b, shift):
        out = [overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), z, min_tokens, min_share)
               for x, y, z in zip(a, b, shift)]
        return pd.DataFrame(out, columns=["n_tokens", "n_equal"])

    n_item = (F.octet_length("b") / 8).cast("int")
    checked = (pairs.select("row_tag", "item", "item_tag", n_item.alias("n_item"), verified("a", "b", "shift").alias("got"))
               .where("got.n_tokens > 0"))
    best = checked.groupBy("row_tag", "item", "item_tag", "n_item").agg(F.max("got").alias("got"))
    # back to the rows, those of one text over all salts
    salt = F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int")
    rows = train.select("row_id", "row_tag").distinct().withColumn("salt", salt)
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(best, ["row_tag", "salt"]).select("row_id", "row_tag", "item", "got.n_tokens", "got.n_equal", "n_item")


def without_contaminated(docs: DataFrame, test: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Rows of ``docs`` that hold no test item, with the columns of ``docs``."""
    bad = contaminated(docs, test, key, text, **how)
    i, t = free_name(docs.columns, "bad_id"), free_name(docs.columns, "bad_tag")
    bad = bad.select(F.col("row_id").alias(i), F.col("row_tag").alias(t)).distinct()
    return docs.join(bad, F.col(key).cast("long").eqNullSafe(F.col(i))
                     & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(t)), "left_anti")
