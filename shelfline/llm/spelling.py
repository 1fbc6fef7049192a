"""Spelling variants: words one edit apart, found by pairs of trie nodes.

1. *Words.* Maximal runs of Latin letters, lower-cased in A-Z, are counted over
   the corpus; a part of the occurrences (the hash of document and word is
   divisible by ``one_in``) loses a letter first. The words that are long and
   common enough are sorted, and their place in code-point order is their number.
2. *Nodes.* The prefixes of a word are nodes of the trie of all words, its
   suffixes nodes of the trie of the reversed words. A node's number is the hash
   of its walk from the root; one grouped pass over all nodes proves with a
   second hash that no number is used twice, else another seed is taken.
   So equal numbers mean equal prefixes (suffixes), and no word is compared.
3. *Pairs.* A word of n letters gives a pair (prefix node, suffix node) for each
   letter that is skipped and for each place where a letter could be inserted.
   Words that share a pair by skipping have one letter replaced; a word that
   skips a letter meets the word without it at its insertion place. A letter of
   a run of equal ones is skipped for a shorter word only once, at the run's
   end, so every two neighbours meet exactly once.
4. *Groups.* The words of one pair differ in one letter of one place, so a
   group has at most one row for each letter of the alphabet (90) and one more.
   Its counts and best members answer all its rows without pairs of them.
5. *Roots.* A word's form is its most common neighbour if that is common
   enough; forms grow by ``ratio`` at every step, and roots are found by
   doubling steps.

Defined cases: null and empty texts and texts without letters have no words; a
null id hashes as the empty string; repeated rows count each by itself; a word
may be as long as a text (its rows hold numbers, not strings); extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, mixed, stored, tidy

SLICE_BYTES = 2 << 20
HELD = 200_000                                            # distinct words a task counts before it sends them on
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")         # UTF-8 of a-z and U+00C0-U+00FF
SKIP, SKIP_ONLY_REPLACED, INSERT = 0, 1, 2


# ---------------------------------------------------------------- words

def words_of(key: int | None, body: bytes, min_length: int, one_in: int) -> Counter:
    """Counts of the words of one text that have ``min_length`` code points after a loss of letters."""
    out: Counter = Counter()
    start = zlib.crc32((b"" if key is None else b"%d" % key) + b":")
    for run, n in Counter(RUNS.findall(body.lower())).items():
        if len(run) < min_length:
            continue
        h = zlib.crc32(run, start)
        if h % one_in == 0:
            text = run.decode()
            k = h % len(text)
            run = (text[:k] + text[k + 1:]).encode()
        # continuation bytes are no code points
        if len(run) - run.count(b"\xc3") >= min_length:
            out[run] += n
    return out


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5,
                one_in: int = 199) -> DataFrame:
    """(word, n) of all words that are long and common enough."""
    base = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))

    @tidy
    def run(batches):
        total: Counter = Counter()

        def sent():
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()),
                                                pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for b in byte_slices(batches, "body", SLICE_BYTES):
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                total.update(words_of(i, v.as_buffer().to_pybytes(), min_length, one_in))
            if len(total) > HELD:
                yield sent()
        yield sent()

    return (base.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


# ---------------------------------------------------------------- trie nodes

def walk(letters: np.ndarray, seed: int) -> np.ndarray:
    """Numbers of the nodes on the way of ``letters`` from the root, the root first (as signed words).

    A number is a polynomial of the letters so far, mixed with their count.
    """
    n = len(letters)
    base = np.uint64(2 * seed * 0x9E3779B97F4A7C15 + 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF | 1)
    up = np.full(n + 1, base, np.uint64)
    up[0] = 1
    up = np.cumprod(up, dtype=np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(letters.astype(np.uint64) + np.uint64(seed * 0x51_7CC1B7 + 1)) * up[:n], out=total[1:])
    return mixed(total ^ np.arange(n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)).view(np.int64)


def _letters(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32)


def _by_word(words: DataFrame, rows_of, schema: str) -> DataFrame:
    """``rows_of(number, n, letters)`` gives the columns of a word's rows; batches of about 100,000 rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    @tidy
    def run(batches):
        held, size = [], 0
        for b in batches:
            for number, n, word in zip(*(b.column(k).to_pylist() for k in range(3))):
                held.append(rows_of(number, n, _letters(word)))
                size += len(held[-1][0])
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    return words.select("number", "n", "word").mapInArrow(run, schema)


def nodes(words: DataFrame, seed: int) -> DataFrame:
    """(side, node, other): the numbers of all nodes, each with a second hash of its walk."""
    def rows_of(_number, _n, letters):
        back = letters[::-1]
        m = len(letters) + 1
        return (np.repeat(np.array([0, 1], np.int32), m), np.concatenate((walk(letters, seed), walk(back, seed))),
                np.concatenate((walk(letters, seed + 1), walk(back, seed + 1))))

    return _by_word(words, rows_of, "side int, node long, other long")


def numbering(words: DataFrame, seed: int = 1) -> int:
    """A seed that numbers all nodes of both tries without using a number twice."""
    while True:
        # roots and short prefixes are shared by many words, so they are grouped before they move
        twice = nodes(words, seed).groupBy("side", "node").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b")
        if twice.isEmpty():
            return seed
        seed += 2


def node_pairs(words: DataFrame, seed: int) -> DataFrame:
    """(prefix, suffix, kind, number, n): the pairs of every word by skipping a letter and at every place between."""
    def rows_of(number, n, letters):
        m = len(letters)
        head, tail = walk(letters, seed), walk(letters[::-1], seed)[::-1]     # tail[i] is the suffix from i
        kind = np.full(2 * m + 1, INSERT, np.int32)
        kind[:m] = SKIP
        kind[:m - 1][letters[:-1] == letters[1:]] = SKIP_ONLY_REPLACED
        return (np.concatenate((head[:m], head)), np.concatenate((tail[1:], tail)), kind, np.full(2 * m + 1, number),
                np.full(2 * m + 1, n))

    return _by_word(words, rows_of, "prefix long, suffix long, kind int, number long, n long")


# ---------------------------------------------------------------- neighbours

def neighbours(pairs: DataFrame) -> DataFrame:
    """(number, n_near, best): the count of a word's neighbours and the best one (n, -number) of them."""
    groups = (pairs.groupBy("prefix", "suffix")
              .agg(F.sort_array(F.collect_list(F.struct("n", (-F.col("number")).alias("rank"), "kind")), asc=False).alias("m"))
              .where(F.size("m") > 1))                                       # at most 91: see the docstring
    skips = F.filter("m", lambda x: x["kind"] != INSERT)
    rows = groups.select("m", skips.alias("skips"), F.filter("m", lambda x: x["kind"] == INSERT).alias("short"),
                         F.filter("m", lambda x: x["kind"] == SKIP).alias("longer"))
    rows = rows.select("skips", "short", "longer", F.explode("m").alias("x"))
    pick = lambda c: F.when(F.size(c) > 0, F.struct(F.get(c, F.lit(0))["n"].alias("n"), F.get(c, F.lit(0))["rank"].alias("rank")))
    others = F.filter("skips", lambda y: y["rank"] != F.col("x.rank"))
    mine = F.col("x.kind")
    # a replaced letter; and, unless the word skips inside a run of equal letters, the word without the letter
    less = F.when(mine == SKIP, F.col("short")).otherwise(F.slice("short", 1, 0))
    near = F.when(mine == INSERT, F.size("longer")).otherwise(F.size(others) + F.size(less))
    best = F.when(mine == INSERT, pick(F.col("longer"))).otherwise(F.greatest(pick(others), pick(less)))
    return (rows.select((-F.col("x.rank")).alias("number"), near.alias("near"), best.alias("best")).where("near > 0")
            .groupBy("number").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(number, root) for the links ``forms(number, form)``, whose chains have no cycle: every round doubles the steps."""
    cur = stored(forms.select("number", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = cur.select(F.col("number").alias("at"), F.col("root").alias("next"))
        nxt = stored(cur.join(on, F.col("root") == F.col("at"), "left")
                     .select("number", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                     "spelling-roots")
        if nxt.where("moved").isEmpty():
            return nxt.select("number", "root")
        cur = nxt.select("number", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5, one_in: int = 199,
             ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word that is long and common enough."""
    counts = word_counts(docs, key, text, min_length, min_count, one_in)
    # numbers ascend with the words: the tasks of a sort follow each other
    words = stored(counts.orderBy("word").select(F.monotonically_increasing_id().alias("number"), "word", "n"), "spelling-words")
    pairs = node_pairs(words, numbering(words))
    near = stored(neighbours(pairs).select("number", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.rank")).alias("best")),
                  "spelling-near")
    known = words.join(near, "number", "left").select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"))
    linked = stored(known.where("form IS NOT NULL"), "spelling-forms")
    ends = roots(linked)
    named = (linked.join(ends, "number")
             .join(words.select(F.col("number").alias("form"), F.col("word").alias("form_word")), "form")
             .join(words.select(F.col("number").alias("root"), F.col("word").alias("root_word")), "root")
             .select("number", F.col("form_word"), F.col("root_word")))
    return (known.join(named, "number", "left")
            .select("word", "n", "n_near", F.col("form_word").alias("form"), "form_n", F.coalesce("root_word", "word").alias("root")))
