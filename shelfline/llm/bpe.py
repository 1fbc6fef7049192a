"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern. The first tier is a
minimal perfect hash over the vocabulary: a pre-token that is itself an entry
gets its id from one probe (and a comparison of the bytes). The second tier
merges the others: the bytes are a linked list, a heap holds the ranks of
neighbouring pairs, and the least rank, leftmost first, is merged until no
pair is an entry. Each distinct pre-token of a batch is resolved once and kept
in a bounded memory of the task.

Defined cases: null and empty texts have no ids; a text longer than
``WHOLE_CHARS`` is cut by the pattern piece by piece, never at a boundary of
its own; rows are independent, so repeated rows repeat their result; extra
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, tidy

VOCABULARY = "byte_bpe_50k.tiktoken"
SLICE_BYTES = 2 << 20
WHOLE_CHARS = 1 << 20
KNOWN_MAX = 400_000            # pre-tokens a task remembers


class PerfectHash:
    """Minimal perfect hash of distinct byte strings, level by level.

    At each level the keys that are left fall into a bit array; those alone in
    their place are settled, the others go on. A key's slot is the number of
    settled places before its own, so n keys fill the slots 0 to n - 1.
    """

    def __init__(self, keys: list[bytes]):
        left = self.hashes(keys)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys must be distinct")
        self.size, self.levels, base = len(keys), [], 0
        while len(left):
            at = self._place(left, len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(at, minlength=2 * len(left) + 1) == 1
            before = np.concatenate(([0], np.cumsum(alone)[:-1])) + base
            self.levels.append((alone, before))
            base += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def hashes(keys) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (h ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        return ((x ^ x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot of each key; for other strings any slot or -1."""
        h, out = self.hashes(keys), np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, before) in enumerate(self.levels):
            at = self._place(h[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = before[at[hit]]
            open_ = open_[~hit]
        return out


class Bpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        # Unicode white space, stated: the two regular-expression libraries differ on control characters
        blank = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{blank}").replace(r"\s", f"[{blank}]").replace(r"\S", f"[^{blank}]"))
        # the same pattern for texts of ASCII alone
        self.plain = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\t-\r\x20A-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]")
                                .replace(r"\p{N}", "[0-9]").replace(r"\s", r"[\t-\r\x20]").replace(r"\S", r"[^\t-\r\x20]"))
        self.entry = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.entry[i] = b
        keys = list(ranks)
        self.table = PerfectHash(keys)
        self.id_at = np.zeros(len(keys), np.int64)         # the id of the entry in each slot
        self.id_at[self.table.slots(keys)] = list(ranks.values())
        self.byte = [ranks[bytes([b])] for b in range(256)]
        # two entries that together are an entry: its rank, in the upper half
        self.pairs = {x << 32 | y: r << 32 for b, r in ranks.items() for k in range(1, len(b))
                      if (x := ranks.get(b[:k])) is not None and (y := ranks.get(b[k:])) is not None}
        self.first = [self.pairs.get(x << 32 | y, -1 << 32) for x in self.byte for y in self.byte]
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: a heap of pair ranks over the linked bytes.

        A heap entry is a rank and a place in one integer, so ties go to the
        left. An entry whose pair has changed since is passed over.
        """
        n, rank, pop, push, first = len(word), self.pairs.get, heapq.heappop, heapq.heappush, self.first
        part = [self.byte[b] for b in word]
        entry = [first[a << 8 | b] | i for i, (a, b) in enumerate(zip(word, word[1:]))]               # the valid entry of each place
        heap = [x for x in entry if x >= 0]
        heapq.heapify(heap)
        entry.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            x = pop(heap)
            i = x & 0xFFFFFFFF
            if entry[i] != x:
                continue
            r, j = x >> 32, after[i]
            part[i], part[j], entry[i], entry[j] = r, -1, -1, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := rank(r << 32 | part[k], -1)) >= 0:
                    entry[i] = q = q | i
                    push(heap, q)
            k = before[i]
            if k >= 0:
                entry[k] = q = rank(part[k] << 32 | r, -1 << 32) | k
                if q >= 0:
                    push(heap, q)
        return [p for p in part if p >= 0]

    def learn(self, words: list[str]) -> None:
        """Resolve new pre-tokens: first by the perfect hash, the misses by merging."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        slots = self.table.slots(raw)
        for w, b, i in zip(words, raw, np.where(slots >= 0, self.id_at[slots], -1).tolist()):
            ids = [i] if i >= 0 and self.entry[i] == b else self.merge(b)
            self.known[w] = pack(f"<{len(ids)}I", *ids)

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= WHOLE_CHARS:
            yield self.split.findall(text)
            return
        found = (m.group() for m in self.split.finditer(text))
        while some := list(islice(found, 1 << 16)):
            yield some

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; new pre-tokens of all are resolved together."""
        if any(len(t) > WHOLE_CHARS for t in texts):
            return [b"".join(self._coded([words])[0] for words in self.pieces(t)) for t in texts]
        return self._coded([(self.plain if t.isascii() else self.split).findall(t) for t in texts])

    def _coded(self, split: list[list[str]]) -> list[bytes]:
        own = set().union(*split)
        if new := [w for w in own if w not in self.known]:
            if len(self.known) + len(new) > KNOWN_MAX:
                self.known, new = {}, list(own)        # the memory is full: start again with these
            self.learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        return [b"".join(map(self.entry.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in coded]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The encoder of a rank file, once a worker."""
    return Bpe(path)


def _mapped(df: DataFrame, source: str, made: dict[str, str], path: str, work) -> DataFrame:
    """``df`` without ``source``, plus the columns ``made`` (name: type) that ``work(bpe, values)`` lists."""
    keep = [c for c in df.columns if c != source]
    schema = df.select(*keep).withColumns({c: F.lit(None).cast(t) for c, t in made.items()}).schema

    @tidy
    def run(batches):
        bpe = load(path)
        try:
            for b in byte_slices(batches, source, SLICE_BYTES):
                columns = work(bpe, b.column(b.schema.get_field_index(source)).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep] + columns, names=keep + [*made])
        finally:
            bpe.known = {}                             # a worker outlives its task

    return df.select(*keep, source).mapInArrow(run, schema)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with ``out`` in place of the text: its ids, 4 bytes each, little-endian."""
    return _mapped(_texts(docs, text), text, {out: "binary"}, path or public_tokenizers.path(VOCABULARY),
                   lambda bpe, texts: [pa.array(bpe.encode(texts), pa.binary())])


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with ``out`` (bytes) in place of the ids."""
    return _mapped(df, ids, {out: "binary"}, path or public_tokenizers.path(VOCABULARY),
                   lambda bpe, coded: [pa.array(bpe.decode(coded), pa.binary())])


def _digests(bpe: Bpe, texts: list[str]) -> list[pa.Array]:
    coded = bpe.encode(texts)
    back = bpe.decode(coded)
    return [pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([sha256(c).hexdigest() for c in coded], pa.string()),
            pa.array([sha256(t).hexdigest() for t in back], pa.string())]


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, then decoded from the ids, in one task."""
    return _mapped(_texts(docs.select(key, text), text), text, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
                   path or public_tokenizers.path(VOCABULARY), _digests)
