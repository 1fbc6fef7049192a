"""Interaction of filters, from a sparse document-term matrix.

1. *Shards.* Every task cuts its documents into shards of at most
   ``SHARD_BYTES`` of text (one longer document is a shard of its own). A shard
   is a block of the document-term matrix in CSR form (``indptr``, ``indices``,
   ``counts``) over its own words, with the flags that need characters only.
2. *Dictionary.* The words of all shards are dealt out by bucket (a hash of the
   word), as one list for each shard and bucket. The task of a bucket numbers
   its words: a word's global id is its bucket and its place there.
3. *Encoding.* The ids go back to the shards, whose columns become global ids
   that ascend within a row.
4. *Decisions.* Row sums (words) and nonzero counts (distinct words) decide
   filters A and B; C and D come with the shard; E asks whether the smallest id
   of the text's digest is another one. The failures of a document are one
   number of five bits, so all that is left is counted by (part, bits, label).
5. *Orders.* What each of the 120 orders removes, and the Shapley sums, are
   sums over the 32 counts of a part.

Defined cases: a null text is empty (no words: it fails A, not B, C or D); a
null id has no place among ids, so its row neither fails E nor makes another
fail it; rows that repeat id and text count each by themselves and do not fail
E for each other; a null source is the empty string; a document with several
label rows counts as good (toxic) if one of them says so, a null label says
nothing; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shelfline.llm.common import byte_slices, range_hashes, stored, tidy, value_bytes

SHARD_BYTES = 8 << 20
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 2      # words; percent of the words; percent of the code points
SYMBOLS = b"#$%&*|"

DOCUMENT_FIELDS = "shard long, ids_of array<long>, parts array<string>, digests array<binary>, flags array<int>, "
SHARD_TYPE = DOCUMENT_FIELDS + "indptr array<int>, indices array<int>, counts array<int>, words array<string>"
PACKED_TYPE = DOCUMENT_FIELDS + "indptr binary, indices binary, counts binary, words string"
ROW_TYPE = "id long, part string, digest binary, flags int, n_words long, n_distinct long"


# ---------------------------------------------------------------- packed cells

def packed_ints(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of ``values`` from each offset of ``cut`` to the next: one binary value for each list."""
    at = pa.array(cut * values.itemsize, pa.int32()).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))])


def packed_words(lists: pa.ListArray) -> pa.Array:
    """The words of each list as one text, a line for each; no word holds a line break."""
    return pc.binary_join(lists, "\n")


def ints_of(cells: pa.Array, kind: type) -> np.ndarray:
    """All numbers of an array of lists, or of packed lists."""
    if pa.types.is_list(cells.type):
        return cells.flatten().to_numpy()
    return value_bytes(cells)[0].view(kind)


def words_of(cells: pa.Array) -> pa.ListArray:
    """The lists of words of an array of lists, or of packed lists; none may be empty."""
    return cells if pa.types.is_list(cells.type) else pc.split_pattern(cells, "\n")


# ---------------------------------------------------------------- shards

def term_block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(indptr, indices, counts, words): the CSR block of ``texts`` over its own words."""
    split = pc.ascii_split_whitespace(texts)
    row, word = pc.list_parent_indices(split), pc.list_flatten(split)
    real = pc.greater(pc.binary_length(word), 0)
    coded = word.filter(real).dictionary_encode()
    row, code = row.filter(real).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64)
    cells, counts = np.unique(row << 32 | code, return_counts=True)
    indptr = np.searchsorted(cells, np.arange(len(texts) + 1, dtype=np.int64) << 32)
    return indptr, cells & 0xFFFFFFFF, counts, coded.dictionary


def character_flags(body: bytes) -> int:
    """Filters C (bit 2) and D (bit 3) of one text in UTF-8."""
    b = np.frombuffer(body, np.uint8)
    upper = int(np.count_nonzero((b >= 65) & (b <= 90)))
    points = int(np.count_nonzero((b & 0xC0) != 0x80))
    return (100 * upper > MAX_UPPER * points) << 2 | any(s in body for s in SYMBOLS) << 3


def _shards(docs: DataFrame, packed: bool = False) -> DataFrame:
    """The CSR shards of ``docs``; ``packed``: numbers and words of a shard are one value each, not arrays that
    Spark copies number by number at every step."""
    @tidy
    def run(batches):
        base, n = TaskContext.get().partitionId() << 32, 0
        for b in byte_slices(batches, "body", SHARD_BYTES):
            ids, parts, digests, body = (b.column(k) for k in range(4))
            indptr, indices, counts, words = term_block(body)
            flags = [character_flags(v.as_buffer().to_pybytes()) for v in body.cast(pa.binary() if body.type == pa.string()
                                                                                    else pa.large_binary())]
            row = [[base + n], [ids], [parts], [digests], [flags]]
            row = [pa.array(v, t) for v, t in zip(row, ARROW_SHARD.types)]
            block = [v.astype(np.int32) for v in (indptr, indices, counts)]
            if packed:
                row += [packed_ints(v, np.array([0, len(v)])) for v in block]
                row.append(packed_words(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)))
            else:
                row += [pa.array([v], pa.list_(pa.int32())) for v in block] + [pa.array([words], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(row, names=ARROW_SHARD.names)
            n += 1

    return docs.mapInArrow(run, PACKED_TYPE if packed else SHARD_TYPE)


ARROW_SHARD = pa.schema([("shard", pa.int64()), ("ids_of", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())),
                         ("digests", pa.list_(pa.binary())), ("flags", pa.list_(pa.int32())), ("indptr", pa.list_(pa.int32())),
                         ("indices", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))])


# ---------------------------------------------------------------- dictionary

def _by_bucket(shards: DataFrame, buckets: int) -> DataFrame:
    """(bucket, shard, pos, words), packed: the words of each shard, one row for each bucket that it has words of."""
    @tidy
    def run(batches):
        for b in batches:
            b = b.filter(pc.greater(size(b.column(1)), 0))       # a shard of empty texts has no words
            for k, shard in enumerate(b.column(0)):
                words = words_of(b.column(1).slice(k, 1)).flatten()
                data, off = value_bytes(words)
                bucket = (range_hashes(data, off[:-1], off[1:]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edge = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1))
                cut = np.concatenate((edge, [len(order)]))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words.take(pa.array(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[order[edge]]), pa.array(np.full(len(edge), shard.as_py())),
                     packed_ints(order.astype(np.int32), cut), packed_words(lists)],
                    names=["bucket", "shard", "pos", "words"])

    size = pc.list_value_length if isinstance(shards.schema["words"].dataType, ArrayType) else pc.binary_length
    return shards.select("shard", "words").mapInArrow(run, "bucket long, shard long, pos binary, words string")


def word_ids(shards: DataFrame, buckets: int, packed: bool = False) -> DataFrame:
    """(shard, pos, ids): the global ids of a shard's words, by bucket; ``packed``: as bytes (int, long).

    A word belongs to the bucket of its hash, and a bucket to one task, which
    numbers its words as they come: the id is (bucket, place). Every shard has
    about equally many words in each bucket, so a common word fills no task.
    """
    @tidy
    def run(batches):
        place: dict[str, int] = {}
        for b in batches:
            words = words_of(b.column(3))
            n = pc.list_value_length(words).to_numpy()
            coded = words.flatten().dictionary_encode()          # Python meets a word once a batch, not once a shard
            seen = coded.dictionary.to_pylist()
            own = np.fromiter((place.setdefault(w, len(place)) for w in seen), np.int64, len(seen))[coded.indices.to_numpy()]
            ids = np.repeat(b.column(0).to_numpy(), n) << 32 | own
            cut, pos = np.concatenate(([0], np.cumsum(n))), b.column(2)
            if packed:
                ids = packed_ints(ids, cut)
            else:
                cut = pa.array(cut, pa.int32())
                pos, ids = (pa.ListArray.from_arrays(cut, pa.array(v)) for v in (ints_of(pos, np.int32), ids))
            yield pa.RecordBatch.from_arrays([b.column(1), pos, ids], names=["shard", "pos", "ids"])

    return (_by_bucket(shards, buckets).repartition(buckets, "bucket")
            .mapInArrow(run, "shard long, pos binary, ids binary" if packed else "shard long, pos array<int>, ids array<long>"))


# ---------------------------------------------------------------- matrix

def encode_block(indptr: np.ndarray, indices: np.ndarray, counts: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Global (indices, counts) of a block; a row's columns ascend."""
    column = columns[indices]
    row = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    place = np.empty(len(columns), np.int64)                      # of a word among the shard's, by global id
    place[np.argsort(columns)] = np.arange(len(columns))
    order = np.argsort(row << 32 | place[indices])
    return column[order], counts[order]


def row_sums(indptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[indptr[1:]] - total[indptr[:-1]]


def document_terms(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """The packed CSR shards of ``docs(id, part, digest, body)`` with the global ids of their columns.

    ``buckets`` of the dictionary: as many as the session's shuffles have tasks.
    """
    shards = stored(_shards(docs, packed=True), "audit-shards")
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an id depends on the order of rows, so the numbering is written before it is used
    ids = stored(word_ids(shards, buckets, packed=True), "audit-ids")
    columns = ids.groupBy("shard").agg(F.collect_list("pos").alias("pos"), F.collect_list("ids").alias("ids"))
    # a shard of empty texts has no words and so no columns
    return shards.drop("words").join(columns, "shard", "left")


def blocks(batch: pa.RecordBatch):
    """Of each shard of the batch: (fields by name, indptr, global indices, counts)."""
    for k in range(batch.num_rows):
        row = {n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}
        indptr, indices, counts = (ints_of(batch.column(n).slice(k, 1), np.int32) for n in ("indptr", "indices", "counts"))
        columns = np.zeros(0, np.int64)
        if row["pos"].is_valid:
            pos = ints_of(row["pos"].values, np.int32)
            columns = np.empty(len(pos), np.int64)
            columns[pos] = ints_of(row["ids"].values, np.int64)
        yield row, indptr, *encode_block(indptr, indices, counts, columns)


def row_counts(matrix: DataFrame) -> DataFrame:
    """(id, part, digest, flags, n_words, n_distinct) of every document: row sums and nonzero counts."""
    @tidy
    def run(batches):
        for b in batches:
            for row, indptr, column, counts in blocks(b):
                new = np.ones(len(column), np.int64)             # equal columns stand side by side
                new[1:] = column[1:] != column[:-1]
                new[indptr[:-1][np.diff(indptr) > 0]] = 1
                yield pa.RecordBatch.from_arrays(
                    [row[n].values for n in ("ids_of", "parts", "digests", "flags")]
                    + [pa.array(row_sums(indptr, counts)), pa.array(row_sums(indptr, new))],
                    names=["id", "part", "digest", "flags", "n_words", "n_distinct"])

    return matrix.mapInArrow(run, ROW_TYPE)


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row a document: id, part, n_words, n_distinct, failed (bit k is filter k of ``FILTERS``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("body"))
    rows = stored(row_counts(document_terms(base)), "audit-rows")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("first", F.lit(1))
    bits = (F.col("flags") + (F.col("n_words") < MIN_WORDS).cast("int")
            + F.when(100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"), 2).otherwise(0)
            + F.when(F.col("id").isNotNull() & F.col("first").isNull(), 16).otherwise(0))
    # the join is on the id too, so copies of one text do not meet in one task
    return rows.join(firsts, ["id", "digest"], "left").select("id", "part", "n_words", "n_distinct", bits.alias("failed"))


# ---------------------------------------------------------------- orders

def _orders() -> Column:
    """All (filter_order, step, filter, bits of the filters before)."""
    rows = []
    for p in permutations(range(len(FILTERS))):
        for k, f in enumerate(p):
            rows.append({"filter_order": "".join(FILTERS[i] for i in p), "step": k + 1, "f": f,
                         "before": sum(1 << i for i in p[:k])})
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, f: int, before: int>>")


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit: one row per part, order of the filters and step.

    ``failed`` has (id, part, failed); ``labels`` has (doc_id, quality, toxic).
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    by_mask = (failed.join(marks, "id", "left").groupBy("part", "failed")
               .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                    F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    by_part = by_mask.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("masks"))    # 32 at most
    rows = by_part.select("part", "masks", F.explode(_orders()).alias("o")).select("part", "masks", "o.*")
    bit = F.expr("shiftleft(1, f)")

    def total(of: str, where) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(where(m["failed"]), m[of]).otherwise(0))

    fails = lambda m: m.bitwiseAND(bit) != 0                        # noqa: E731
    early = lambda m: m.bitwiseAND(F.col("before")) != 0            # noqa: E731
    removed = lambda m: fails(m) & ~early(m)                        # noqa: E731
    # of the filters that a document fails, each comes first in an equal share of the orders
    share = F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(
        fails(m["failed"]), m["n"] * 120 / F.bit_count(m["failed"])).otherwise(0).cast("long"))
    return rows.select("part", "filter_order", "step",
                       total("n", lambda m: ~fails(m) & ~early(m)).alias("kept"), total("n", removed).alias("removed"),
                       total("n", lambda m: fails(m) & early(m)).alias("redundant"),
                       total("n", lambda m: m == bit).alias("unique_fails"), total("good", removed).alias("good_lost"),
                       total("toxic", removed).alias("toxic_lost"), share.alias("shapley"))
