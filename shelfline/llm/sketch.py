"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below a fixed fraction of the hash
range. What it keeps depends on the text alone, so sketches of parts merge by
union, and the containment of one text in another is estimated from the hashes
they share, however unequal their lengths. Shingles are ``WORDS`` consecutive
words in lower case; a text of fewer words is one shingle, a text without
words has none.

Everything is made of DataFrame functions. Words are hashed once; a shingle's
hash combines its words' hashes.

Defined cases: null and empty texts have the empty sketch; two texts with equal
fingerprints have likeness 1 (the empty ones too), otherwise an empty sketch has
likeness 0 with any other; equal texts have equal fingerprints; a null id (as
which -2**63 counts) comes
last in the order of successors, equal ids follow one another by the hash of
their text, and rows equal in both share one successor; the last document is
followed by the first, so a single document follows itself; extra columns do no
harm; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored

WORDS = 5                      # words of a shingle
SCALE = 4                      # one hash in SCALE is kept
LOW = -(1 << 63)


def sketch(text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct shingle hashes below the threshold (signed longs)."""
    threshold = LOW + (1 << 64) // scale
    tokens = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.greatest(F.size(h) - F.lit(words - 1), F.lit(1))
        each = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(words)]))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(each)

    # one-element transform: the word hashes are computed once and named
    made = F.element_at(F.transform(F.array(hashed), shingles), 1)
    return F.array_sort(F.array_distinct(F.filter(made, lambda v: v < F.lit(threshold))))


def fingerprint(hashes: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(hashes, lambda v: F.lower(F.lpad(F.hex(v), 16, "0"))), "")


def merged(a: Column, b: Column) -> Column:
    """The sketch of two parts of a text, less the shingles across their border."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has, 0 to 1."""
    least = F.least(F.size(a), F.size(b))
    return (F.when(a == b, F.lit(1.0)).when(least == 0, F.lit(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / least).cast("double"))


def successors(keys: DataFrame) -> DataFrame:
    """(id, tag, n, next_id, next_tag) of distinct keys: the next one in descending order, the first after the last.

    The keys are dealt out by ranges and ordered inside each range; only the
    head of every range meets the others (one row a range, at most one range a
    shuffle partition).
    """
    order = [F.col("id").desc(), F.col("tag").desc()]
    ranged = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sketch-order")
    heads = ranged.groupBy("part").agg(F.max(F.struct("id", "tag")).alias("head"))
    first = heads.agg(F.min_by("head", "part").alias("first"))
    heads = (heads.withColumn("follows", F.lead("head").over(Window.orderBy("part"))).crossJoin(F.broadcast(first))
             .select("part", F.coalesce("follows", "first").alias("follows")))
    nxt = F.lead(F.struct("id", "tag")).over(Window.partitionBy("part").orderBy(*order))
    return (ranged.withColumn("nxt", nxt).join(F.broadcast(heads), "part").withColumn("nxt", F.coalesce("nxt", "follows"))
            .select("id", "tag", "n", F.col("nxt.id").alias("next_id"), F.col("nxt.tag").alias("next_tag")))


def compared_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                        scale: int = SCALE) -> DataFrame:
    """Every row's sketch beside that of its edited text and of its successor.

    The edited text is the text with its last third (of the code points,
    floor) replaced by as many first ones of the next document, or all of it.
    Returns (key, n_chars, own, edited, edited_hashes, next_hashes).

    The texts are exchanged once, by their key: a document hands the prefix
    and sketch that its predecessor needs to that predecessor's task, where
    its text already is. (Both uses of ``placed`` ask for the same columns of
    the texts, so Spark reuses their exchange.)
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LOW)).alias("id"), F.xxhash64(body).alias("tag"), body.alias("body"))
    keys = base.groupBy("id", "tag").agg(F.max(F.char_length("body")).cast("long").alias("n"))
    order = stored(successors(keys), "sketch-next")
    third = F.floor(F.col("n") / 3).cast("int")
    before = order.select(F.col("next_id").alias("id"), F.col("next_tag").alias("tag"), F.col("id").alias("to_id"),
                          F.col("tag").alias("to_tag"), third.alias("to_k"))
    plan = stored(order.select("id", "tag", "n", third.alias("k")).join(before, ["id", "tag"]), "sketch-plan")
    placed = base.join(plan, ["id", "tag"])
    handed = (placed.select(F.col("to_id").alias("id"), F.col("to_tag").alias("tag"), F.substr("body", F.lit(1), "to_k").alias("prefix"),
                            sketch(F.col("body"), words, scale).alias("next_hashes"))
              .groupBy("id", "tag").agg(F.first("prefix").alias("prefix"), F.first("next_hashes").alias("next_hashes")))
    edited = F.concat(F.substr("body", F.lit(1), (F.col("n") - F.col("k")).cast("int")), F.col("prefix"))
    made = placed.join(handed, ["id", "tag"]).select("id", F.col("n").alias("n_chars"), "body", edited.alias("edited"), "next_hashes")
    return made.select(F.nullif("id", F.lit(LOW)).cast(docs.schema[key].dataType).alias(key), "n_chars", "edited", sketch(F.col("body"), words, scale).alias("own"),
                       sketch(F.col("edited"), words, scale).alias("edited_hashes"), "next_hashes")
