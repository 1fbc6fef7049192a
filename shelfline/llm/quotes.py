"""Quotation linking: conversations rebuilt from messages that quote each other.

A line's quote level is the number of ``>`` marks at its start (blanks between
them allowed). Consecutive lines of one level form a block; blocks of level 1
or more are quoted passages, the others are the message's own text. Passages
are normalised (lower case, runs of white space as one blank) and hashed, and
so are the whole own text of every message, its paragraphs and its lines. A
passage joins the latest earlier message of its conversation whose own text
holds its hash. A passage of several lines may also be a trimmed quote: the
messages of its conversation hash every run of as many lines (blank ones left
out), and it joins the latest that holds its lines in a row. A message answers the origin of its least nested linked
passage (the latest of several); messages that answer each other, directly or
over others, are one thread. Conversations are laid out in reply order: by
thread (its first turn), then by turn, so every message follows the one it
answers; the text is the own text, without quotes and attribution lines.

No conversation is gathered in one task, however many rows it has: passages
and sources are first aggregated to one row for each (conversation, hash,
turn), the windows that look back hold at most 1,024 turns (the maximum of
the buckets before is an aggregate of its own), threads are components of the
links, and the layout is a range exchange.

Defined cases: a null text is empty; a message of quotes only has an empty own
text and keeps its place; rows repeated in all columns count once; messages of
one turn do not quote each other; a null conversation is one of its own, a
null turn comes first; a passage that nothing earlier holds has no origin, and
its message starts a thread; extra columns are left out; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import star_components, stored

BUCKET_BITS = 10               # 2**10 turns in one window
LOW = -(1 << 63)

_MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"^\s*(on\b.{0,200}\bwrote|.{1,80}\bwrote|am\b.{0,200}\bschrieb.{0,80}|le\b.{0,200}\bécrit)\s*:\s*$", re.I)


def level(line: str) -> tuple[int, str]:
    """(quote level, the line without its marks)."""
    m = _MARK.match(line)
    return (m.group(1).count(">"), line[m.end():]) if m else (0, line)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def digest(text: str) -> str | None:
    """Hash of the normalised text; nothing for a blank one."""
    n = normal(text)
    return hashlib.md5(n.encode()).hexdigest() if n else None


def blocks(text: str) -> list[tuple[int, str]]:
    """(level, text) of the runs of lines of one level; attribution lines before a quote are left out."""
    lines = [level(x) for x in (text or "").split("\n")]
    out: list[tuple[int, list[str]]] = []
    for k, (depth, line) in enumerate(lines):
        deeper = next((d for d, x in lines[k + 1:k + 3] if d or x.strip()), 0) > depth
        if deeper and _ATTRIBUTION.match(line):
            continue
        if out and out[-1][0] == depth:
            out[-1][1].append(line)
        else:
            out.append((depth, [line]))
    return [(d, "\n".join(x)) for d, x in out if d == 0 or any(y.strip() for y in x)]


def full_lines(text: str) -> list[str]:
    """The normalised lines that are not blank."""
    return [x for x in map(normal, text.split("\n")) if x]


def run_hashes(own: str, sizes) -> list[str]:
    """Hashes of the runs of ``own``'s lines that have one of ``sizes`` lines, as ``digest`` makes them of a quote."""
    lines = full_lines(own)
    return sorted({digest(" ".join(lines[k:k + n])) for n in sizes for k in range(len(lines) - n + 1)})


@F.pandas_udf(T.ArrayType(T.StringType()))
def runs_udf(own: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([run_hashes(x, s) for x, s in zip(own, sizes)])


def parsed(text: str) -> dict:
    """Own text, quoted passages (place, level, hash) and the hashes that others can quote."""
    found = blocks(text)
    own = re.sub(r"\n{3,}", "\n\n", "\n".join(x for d, x in found if d == 0)).strip()
    quotes = [{"place": k, "depth": d, "hash": digest(x), "text": x, "lines": len(full_lines(x))} for k, (d, x) in enumerate((d, x) for d, x in found if d)]
    parts = [own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]
    return {"own": own, "quotes": quotes, "hashes": sorted({h for h in map(digest, parts) if h})}


PARSED = T.StructType([
    T.StructField("own", T.StringType()),
    T.StructField("quotes", T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("depth", T.IntegerType()),
                                                      T.StructField("hash", T.StringType()), T.StructField("text", T.StringType()),
                                                      T.StructField("lines", T.IntegerType())]))),
    T.StructField("hashes", T.ArrayType(T.StringType()))])


@F.pandas_udf(PARSED)
def parse_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parsed(t) for t in texts], columns=["own", "quotes", "hashes"])


def messages(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, at, node, own, quotes, hashes): the distinct messages, parsed.

    ``at`` is the turn as a number that is never null, ``node`` names the message.
    """
    base = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                       F.coalesce(F.col(text), F.lit("")).alias("body")).dropDuplicates()
    return (base.withColumn("at", F.coalesce(F.col("turn").cast("long"), F.lit(LOW)))
            .withColumn("node", F.xxhash64(F.col("conv").isNull(), "conv", "at", "role", "body")).withColumn("p", parse_udf("body"))
            .select("conv", "turn", "role", "at", "node", "p.own", "p.quotes", "p.hashes"))


def origins(quoted: DataFrame, sources: DataFrame) -> DataFrame:
    """(conv, hash, at, origin): for the distinct (conv, hash, at) of passages the node of the latest earlier source, if any."""
    bucket = F.shiftright("at", BUCKET_BITS)
    held = sources.groupBy("conv", "hash", "at").agg(F.min("node").alias("node"))
    asked = quoted.select("conv", "hash", "at").distinct()
    source = F.struct("at", "node")
    rows = (held.select("conv", "hash", "at", source.alias("source"), F.lit(False).alias("ask"))
            .union(asked.select("conv", "hash", "at", F.lit(None).cast(held.select(source.alias("s")).schema["s"].dataType), F.lit(True)))
            .withColumn("bucket", bucket))
    # at most two rows a turn, the passage before the source, which it cannot quote
    inside = (Window.partitionBy("conv", "hash", "bucket").orderBy("at", F.col("ask").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    near = rows.withColumn("near", F.max("source").over(inside)).where("ask").select("conv", "hash", "at", "bucket", "near")
    # one row a bucket
    last = rows.groupBy("conv", "hash", "bucket").agg(F.max("source").alias("m"))
    back = Window.partitionBy("conv", "hash").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    far = last.withColumn("far", F.max("m").over(back)).select("conv", "hash", "bucket", "far")
    a, b = near.alias("a"), far.alias("b")
    met = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.hash") == F.col("b.hash"))
                 & (F.col("a.bucket") == F.col("b.bucket")))
    return met.select("a.conv", "a.hash", "a.at", F.coalesce("a.near", "b.far").alias("origin"))


def linked(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a message, laid out in reply order.

    (conv, turn, role, own, n_quotes, n_linked, max_depth, reply_turn, thread_turn, node): ``reply_turn``
    is the turn it answers, ``thread_turn`` the first turn of its thread (its own if it links to nothing).
    """
    found = stored(messages(rows, conv, turn, role, text), "quotes-parsed")
    quoted = (found.select("conv", "at", "node", F.explode("quotes").alias("q"))
              .select("conv", "at", "node", F.col("q.depth").alias("depth"), F.col("q.hash").alias("hash")))
    sources = found.select("conv", "at", "node", F.explode("hashes").alias("hash"))
    # only the sizes that some passage of the conversation has, two lines or more
    sizes = stored(found.select("conv", F.explode("quotes.lines").alias("n")).where("n > 1").groupBy("conv")
                   .agg(F.collect_set("n").alias("sizes")), "quotes-sizes")
    if not sizes.isEmpty():
        own, s = found.select("conv", "at", "node", "own").alias("m"), sizes.alias("s")
        runs = own.join(s, F.col("m.conv").eqNullSafe(F.col("s.conv"))).select("m.conv", "m.at", "m.node", F.explode(runs_udf("m.own", "s.sizes")).alias("hash"))
        sources = sources.union(runs)
    a, b = quoted.alias("a"), origins(quoted, sources).alias("b")
    met = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.hash") == F.col("b.hash")) & (F.col("a.at") == F.col("b.at")))
    per = stored(met.groupBy("a.node").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("b.origin").alias("n_linked"), F.max("a.depth").alias("max_depth"),
        F.max(F.when(F.col("b.origin").isNotNull(), F.struct((-F.col("a.depth")).alias("d"), F.col("b.origin").alias("o")))).alias("best")),
        "quotes-links")
    threads = star_components(per.where("best IS NOT NULL").select(F.col("node").alias("a"), F.col("best.o.node").alias("b")), "quotes-threads")
    known = found.select("conv", "turn", "role", "at", "node", "own").join(per, "node", "left").join(threads, "node", "left")
    root = F.coalesce("root", "node")
    first = (found.select("node", "at").join(threads, "node").groupBy("root").agg(F.min("at").alias("thread_at")))
    out = known.join(first, "root", "left").select(
        "conv", "turn", "role", "own", F.coalesce("n_quotes", F.lit(0)).cast("int").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"), F.coalesce("max_depth", F.lit(0)).alias("max_depth"),
        F.nullif(F.col("best.o.at"), F.lit(LOW)).alias("reply_turn"), F.coalesce("thread_at", "at").alias("thread_at"), root.alias("thread"),
        "at", "node")
    order = ["conv", "thread_at", "thread", "at", "node"]
    return (out.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("thread_turn", F.nullif(F.col("thread_at"), F.lit(LOW))).drop("thread_at", "at"))
