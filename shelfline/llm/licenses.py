"""License scan by diagonal voting.

1. *Hashes.* Every document gives the hash of each of its word k-grams with its
   place; so do the templates. The two meet in a join on the hash (the
   templates are a parameter of bounded size, checked before it is sent to all
   tasks), and each meeting votes for the diagonal: place in the document less
   place in the template.
2. *Diagonals.* Votes are counted by (document, template, diagonal).
   Neighbouring diagonals of a document and template, at most ``slack`` apart,
   are one candidate: words that were inserted or left out shift the rest of a
   text to a diagonal nearby. Candidates with fewer votes than any text within
   the allowed edits must have are dropped (every edit spoils k grams at most).
3. *Spans.* A candidate's words are aligned with its template. It holds if the
   best alignment needs at most ``edits`` insertions, deletions and
   replacements of words. Phrases allow no edit, so their places are exact.

Nothing is looked up outside the diagonals: a phrase's places are its verified
candidates, with one vote for each of its k-grams.

Defined cases: a null text is empty; a text without words has no label and
score 0; rows that repeat id and text have the same result; null ids are kept;
extra columns pass by; an empty table gives an empty result. A place may be
anywhere in a text of any length.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, free_name, mixed, range_hashes, stored, tidy, value_bytes

SLICE_BYTES = 1 << 20
K = 3
SHARE = 0.2                     # of a template's words may be edited
MAX_TEMPLATE_WORDS = 1_000_000  # what is sent to all tasks is bounded


class Template(NamedTuple):
    label: str
    text: str
    exact: bool = False         # a phrase: its words stand consecutively


#: Phrases that name a license.
PHRASES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]

#: The notices that the licenses themselves ask for, in their public wording.
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                    "documentation files"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http www apache org licenses LICENSE 2.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met"),
]
TEMPLATES = PHRASES + NOTICES


# ---------------------------------------------------------------- words

_CODES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
_IN_WORD = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)


def word_places(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(low, starts, ends, first): lower-cased bytes, the words' byte ranges, and the first word of each value (n + 1)."""
    low = _LOWER[data]
    inside = np.concatenate(([False], _IN_WORD[low], [False]))
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True                                       # words end with their value
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, off)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes."""
    m = max(0, len(words) - k + 1)
    out = np.zeros(m, np.uint64)
    for i in range(k):
        out = mixed(out + words[i:i + m] * np.uint64(2 * i + 1))
    return out


def words_of(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    low, starts, ends, _ = word_places(data, np.array([0, len(data)]))
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def edits_of(template: Template, n: int) -> int:
    return 0 if template.exact else int(SHARE * n)


# ---------------------------------------------------------------- votes

def _grams(docs: DataFrame, k: int) -> DataFrame:
    """(id, tag, place, h): every k-gram of ``docs(id, tag, body)``."""
    @tidy
    def run(batches):
        for b in byte_slices(batches, "body", SLICE_BYTES):
            data, off = value_bytes(b.column(2))
            low, starts, ends, first = word_places(data, off)
            h = gram_hashes(range_hashes(low, starts, ends), k)
            doc = np.repeat(np.arange(b.num_rows), np.diff(first))
            own = doc[:len(h)] == doc[k - 1:]             # all words in one document
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc[at])), b.column(1).take(pa.array(doc[at])), pa.array(at - first[doc[at]]),
                 pa.array(h[at].view(np.int64))], names=["id", "tag", "place", "h"])

    return docs.mapInArrow(run, "id long, tag long, place long, h long")


def _template_table(spark, templates: list[Template], k: int) -> DataFrame:
    """(h, t, at): the k-grams of the templates."""
    rows, total = [], 0
    for t, template in enumerate(templates):
        data = np.frombuffer(template.text.encode(), np.uint8)
        low, starts, ends, _ = word_places(data, np.array([0, len(data)]))
        total += len(starts)
        if len(starts) < k or len(starts) - k + 1 - k * edits_of(template, len(starts)) < 1:
            raise ValueError(f"template {t} is too short for {k}-grams and its edits")
        rows += [(int(h), t, p) for p, h in enumerate(gram_hashes(range_hashes(low, starts, ends), k).view(np.int64))]
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError("templates are too large to be sent to all tasks")
    return spark.createDataFrame(rows, "h long, t int, at int")


def candidates(docs: DataFrame, templates: list[Template] = TEMPLATES, k: int = K) -> DataFrame:
    """(id, tag, t, low, high): merged diagonals of ``docs(id, tag, body)`` with enough votes for their template."""
    grams = _template_table(docs.sparkSession, templates, k)
    votes = (_grams(docs, k).join(F.broadcast(grams), "h")
             .groupBy("id", "tag", "t", (F.col("place") - F.col("at")).alias("diagonal"))
             .agg(F.countDistinct("at").alias("votes")))  # rows that repeat a document vote once
    sizes = [(len(words_of(x.text)), x) for x in templates]
    need = F.array(*[F.lit(n - k + 1 - k * edits_of(x, n)) for n, x in sizes])
    slack = F.array(*[F.lit(edits_of(x, n)) for n, x in sizes])
    here = "PARTITION BY id, tag, t ORDER BY diagonal"    # at most the votes of one document
    apart = votes.withColumn("new", (F.col("diagonal") - F.expr(f"lag(diagonal) OVER ({here})") <= F.get(slack, F.col("t"))).cast("int"))
    groups = apart.withColumn("g", F.expr(f"sum(1 - coalesce(new, 0)) OVER ({here})"))
    return (groups.groupBy("id", "tag", "t", "g").agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"),
                                                      F.max("diagonal").alias("high"))
            .where(F.col("votes") >= F.get(need, F.col("t"))).select("id", "tag", "t", "low", "high"))


# ---------------------------------------------------------------- spans

def best_alignment(pattern: list[bytes], span: list[bytes]) -> tuple[int, int]:
    """(edits, end): the fewest word edits that turn ``pattern`` into a stretch of ``span``, and where the first such stretch ends.

    Columns of the edit table are kept as two bit masks of differences.
    """
    n = len(pattern)
    where: dict[bytes, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, (n, 0)
    for j, w in enumerate(span):
        equal = where.get(w, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if score < best[0]:
            best = (score, j + 1)
    return best


def verified(text: str, found: list[tuple[int, int, int]], templates: list[tuple[list[bytes], int]]) -> list[tuple[int, int, int, int]]:
    """(template, first word, end, edits) of the candidates (template, low, high) that hold in ``text``."""
    words, out = words_of(text), []
    for t, low, high in found:
        pattern, edits = templates[t]
        a = max(0, low - edits) if edits else low
        if not edits:
            if words[a:a + len(pattern)] == pattern:
                out.append((t, a, a + len(pattern), 0))
            continue
        score, end = best_alignment(pattern, words[a:max(0, high + len(pattern) + edits)])
        if score <= edits:
            out.append((t, max(a, a + end - len(pattern)), a + end, score))
    return sorted(out)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[Template] = TEMPLATES, k: int = K,
         out: str = "scan") -> DataFrame:
    """``docs`` plus the struct ``out``: n_words and spans of (t, label, exact, start, end, edits, share).

    ``start`` and ``end`` are places among the words (with edits, ``start`` is
    the template's length before ``end``); ``share`` is the part of the template's words without an edit.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("tag"), body.alias("body"))
    found = stored(candidates(keyed, templates, k).groupBy("id", "tag")
                   .agg(F.sort_array(F.collect_list(F.struct("t", "low", "high"))).alias("found")), "license-candidates")
    names = docs.columns
    i, t, f = (free_name(names, x) for x in ("scan_id", "scan_tag", "scan_found"))
    found = found.select(F.col("id").alias(i), F.col("tag").alias(t), F.col("found").alias(f))
    joined = docs.join(found, F.col(key).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(body) == F.col(t)), "left").drop(i, t)
    patterns = [(words_of(x.text), edits_of(x, len(words_of(x.text)))) for x in templates]

    @F.pandas_udf("n_words long, spans array<struct<t: int, label: string, exact: boolean, start: long, end: long, edits: int, share: double>>")
    def spans(bodies: pd.Series, lists: pd.Series) -> pd.DataFrame:
        counts, rows = [], []
        for v, w in zip(bodies, lists):
            data = np.frombuffer(v.encode(), np.uint8)
            counts.append(len(word_places(data, np.array([0, len(data)]))[1]))
            hits = [] if w is None else verified(v, [(x["t"], x["low"], x["high"]) for x in w], patterns)
            rows.append([{"t": t, "label": templates[t].label, "exact": templates[t].exact, "start": a, "end": z, "edits": e,
                          "share": 1 - e / len(patterns[t][0])} for t, a, z, e in hits])
        return pd.DataFrame({"n_words": counts, "spans": rows})

    return joined.withColumn(out, spans(body, F.col(f))).drop(f)
