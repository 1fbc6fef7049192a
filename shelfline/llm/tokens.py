"""Token counts of a library tokenizer, computed in Arrow functions that return lengths only.

Texts are split at safe boundaries, and the distinct parts that a worker has
not met yet are encoded in batches of a fixed number of bytes; only their
lengths are kept, in a bounded memory, and one number a text is sent back. So
no batch depends on the longest text, and a part that occurs often is encoded
once.

A blank or line feed is a safe boundary for a vocabulary that drops white
space (``drops_blanks``): its pattern ends every word there, no normalization
combines a character with a blank, and no added token holds one. A vocabulary
that keeps white space has its texts encoded whole.

Defined cases: null and empty texts have no tokens; special strings inside a
text count as the library counts them by default; a text without a boundary is
one part; rows are independent, so repeated rows repeat their result; extra
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import byte_slices, tidy

VOCABULARY = "word_bpe_49k.json"
BATCH_BYTES = 1 << 20
KNOWN_MAX = 400_000            # parts whose length a worker remembers
KNOWN_CHARS = 64               # longer parts are not remembered


@lru_cache(maxsize=2)
def load(path: str):
    """The library's counter for a vocabulary file: texts in, token counts out."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark shares out the cores
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_padding()
        tok.no_truncation()
        return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(e) for e in model.encode(texts, num_threads=1)]


class Counter:
    """Token counts of texts by the lengths of their parts."""

    def __init__(self, path: str, drops_blanks: bool):
        self.encode, self.drops_blanks, self.known = load(path), drops_blanks, {}

    def lengths(self, parts: list[str]) -> list[int]:
        """Library calls on batches of about ``BATCH_BYTES``."""
        out, group, size = [], [], 0
        for p in parts:
            group.append(p)
            size += len(p)
            if size >= BATCH_BYTES:
                out += self.encode(group)
                group, size = [], 0
        return out + (self.encode(group) if group else [])

    def count(self, texts: list[str]) -> list[int]:
        if not self.drops_blanks:
            return self.lengths(texts)
        split = [t.replace("\n", " ").split(" ") for t in texts]
        own = set().union(*split)
        new = [p for p in own if p not in self.known]
        if len(self.known) + len(new) > KNOWN_MAX:
            self.known, new = {}, list(own)            # the memory is full: start again with these
        self.known.update(zip(new, self.lengths(new)))
        out = [sum(map(self.known.__getitem__, parts)) for parts in split]
        for p in new:
            if len(p) > KNOWN_CHARS:
                del self.known[p]
        return out


def token_counts(docs: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None,
                 drops_blanks: bool = True) -> DataFrame:
    """``docs`` with ``out`` in place of the text. ``drops_blanks`` must say what the vocabulary does."""
    keep, path = [c for c in docs.columns if c != text], path or public_tokenizers.path(VOCABULARY)
    schema = docs.select(*keep).withColumn(out, F.lit(0).cast("long")).schema

    @tidy
    def run(batches):
        counter = Counter(path, drops_blanks)
        for b in byte_slices(batches, text, BATCH_BYTES):
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep]
                                             + [pa.array(counter.count(texts), pa.int64())], names=keep + [out])

    return docs.select(*keep, text).mapInArrow(run, schema)
