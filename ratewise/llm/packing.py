"""Packing tokenised documents into sequences of fixed length: bounded-space online best fit.

Documents are tokenised where they are read; only piece digests are shuffled. Pieces meet in groups of a
fixed expected size, dealt by a hash, so no task grows with the table and no key can be hot. In a group they
arrive longest first and go to open bins that sit in a bitset by free space: the fitting bin with the least
space is the lowest set bit at or above the length. If none fits and all bins are open, the fullest closes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import chunks

END = 2
SEQUENCE = 1024
#: Documents to a packing group, and bins that a group keeps open.
GROUP_DOCS = 16_384
OPEN_BINS = 8_192
#: Beyond these letters two libraries may sort a character into different classes.
_OTHER_SCRIPTS = re.compile("[^\x00-ɏ]")
#: tiktoken fails on runs of white space a little over ten times as long.
LONGEST_SPACE = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def encoder(name: str, special: bool = False):
    """A function from text to token ids as uint32. `special`: special tokens written in a text are their one id,
    as in the library's plain call; without it they are text like any other.

    `tokenizers` defines the ids. `tiktoken` holds the same vocabulary as ranks and is several times faster;
    it serves texts of scripts for which both split alike (tests compare them), without very long white space.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    made: list[Tokenizer] = []

    def slow() -> Tokenizer:
        if not made:
            made.append(Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
            made[0].encode_special_tokens = not special
        return made[0]

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    tokens = [t.content for t in slow().get_added_tokens_decoder().values()] if special else []

    def ids(text: str) -> np.ndarray:
        long_space = len(text) > LONGEST_SPACE and max(map(len, re.findall(r"\s+", text)), default=0) > LONGEST_SPACE
        if long_space or _OTHER_SCRIPTS.search(text) or any(t in text for t in tokens):
            return np.array(slow().encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return ids


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole ones of `size`, the first may be shorter."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, tokenizer: str = "byte_bpe_50k", special: bool = False) -> DataFrame:
    """The ids of every text, then an end id, in pieces: doc_id, piece, start, length, ids (little-endian uint32).

    Null and empty texts give one piece with the end id alone. Rows with equal or null ids are documents of
    their own. An empty table gives no rows.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in chunks(batches):
            rows: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(END)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    for column, value in zip(rows, (doc, k, start, length, ids[start : start + length].tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(kernel, PIECES)


class OpenBins:
    """At most `limit` open bins, keyed by free space in a bitset."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        chosen = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return chosen

    def put(self, length: int) -> tuple[int, int]:
        """The bin that takes the piece, and the place in it."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.count == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, chosen = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            self.count += 1
        return chosen, self.size - free


def pack(pieces: DataFrame, documents: int, size: int = SEQUENCE, open_bins: int = OPEN_BINS, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Adds sequence_id and offset to rows (doc_id, piece, start, length, ids_crc32).

    `documents` only sets the number of groups. Ties in length are taken by id, piece and content, so the
    result is the same for any partitioning; fully equal rows are interchangeable.
    """
    groups = max(1, math.ceil(documents / group_docs))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], kind="stable")
        bins, base = OpenBins(size, open_bins), int(group["g"].iloc[0]) << 32
        placed = [bins.put(n) for n in group["length"].tolist()]
        group["sequence_id"] = [base + b for b, _ in placed]
        group["offset"] = [o for _, o in placed]
        return group.drop(columns="g")

    dealt = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32"), F.lit(groups))
    return (
        pieces.select("doc_id", "piece", "start", "length", "ids_crc32", dealt.alias("g"))
        .groupBy("g")
        .applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, special: bool = False) -> DataFrame:
    """Where every piece of every document goes, with a checksum of its ids in place of the ids."""
    digests = token_pieces(docs, id_col, text_col, size, special=special).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digests, docs.count(), size)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (little-endian uint32), documents in order.

    Joins the pieces with their places; each sequence has a bounded length. Ids must identify documents.
    """
    where = placed.select(F.col("doc_id").alias("p_doc"), F.col("piece").alias("p_piece"), "sequence_id", "offset")
    both = pieces.join(where, pieces["doc_id"].eqNullSafe(where["p_doc"]) & (pieces["piece"] == where["p_piece"]))
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_, part: F.concat(all_, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
