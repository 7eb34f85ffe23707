"""Packing by power-of-two decomposition.

A document's ids, closed by one end id, are cut into pieces whose lengths are powers of two: as many
of the longest allowed length as fit, then the binary digits of the rest, longest first.  Each piece
is a sequence of its own, so no sequence crosses documents and none is padded; pieces of equal
length form a bucket from which batches of one shape are drawn.

Every document is handled where it is read: there is no shuffle, and a hot source or group of copies
costs no task more than its share of rows.

Defined results: a null or empty text is the single end id; repeated rows give repeated pieces under
sequence ids of their own; a null id stays null; an empty table gives no pieces; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import binascii
import json
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows
from quillwork.llm.bpe import PRE_TOKENS, Encoder, byte_letters, encoder

MAX_LENGTH = 2048
END_ID = 1


@lru_cache(maxsize=2)
def fast_encoder(vocabulary: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizers JSON file in the form that encodes fastest.

    The ids of that file follow the order of its merges, so they serve as ranks.
    """
    spec, letters = json.loads(vocabulary), byte_letters()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): number
             for token, number in spec["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding("given", pat_str=PRE_TOKENS, mergeable_ranks=ranks,
                             special_tokens=added)


def token_ids(own: tiktoken.Encoding, slow: Encoder, text: str | None) -> np.ndarray:
    """Ids of a whole text without an end id."""
    try:
        ids = own.encode_to_numpy(text or "", allowed_special="all")
    except ValueError:  # a very long run of white space exceeds the stack of its pattern matcher
        ids = slow.encode(text)
    return ids.astype("<u4", copy=False)


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest``, in falling order."""
    rest = n % longest
    digits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (n // longest) + digits


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         longest: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length`` (its bucket), ``ids``
    (the piece itself, unless ``with_ids`` is false), ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset``.  Sequence ids are unique, and repeat when a task is repeated.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(texts: list[str | None]) -> Answer:
        own, slow = fast_encoder(shipped.value), encoder(shipped.value)
        end = np.array([end_id], "<u4")
        rows, starts, lengths, checks, totals, parts = [], [], [], [], [], []
        for row, text in enumerate(texts):
            ids = np.concatenate((token_ids(own, slow, text), end))
            raw, at = memoryview(ids.tobytes()), 0
            for length in piece_lengths(len(ids), longest):
                rows.append(row)
                starts.append(at)
                lengths.append(length)
                checks.append(binascii.crc32(raw[4 * at:4 * (at + length)]))
                totals.append(len(ids))
                if with_ids:
                    parts.append(ids[at:at + length].astype("i4"))
                at += length
        return rows, {"start": starts, "length": lengths, "ids_crc32": checks, "doc_tokens": totals,
                      "ids": parts}

    schema = "start long, length long, ids_crc32 long, doc_tokens long"
    pieces = map_rows(docs, id_col, [F.col(text_col)], schema + ", ids array<int>" * with_ids, cut)
    return pieces.withColumns({
        "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"),
    })


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store pieces by length, so that a reader draws batches of one shape."""
    pieces.write.partitionBy("length").parquet(path)
