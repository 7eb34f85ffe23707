"""Line de-duplication by range-partitioned hashes and per-document keep bitmaps.

Every line becomes (hash of its key, document, position).  Those rows are range-partitioned by hash
*and* document and sorted by hash, document, position, so a line found in a third of all documents
is spread over many partitions.  Each partition streams through its rows once, taking the first
occurrence of a hash in each document; a run that ends inside the partition is settled there, and
only the first and last runs, which may go on next door, are added up afterwards.  What comes back
is no text: a document that loses lines gets a zlib-compressed bitmap of the lines that stay.

A line's key is the line without white space at its ends and with A-Z in lower case; lines with an
empty key always stay.  Rows that agree in id and text are one document, and a line counts once for
each document.  Defined results: a null or empty text is one empty line; null ids are ids like any
other; an empty table gives an empty table; columns beside id and text are passed on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import free_name
from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import settle

# Fixed value: the white space stripped from both ends of a line.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
LINE, DOC = ["line_a", "line_b"], ["doc_a", "doc_b"]


def document_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that stand for an id and a text."""
    return [F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)).alias(name)
            for seed, name in enumerate(DOC)]


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """128-bit hashes and positions of the lines with a key, and the number of all lines."""
    lines = (text or "").encode().split(b"\n")
    keys = [(i, k) for i, x in enumerate(lines) if (k := x.strip(BLANKS).lower())]
    raw = b"".join(xxhash.xxh3_128_digest(k) for _, k in keys)
    hashes = np.frombuffer(raw, ">i8").astype("i8").reshape(-1, 2)
    return hashes, np.array([i for i, _ in keys], "i8"), len(lines)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line with a key: its hash, its document, its position.

    Rows repeated within a batch are taken once, so that many copies of one row stay few.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates(DOC)
            found = [line_hashes(t) for t in batch["text"]]
            if not found:
                continue
            sizes = [len(p) for _, p, _ in found]
            hashes = np.concatenate([h for h, _, _ in found])
            yield pd.DataFrame({
                "line_a": hashes[:, 0], "line_b": hashes[:, 1],
                "doc_a": np.repeat(batch["doc_a"].to_numpy(), sizes),
                "doc_b": np.repeat(batch["doc_b"].to_numpy(), sizes),
                "place": np.concatenate([p for _, p, _ in found]),
                "n_lines": np.repeat([n for _, _, n in found], sizes),
            })

    texts = docs.select(*document_key(id_col, text_col), F.col(text_col).alias("text"))
    return texts.mapInPandas(
        run, "line_a long, line_b long, doc_a long, doc_b long, place long, n_lines long")


def changes(values: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Where a row differs from the row above it; ``before`` is the row above the first."""
    out = np.ones(len(values), bool)
    out[1:] = (values[1:] != values[:-1]).any(axis=1)
    if before is not None:
        out[0] = (values[0] != before).any()
    return out


def run_counts(min_docs: int):
    """A pass over sorted rows that gives (hash, documents, first document, first place) of runs.

    Runs of fewer documents are left out unless they touch an end of the partition.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, open_run, at_edge = None, None, True
        for batch in batches:
            if batch.empty:
                continue
            rows = batch[[*LINE, *DOC, "place"]].to_numpy()
            new_line = changes(rows[:, :2], None if last is None else last[:2])
            new_doc = changes(rows[:, :4], None if last is None else last[:4])
            starts = np.flatnonzero(new_line)
            last = rows[-1]
            head = int(new_doc[:starts[0] if len(starts) else None].sum())
            if open_run is not None:
                open_run[2] += head
            if not len(starts):
                continue
            counts = np.add.reduceat(new_doc.astype("i8"), starts)
            runs = np.column_stack((rows[starts, :2], counts, rows[starts, 2:]))
            closed = runs[:-1][counts[:-1] >= min_docs]
            if open_run is not None:
                if at_edge or open_run[2] >= min_docs:
                    closed = np.vstack((open_run, closed))
                at_edge = False
            if at_edge and len(runs) > 1:
                closed = np.vstack((runs[0], closed)) if counts[0] < min_docs else closed
                at_edge = False
            open_run = runs[-1].copy()
            yield frame(closed)
        if open_run is not None:
            yield frame(open_run[None])

    def frame(runs: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(runs, columns=[*LINE, "docs", *DOC, "place"])

    return run


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents, with their first document and place."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*LINE, *DOC, "place"]
    runs = (
        lines.select(*order)
        .repartitionByRange(parts, *LINE, *DOC)
        .sortWithinPartitions(*order)
        .mapInPandas(run_counts(min_docs), "line_a long, line_b long, docs long, "
                                           "doc_a long, doc_b long, place long")
    )
    return (
        runs.groupBy(*LINE)
        .agg(F.sum("docs").alias("docs"), F.min(F.struct(*DOC, "place")).alias("first"))
        .filter(F.col("docs") >= min_docs)
    )


def keep_bitmap(n_lines: int, gone: np.ndarray) -> bytes:
    """One bit for each line, set where it stays; compressed."""
    bits = np.ones(n_lines, bool)
    bits[gone] = False
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(bitmap), "u1")
    return np.unpackbits(raw, count=n_lines, bitorder="little").astype(bool)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, keep_first: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_a, doc_b, n_lines, bitmap`` of the documents that lose lines.

    With ``keep_first`` the first occurrence, by document key and position, stays.  Writes the
    line hashes to the shared folder when it is called.
    """
    lines = settle(line_rows(docs, id_col, text_col))
    gone = lines.join(repeated_lines(lines, min_docs), LINE).select(
        *[lines[c] for c in DOC], lines["place"], "n_lines", "first")
    if keep_first:
        gone = gone.filter(F.struct(*DOC, "place") != F.col("first"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            maps = [keep_bitmap(n, p) for n, p in zip(batch["n_lines"], batch["places"])]
            yield pd.DataFrame({"doc_a": batch["doc_a"], "doc_b": batch["doc_b"],
                                "n_lines": batch["n_lines"], "bitmap": maps})

    return (
        gone.groupBy(*DOC, "n_lines").agg(F.collect_set("place").alias("places"))
        .mapInPandas(run, "doc_a long, doc_b long, n_lines long, bitmap binary")
    )


def cut_lines(texts: pd.Series, bitmaps: pd.Series) -> pd.DataFrame:
    out = []
    for text, bitmap in zip(texts, bitmaps):
        lines = (text or "").split("\n")
        if bitmap is None:
            out.append((text or "", len(lines), 0))
            continue
        keep = kept_lines(bitmap, len(lines))
        left = [x for x, k in zip(lines, keep.tolist()) if k]
        out.append(("\n".join(left), len(lines), len(lines) - len(left)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_docs: int = 10, keep_first: bool = False,
                id_col: str = "doc_id", text_col: str = "text", into: str = "_lines") -> DataFrame:
    """All columns of ``docs`` with repeated lines cut from the text, and a struct ``into``.

    The struct holds ``n_lines`` before and ``n_dropped``; where ``docs`` has a column of its name, it
    gets underscores before it.  A text that was null becomes empty.  Few documents lose lines, so their
    bitmaps are mostly small enough to go to the texts; beyond the measured bound texts are shuffled.
    """
    bitmaps, size = settle_measured(keep_bitmaps(docs, min_docs, keep_first, id_col, text_col))
    rows = docs.select(F.struct("*").alias("row"), *document_key(id_col, text_col))
    cutter = F.pandas_udf(cut_lines, "text string, n_lines long, n_dropped long")
    cut = join_measured(rows, bitmaps, size, DOC, "left").select(
        "row", cutter(F.col("row").getField(text_col), F.col("bitmap")).alias("cut"))
    return cut.select(
        *[F.col("cut.text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
          for c in docs.columns],
        F.struct("cut.n_lines", "cut.n_dropped").alias(free_name(docs, into)))
