"""Hierarchical packing of documents into windows of several lengths.

A document's ids (and an end id) are cut into whole windows of the largest tier; what is left is routed to the smallest
tier that holds it. Tiers are packed from the longest: a window takes the longest remainder of its tier, and its gap is
filled from the same and the shorter tiers, whole pieces first and a cut piece last, so that windows come out full. The
last remainders of a task become windows of smaller powers of two. Sequences are then dealt to step groups so that each
group gets like numbers of tokens of each length.

A task packs the rows of its own input partition in blocks of bounded size, in the order of document id and text, so
nothing is shuffled and a retried task gives the same pieces. Null texts are empty (one end id); repeated rows are packed
each; ids may be null; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.memory import release
from tessera.llm.tokens import encoder, slices

WINDOW, SMALLEST, END = 1024, 128, 0
PIECES = "doc string, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, window long, step_group long"


class Shelf:
    """Remainders by length; finds the longest of at most a given length at once."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths = 0  # bit n: there is a remainder of length n

    def put(self, doc: int, start: int, length: int) -> None:
        self.by_length.setdefault(length, []).append((doc, start))
        self.lengths |= 1 << length

    def take(self, most: int, least: int = 1) -> tuple[int, int, int] | None:
        length = (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1
        if length < least:
            return None
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            self.lengths &= ~(1 << length)
        return doc, start, length


def pack(sizes: list[int], window: int = WINDOW, smallest: int = SMALLEST) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences ``(window, [(document, start, length), ...])`` that hold each id of documents of ``sizes`` once."""
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    shelf = Shelf()
    for doc, size in enumerate(sizes):
        whole = size - size % window
        out += [(window, [(doc, s, window)]) for s in range(0, whole, window)]
        if size > whole:
            shelf.put(doc, whole, size - whole)
    tier = window
    while tier >= smallest:
        # the remainders of this tier are those longer than half of it; all are served before the next tier begins
        while (piece := shelf.take(tier, tier // 2 + 1)) is not None:
            row, gap = [piece], tier - piece[2]
            while gap and (filler := shelf.take(gap)) is not None:
                row.append(filler)
                gap -= filler[2]
            if gap and (longer := shelf.take(window)) is not None:  # all that is left is longer than the gap: cut one
                doc, start, length = longer
                row.append((doc, start, gap))
                shelf.put(doc, start + gap, length - gap)
                gap = 0
            out += _split(row, tier - gap) if gap else [(tier, row)]
        tier //= 2
    rest = []
    while (piece := shelf.take(window)) is not None:
        rest.append(piece)
    return out + _split(rest, sum(p[2] for p in rest))


def _split(row: list[tuple[int, int, int]], total: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The pieces of ``row`` as windows of powers of two, largest first, without padding."""
    out, row = [], list(reversed(row))
    while total:
        size = min(WINDOW, 1 << (total.bit_length() - 1))
        mine, need = [], size
        while need:
            doc, start, length = row.pop()
            mine.append((doc, start, min(length, need)))
            if length > need:
                row.append((doc, start + need, length - need))
            need -= mine[-1][2]
        out.append((size, mine))
        total -= size
    return out


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", block_tokens: int = 1 << 22, groups: int = 64) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_group``.

    ``block_tokens`` bounds what a task holds; a single longer document is a block of its own.
    """

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list, list]]:
        tool = encoder(tokenizer)
        part, names, ids, size = 0, [], [], 0
        for batch in batches:
            docs_, texts = batch["doc"].tolist(), batch["text"].tolist()
            part = int(batch["part"].iloc[0]) if len(batch) else part
            for first, last in slices(texts):
                for name, own in zip(docs_[first:last], tool.encode(texts[first:last]), strict=True):
                    names.append(name)
                    ids.append(np.append(own, np.uint32(END)).astype("<u4", copy=False))
                    size += len(ids[-1])
                    if size >= block_tokens:
                        yield part, names, ids
                        names, ids, size = [], [], 0
        if names:
            yield part, names, ids
        tool.forget()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        serial = 0
        dealt: dict[int, int] = {}  # the last group that got a sequence of each length, over all blocks of the task
        for part, names, ids in blocks(batches):
            sizes = list(map(len, ids))
            rows = []
            for window, pieces in pack(sizes):
                group = (dealt.get(window, part) + 1) % groups
                dealt[window] = group
                offset, sequence = 0, (part << 40) + serial
                serial += 1
                for doc, start, length in pieces:
                    rows.append((names[doc], start, length, zlib.crc32(ids[doc][start : start + length].tobytes()), sizes[doc], sequence, offset, window, group))
                    offset += length
            for i in range(0, len(rows), 50_000):
                yield pd.DataFrame(rows[i : i + 50_000], columns=[c.split()[0] for c in PIECES.split(", ")])
        release()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.sortWithinPartitions("doc", "text").select(F.spark_partition_id().alias("part"), "doc", "text")
    out = rows.mapInPandas(run, PIECES)
    return out.select(F.col("doc").cast("long").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", F.col("sequence").alias("sequence_id"), "offset", "window", "step_group")
