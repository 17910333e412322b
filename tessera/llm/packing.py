"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted length are cut into pieces of that length
and a rest; a piece is never cut again.  Pieces are dealt to packing groups of about
GROUP_TOKENS tokens.  A group is packed best-fit decreasing once for every way to choose
the length of a new sequence: the least cost per token that can still fill it, or a
fixed smallest length.  Afterwards each sequence shrinks to the least permitted length
that holds its contents, and the cheapest of the packings is kept.  The cost of a
sequence grows a little faster than its length (attention) and has a fixed part.

Documents of no tokens (or a null length) take no place: their one row has a null
seq_id, capacity and offset.  Null doc_ids are packed like any other; repeated rows are
packed once each.  An empty table gives no row.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, slices, stored
from tessera.llm.words import encoder, vocabulary

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP_TOKENS = 1 << 20     # tokens packed together
FIXED_COST = 16.0          # of one sequence, in tokens
ATTENTION = 32768.0        # length at which attention doubles the cost of a token
VOCABULARY = "word_bpe_49k.json"
SLICE_CHARS = 4 << 20


def cost(capacity: int) -> float:
    return capacity * (1.0 + capacity / ATTENTION) + FIXED_COST


def best_fit(lengths: Sequence[int], opening: Callable[[int, int], int]) -> tuple[list[int], list[int], list[int]]:
    """(bin of each length, its offset there, capacity of each bin); lengths descending.

    ``opening(length, rest)`` names the capacity of a new bin, given the tokens still to pack.
    """
    room: list[tuple[int, int]] = []  # (free tokens, bin), ascending
    where, offset, capacity = [], [], []
    rest = sum(lengths)
    for length in lengths:
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, number = room.pop(at)
        else:
            number, free = len(capacity), opening(length, rest)
            capacity.append(free)
        where.append(number)
        offset.append(capacity[number] - free)
        if free > length:
            insort(room, (free - length, number))
        rest -= length
    return where, offset, capacity


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """The cheapest packing of descending lengths: (bin, offset) of each, capacity of each bin."""
    sizes = sorted(capacities)

    def least_cost(length: int, rest: int) -> int:
        return min((c for c in sizes if c >= length), key=lambda c: (cost(c) / min(c, rest), c))

    def at_least(base: int) -> Callable[[int, int], int]:
        return lambda length, _: sizes[bisect_left(sizes, max(base, length))]

    best = None
    for opening in (least_cost, *map(at_least, sizes)):
        where, offset, opened = best_fit(lengths, opening)
        used = np.zeros(len(opened), np.int64)
        np.add.at(used, where, lengths)
        shrunk = [sizes[bisect_left(sizes, u)] for u in used.tolist()]
        price = sum(map(cost, shrunk))
        if best is None or price < best[0]:
            best = price, where, offset, shrunk
    return best[1:] if best else ([], [], [])


OUT = "doc_id long, piece long, token_start long, n_tokens long, seq_id long, capacity int, offset int"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())


def packed(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Places of the pieces of ``docs(doc_id, n_tokens)``: one row per piece."""
    longest = max(capacities)
    n = F.coalesce(F.greatest(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0).cast("long"))
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"))
    # a random group for each document's first piece, fixed by writing it down
    items = stored(items.withColumn("deal", F.floor(F.rand(5) * (1 << 40)).cast("long")), "pieces")
    total = items.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    last = F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0).cast("long"))
    pieces = items.select("doc_id", "n", "deal", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("token_start"),
        F.least(F.lit(longest).cast("long"), F.col("n") - F.col("piece") * longest).alias("n_tokens"),
        F.pmod(F.xxhash64("deal", "piece"), F.lit(groups)).alias("pack_group"))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table["n_tokens"].to_numpy()
        full = int((lengths > 0).sum())
        where, offset, capacity = pack(lengths[:full].tolist(), capacities)
        group = table["pack_group"][0].as_py()
        empty = [None] * (len(lengths) - full)
        seq = [(group << 24) + w for w in where] + empty
        cols = [*(table[c] for c in ("doc_id", "piece", "token_start", "n_tokens")), pa.array(seq, pa.int64()),
                pa.array([capacity[w] for w in where] + empty, pa.int32()), pa.array(offset + empty, pa.int32())]
        return pa.table([pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in cols],
                        names=[f.split()[0] for f in OUT.split(", ")])

    return pieces.groupBy("pack_group").applyInArrow(solve, OUT)


def token_counts(docs: DataFrame, vocab: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens): ids of each whole text and one end id; a null text counts as empty."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary(vocab))
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), []
            for lo, hi in slices((len(t or "") for t in texts), SLICE_CHARS):
                out += [len(b) // enc.width + 1 for b in enc.encode(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(count, 1), "doc_id long, n_tokens long")


def documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """Sequences of the documents' token ids (with an end id each)."""
    return packed(token_counts(docs), capacities)
