"""Token-id output: one shared zstandard dictionary, one frame per document, an offset index.

Format: a Parquet table of blocks.  A block row holds ``part`` and ``seq`` (its place in
ascending doc_id order), ``dict_hash``, the documents' ids, token counts and frame end
offsets (the index), and ``payload``, the documents' zstandard frames joined.  Each frame
is compressed on its own with the shared dictionary, so a reader opens one block, slices
one frame and decompresses only that.  ``<path>/dictionary`` holds the dictionary, and
readers check its SHA-256 against every block.

Rows with a null doc_id come first; equal doc_ids keep no particular order among
themselves; a null text counts as empty.  An empty table gives a table with no block.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import lean, slices, stored
from tessera.llm.words import encoder, vocabulary
from tessera.session import work_dir

VOCABULARY = "word_bpe_49k.json"
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 512          # the dictionary's documented sample, chosen by a hash of doc_id
SAMPLE_IDS = 4096          # ids of one sampled document, from a hash-chosen place
BLOCK_BYTES = 1 << 20      # payload after which a block ends
SLICE_CHARS = 4 << 20      # text encoded at a time

BLOCK_SCHEMA = ("part int, seq int, dict_hash string, width int, start_in_part long, n_tokens long, "
                "first_doc long, last_doc long, doc_ids array<long>, counts array<long>, ends array<long>, "
                "payload binary")


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    import zstandard as zstd
    samples = [s for s in samples if s]
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _codec(raw: bytes):
    import zstandard as zstd
    return zstd.ZstdCompressionDict(raw) if raw else None


def _sample(docs: DataFrame, vocab: str, end_id: int) -> list[bytes]:
    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            enc = encoder(vocabulary(vocab))
            out = []
            for key, raw in zip(ids, enc.encode(batch.column(1).to_pylist())):
                raw = raw + end_id.to_bytes(enc.width, "little")
                room = max(1, len(raw) // enc.width - SAMPLE_IDS)
                at = (zlib.crc32(str(key).encode()) % room) * enc.width
                out.append(raw[at: at + SAMPLE_IDS * enc.width])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    # the ids first, without the texts; then one text per id, its least by hash
    picked = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    chosen = docs.join(F.broadcast(picked), docs["doc_id"].eqNullSafe(picked["doc_id"]), "left_semi").groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    return sorted(bytes(r.ids) for r in chosen.mapInArrow(lean(cut, 1), "ids binary").collect())


def write(docs: DataFrame, path: str, vocab: str = VOCABULARY, end_id: int = 1) -> None:
    """Encode every text (ids, then ``end_id``) and write the token table to ``path``."""
    import zstandard as zstd
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    raw = train_dictionary(_sample(docs, vocab, end_id))
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_hash string, dictionary binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(raw)
        press = zstd.ZstdCompressor(level=3, dict_data=codec) if codec else zstd.ZstdCompressor(level=3)
        enc = encoder(vocabulary(vocab))
        end = end_id.to_bytes(enc.width, "little")
        for batch in batches:
            texts, counts, out = batch.column(1).to_pylist(), [], []
            for lo, hi in slices((len(t or "") for t in texts), SLICE_CHARS):
                for body in enc.encode(texts[lo:hi]):
                    counts.append(len(body) // enc.width + 1)
                    out.append(press.compress(body + end))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "count", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(vocabulary(vocab)).width
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, ends, held, size = [], [], [], [], 0

        def flush():
            total = sum(counts)
            known = [i for i in ids if i is not None]
            row = {"part": part, "seq": seq, "dict_hash": digest, "width": width, "start_in_part": before,
                   "n_tokens": total, "first_doc": min(known, default=None), "last_doc": max(known, default=None),
                   "doc_ids": list(ids), "counts": list(counts), "ends": list(ends), "payload": b"".join(held)}
            return pa.RecordBatch.from_pylist([row], schema=ARROW_BLOCK), total

        for batch in batches:
            for key, count, frame in zip(*(c.to_pylist() for c in batch.columns)):
                size += len(frame)
                ids.append(key)
                counts.append(count)
                ends.append(size)
                held.append(frame)
                if size >= BLOCK_BYTES:
                    out, total = flush()
                    yield out
                    seq, before, size = seq + 1, before + total, 0
                    ids, counts, ends, held = [], [], [], []
        if ids:
            yield flush()[0]

    # encoded once and stored, so that neither the range's bounds nor the shuffle touch the texts
    packed = stored(docs.mapInArrow(lean(frames, 1), "doc_id long, count long, frame binary"), "token-frames")
    # the random second key splits a doc_id that many rows share
    (packed.withColumn("tie", F.rand(1)).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "count", "frame").mapInArrow(lean(blocks), BLOCK_SCHEMA).write.parquet(f"{path}/blocks"))


ARROW_BLOCK = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("dict_hash", pa.string()), ("width", pa.int32()),
                         ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("first_doc", pa.int64()),
                         ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                         ("ends", pa.list_(pa.int64())), ("payload", pa.binary())])


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(row.dictionary)
    if hashlib.sha256(raw).hexdigest() != row.dict_hash:
        raise ValueError(f"the dictionary of {path} does not match its hash")
    return row.dict_hash, raw


def _frames(digest: str, raw: bytes, row: dict, want: int | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in the block, ids) of a block's documents, or of ``want`` alone."""
    import zstandard as zstd
    if row["dict_hash"] != digest:
        raise ValueError("a block was written with another dictionary")
    codec = _codec(raw)
    open_ = zstd.ZstdDecompressor(dict_data=codec) if codec else zstd.ZstdDecompressor()
    kind = np.dtype(f"<u{row['width']}")
    view, lo, before = memoryview(row["payload"]), 0, 0
    for key, count, hi in zip(row["doc_ids"], row["counts"], row["ends"]):
        if want is None or key == want:
            yield key, before, np.frombuffer(open_.decompress(view[lo:hi]), kind)
        lo, before = hi, before + count


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every stored document, ids as uint32 bytes
    (left out on demand: they would cross from Python even where nobody selects them).

    ``start`` counts the ids of all documents before; the running sum of the blocks is
    taken per part, then over the parts (one row per written part).
    """
    digest, raw = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for key, before, ids in _frames(digest, raw, row):
                    four = ids.astype("<u4").tobytes()
                    out.append((key, row["base"] + row["start_in_part"] + before, len(ids), zlib.crc32(four), four if with_ids else b""))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())[: 5 if with_ids else 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 5 if with_ids else 4]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    # one row per part: bounded by the shuffle partitions of the write
    return blocks.join(F.broadcast(base), "part").mapInArrow(lean(documents), schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this doc_id: block by index, one frame decompressed each."""
    digest, raw = _dictionary(spark, path)
    hits = (spark.read.parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
            .where(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))))
    return [ids.tolist() for r in hits.toLocalIterator() for _, _, ids in _frames(digest, raw, r.asDict(), doc_id)]


def store_and_read(docs: DataFrame, vocab: str = VOCABULARY, end_id: int = 1) -> DataFrame:
    path = work_dir(docs.sparkSession, "token-store")
    write(docs, path, vocab, end_id)
    return read(docs.sparkSession, path, with_ids=False)
