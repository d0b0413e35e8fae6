"""Token ids in fixed-width bits.

Documents are put in ascending order by a range partition, each partition is one shard, and a shard is a sequence of
segments. A segment is one self-contained binary value:

    magic "VQTB", version, bits of an id, ids in a block, documents, ids         (6 x unsigned 32-bit, little endian)
    ids of the documents (int64), a byte each that is 0 where that id is null
    start of each document within the segment, and the end                      (documents + 1, unsigned 64-bit)
    byte offset of each block of ids, and the end                                (blocks + 1, unsigned 64-bit)
    the blocks: ids in as few bits as the vocabulary needs, high bits first, each block padded to whole bytes

so a range of ids is read by unpacking the blocks it touches. Spark's own writer stores the segments, with their
shard, number and counts, as Parquet rows: any store Spark can write will do, and a lost executor costs its shard.

Defined results: a null text counts as empty and so has the end id only; rows of one doc_id follow each other,
ordered by their text; null doc_ids come first; an empty table gives an empty file set; a document of any length
is in one segment.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.llm import pieces

MAGIC, VERSION = int.from_bytes(b"VQTB", "little"), 1
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 18
SEGMENT_SCHEMA = "shard int, segment int, shard_start long, n_docs long, n_ids long, payload binary"
READ_SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids_crc32 long"


def bit_width(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16):
        return ids.astype(f">u{bits // 8}").tobytes()
    if bits % 8 == 0:
        return ids.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - bits // 8 :].tobytes()
    shown = np.unpackbits(ids.astype(">u4").view(np.uint8)).reshape(-1, 32)
    return np.packbits(shown[:, 32 - bits :]).tobytes()


def unpack_bits(packed: np.ndarray, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16):
        return packed.view(f">u{bits // 8}").astype("<u4")
    if bits % 8 == 0:
        whole = np.zeros((n, 4), dtype=np.uint8)
        whole[:, 4 - bits // 8 :] = packed.reshape(n, bits // 8)
        return whole.view(">u4").reshape(n).astype("<u4")
    full = np.zeros((n, 32), dtype=np.uint8)
    full[:, 32 - bits :] = np.unpackbits(packed, count=n * bits).reshape(n, bits)
    return np.packbits(full).view(">u4").astype("<u4")


def pack_segment(doc_ids: list, arrays: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    ids = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype("<u8")
    blocks = [pack_bits(ids[at : at + block], bits) for at in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = np.array([MAGIC, VERSION, bits, block, len(doc_ids), len(ids)], dtype="<u4")
    keys = np.array([0 if x is None else x for x in doc_ids], dtype="<i8")
    there = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    return b"".join([head.tobytes(), keys.tobytes(), there.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Segment:
    """A view on one segment; nothing is unpacked before it is asked for."""

    def __init__(self, payload: bytes):
        magic, version, self.bits, self.block, n_docs, self.n_ids = (int(x) for x in np.frombuffer(payload, "<u4", 6))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token segment of this version")
        at = 24
        keys = np.frombuffer(payload, "<i8", n_docs, at)
        there = np.frombuffer(payload, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [int(k) if t else None for k, t in zip(keys, there)]
        at += 9 * n_docs
        self.starts = np.frombuffer(payload, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(payload, "<u8", n_blocks + 1, at).astype(np.int64)
        self.packed = np.frombuffer(payload, np.uint8, offset=at + 8 * (n_blocks + 1))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids [start, stop) of the segment."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        found = [
            unpack_bits(
                self.packed[self.offsets[k] : self.offsets[k + 1]],
                self.bits,
                min(self.block, self.n_ids - k * self.block),
            )
            for k in range(first, last + 1)
        ]
        return np.concatenate(found)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def _packed(path: str, bits: int, end_id: int, segment_ids: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, shard = pieces.encoder(path), TaskContext.get().partitionId()
        end = np.uint32(end_id).tobytes()
        keys, arrays, held, segment, done = [], [], 0, 0, 0

        def made():
            row = [[shard], [segment], [done], [len(keys)], [held], [pack_segment(keys, arrays, bits)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in SEGMENT_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.ids(text.as_py(), end)
                keys.append(key)
                arrays.append(ids)
                held += len(ids)
                if held >= segment_ids:
                    yield made()
                    segment, done = segment + 1, done + held
                    keys, arrays, held = [], [], 0
        if keys:
            yield made()

    return run


def write_token_file(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every document, append ``end_id`` and write the segments below ``path``."""
    bits = bit_width(pieces.encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    packed = placed.select("doc_id", "text").mapInArrow(_packed(tokenizer, bits, end_id, segment_ids), SEGMENT_SCHEMA)
    packed.write.parquet(path)


def _unpacked(batches):
    import pyarrow as pa

    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    for batch in batches:
        for row in range(batch.num_rows):
            shard, start = batch.column("shard")[row].as_py(), batch.column("shard_start")[row].as_py()
            held = Segment(batch.column("payload")[row].as_py())
            n = len(held.doc_ids)
            ids, edges = memoryview(held.ids(0, held.n_ids).tobytes()), (4 * held.starts).tolist()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(edges, edges[1:])]
            columns = [
                pa.array(held.doc_ids, pa.int64()),
                pa.array([shard] * n, pa.int32()),
                pa.array(start + held.starts[:-1], pa.int64()),
                pa.array(np.diff(held.starts), pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_token_file(spark: SparkSession, path: str, broadcast_shards: int = 100_000) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from the stored bits.

    ``start`` counts the ids of all documents before it. Only shard totals are summed in one task. They are broadcast
    while there are at most ``broadcast_shards`` of them (16 bytes each), and joined by shuffle beyond.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = totals.selectExpr(
        "shard", "sum(ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ids AS before"
    )
    if totals.count() <= broadcast_shards:
        before = F.broadcast(before)
    # Small read units: a task holds a batch of payloads at a time.
    rows = stored.select("shard", "shard_start", "payload").mapInArrow(_unpacked, READ_SCHEMA)
    return rows.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )
