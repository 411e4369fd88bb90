"""Token-id files: one zstandard frame per document, a shared dictionary and an offset index (operator 6).

Layout under ``path``: ``dictionary`` (one row: the zstandard dictionary and
its SHA-256) and ``shards`` (Parquet). A shard row holds about ``shard_bytes``
of frames in one binary value, the index of the documents in it (id, byte
offset, number of ids) and the hash of the dictionary they need. One document
is read by pruning shards on ``first_doc_id``/``last_doc_id`` and unpacking
its frame alone. Spark's writer commits the files, so a retried task leaves
no half-written shard.

Defined cases: null texts are empty and hold the end id alone; null ids come
first; rows with the same id are ordered by a hash of their text; repeated
rows are all kept; an empty table gives files without shards. Other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivestats.llm.common import bounded_sample, map_arrow
from drivestats.llm.tokens import encoder

MAGIC = b"TOKZ"
LEVEL = 3
SHARD_SCHEMA = (
    "part int, shard int, start_in_part long, first_doc_id long, last_doc_id long, n_tokens long, "
    "dictionary_sha256 string, doc_ids array<bigint>, offsets array<bigint>, counts array<bigint>, frames binary"
)
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, dictionary_bytes: int, sample_docs: int, sample_chars: int) -> bytes:
    """A dictionary trained on at most ``sample_docs`` serialized documents of at most ``sample_chars`` characters."""
    import zstandard

    short = bounded_sample(docs.select("doc_id", "text").where(F.length("text") <= sample_chars), [F.col("doc_id"), F.col("text")], sample_docs, counted=docs.select("doc_id"))

    def serialize(batches):
        enc = encoder(tokenizer)
        for b in batches:
            texts = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.append(ids, enc.dtype(end_id)).tobytes() for ids in enc.encode(texts)], pa.binary())], ["ids"]
            )

    samples = [bytes(r.ids) for r in map_arrow(short.select("text"), serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b""


def _frames(tokenizer: str, end_id: int, dictionary: bytes, shard_bytes: int):
    digest = hashlib.sha256(dictionary).hexdigest()

    def write(batches):
        import zstandard

        enc = encoder(tokenizer)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        header = MAGIC + struct.pack("<BB", 1, enc.dtype().itemsize) + bytes.fromhex(digest)
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        ids_of, offsets, counts, frames, size = [], [], [], [], len(header)

        def row():
            total = sum(counts)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "start_in_part": pa.array([start], pa.int64()),
                    "first_doc_id": pa.array([next((i for i in ids_of if i is not None), None)], pa.int64()), "last_doc_id": pa.array([ids_of[-1]], pa.int64()),
                    "n_tokens": pa.array([total], pa.int64()), "dictionary_sha256": [digest],
                    "doc_ids": pa.array([ids_of], pa.list_(pa.int64())), "offsets": pa.array([offsets], pa.list_(pa.int64())),
                    "counts": pa.array([counts], pa.list_(pa.int64())), "frames": pa.array([header + b"".join(frames)], pa.binary()),
                }
            )

        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for doc_id, ids in zip(doc_ids, enc.encode(texts)):
                frame = compress(np.append(ids, enc.dtype(end_id)).tobytes())
                if ids_of and size + len(frame) > shard_bytes:
                    yield row()
                    start += sum(counts)
                    shard += 1
                    ids_of, offsets, counts, frames, size = [], [], [], [], len(header)
                ids_of.append(doc_id)
                offsets.append(size)
                counts.append(len(ids) + 1)
                frames.append(frame)
                size += len(frame)
        if ids_of:
            yield row()

    return write


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 0, dictionary_bytes: int = 65536,
    sample_docs: int = 1500, sample_chars: int = 50_000, shard_bytes: int = 2_000_000,
) -> None:
    """Write ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    ``sample_docs`` and ``sample_chars`` bound what the dictionary is trained
    on; every document is encoded whole whatever they are.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    dictionary = train_dictionary(docs, tokenizer, end_id, dictionary_bytes, sample_docs, sample_chars)
    spark.createDataFrame([(dictionary, hashlib.sha256(dictionary).hexdigest())], "dictionary binary, sha256 string").coalesce(1).write.parquet(f"{path}/dictionary")
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    map_arrow(ordered, _frames(tokenizer, end_id, dictionary, shard_bytes), SHARD_SCHEMA).write.parquet(f"{path}/shards")


def _unpack(frames: bytes, offsets, counts, dictionary: bytes, digest: str):
    """The id arrays of the documents at ``offsets``."""
    import zstandard

    if frames[:4] != MAGIC or frames[6:38].hex() != digest:
        raise ValueError("not a token file of this dictionary")
    dtype = np.dtype(f"<u{frames[5]}")
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress
    ends = [*offsets[1:], len(frames)]
    view = memoryview(frames)
    for a, b, n in zip(offsets, ends, counts):
        yield np.frombuffer(decompress(view[a:b], max_output_size=n * dtype.itemsize), dtype)


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    return bytes(row.dictionary), row.sha256


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, from their ids.

    ``start`` is the number of ids of all documents before. Only one number
    per written part goes through the driver.
    """
    dictionary, digest = _dictionary(spark, path)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    totals = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_tokens")).collect())
    base, bases = 0, {}
    for part, n in totals:
        bases[part] = base
        base += n

    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                start = bases[row["part"]] + row["start_in_part"]
                crcs, starts = [], []
                for ids in _unpack(row["frames"], row["offsets"], row["counts"], dictionary, digest):
                    starts.append(start)
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(row["doc_ids"], pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(row["counts"], pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())}
                )

    return map_arrow(shards.select("part", "start_in_part", "doc_ids", "offsets", "counts", "frames"), read, READ_SCHEMA)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with that id): only its shards are read and only its frames unpacked."""
    dictionary, digest = _dictionary(spark, path)
    rows = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards").where((F.col("first_doc_id") <= doc_id) & (F.col("last_doc_id") >= doc_id)).orderBy("part", "shard")
    out = []
    for row in rows.toLocalIterator():
        ends = [*row.offsets[1:], len(row.frames)]
        for i, own in enumerate(row.doc_ids):
            if own == doc_id:
                one = bytes(row.frames[:38]) + bytes(row.frames[row.offsets[i] : ends[i]])
                out += list(_unpack(one, [38], [row.counts[i]], dictionary, digest))
    return out
