"""Arrays packed into rows, for exchanges in which a row for each value would cost too much.

Documents are dealt into chunks, as compressed batches. A chunk asks about its distinct values in
sorted order, in one row for each bucket of values; the answer of a bucket has
the same order, so that a chunk puts its answers together without keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import text_bytes, text_of

#: Bytes of text of a chunk, about.
CHUNK_BYTES = 4 << 20
#: More would take much longer for little less.
LEVEL = 3


def shrunk(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def grown(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True)


def stream_of(batch: pa.RecordBatch) -> bytes:
    """A batch as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an array of integers, by planes of bytes; `open_up` restores them."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return shrunk(np.ascontiguousarray(planes).tobytes())


def open_up(data: bytes, kind: str, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(grown(data, n * width), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """The same for sorted unsigned 64-bit keys, which are kept as differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def open_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(open_up(data, "<u8", n), dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted 64-bit keys; buckets are equal ranges of keys."""
    high = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(high, np.arange(buckets + 1, dtype=np.uint64))


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def split_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All words of all texts as places in a list of distinct words; the words before each text; the list."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    encoded = lists.flatten().dictionary_encode()
    places = encoded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    kept = places != empty
    starts = np.concatenate([[0], np.cumsum(kept)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return places[kept].astype(np.int64), starts.astype(np.int64), encoded.dictionary


def sizes_for(documents: DataFrame) -> tuple[int, int]:
    """How many chunks and how many buckets; both grow with the bytes of the texts."""
    chunks = max(1, -(-text_bytes(documents) // CHUNK_BYTES))
    return chunks, max(chunks // 2, min(chunks, 8))


def chunked(documents: DataFrame, chunks: int, **more: Column) -> DataFrame:
    """`doc_id, text, chunk` and more columns; the chunk follows from id and text alone."""
    doc_id, text = documents["doc_id"].cast("long"), text_of(documents)
    chunk = F.pmod(F.xxhash64(doc_id, text), F.lit(chunks))
    return documents.select(
        doc_id.alias("doc_id"), text.alias("text"), chunk.alias("chunk"), *[c.alias(name) for name, c in more.items()]
    )


def packed(rows: DataFrame) -> DataFrame:
    """`chunk, batch`: the rows of a chunk that a task has read, all columns, as compressed Arrow streams.

    Texts so take half the place in an exchange that they would take as rows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column(batch.schema.get_field_index("chunk")).to_numpy()
            order = np.argsort(chunk, kind="stable")
            values, starts = np.unique(chunk[order], return_index=True)
            for value, own in zip(values.tolist(), np.split(order, starts[1:]), strict=True):
                stream = stream_of(batch.take(pa.array(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], pa.int64()), pa.array([stream], pa.binary())], names=["chunk", "batch"]
                )

    return rows.mapInArrow(pack, "chunk long, batch binary")


def unpacked(group: pa.Table) -> pa.Table:
    """The rows of a chunk."""
    batches = [pa.ipc.open_stream(b).read_all() for b in group.column("batch").to_pylist()]
    return pa.concat_tables(batches).combine_chunks()


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
