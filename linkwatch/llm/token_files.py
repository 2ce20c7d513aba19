"""Flat token-id files with 64-bit document offsets, memory-mapped for reading.

Documents are range partitioned by id and each task writes one pair of files:

``<name>.bin``  unsigned little-endian ids of the task's documents, no gaps
``<name>.idx``  magic, id width in bytes, number of documents n, then n + 1
                offsets (unsigned 64-bit, in ids) and n document ids (signed
                64-bit; the smallest value stands for a null id)

A manifest row per task names the files and counts documents and ids.  The
place of a partition in the whole stream is the prefix sum of the counts before
it.  Names are unique per task attempt, so an attempt that is lost or repeated
leaves a file no manifest row names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.llm.common import landed
from linkwatch.llm.tokens import encoder

MAGIC = b"LWTOKID1"
NULL_ID = -(1 << 63)
SLICE = 512
FILE_BYTES = 1 << 28  # text behind one file
MANIFEST = "part int, name string, n_docs long, n_tokens long, id_bytes int"
SPANS = "doc_id long, start long, n_tokens long, ids_crc32 long, partition int"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Encode whole texts in ascending id order; returns the manifest.

    A null or empty text is just the end id.  Null ids come first.  Rows that
    repeat an id are all written, next to each other, in an order that depends on
    their texts alone (by hash, then by text), whatever the input's order.  An
    empty table gives an empty manifest.  Only the two named columns are read.  Without ``partitions`` there is one range per
    ``FILE_BYTES`` of text, or one per shuffle partition where that is more.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, store = encoder(tokenizer, end_id), None
        end = np.array([end_id], enc.dtype).tobytes()
        ids, lengths, name = [], [], ""
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                if store is None:
                    store, path = _store(folder)
                    store.create_dir(path, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(f"{path}/{name}.bin")
                ids.append(rows.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
                blobs = [x + end for x in enc.encode(rows.column(1).to_pylist())]
                lengths.append(np.array([len(x) for x in blobs], "<u8") // enc.dtype.itemsize)
                out.write(b"".join(blobs))
        if store is None:
            return
        out.close()
        lengths, ids = np.concatenate(lengths), np.concatenate(ids).astype("<i8")
        offsets = np.concatenate([np.zeros(1, "<u8"), np.cumsum(lengths, dtype="<u8")])
        head = np.array([enc.dtype.itemsize, len(ids)], "<u8")
        with store.open_output_stream(f"{path}/{name}.idx") as index:
            for x in (MAGIC, head.tobytes(), offsets.tobytes(), ids.tobytes()):
                index.write(x)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": TaskContext.get().partitionId(),
                    "name": name,
                    "n_docs": len(ids),
                    "n_tokens": int(offsets[-1]),
                    "id_bytes": enc.dtype.itemsize,
                }
            ],
            schema=pa.schema(
                [
                    ("part", pa.int32()),
                    ("name", pa.string()),
                    ("n_docs", pa.int64()),
                    ("n_tokens", pa.int64()),
                    ("id_bytes", pa.int32()),
                ]
            ),
        )

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    if partitions is None:
        size = narrow.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-size // FILE_BYTES))
    # a hash splits an id that many rows share, without texts in the ranges' bounds
    narrow = narrow.withColumn("tie", F.xxhash64("text"))
    ordered = narrow.repartitionByRange(partitions, "id", "tie")
    ordered = ordered.sortWithinPartitions("id", "tie", "text")
    return landed(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_index(folder: str, name: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Id width in bytes, document offsets and document ids of one pair of files."""
    store, path = _store(folder)
    with store.open_input_file(f"{path}/{name}.idx") as file:
        data = file.read()
    if data[:8] != MAGIC:
        raise ValueError(f"{name}.idx is no token index")
    width, n = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
    return (
        width,
        np.frombuffer(data, "<u8", n + 1, 24),
        np.frombuffer(data, "<i8", n, 24 + 8 * (n + 1)),
    )


def map_ids(folder: str, name: str, width: int, n_tokens: int) -> np.ndarray:
    """The ids of one file: memory-mapped where the folder is mounted, else read."""
    store, path = _store(folder)
    kind = np.dtype(f"<u{width}")
    if n_tokens and isinstance(store, pafs.LocalFileSystem):
        return np.memmap(f"{path}/{name}.bin", kind, "r")
    with store.open_input_file(f"{path}/{name}.bin") as file:
        return np.frombuffer(file.read(), kind)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: place in the whole stream, ids and checksum.

    The driver sees one manifest row per file and turns the counts into
    partition bases; ids and offsets are only read by the tasks.
    """
    parts = manifest.orderBy("part").collect()
    bases = accumulate((x.n_tokens for x in parts), initial=0)
    rows = [(x.part, x.name, x.n_tokens, b) for x, b in zip(parts, bases, strict=False)]
    files = spark.createDataFrame(rows, "part int, name string, n_tokens long, base long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width, offsets, ids = read_index(folder, row["name"])
                tokens = map_ids(folder, row["name"], width, row["n_tokens"])
                edges = offsets.astype(np.int64)
                crc = [
                    zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, mask=ids == NULL_ID),
                        pa.array(edges[:-1] + row["base"]),
                        pa.array(np.diff(edges)),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(ids), row["part"], np.int32)),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "partition"],
                )

    return files.repartition(max(1, len(rows))).mapInArrow(read, SPANS)
