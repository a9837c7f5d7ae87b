"""Token ids as flat binary files with 64-bit document offsets.

A folder holds, for each shard ``k``, ``k.ids`` (little-endian unsigned integers, 16 or 32 bits),
``k.offsets`` (int64, one more than the shard has documents: where each starts in the shard) and
``k.docs`` (int64 document ids; the smallest int64 stands for null), and ``manifest.json`` with the
width, and of each shard the documents, the ids and the ids of all shards before it. Shards follow
each other in document order. Readers map the files into memory.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import quoted
from cohortflow.llm.piece_arrays import Encoder, slices
from cohortflow.llm.pieces import kept_by_worker, load, release

NULL_ID = -(1 << 63)
READ_DOCS = 20_000


def mounted(folder: str) -> str:
    """The folder as a path that every executor has mounted; memory maps need one."""
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"token files are memory-mapped; {folder} is not on a mounted file system")
    return unquote(parts.path) if parts.scheme else folder


@kept_by_worker
def _encoder(path: str, kind: str) -> Encoder:
    return Encoder(path, kind)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the files in ascending order of the id.

    Null ids come first, equal ids in the order of a hash of their text; a null text counts as
    empty and gives the end id alone, a text of any length is encoded whole. An empty table gives a manifest without
    shards. Other columns are not read, whatever their names. Each shard is written under a name of its attempt and then
    renamed, so a task that runs again leaves the same files. Returns ``read_token_files``.
    """
    spark, path = docs.sparkSession, mounted(folder)
    os.makedirs(path, exist_ok=True)
    tokenizer = load(tokenizer_path)
    if tokenizer.normalizer is not None:
        raise ValueError("the tokenizer changes texts before it splits them")
    ids = max(tokenizer.get_vocab(with_added_tokens=True).values())
    kind = "<u2" if max(ids, end_id) < 1 << 16 else "<u4"
    end = np.array([end_id], kind).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        at = f"{path}/{shard}"
        own = {part: f"{at}.{part}.{attempt}" for part in ("ids", "offsets", "docs")}
        release(keep=_encoder)
        encoder = _encoder(tokenizer_path, kind)
        n_docs = n_ids = 0
        with open(own["ids"], "wb") as f_ids, open(own["offsets"], "wb") as f_offsets, open(own["docs"], "wb") as f_docs:
            f_offsets.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                f_docs.write(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs += batch.num_rows
                for texts in slices(batch.column(1)):
                    ids, sizes = encoder.encode(texts, end)
                    ends = n_ids + np.cumsum(sizes)
                    n_ids += len(ids)
                    f_offsets.write(ends.astype("<i8").tobytes())
                    f_ids.write(ids.tobytes())
        for part, name in own.items():
            os.replace(name, f"{at}.{part}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())],
            names=["shard", "n_docs", "n_ids"],
        )

    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, "shard long, n_docs long, n_ids long")
        .collect()  # a row per shard
    )
    listed, before = [], 0
    for shard, n_docs, n_ids in sorted(tuple(r) for r in written):
        if n_docs:
            listed.append({"shard": shard, "n_docs": n_docs, "n_ids": n_ids, "before": before})
            before += n_ids
    with open(f"{path}/manifest.json.new", "w") as f:
        json.dump({"kind": kind, "shards": listed}, f)
    os.replace(f"{path}/manifest.json.new", f"{path}/manifest.json")
    return read_token_files(spark, folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document, from the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (unsigned crc32 of the ids as little-endian unsigned 32-bit integers)."""
    path = mounted(folder)
    with open(f"{path}/manifest.json") as f:
        n = len(json.load(f)["shards"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(f"{path}/manifest.json") as f:
            manifest = json.load(f)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield from _shard_rows(path, manifest["kind"], manifest["shards"][k])

    return spark.range(0, n, 1, max(n, 1)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shard_rows(path: str, kind: str, shard: dict) -> Iterator[pa.RecordBatch]:
    at = f"{path}/{shard['shard']}"
    ids = np.memmap(f"{at}.ids", kind, "r")
    offsets, docs = np.memmap(f"{at}.offsets", "<i8", "r"), np.memmap(f"{at}.docs", "<i8", "r")
    if len(ids) != shard["n_ids"] or len(docs) != shard["n_docs"] or offsets[-1] != len(ids):
        raise ValueError(f"{at}: the files do not fit the manifest")
    for i in range(0, len(docs), READ_DOCS):
        doc, bounds = np.array(docs[i : i + READ_DOCS]), np.array(offsets[i : i + READ_DOCS + 1])
        sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64(), mask=doc == NULL_ID),
                pa.array(bounds[:-1] + shard["before"], pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
