"""Token files: documents as compressed ids in ascending doc_id order, written and read by Spark tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyloom.llm import coder
from skyloom.llm.common import crc_of, read_table, register, text_of, word_cache
from skyloom.llm.packing import default_tokenizer
from skyloom.session import scratch_path, stored

END_ID = 2
BITS = 16
FILE_TOKENS = 3_000_000
_ENOUGH = 1.25  # files: a rest of less than a quarter goes into the file before it
MANIFEST = "part int, file int, path string, docs long, tokens long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, bits: int = BITS) -> DataFrame:
    """Writes token files below ``folder`` (seen by all executors) and returns their manifest, a stored table.

    Rows are range-partitioned by doc_id and sorted, nulls first; a task writes its rows in order to
    files of about ``FILE_TOKENS`` ids (up to a quarter more). Every attempt of a task has file names of its own and only
    the successful one is in the manifest, so lost executors and repeated tasks leave at most
    files that nothing refers to.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, attempt = word_cache(tokenizer, ""), TaskContext.get().partitionId(), uuid.uuid4().hex
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        names, counts, chunks, size, number = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            """Write the documents up to the one that fills a file, or all if what is left is no file of its own."""
            nonlocal names, counts, chunks, size, number
            path, docs = f"part-{part:06d}-{number:04d}-{attempt}.tokens", len(names)
            ids, ends = np.concatenate(chunks), np.cumsum(counts)
            if size >= _ENOUGH * FILE_TOKENS:
                docs = min(docs, int(np.searchsorted(ends, FILE_TOKENS)) + 1)
            tokens = int(ends[docs - 1])
            with system.open_output_stream(f"{base}/{path}") as out:
                out.write(coder.pack(names[:docs], counts[:docs], ids[:tokens], bits))
            row = (part, number, f"{folder}/{path}", docs, tokens)
            names, counts, chunks, size, number = names[docs:], counts[docs:], [ids[tokens:].copy()], size - tokens, number + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, arrow.types)], schema=arrow)

        for batch in batches:
            ids, ends = cache.encode_all(batch.column(1), end_id)
            names += batch.column(0).to_pylist()
            counts += np.diff(ends).tolist()
            chunks.append(ids)
            size += len(ids)
            while size >= _ENOUGH * FILE_TOKENS:
                yield flush()
        if names:
            yield flush()

    arrow = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])
    rows = docs.select("doc_id", text_of().alias("text"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(placed.mapInArrow(write, MANIFEST))


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files of a manifest.

    ``start`` counts the ids of all documents before it. The offsets come from one row for each
    file: sums per part, then within the part. A damaged block raises ValueError.
    """
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    files = stored(files.select("path", (F.col("base") + F.col("inside")).alias("start")))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = _open(path)
                with system.open_input_stream(place) as data:
                    doc_ids, counts, ids = coder.unpack(data.read())
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                pieces = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), counts.tolist())]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array([crc_of(p) for p in pieces], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(pieces, pa.binary())] * with_ids, names)

    count = max(1, files.count())
    spread = files.repartition(count)  # a task for each file
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, bits: int = BITS) -> DataFrame:
    """Writes all documents to token files in the shared folder and returns what the files hold.

    Null and empty texts are the end id alone. A null doc_id comes first; rows that repeat a doc_id
    stay apart, in any order among themselves. An empty table has no files and gives an
    empty result. Other columns are not read.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id, bits))


@register("op5_token_files")
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(read_table(spark, folder, "documents"), default_tokenizer("word_bpe_49k.json"))
