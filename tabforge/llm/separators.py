"""Token counts from flat token files without an index, by a scan for the end-of-document id.

A flat file is a row of fixed-size blocks of little-endian ids; documents follow each other, each closed by the end
id, and run over block ends. The scan finds the end ids of each block in one vector search. A prefix scan over the
blocks' summaries (ids, end ids, last end id) then stitches what crosses blocks. It has two levels, blocks within
segments and segments within files, so no task sees all blocks of a long file, and no ids are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .tokens import default_tokenizer, encoded, task_ends

END_ID = 50_256
BLOCK_IDS = 1 << 18
SEGMENT = 1024
FILE_SCHEMA = "file int, block long, payload binary"


def write_flat(
    docs: DataFrame, folder: str, *, text: str = "text", tokenizer: str | None = None, end_id: int = END_ID, id_bytes: int = 2,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Flat token files, one per reading task, documents in the order in which the task reads them.

    The end id's own string within a text is encoded as ordinary text. Missing and empty texts are only the end id.
    """
    path, kind = tokenizer or default_tokenizer(), f"<u{id_bytes}"

    def run(batches):
        file, block, rest = TaskContext.get().partitionId(), 0, np.zeros(0, kind)

        def row(ids):
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([ids.tobytes()], pa.binary())], names=["file", "block", "payload"])

        for batch in batches:
            for _, _, ids, _ in encoded(batch.column(0), path, end_id, special_as_text=True):
                rest = np.concatenate((rest, ids.astype(kind)))
                while len(rest) >= block_ids:
                    yield row(rest[:block_ids])
                    block, rest = block + 1, rest[block_ids:]
        if len(rest):
            yield row(rest)
        task_ends()

    docs.select(text).mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(folder)


def document_counts(files: DataFrame, *, end_id: int = END_ID, id_bytes: int = 2, segment: int = SEGMENT) -> DataFrame:
    """One row per document found: file, doc_no (from 0), start, n_tokens (with the end id), complete.

    ``files`` has rows (file, block, payload), blocks numbered from 0 in order. Ids after a file's last end id make
    one document that is not complete. A file whose bytes are no whole number of ids fails.
    """
    kind = f"<u{id_bytes}"

    def scan(batches):
        for batch in batches:
            ends, sizes = [], []
            for payload in batch.column(2):
                ids = np.frombuffer(payload.as_buffer(), kind) if payload.is_valid else np.zeros(0, kind)
                ends.append(np.flatnonzero(ids == end_id))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], names=["file", "block", "n_ids", "ends"]
            )

    found = files.select("file", "block", "payload").mapInArrow(scan, "file int, block long, n_ids long, ends array<long>")
    blocks = found.withColumns({"seg": F.floor(F.col("block") / segment), "n_ends": F.size("ends"), "last": F.when(F.size("ends") > 0, F.element_at("ends", -1))})
    none = F.lit(0).cast("long")
    before = (Window.unboundedPreceding, -1)
    in_seg = Window.partitionBy("file", "seg").orderBy("block").rowsBetween(*before)
    # level one: places within the segment
    placed = blocks.withColumn("_ids", F.coalesce(F.sum("n_ids").over(in_seg), none)).withColumns({
        "_docs": F.coalesce(F.sum("n_ends").over(in_seg), none), "_last": F.max(F.col("_ids") + F.col("last")).over(in_seg),
    })
    # level two: segments within the file
    segments = placed.groupBy("file", "seg").agg(F.sum("n_ids").alias("s_ids"), F.sum("n_ends").alias("s_docs"), F.max(F.col("_ids") + F.col("last")).alias("s_last"))
    in_file = Window.partitionBy("file").orderBy("seg").rowsBetween(*before)
    offsets = segments.withColumn("o_ids", F.coalesce(F.sum("s_ids").over(in_file), none)).select(
        F.col("file").alias("_file"), F.col("seg").alias("_seg"), "o_ids", F.coalesce(F.sum("s_docs").over(in_file), none).alias("o_docs"),
        F.max(F.col("o_ids") + F.col("s_last")).over(in_file).alias("o_last"),
        (F.lead("seg").over(Window.partitionBy("file").orderBy("seg")).isNull()).alias("_final"),
    )
    joined = placed.join(offsets, (F.col("file") == F.col("_file")) & (F.col("seg") == F.col("_seg")))
    base = F.col("o_ids") + F.col("_ids")
    previous = F.coalesce(F.col("o_ids") + F.col("_last"), F.col("o_last"), F.lit(-1).cast("long"))
    at = joined.select("file", "block", base.alias("base"), (F.col("o_docs") + F.col("_docs")).alias("docs"), previous.alias("previous"), "n_ids", "ends", "seg", "_final")
    closed = at.select("file", "base", "docs", "previous", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("docs") + F.col("i")).alias("doc_no"),
        F.when(F.col("i") == 0, F.col("previous") + 1).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1).alias("start"),
        (F.col("base") + F.col("end") + 1).alias("stop"), F.lit(True).alias("complete"),
    )
    last_end = F.coalesce(F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1)), F.col("previous"))
    tail = at.where("_final").groupBy("file").agg(
        F.max(F.col("base") + F.col("n_ids")).alias("stop"), F.max(last_end + 1).alias("start"), F.max(F.col("docs") + F.size("ends")).alias("doc_no")
    ).where("stop > start").select("file", "doc_no", "start", "stop", F.lit(False).alias("complete"))
    both = closed.unionByName(tail)
    return both.select("file", "doc_no", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "complete")
