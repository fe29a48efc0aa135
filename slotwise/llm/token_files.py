"""Operator 5: token ids in Arrow files of equal-length sequences with masks.

Documents are dealt by ranges of doc_id, so every task writes one shard and
the shards follow each other in order. A shard is an Arrow file (the stream
format with a footer) of record batches with two fixed-size-list columns:
``ids``, the documents' ids one after another cut into sequences of ``length``,
and ``mask``, false for the padding after the shard's last id. Ids take two
bytes where the vocabulary allows. A second, small Arrow file beside it says
where each document starts. A batch is found by division and its lists are
views of the mapped file, so any sequence is read without copying.

A shard is written under a name of its own and moved into place at the end: a
task that is lost or runs twice leaves the same file. Shards go to the shared
folder through Arrow's file systems.

Defined cases: a null or empty text is the end id alone; null doc_ids come
first; repeated rows are written each; an empty table gives no files and no
rows. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm.common import ship, written
from slotwise.session import run_dir

BATCH = 64  #: sequences in a record batch


def _place(uri: str):
    """(file system, path) of a shared place."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _schema(length: int, wide: bool):
    import pyarrow as pa

    ids = pa.list_(pa.uint32() if wide else pa.uint16(), length)
    return pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Writes one shard: ids are appended, full batches leave memory at once."""

    def __init__(self, folder: str, shard: int, attempt: str, length: int, wide: bool):
        import numpy as np
        import pyarrow as pa

        self.fs, root = _place(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = {k: f"{root}/shard-{shard:07d}.{k}.arrow" for k in ("ids", "docs")}
        self.temp = {k: f"{root}/.{attempt}.{k}" for k in self.final}
        self.length, self.schema = length, _schema(length, wide)
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = {k: self.fs.open_output_stream(p) for k, p in self.temp.items()}
        self.files = {"ids": pa.ipc.new_file(self.out["ids"], self.schema), "docs": pa.ipc.new_file(self.out["docs"], self.docs_schema)}
        self.parts: list = []
        self.held = self.n_ids = self.n_docs = 0

    def add(self, doc_ids: list, texts_ids: list) -> None:
        import pyarrow as pa

        starts, sizes = [], []
        for ids in texts_ids:
            starts.append(self.n_ids)
            sizes.append(len(ids))
            self.parts.append(ids.astype(self.dtype))
            self.n_ids += len(ids)
            self.held += len(ids)
        self.n_docs += len(sizes)
        self.files["docs"].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=self.docs_schema))
        if self.held >= self.length * BATCH:
            self._flush(self.length * BATCH)

    def _flush(self, unit: int) -> None:
        """Write whole units of ids; ``unit`` 1 pads the rest to a sequence."""
        import numpy as np
        import pyarrow as pa

        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        n = len(ids) // unit * unit
        rest, ids = ids[n:], ids[:n]
        for at in range(0, n, self.length * BATCH):
            part = ids[at : at + self.length * BATCH]
            pad = -len(part) % self.length
            flat = np.concatenate([part, np.zeros(pad, self.dtype)])
            mask = np.arange(len(flat)) < len(part)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, mask)]
            self.files["ids"].write_batch(pa.record_batch(columns, schema=self.schema))
        self.parts, self.held = [rest], len(rest)

    def close(self) -> None:
        self._flush(1)
        for k in self.final:
            self.files[k].close()
            self.out[k].close()
            self.fs.move(self.temp[k], self.final[k])


class ShardReader:
    """Random access to a shard's sequences, masks and documents."""

    def __init__(self, folder: str, shard: int):
        import pyarrow as pa
        from pyarrow import fs

        self.fs, root = _place(folder)
        names = {k: f"{root}/shard-{shard:07d}.{k}.arrow" for k in ("ids", "docs")}
        local = isinstance(self.fs, fs.LocalFileSystem)
        sources = {k: pa.memory_map(p) if local else self.fs.open_input_file(p) for k, p in names.items()}
        self.ids = pa.ipc.open_file(sources["ids"])
        self.docs = pa.ipc.open_file(sources["docs"])
        self.length = self.ids.schema.field("ids").type.list_size

    def sequence(self, n: int):
        """Ids and mask of the n-th sequence; the ids are a view of the file."""
        batch = self.ids.get_batch(n // BATCH)
        return batch["ids"].flatten().to_numpy().reshape(-1, self.length)[n % BATCH], batch["mask"][n % BATCH].values.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple]:
        """(doc_id, start, ids) of every document in order; one batch is held at a time."""
        import numpy as np

        unit, at, flat = self.length * BATCH, -1, None
        for b in range(self.docs.num_record_batches):
            for doc, start, n in zip(*(c.to_pylist() for c in self.docs.get_batch(b).columns), strict=True):
                parts, place = [], start
                while place < start + n:
                    if place // unit != at:
                        at = place // unit
                        flat = self.ids.get_batch(at)["ids"].flatten().to_numpy()
                    parts.append(flat[place % unit : place % unit + start + n - place])
                    place += len(parts[-1])
                yield doc, start, np.concatenate(parts)


def write(docs: DataFrame, tokenizer: str, folder: str, length: int = 2048, end_id: int = 1, wide: bool = False) -> DataFrame:
    """Write all documents; shard, n_docs, n_ids per shard. ``wide``: ids need four bytes."""

    def shards(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        from slotwise.llm.tokens import encoder

        context, end, writer = TaskContext.get(), np.array([end_id], dtype="<u4"), None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                writer = ShardWriter(folder, context.partitionId(), f"{context.partitionId()}-{context.taskAttemptId()}", length, wide)
            ids = [np.concatenate([i, end]) for i in encoder(tokenizer).encode(batch["text"])]
            writer.add([None if pd.isna(d) else int(d) for d in batch["doc_id"]], ids)
        if writer:
            writer.close()
            yield pd.DataFrame({"shard": [context.partitionId()], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids]})

    ship(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    ordered = keyed.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    return written(ordered.mapInPandas(shards, "shard int, n_docs long, n_ids long"), "shards")


def read(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def documents(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for shard, base in zip(batch["shard"], batch["base"], strict=True):
                rows = []
                for doc, start, ids in ShardReader(folder, int(shard)).documents():
                    rows.append((doc, int(base) + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                out["doc_id"] = pd.array([r[0] for r in rows], dtype="Int64")
                yield out

    ship(spark)
    # One row per shard: the running total over them is small however many ids.
    base = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    placed = shards.select("shard", F.coalesce(base, F.lit(0)).alias("base"))
    n = max(1, shards.count())
    dealt = written(placed, "shard_places").repartition(n, "shard")
    return dealt.mapInPandas(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to the shared folder and read the files back."""
    folder = run_dir(docs.sparkSession, "token_files")
    return read(docs.sparkSession, folder, write(docs, tokenizer, folder, length, end_id))
