"""Operator 2: token ids as Arrow stream files of equal-length sequences.

Documents are dealt by ranges of doc_id, sorted, encoded, and each partition
writes one stream file: batches of fixed-size lists `ids` (unsigned 16-bit where
the vocabulary fits, else 32-bit) and `mask` (true: a token, false: padding of the file's last
sequence), so sequence k of a file is at a known place in a memory map and is
read without a copy. Beside it stands a stream file with each document's place.
A partition's file has a name of its own try; the manifest, committed by Spark,
lists only the files of tries that won, so a lost executor leaves at most
unlisted files.

Null and empty texts give the end id alone; rows with the same doc_id follow each
other in the order of their text's hash; an empty table gives no file; other
columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightlake.llm.encoder import encoder
from flightlake.llm.runtime import bounded_batches, id_and_text, stored

MANIFEST = "file_no long, path string, n_docs long, n_tokens long"
SPANS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


class _SequenceWriter:
    """Cuts a stream of ids into sequences of seq_len and writes them in batches."""

    def __init__(self, sink, seq_len: int, dtype: str, batch_rows: int):
        self.len, self.dtype, self.room = seq_len, np.dtype(dtype), seq_len * batch_rows
        kind = pa.uint16() if self.dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.room:
            flat = np.concatenate(self.parts)
            full = len(flat) // self.room * self.room
            for i in range(0, full, self.room):
                self._batch(flat[i:i + self.room], self.room)
            self.parts, self.held = [flat[full:]], len(flat) - full

    def _batch(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(len(ids)) < n
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.len) for x in (ids, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.parts)
            padded = np.zeros(-(-len(flat) // self.len) * self.len, self.dtype)
            padded[:len(flat)] = flat
            self._batch(padded, len(flat))
        self.out.close()


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, style: str = "spaces", vocab: int = 50257,
                      end_id: int = 0, seq_len: int = 2048, batch_rows: int = 64,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs in ascending doc_id order; gives the manifest, one row a file."""
    bounded_batches(docs.sparkSession)
    dtype = "<u2" if vocab <= 1 << 16 else "<u4"
    end = np.array([end_id], "<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, file_no = encoder(tokenizer_path, style), TaskContext.get().partitionId()
        writer = index = None
        doc_ids: list = []
        starts: list[int] = []
        counts: list[int] = []
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                path = f"{out_dir}/tokens-{file_no:06d}-{uuid.uuid4().hex}.arrows"
                filesystem, local = _open(path)
                filesystem.create_dir(local.rpartition("/")[0], recursive=True)
                sink, beside = filesystem.open_output_stream(local), filesystem.open_output_stream(local + ".docs")
                writer = _SequenceWriter(sink, seq_len, dtype, batch_rows)
            ids, place = enc.encode(b.column(1))
            for doc_id, s, e in zip(b.column(0).to_pylist(), place[:-1].tolist(), place[1:].tolist()):
                doc_ids.append(doc_id)
                starts.append(writer.total)
                counts.append(e - s + 1)
                writer.add(ids[s:e])
                writer.add(end)
        if writer is None:
            return
        writer.close()
        docs_batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(counts, pa.int64())})
        with pa.ipc.new_stream(beside, docs_batch.schema) as index:
            index.write_batch(docs_batch)
        sink.close()
        beside.close()
        yield pa.RecordBatch.from_pydict({"file_no": pa.array([file_no], pa.int64()), "path": [path], "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_tokens": pa.array([writer.total], pa.int64())})

    # rows of one id, or of none, may be many: their texts' hashes split them
    sorted_docs = (id_and_text(docs, id_col, text_col).withColumn("name", F.xxhash64("text"))
                   .repartitionByRange("doc_id", "name").sortWithinPartitions("doc_id", "name").drop("name"))
    return stored(sorted_docs.mapInArrow(write, MANIFEST), "token-manifest")


def open_sequences(path: str) -> tuple[list[pa.RecordBatch], pa.Table]:
    """A file's batches and its document index; local files are mapped, not copied."""
    filesystem, local = _open(path)
    is_local = isinstance(filesystem, fs.LocalFileSystem)
    source = pa.memory_map(local) if is_local else filesystem.open_input_file(local)
    batches = list(pa.ipc.open_stream(source))
    with filesystem.open_input_file(local + ".docs") as f:
        return batches, pa.ipc.open_stream(f).read_all()


def read_token_spans(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start over all files, n_tokens, ids_crc32."""
    offsets = F.sum("n_tokens").over(Window.orderBy("file_no")) - F.col("n_tokens")   # one row a file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                seqs, index = open_sequences(path)
                ids = [s.column(0).flatten().to_numpy(zero_copy_only=True) for s in seqs]
                ends = np.cumsum([len(x) for x in ids])
                start, n = index["start"].to_numpy(), index["n_tokens"].to_numpy()
                crcs = np.empty(len(start), np.int64)
                for i, (s, e) in enumerate(zip(start, start + n)):
                    crc, k = 0, int(np.searchsorted(ends, s, "right"))
                    while s < e:
                        first = ends[k] - len(ids[k])
                        to = min(e, ends[k])
                        crc = zlib.crc32(ids[k][s - first:to - first].astype("<u4").tobytes(), crc)
                        s, k = to, k + 1
                    crcs[i] = crc
                for i in range(0, len(start), 8192):
                    part = index.slice(i, 8192)
                    yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), pa.array(start[i:i + 8192] + base), pa.array(n[i:i + 8192]), pa.array(crcs[i:i + 8192])], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = manifest.withColumn("base", offsets).select("file_no", "path", F.col("base").cast("long"))
    # a task a file, which AQE does not join: a manifest is small, what it names is not
    files = placed.agg(F.max("file_no")).first()[0]
    return placed.repartitionByRange((files or 0) + 1, "file_no").mapInArrow(read, SPANS)


def token_spans(spark: SparkSession, docs: DataFrame, out_dir: str, tokenizer_path: str, **options) -> DataFrame:
    return read_token_spans(write_token_files(docs, out_dir, tokenizer_path, **options))
