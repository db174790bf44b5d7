"""Token ids in Arrow files whose batches hold equal-length sequences, written and read in parallel.

A shard is one Arrow IPC file. Each record batch has up to ``BATCH_SEQUENCES`` rows of two fixed-size lists of
``length`` values: ``ids`` (unsigned 16 or 32 bits) and ``mask`` (one bit: true for an id, false for padding). The documents of a shard
follow one another without gaps, and only the last sequence is padded. Since every sequence has the same size, the id at
place p of a shard is element p modulo length of sequence p // length, which a memory-mapped file gives without copying.
Beside it lies an index file with one row per document: key, start within the shard, number of ids.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilspark.session import scratch_dir

from .common import CACHE_ENTRIES, groups, hold, kept

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LENGTH = 2048
BATCH_SEQUENCES = 64
# Documents of about this many bytes make one shard.
SHARD_BYTES = 16 << 20
# Words that the library encodes in one call.
JOINED = 500
# Texts of these characters alone are split here before their pieces are looked up; others go to the library whole.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ]*\Z")
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
PIECES = re.compile(rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")


class PieceEncoder:
    """Encodes with the tokenizers library, each distinct piece of text once while it stays in the cache.

    The vocabulary's own rule splits a text before any merge, so a text's ids are its pieces' ids in order.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        self.pieces: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known. Words with a leading space are encoded many at a time: the splitting rule
        parts their concatenation before each space, and the library says which word each id belongs to."""
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            done = self.library.encode("".join(some), add_special_tokens=False)
            ids, word = np.array(done.ids, self.kind), np.array(done.word_ids)
            ends = np.searchsorted(word, np.arange(len(some)), "right") * self.kind.itemsize
            data, start = ids.tobytes(), 0
            for piece, end in zip(some, ends.tolist(), strict=True):
                self.pieces[piece] = data[start:end]
                start = end
        for piece in pieces:
            if piece not in self.pieces:
                self.pieces[piece] = self._encoded(piece)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of whole texts as bytes of ``kind``; null is empty."""
        for group in groups(texts):
            split = [PIECES.findall(t) if t and PLAIN.match(t) and not any(s in t for s in self.special) else None
                     for t in group]
            known = self.pieces
            if len(known) >= CACHE_ENTRIES:
                known.clear()
            place, learned = known.__getitem__, False
            for text, pieces in zip(group, split, strict=True):
                if pieces is None:
                    yield self._encoded(text) if text else b""
                    continue
                try:
                    ids = b"".join(map(place, pieces))
                except KeyError:  # a group's new pieces are looked for only when its texts hold one
                    if learned:
                        raise
                    self._learn(list({p for some in split if some for p in some if p not in known}))
                    learned, ids = True, b"".join(map(place, pieces))
                yield ids


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str = VOCABULARY) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        uri = f"file://{uri}" if uri.startswith("/") else f"file:///{uri.removeprefix('file:').lstrip('/')}"
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard; memory is bounded by one record batch and the shard's index."""

    def __init__(self, folder: str, name: str, length: int, kind: np.dtype):
        self.store, self.folder = _place(folder)
        self.name, self.length, self.kind = name, length, kind
        self.store.create_dir(self.folder, recursive=True)
        # A name of its own until complete, so a lost or repeated attempt never leaves half a file under the final name.
        self.draft = f"{self.folder}/.{name}-{uuid.uuid4().hex}"
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.store.open_output_stream(self.draft)
        self.file = ipc.new_file(self.sink, self.schema)
        self.waiting: list[bytes] = []
        self.size, self.total, self.index = 0, 0, []

    def add(self, key, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.index.append((key, self.total, n))
        self.total += n
        self.waiting.append(ids)
        self.size += n
        if self.size >= self.length * BATCH_SEQUENCES:
            self._flush(False)

    def _flush(self, final: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), self.kind)
        step = self.length * BATCH_SEQUENCES
        at = 0
        while len(flat) - at >= step or (final and at < len(flat)):
            part = flat[at : at + step]
            rows = -(-len(part) // self.length)
            ids = np.zeros(rows * self.length, self.kind)
            mask = np.zeros(rows * self.length, bool)
            ids[: len(part)], mask[: len(part)] = part, True
            self.file.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)], schema=self.schema))
            at += len(part)
        self.waiting = [flat[at:].tobytes()] if at < len(flat) else []
        self.size = max(0, len(flat) - at)

    def close(self) -> tuple[int, int]:
        self._flush(True)
        self.file.close()
        self.sink.close()
        keys, starts, counts = zip(*self.index, strict=True) if self.index else ((), (), ())
        table = pa.table({"key": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()),
                          "n": pa.array(counts, pa.int64())})
        with self.store.open_output_stream(self.draft + ".index") as out, ipc.new_file(out, table.schema) as f:
            f.write_table(table)
        self.store.move(self.draft + ".index", f"{self.folder}/{self.name}.index.arrow")
        self.store.move(self.draft, f"{self.folder}/{self.name}.arrow")
        return len(self.index), self.total


class Shard:
    """Random access to one shard. On a local or mounted folder the file is mapped, and ids of one batch are not copied."""

    def __init__(self, folder: str, name: str):
        store, path = _place(folder)
        mapped = isinstance(store, fs.LocalFileSystem)
        opened = (lambda p: pa.memory_map(p)) if mapped else store.open_input_file
        self.file = ipc.open_file(opened(f"{path}/{name}.arrow"))
        self.index = ipc.open_file(opened(f"{path}/{name}.index.arrow")).read_all()
        self.length = self.file.schema.field("ids").type.list_size
        self.batch = (-1, None)

    def _values(self, k: int) -> np.ndarray:
        if self.batch[0] != k:
            self.batch = (k, self.file.get_batch(k).column(0).flatten().to_numpy(zero_copy_only=True))
        return self.batch[1]

    @property
    def sequences(self) -> int:
        """Number of equal-length sequences in the shard."""
        return sum(self.file.get_batch(k).num_rows for k in range(self.file.num_record_batches))

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``i`` of the shard: its ids, a view of the mapped file, and its mask, true for ids and false for padding."""
        k, row = divmod(i, BATCH_SEQUENCES)
        mask = self.file.get_batch(k).column(1).slice(row, 1).flatten()
        return self._values(k)[row * self.length : (row + 1) * self.length], mask.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from a place of the shard."""
        step = self.length * BATCH_SEQUENCES
        parts, at, end = [], start, start + n
        while at < end:
            k = at // step
            stop = min(end, (k + 1) * step)
            parts.append(self._values(k)[at - k * step : stop - k * step])
            at = stop
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.array([], np.uint16)


def write(docs: DataFrame, folder: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = 0,
          length: int = LENGTH, vocabulary: str = VOCABULARY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents in ascending order of key (nulls first) and return the manifest: shard, docs, ids, base.

    ``base`` is the number of ids in all shards before. The documents are range-partitioned by key, one shard per
    partition; equal keys lie together. Each task encodes its documents and writes them as they come. ``folder`` must be
    one that every executor reaches: a mounted path or a store that pyarrow can open. Null texts have the end id alone.
    """
    size = docs.agg(F.sum(F.octet_length(text)).alias("b"), F.count("*").alias("n")).first()
    shards = max(1, -(-int((size.b or 0) + 64 * size.n) // shard_bytes))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(shards, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("token files", _ENCODERS.clear)
        bpe = encoder(vocabulary)
        closing = b"" if end_id is None else np.array([end_id], bpe.kind).tobytes()
        shard = TaskContext.get().partitionId()
        writer = None
        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), bpe.encode(b.column(1).to_pylist()), strict=True):
                writer = writer or ShardWriter(folder, f"shard-{shard:06d}", length, bpe.kind)
                writer.add(k, ids + closing)
        if writer:
            n, total = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard]), "docs": pa.array([n]), "ids": pa.array([total])})

    manifest = kept(ordered.mapInArrow(run, "shard long, docs long, ids long"), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: key, start among all ids, n_tokens and the ids' checksum ``ids_crc32``.

    Each task opens its shards and takes every document's ids by its place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                opened = Shard(folder, f"shard-{shard:06d}")
                starts, counts = (opened.index.column(c).to_numpy() for c in ("start", "n"))
                sums = [zlib.crc32(opened.ids(s, n).astype("<u4").tobytes()) for s, n in zip(starts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [opened.index.column("key").combine_chunks(), pa.array(starts + base), pa.array(counts),
                     pa.array(sums, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("shard", "base").repartition(F.col("shard"))
    return shards.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark, docs: DataFrame) -> DataFrame:
    """Every document's place and ids in the files, the ids as a checksum. Null and empty texts have the end id alone, rows that
    repeat an id follow one another, null ids come first, an empty table gives no file and no rows, and columns but doc_id and
    text are ignored.
    """
    folder = scratch_dir(spark, "token-files")
    manifest = write(docs.select("doc_id", "text"), folder)
    return read(manifest, folder).withColumnRenamed("key", "doc_id")
