"""Token-id output (operator 10): flat unsigned integer files with 64-bit document offsets.

One shard per partition of the documents in ascending id order:

* ``part-NNNNN.bin``  token ids, little-endian, 16 bits wide if every id of
  the vocabulary fits and 32 bits otherwise;
* ``part-NNNNN.idx``  the magic ``TOKIDX1`` and the width, the document
  count, then per document its id (int64), whether the id is present
  (uint8), and count + 1 token offsets (int64) relative to the shard.

A shard's base -- tokens and documents in all shards before it -- is the
prefix sum of the shards' totals and stands in ``manifest.json``.  A task
writes under a name of its own and renames at the end, so a repeated or
speculative attempt leaves the same complete files.  Readers map the files
into memory.

Order and edge cases: rows without an id come first; rows that share an id
are ordered by their text; a null or empty text has the end id alone.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricescope.llm.common import scratch

MAGIC = b"TOKIDX1\0"
HEAD = "<8sqq"
#: Words a worker remembers the ids of; the memory is emptied beyond that.
REMEMBER = 700_000
#: ASCII marks that form a run of their own after a word (no apostrophe: it starts contractions).
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


class WordIds(dict):
    """Word -> its ids as bytes, filled by the tokenizers library on first sight.

    The vocabulary's pre-tokenizer never joins across white space, nor a word
    of letters with the marks after it, so a text's ids are those of its
    pieces in order, and frequent pieces are encoded once per worker.  Letters
    are judged after the vocabulary's normalisation, which splits some of
    them (a dotted capital I) into a letter and a mark.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.code, self.tok = {"<u2": "H", "<u4": "I"}[dtype], Tokenizer.from_file(path)
        self.model = self.tok.model
        self[""] = b""

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _letters(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or self.tok.normalizer.normalize_str(word).isalpha())

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBER:
            self.clear()
            self[""] = b""
        stem = word.rstrip(MARKS)
        if stem != word and self._letters(stem):
            got = self[stem] + self[word[len(stem):]]
        elif word.isascii() and word.isalpha():
            low = word.lower()
            got = self[low] if low != word else self._pack([t.id for t in self.model.tokenize(word)])
        else:
            got = self._pack(self.tok.encode(word, add_special_tokens=False).ids)
        if len(word) <= 40:
            self[word] = got
        return got

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


@functools.cache
def word_ids(path: str, dtype: str) -> WordIds:
    """The worker process's own encoder, kept from task to task."""
    return WordIds(path, dtype)


def width_of(path: str, end_id: int) -> str:
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    most = max(end_id, *tok.get_vocab(with_added_tokens=True).values())
    return "<u2" if most < 2**16 else "<u4"


def _fs(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def _writer(folder: str, tokenizer: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = _fs(folder)
        tmp, name = f"{base}/_{part:05d}-{uuid.uuid4().hex}", f"{base}/part-{part:05d}"
        words, end = word_ids(tokenizer, dtype), np.array([end_id], dtype).tobytes()
        size, ids, have, offsets = len(end), [], [], [0]
        with fs.open_output_stream(f"{tmp}.bin") as out:
            for b in batches:
                for text in b.column("text"):
                    data = words.encode(text.as_py()) + end
                    out.write(data)
                    offsets.append(offsets[-1] + len(data) // size)
                key = b.column("doc_id")
                ids.append(np.asarray(key.fill_null(0), "<i8"))
                have.append(np.asarray(key.is_valid(), np.uint8))
        n = len(offsets) - 1
        if n:
            with fs.open_output_stream(f"{tmp}.idx") as out:
                out.write(struct.pack(HEAD, MAGIC, size, n))
                for x in (np.concatenate(ids), np.concatenate(have), np.array(offsets, "<i8")):
                    out.write(x.tobytes())
            fs.move(f"{tmp}.bin", f"{name}.bin")
            fs.move(f"{tmp}.idx", f"{name}.idx")
            yield pa.record_batch({"part": pa.array([part], pa.int64()), "docs": pa.array([n], pa.int64()),
                                   "tokens": pa.array([offsets[-1]], pa.int64())})
        else:
            fs.delete_file(f"{tmp}.bin")
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Encode every document and write the shards; returns the manifest.

    ``folder`` must be reachable by all executors.  Only one row per shard
    (its counts) comes to the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = (rows.repartitionByRange(partitions, "doc_id") if partitions else rows.repartitionByRange("doc_id"))
    fs, base = _fs(folder)
    fs.create_dir(base)
    dtype = width_of(tokenizer, end_id)
    parts = (rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
             .mapInArrow(_writer(folder, tokenizer, end_id, dtype), "part long, docs long, tokens long")
             .collect())
    manifest = {"width": int(dtype[-1]), "shards": []}
    doc_base = token_base = 0
    for p in sorted(parts):
        manifest["shards"].append({"name": f"part-{p['part']:05d}", "docs": p["docs"], "tokens": p["tokens"],
                                   "doc_base": doc_base, "token_base": token_base})
        doc_base, token_base = doc_base + p["docs"], token_base + p["tokens"]
    with fs.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def open_shard(folder: str, name: str):
    """(doc_ids, present, offsets, ids) of a shard; ids are mapped from the file, not loaded."""
    fs, base = _fs(folder)
    with fs.open_input_file(f"{base}/{name}.idx") as f:
        magic, width, n = struct.unpack(HEAD, f.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError(f"{name}.idx is no token index")
        ids, have = np.frombuffer(f.read(8 * n), "<i8"), np.frombuffer(f.read(n), np.uint8)
        offsets = np.frombuffer(f.read(8 * (n + 1)), "<i8")
    path, kind = f"{base}/{name}.bin", f"<u{width}"
    if isinstance(fs, pafs.LocalFileSystem):
        return ids, have, offsets, np.memmap(path, kind, "r")
    return ids, have, offsets, _Ranges(fs.open_input_file(path), kind)


class _Ranges:
    """Slices of a remote file, read when asked for."""

    def __init__(self, file, kind: str):
        self.file, self.kind, self.size = file, kind, np.dtype(kind).itemsize

    def __getitem__(self, at: slice) -> np.ndarray:
        got = self.file.read_at((at.stop - at.start) * self.size, at.start * self.size)
        return np.frombuffer(got, self.kind)


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, base in zip(b.column("name").to_pylist(), b.column("token_base").to_pylist(), strict=True):
                ids, have, offsets, data = open_shard(folder, name)
                for i in range(0, len(ids), 20_000):
                    j = min(i + 20_000, len(ids))
                    crc = [zlib.crc32(np.ascontiguousarray(data[offsets[d]:offsets[d + 1]], "<u4"))
                           for d in range(i, j)]
                    yield pa.record_batch({
                        "doc_id": pa.array(ids[i:j], mask=have[i:j] == 0), "start": pa.array(base + offsets[i:j]),
                        "n_tokens": pa.array(np.diff(offsets[i:j + 1])), "ids_crc32": pa.array(crc, pa.int64())})
    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32."""
    fs, base = _fs(folder)
    with fs.open_input_file(f"{base}/manifest.json") as f:
        shards = json.loads(f.read())["shards"]
    rows = [(s["name"], s["token_base"]) for s in shards]
    df = spark.createDataFrame(rows, "name string, token_base long")
    if rows:
        df = df.repartition(len(rows), "name")
    return df.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write the files of ``docs`` and read them back as one row per document."""
    folder = folder or scratch(docs.sparkSession, "token-files")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder)
