"""Token ids in bit-packed files.

File format (little endian): the blocks, then what finds them, so that a file is written
from front to back while its documents are encoded.

    magic    "QMTOK2\\0\\0"
    blocks   up to `block length` ids, each in `bits` bits, lowest bits first
    offsets  the byte offset of each block from the first, and the end (uint64)
    table    for each document its id (int64), whether it is null (int64), the first of
             its ids (int64); a last row holds the number of all ids
    footer   bits, block length, documents, ids (uint64), magic

`bits` is the least width that holds every id of the vocabulary, so eight ids fill
`bits` bytes and numpy packs and unpacks them in columns. A block starts at a byte of
its own: ids can be read from the middle of a file through the offsets.

The documents are dealt out by ranges of their id and sorted; each part writes its
files into the shared folder, each under a name of its own attempt first, and renames
it, so that a part that is run again replaces its files by equal ones. A file ends
with the chunk of documents that brings it to FILE_DOCS documents or FILE_IDS ids; of it, a
writer holds the ids that do not fill a block yet and the table, a reader one piece of
PIECE ids: neither grows with the partition.

Encoding: no token of the vocabulary spans white space, so texts are cut at ASCII white
space, and each span that a worker has not seen yet goes through the tokenizers library
(other white space stays inside a span, where the library drops it).

Defined cases: a null text is empty and gives only the end id; documents are in
ascending order of their id (null first), equal ids by text; a text may be of any length; an
empty table writes no file; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.ragged import chunks_by_size, clears_cache, offsets_of, worker
from quillmill.llm.spans import SpanCache
from quillmill.session import bound_arrow_batches, maybe_broadcast

MAGIC = b"QMTOK2\0\0"
BLOCK = 4096  # ids of a block; a multiple of 8
#: Documents, and ids, with which a file ends.
FILE_DOCS, FILE_IDS = 1_000_000, 256_000_000
#: Ids that a reader unpacks at once; a multiple of BLOCK.
PIECE = 64 * BLOCK
_FOOTER = 4 * 8 + len(MAGIC)
#: Bytes of text, and spans, handled at once.
CHUNK = 1_000_000
ENCODED_AT_ONCE = 1_000


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids in `bits` bits each; the last byte is filled up with zeros."""
    n = len(ids)
    rows = np.zeros((-(-n // 8), 8), np.uint64)
    rows.reshape(-1)[:n] = ids
    out = np.zeros((len(rows), bits + 8), np.uint8)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        value = rows[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, at + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].reshape(-1)[: -(-n * bits // 8)]


def unpack(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    rows = np.zeros((-(-n // 8), bits), np.uint8)
    rows.reshape(-1)[: len(data)] = data
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        value = np.zeros(len(rows), np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= rows[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class TokenWriter:
    """Writes one file, front to back."""

    def __init__(self, out: BinaryIO, bits: int):
        self.out, self.bits = out, bits
        self.n_docs = self.n_ids = self._blocks = 0
        self._rest = np.zeros(0, np.uint32)
        self._tables: list[np.ndarray] = []
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> None:
        starts = self.n_ids + offsets_of(counts)[:-1]
        self._tables.append(np.array([[0 if d is None else d for d in doc_ids], [d is None for d in doc_ids], starts], "<i8").T)
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)
        self._rest = np.concatenate((self._rest, ids.astype(np.uint32)))
        whole = len(self._rest) // BLOCK * BLOCK
        # whole blocks begin at whole bytes, so all of them are packed at once
        self.out.write(pack(self._rest[:whole], self.bits).tobytes())
        self._blocks += whole // BLOCK
        self._rest = self._rest[whole:]

    def close(self) -> None:
        last = pack(self._rest, self.bits)
        size = BLOCK * self.bits // 8
        offsets = np.arange(self._blocks + 1, dtype="<u8") * np.uint64(size)
        if len(self._rest):
            offsets = np.append(offsets, offsets[-1] + np.uint64(len(last))).astype("<u8")
        self.out.write(last.tobytes())
        self.out.write(offsets.tobytes())
        for table in self._tables:
            self.out.write(table.tobytes())
        self.out.write(np.array([0, 0, self.n_ids], "<i8").tobytes())
        self.out.write(np.array([self.bits, BLOCK, self.n_docs, self.n_ids], "<u8").tobytes() + MAGIC)


class TokenFile:
    """A file, read at random: nothing but what is asked for is read."""

    def __init__(self, source: BinaryIO, size: int):
        self.source = source
        footer = self._read(size - _FOOTER, _FOOTER)
        if footer[-len(MAGIC) :].tobytes() != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, self.n_docs, self.n_ids = (int(x) for x in footer[:32].view("<u8"))
        self._table_at = size - _FOOTER - 24 * (self.n_docs + 1)
        self._offsets_at = self._table_at - 8 * (-(-self.n_ids // self.block) + 1)

    def _read(self, at: int, n: int) -> np.ndarray:
        self.source.seek(at)
        return np.frombuffer(self.source.read(n), np.uint8)

    def table(self, i: int, j: int) -> np.ndarray:
        """Rows i to j - 1 of the table and the one behind them: id, whether it is null, first of the ids."""
        return self._read(self._table_at + 24 * i, 24 * (j - i + 1)).view("<i8").reshape(-1, 3)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from the start-th on; only the blocks that hold them are read and unpacked."""
        if n == 0:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-(start + n) // self.block)
        offsets = self._read(self._offsets_at + 8 * a, 8 * (b - a + 1)).view("<u8")
        data = self._read(len(MAGIC) + int(offsets[0]), int(offsets[-1] - offsets[0]))
        skip = start - a * self.block
        return unpack(data, self.bits, min(b * self.block, self.n_ids) - a * self.block)[skip : skip + n]

    def document(self, i: int) -> np.ndarray:
        a, b = self.table(i, i + 1)[:, 2].tolist()
        return self.ids(a, b - a)


@lru_cache(maxsize=2)
def span_encoder(path: str) -> SpanCache:
    """Encodes texts by a tokenizer of the tokenizers library that drops white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(spans: list[str]) -> Iterator[list[int]]:
        for i in range(0, len(spans), ENCODED_AT_ONCE):
            for found in tokenizer.encode_batch_fast(spans[i : i + ENCODED_AT_ONCE], add_special_tokens=False):
                yield found.ids

    return SpanCache(encode, keep_space=False)


clears_cache("token_files", span_encoder.cache_clear)


def _filesystem(uri: str):
    """pyarrow's file system of the URI, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if rest and known not in ("file", "hdfs", "viewfs", "s3", "gs"):
        raise ValueError(f"token files need a folder that pyarrow opens (file, hdfs, viewfs, s3, gs), not {uri}")
    return fs.FileSystem.from_uri(f"{known}://{rest}" if rest else uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, vocabulary_size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return part, nth, file, docs, ids of each, as a small table, in order of the documents.

    folder: a URI below the shared folder. tokenizer: a path that every executor has.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    _filesystem(folder)
    bits = bits_for(vocabulary_size)

    @worker("token_files")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = span_encoder(tokenizer)
        system, path = _filesystem(folder)
        part, nth = TaskContext.get().partitionId(), 0
        writer, out, own = None, None, ""

        def finish() -> pa.RecordBatch:
            writer.close()
            out.close()
            name = f"part-{part:06d}-{nth:04d}.tok"
            system.move(own, f"{path}/{name}")
            return pa.RecordBatch.from_pydict({"part": [part], "nth": [nth], "file": [f"{folder}/{name}"], "docs": [writer.n_docs], "ids": [writer.n_ids]})

        for batch in batches:
            texts = batch.column(1)
            for i, j in chunks_by_size(pa.compute.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    own = f"{path}/_{part:06d}.{uuid.uuid4().hex}"
                    out = system.open_output_stream(own)
                    writer = TokenWriter(out, bits)
                found, offsets = encoder.encode([(t or "").encode() for t in texts[i:j].to_pylist()])
                # the end id goes behind each document's ids
                writer.add(batch.column(0)[i:j].to_pylist(), np.diff(offsets) + 1, np.insert(found, offsets[1:], end_id))
                if writer.n_docs >= FILE_DOCS or writer.n_ids >= FILE_IDS:
                    yield finish()
                    writer, nth = None, nth + 1
        if writer is not None:
            yield finish()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(id_col).asc_nulls_first(), F.col(text_col)]
    kind = "part long, nth long, file string, docs long, ids long"
    written = (
        docs.select(F.col(id_col).cast("long"), text_col)
        .repartitionByRange(parts, F.col(id_col).asc_nulls_first())
        .sortWithinPartitions(*order)
        .mapInArrow(write, kind)
        .collect()  # a row a file
    )
    return spark.createDataFrame(sorted(written), kind)


def read_token_files(files: DataFrame, id_col: str = "doc_id", digest: Callable[[np.ndarray, int], int] | None = None) -> DataFrame:
    """id, start (ids of all documents before), n_tokens, ids: read back from the files of write_token_files().

    With digest, a running value over pieces of a document's ids (uint32, and the value so
    far, 0 first) is returned in their place, so that they need not leave the reader.
    """
    spark = files.sparkSession
    listed = sorted(files.collect())  # a row a file
    rows, before = [], 0
    for i, f in enumerate(listed):
        rows.append((i, f["file"], before))
        before += f["ids"]

    def running(tokens: TokenFile, edges: np.ndarray) -> list[int]:
        """The digests of the documents between these edges, PIECE ids at once."""
        values = [0] * (len(edges) - 1)
        for low in range(int(edges[0]), int(edges[-1]), PIECE):
            high = min(low + PIECE, int(edges[-1]))
            ids = tokens.ids(low, high - low)
            for d in range(int(np.searchsorted(edges, low, "right")) - 1, int(np.searchsorted(edges, high, "left"))):
                a, b = max(int(edges[d]), low), min(int(edges[d + 1]), high)
                if a < b:
                    values[d] = digest(ids[a - low : b - low], values[d])
        return values

    @worker("token_files")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                system, path = _filesystem(file)
                with system.open_input_file(path) as f:
                    tokens = TokenFile(f, f.size())
                    for low in range(0, tokens.n_docs, BLOCK):
                        some = tokens.table(low, min(low + BLOCK, tokens.n_docs))
                        for i, j in chunks_by_size(np.diff(some[:, 2]).tolist(), PIECE):
                            part, edges = some[i:j], some[i : j + 1, 2]
                            if digest is None:
                                ids = tokens.ids(int(edges[0]), int(edges[-1] - edges[0]))
                                found = pa.ListArray.from_arrays(pa.array((edges - edges[0]).astype(np.int32)), pa.array(ids.astype(np.int64)))
                            else:
                                found = pa.array(running(tokens, edges), pa.int64())
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(part[:, 0], mask=part[:, 1].astype(bool)), pa.array(part[:, 2] + base), pa.array(np.diff(edges)), found],
                                names=[id_col, "start", "n_tokens", last],
                            )

    last, kind = ("ids", "array<long>") if digest is None else ("digest", "long")
    # one task a file
    todo = spark.range(0, len(rows), 1, max(1, len(rows))).join(maybe_broadcast(spark.createDataFrame(rows, "id long, file string, base long")), "id")
    return todo.select("file", "base").mapInArrow(read, f"`{id_col}` long, start long, n_tokens long, {last} {kind}")


def ids_crc32(ids: np.ndarray, before: int = 0) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers, carried on from `before`."""
    return zlib.crc32(ids.astype("<u4").tobytes(), before)
