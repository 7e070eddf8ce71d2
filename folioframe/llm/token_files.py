"""Token ids in fixed-width, bit-packed files with random access.

A file is: 8 bytes of magic; blocks of BLOCK ids, each id in the fewest bits that hold the vocabulary, lowest bit
first, a block padded to whole bytes; the byte offset of each block and the end (unsigned 64 bits); the documents'
ids and token counts as an Arrow stream; then, in 40 bytes, bits, ids to a block, number of ids, lengths of the two
tables before, and the magic again. Block k starts at a stored offset, so any range of ids is read by unpacking the
blocks it touches, and numpy unpacks a block at once.

Every task of a job writes one file under a name of its attempt and then moves it to a fixed name, so a repeated or
speculative task leaves one whole file. Files go to the shared folder through pyarrow's file systems (local, HDFS, S3
and others by the folder's scheme).

Edge cases: a null text has no token but the end id; documents with equal ids are in the order of a hash of their
texts; a null doc_id comes first; repeated rows each get their own row; an empty table makes no file and no row; very
long texts span several blocks; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from folioframe.llm.bpe import read_definition, vocabulary
from folioframe.llm.pretoken import count_pieces, normalised, words
from folioframe.llm.shared import fresh_path, table, written

MAGIC = b"FOLIOIDS"
BLOCK = 65_536
END_ID = 2
#: A worker forgets its encoded words when it has so many.
CACHE_WORDS = 800_000
_TAIL = struct.Struct("<IIQQQ8s")


def bits_for(size: int) -> int:
    """Fewest bits that tell size ids apart."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids (unsigned 32 bits) in so many bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(rows[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed data."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    rows = np.zeros((n, 32), np.uint8)
    rows[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return np.packbits(rows, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    """Writes one file, block by block; memory holds one block and the documents' counts."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.offsets, self.at, self.n = [], len(MAGIC), 0
        self.docs, self.counts, self.open, self.waiting = [], [], [], 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.open.append(ids)
        self.waiting += len(ids)
        self.n += len(ids)
        if self.waiting >= BLOCK:
            ids = np.concatenate(self.open)
            whole = len(ids) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._block(ids[k : k + BLOCK])
            self.open, self.waiting = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.at += len(data)
        self.out.write(data)

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.open))
        offsets = np.array([*self.offsets, self.at], "<u8").tobytes()
        sink = io.BytesIO()
        docs = pa.record_batch([pa.array(self.docs, pa.int64()), pa.array(self.counts, pa.int64())], names=["doc_id", "n_tokens"])
        with pa.ipc.new_stream(sink, docs.schema) as stream:
            stream.write_batch(docs)
        self.out.write(offsets + sink.getvalue() + _TAIL.pack(self.bits, BLOCK, self.n, len(offsets), len(sink.getvalue()), MAGIC))


class Reader:
    """Reads ranges of ids and documents of one file."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - _TAIL.size)
        self.bits, self.block, self.n, a, b, magic = _TAIL.unpack(source.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        source.seek(end - _TAIL.size - a - b)
        self.offsets = np.frombuffer(source.read(a), "<u8")
        docs = pa.ipc.open_stream(source.read(b)).read_all()
        self.doc_ids, self.counts = docs.column(0).to_pylist(), docs.column(1).to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._at, self._ids = -1, None

    def _unpacked(self, k: int) -> np.ndarray:
        if k != self._at:
            a, b = int(self.offsets[k]), int(self.offsets[k + 1])
            self.source.seek(a)
            self._at, self._ids = k, unpack(self.source.read(b - a), self.bits, min(self.block, self.n - k * self.block))
        return self._ids

    def ids(self, start: int, end: int) -> np.ndarray:
        """ids from start to before end."""
        parts = [self._unpacked(k)[max(0, start - k * self.block) : end - k * self.block] for k in range(start // self.block, -(-end // self.block))]
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class WordEncoder:
    """Ids by the tokenizers library; words seen before are remembered as the bytes of their ids."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.seen: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode new words in one call of the library; each of their pieces ends with a token that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        last = np.cumsum([count_pieces(w, self.tokenizer) for w in new])
        if len(ends) != last[-1]:
            self.seen.update((w, self._whole(w)) for w in new)
            return
        data, at = ids.tobytes(), 0
        for w, end in zip(new, (ends[last - 1] * 4).tolist(), strict=True):
            self.seen[w] = data[at:end]
            at = end

    def _words(self, text: str) -> list[str] | None:
        """Words to encode one by one; none if the text's normal form isn't final, or if it, or what becomes of it, holds a
        special token: the library then takes the text as a whole, as it takes special tokens in their own case only."""
        found = normalised(text, self.tokenizer)
        if found is None or any(s in text or s in found[0] for s in self.special):
            return None
        return words(*found, self.tokenizer)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self._words(t) if t else [] for t in texts]
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        seen = self.seen
        new = list(set(chain.from_iterable(filter(None, split))).difference(seen))
        for k in range(0, len(new), 4096):
            self._learn(new[k : k + 4096])
        return [self._whole(t) if x is None else b"".join(map(seen.__getitem__, x)) for t, x in zip(texts, split, strict=True)]


_encoders: dict[str, WordEncoder] = {}


def encoder(definition: str) -> WordEncoder:
    """The worker's encoder for a definition; one is kept, so that its pieces serve later tasks too."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


MANIFEST = "path string, first_id bigint, first_hash bigint, n_docs bigint, n_ids bigint"


def write_files(spark: SparkSession, docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode docs in the order of doc_id into files in folder; the manifest has a row for each file."""
    shared = spark.sparkContext.broadcast(read_definition(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()

    def each(batches):
        words = encoder(shared.value)
        writer = first = None
        context = TaskContext.get()
        fs, base = FileSystem.from_uri(folder)
        final = f"{base}/ids-{context.partitionId():06d}.bin"
        draft = f"{base}/_draft-{context.partitionId():06d}-{context.taskAttemptId()}"
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                encoded = words.encode_batch(part.column(1).to_pylist())
                for doc_id, h, data in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), encoded, strict=True):
                    if writer is None:
                        fs.create_dir(base, recursive=True)
                        writer, first = Writer(fs.open_output_stream(draft), bits_for(words.size)), (doc_id, h)
                    writer.add(doc_id, np.frombuffer(data + end, "<u4"))
        if writer is not None:
            writer.close()
            writer.out.close()
            fs.move(draft, final)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in ((final, pa.string()), (first[0], pa.int64()), (first[1], pa.int64()), (len(writer.docs), pa.int64()), (writer.n, pa.int64()))], names=["path", "first_id", "first_hash", "n_docs", "n_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    return written(spark, ordered.mapInArrow(each, MANIFEST), "manifest")


def read_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each document of the files: where its ids start over all files, how many, and their crc32."""
    w = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash")
    placed = manifest.withColumn("start", F.sum("n_ids").over(w) - F.col("n_ids")).select("path", "start")

    def each(batches):
        fs, _ = FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(path) as source:
                    reader = Reader(source)
                    crc = [zlib.crc32(reader.document(k).tobytes()) for k in range(len(reader.doc_ids))]
                    yield pa.RecordBatch.from_arrays([pa.array(reader.doc_ids, pa.int64()), pa.array(reader.starts[:-1] + start, pa.int64()), pa.array(reader.counts, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return placed.repartition(files, "path").mapInArrow(each, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    manifest = write_files(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), folder)
    return read_files(spark, manifest, folder)
