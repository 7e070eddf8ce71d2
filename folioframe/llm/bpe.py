"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, and decoding.

A piece starts as one symbol for each byte. The leaves of the tree are the ranks of adjacent pairs; the root has the
lowest rank, and of equal ones the leftmost. Merging it changes two neighbouring pairs and removes one, each a point
update along one path to the root. When no pair is in the merge table, the root is infinite and the piece is done.

Edge cases: a null text is encoded as an empty one, which has no tokens; special tokens in a text become their ids;
one piece may be the whole of a very long text, which takes n log n steps; repeated rows each get their own row; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from folioframe.llm.pretoken import byte_pieces
from folioframe.llm.shared import table

#: A worker forgets its encoded pieces when it has so many.
CACHE_PIECES = 400_000
#: Children of a node of the tree; the lowest of them is found in one call.
FAN = 64
_SHIFT = 32
_NONE = 1 << 62


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves; the others take the code points from 256 on, in order.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def _update(levels: list[list[int]], nodes: set[int]) -> None:
    """Make the ancestors of changed leaves right again; nodes are their parents."""
    for below, level in zip(levels, levels[1:], strict=False):
        for k in nodes:
            level[k] = min(below[k * FAN : k * FAN + FAN])
        nodes = {k // FAN for k in nodes}


class _Pieces(dict):
    """Ids of pieces seen before; computes missing ones."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece):
        if len(self) >= CACHE_PIECES:
            self.clear()
        ids = self[piece] = self.encode(piece)
        return ids


class SegmentTreeBPE:
    """Encoder and decoder for a byte-level vocabulary in the tokenizers library's format."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = [vocab[c] for c in letters]
        pair = lambda m: m if isinstance(m, list) else m.split(" ")
        self.merges = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = pair(m)
            self.merges.setdefault((vocab[a], vocab[b]), (rank << _SHIFT, vocab[a + b]))
        back = {c: bytes([b]) for b, c in enumerate(letters)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = b"".join(map(back.__getitem__, token))
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.special = special
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.tokenizer = Tokenizer.from_str(definition)
        self.pieces = _Pieces(self.encode_piece)

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        symbols = [self.byte_ids[b] for b in piece.encode()]
        n = len(symbols)
        if n < 2:
            return symbols
        find = self.merges.get
        leaves, made = [_NONE] * n, [0] * n
        for i in range(n - 1):
            if hit := find((symbols[i], symbols[i + 1])):
                leaves[i], made[i] = hit[0] + i, hit[1]
        levels = [leaves]
        while len(levels[-1]) > FAN:
            below = levels[-1]
            levels.append([min(below[k : k + FAN]) for k in range(0, len(below), FAN)])
        top, deep = levels[-1], len(levels) > 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := min(top)) < _NONE:
            i = root & 0xFFFFFFFF
            j = after[i]
            symbols[i], symbols[j] = now, _ = made[i], -1
            k = after[i] = after[j]
            leaves[j] = leaves[i] = _NONE
            if k < n:
                before[k] = i
                if hit := find((now, symbols[k])):
                    leaves[i], made[i] = hit[0] + i, hit[1]
            p = before[i]
            if p >= 0:
                hit = find((symbols[p], now))
                leaves[p] = _NONE
                if hit:
                    leaves[p], made[p] = hit[0] + p, hit[1]
            if deep:
                _update(levels, {i // FAN, j // FAN, max(p, 0) // FAN})
        return [s for s in symbols if s >= 0]

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a whole text."""
        if not text:
            return []
        if self.special_re is None or not self.special_re.search(text):
            return list(chain.from_iterable(map(self.pieces.__getitem__, byte_pieces(text, self.tokenizer))))
        ids: list[int] = []
        for k, part in enumerate(self.special_re.split(text)):
            if k % 2:
                ids.append(self.special[part])
            elif part:
                ids.extend(chain.from_iterable(map(self.pieces.__getitem__, byte_pieces(part, self.tokenizer))))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of token ids, special ones included; what isn't UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_coders: dict[str, SegmentTreeBPE] = {}


def coder(definition: str) -> SegmentTreeBPE:
    """The worker's coder for a definition; one is kept, so that its pieces serve later tasks too."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _coders:
        _coders.clear()
        _coders[key] = SegmentTreeBPE(definition)
    return _coders[key]


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id of docs with the array ids. The vocabulary file has a fixed size, so it is broadcast."""
    shared = spark.sparkContext.broadcast(read_definition(tokenizer_path))

    def each(batches):
        bpe = coder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id bigint, ids array<int>")


def decode(spark: SparkSession, encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""
    shared = spark.sparkContext.broadcast(read_definition(tokenizer_path))

    def each(batches):
        bpe = coder(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id bigint, text string")


def digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str, also: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: number of tokens, digest of the ids and of the text decoded from them.

    also: bigint columns that pass through.
    """
    shared = spark.sparkContext.broadcast(read_definition(tokenizer_path))

    def each(batches):
        bpe = coder(shared.value)
        names = [str(i) for i in range(len(bpe.bytes_of))]
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), *batch.columns[2:]], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *also])

    return docs.select("doc_id", "text", *also).mapInArrow(each, ", ".join(["doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", *[f"{c} bigint" for c in also]]))


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
