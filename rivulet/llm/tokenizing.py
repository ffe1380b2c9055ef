"""Operator 1: byte-level BPE encoding and decoding.

A rank file (token bytes, rank) is serialised straight into a sentencepiece
BPE model: every byte ``b`` becomes the character ``U+0100+b``, a token
becomes the piece of its mapped bytes at id = rank with score ``-rank``, and
the normaliser is the identity. A text is cut into pre-tokens by the pattern
that belongs to the ranks, each pre-token is encoded by that model, and ids
are decoded by the inverse byte mapping.

Defined results: null or empty text -> no ids, empty bytes. Any other column
of the input is left alone; repeated rows give repeated results; an empty
table gives an empty one. A text is never cut other than by the pattern, so
its length does not matter for the ids.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm.common import once_per_process, read_table, slices, text_or_empty

#: First of the 256 characters that stand for bytes.
BYTE_BASE = 0x100
#: Text whose pre-tokens are told apart at once.
SLICE_BYTES = 3 << 20
#: Rows decoded at once.
DECODE_ROWS = 500
#: Distinct pre-tokens in each of the two generations a worker remembers.
CACHE_ENTRIES = 100_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protobuf field: int -> varint, float -> 32 bits, else length-delimited."""
    if isinstance(value, (bool, int)):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def map_bytes(data: bytes) -> str:
    """Bytes -> the string of their stand-in characters."""
    return data.decode("latin-1").translate(_TO_CHAR)


_TO_CHAR = {b: chr(BYTE_BASE + b) for b in range(256)}


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model (protobuf bytes) of a rank vocabulary.

    Piece ``i`` is the token of rank ``i``; the unknown piece, which valid
    input never needs, comes last. Ranks must be 0..n-1.
    """
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0..n-1 without gaps")
    out = bytearray()
    for rank, token in enumerate(tokens):
        out += _field(1, _field(1, map_bytes(token)) + _field(2, -float(rank)) + _field(3, 1))
    unk = len(tokens)
    out += _field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    # trainer: BPE, no control pieces; normaliser: identity, white space as it is
    out += _field(2, _field(3, 2) + _field(4, unk + 1) + _field(40, unk)
                  + _field(41, -1) + _field(42, -1) + _field(43, -1))
    out += _field(3, _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False))
    return bytes(out)


class ByteBpe:
    """Encoder and decoder over a serialised model; one per task."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        pieces = [self._inverse(self.sp.id_to_piece(i)) for i in range(len(ranks))]
        self.piece_size = np.array([len(p) for p in pieces], np.int64)
        self.piece_first = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    @staticmethod
    def _inverse(piece: str) -> bytes:
        return bytes(ord(c) - BYTE_BASE for c in piece)

    def _learn(self, pretokens: list[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens. A pre-token that is itself a token is
        that token even where no chain of merges reaches it."""
        raw = [t.encode("utf-8", "surrogatepass") for t in pretokens]
        known = {t: array("i", (self.ranks[b],)).tobytes() for t, b in zip(pretokens, raw) if b in self.ranks}
        rest = [(t, map_bytes(b)) for t, b in zip(pretokens, raw) if b not in self.ranks]
        ids = self.sp.encode([m for _, m in rest], out_type=int, num_threads=1) if rest else []
        known.update((t, array("i", x).tobytes()) for (t, _), x in zip(rest, ids))
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found = [self.find(t) for t in texts]
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        young, old, all_of = self.young, self.old, set().union(*found)
        young.update({t: old[t] for t in all_of if t not in young and t in old})
        young.update(self._learn([t for t in all_of if t not in young]))
        ids_of = {t: young[t] for t in all_of}.__getitem__
        return [np.frombuffer(b"".join(map(ids_of, f)), np.int32) for f in found]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, by the inverse mapping."""
        size = self.piece_size[ids]
        until = np.cumsum(size)
        if not len(until):
            return b""
        at = np.repeat(self.piece_first[ids] - until + size, size) + np.arange(until[-1])
        return self.piece_bytes[at].tobytes()


def _default_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """(id_col, ids array<int>) of every row. The rank file is read once on
    the driver (its size is the vocabulary's, not the data's) and shipped."""
    with open(ranks_path, "rb") as f:
        data = f.read()
    digest = hashlib.sha256(data + pattern.encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast((serialize_model(read_ranks(data)), data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once_per_process(f"bpe {digest}", lambda: ByteBpe(shared.value[0], read_ranks(shared.value[1]), pattern))
        gc.disable()      # millions of small strings and no cycles; a worker ends with its executor
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES):
                rows = bpe.encode(part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
                flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat)], [id_col, ids_col])

    src = df.select(F.col(id_col), text_or_empty(text_col).alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, `{ids_col}` array<int>")


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Adds the bytes that ``ids_col`` stands for (null ids: null)."""
    with open(ranks_path, "rb") as f:
        data = f.read()
    digest = hashlib.sha256(data + pattern.encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast((serialize_model(read_ranks(data)), data))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once_per_process(f"bpe {digest}", lambda: ByteBpe(shared.value[0], read_ranks(shared.value[1]), pattern))
        for batch in batches:
            names = [n for n in batch.schema.names if n != out_col]
            ids = batch.column(ids_col)
            ends = np.cumsum([0, *(n or 0 for n in pa.compute.list_value_length(ids).to_pylist())])
            flat = ids.flatten().to_numpy()
            for at in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(at, DECODE_ROWS)
                texts = [bpe.decode(flat[ends[i]:ends[i + 1]]) if part.column(ids_col)[i - at].is_valid else None
                         for i in range(at, at + part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(texts, pa.binary())], [*names, out_col])

    return df.mapInArrow(run, f"{fields}, `{out_col}` binary")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    path, pattern = _default_file()
    ids = encode(read_table(spark, sf_dir, "documents"), path, pattern)
    both = decode(ids, path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
