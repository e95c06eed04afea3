"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding.

A vocabulary of ranks over byte strings becomes a character vocabulary by the usual table of 256 printable
characters, one per byte, so a character of the mapped text is a byte of the text and the library's offsets
are byte offsets.  A text is first split by the pattern; each different piece is encoded once and kept in a
bounded cache, since most pieces come back.  Decoding looks the bytes of each id up and joins them, so a
character whose bytes are spread over several tokens is whole again; bytes that are no UTF-8 remain bytes.

Each task holds one slice of about 256 KB of text and the cache.  Nothing is shuffled.

Defined results: null and empty texts have no tokens and decode to the empty string.  Further columns are
ignored; an empty table gives an empty result; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.llm.common import ready, slices

CACHED = 200_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    # The byte ranges that stand for themselves.
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The last merge that makes a token out of tokens of lower rank."""
    parts = [token[i:i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        options = [(ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(options)
        if rank >= limit:
            raise ValueError(f"no merges lead to the token {token!r}")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def _pattern(pattern: str) -> str:
    """White space as Unicode has it, whatever the engine takes it for."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def build(ranks: dict[bytes, int]) -> str:
    """The library's model of the ranks, over mapped characters, as JSON."""
    from tokenizers import Tokenizer, models

    shown = byte_characters()
    mapped = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [tuple(mapped[part] for part in _halves(token, ranks))
              for token in sorted(ranks, key=ranks.__getitem__) if len(token) > 1]
    model = models.BPE({mapped[token]: rank for token, rank in ranks.items()}, merges, ignore_merges=True)
    return Tokenizer(model).to_str()


class Encoder:
    """One per task: the library's tokenizer and the ids of the pieces met."""

    def __init__(self, model: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.pieces = regex.compile(_pattern(pattern)).findall
        self.table = {byte: char for byte, char in enumerate(byte_characters())}
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        split = [self.pieces(text) for text in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        unknown = list(dict.fromkeys(p for pieces in split for p in pieces if p not in self.cache))
        mapped = [piece.encode().decode("latin-1").translate(self.table) for piece in unknown]
        for piece, found in zip(unknown, self.tokenizer.encode_batch_fast(mapped, add_special_tokens=False)):
            self.cache[piece] = np.array(found.ids, "<u4").tobytes()
        ids_of = self.cache.__getitem__
        return [b"".join(map(ids_of, pieces)) for pieces in split]


def _encode(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for part in slices(batch, "to_encode"):
                ids = encoder.encode(part.column("to_encode").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids, pa.binary())], names=[*part.schema.names[:-1], "ids"])

    return encode


def _shared(spark: SparkSession, path: str, pattern: str):
    """The model once per executor; as large as the vocabulary, whatever the texts."""
    return spark.sparkContext.broadcast((build(read_ranks(path)), pattern))


def encode(documents: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns to ``keep``, and ``ids``: little-endian unsigned 32-bit integers, one after another."""
    spark = ready(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), *keep, F.coalesce("text", F.lit("")).alias("to_encode"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    return rows.mapInArrow(_encode(_shared(spark, path, pattern)), f"{fields}, ids binary")


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id, by way of the characters and back."""
    shown = byte_characters()
    byte_of = {char: byte for byte, char in enumerate(shown)}
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = bytes(byte_of[char] for char in "".join(shown[b] for b in token))
    return table


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes of their ids."""
    spark = ready(encoded.sparkSession)
    shared = spark.sparkContext.broadcast(token_bytes(read_ranks(path)))

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = shared.value.__getitem__
        for batch in batches:
            for part in slices(batch, "ids"):
                decoded = [b"".join(map(bytes_of, np.frombuffer(ids or b"", "<u4").tolist()))
                           for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(lookup, f"{fields}, decoded binary")


def token_offsets(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, position, id, start_char, end_char``: the characters that each token has a byte of.

    Tokens that share a character overlap in it.
    """
    spark = ready(encoded.sparkSession)
    shared = spark.sparkContext.broadcast(token_bytes(read_ranks(path)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(packed or b"", "<u4")
                parts = [table[i] for i in ids.tolist()]
                data = np.frombuffer(b"".join(parts), np.uint8)
                begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters begun before each byte
                ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
                starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                inner = (data[starts] & 0xC0) == 0x80 if len(ends) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(ids), pa.int64()), pa.array(np.arange(len(ids), dtype=np.int64)),
                     pa.array(ids.astype(np.int64)), pa.array(begun[starts] - inner), pa.array(begun[ends])],
                    names=["doc_id", "position", "id", "start_char", "end_char"])

    return encoded.mapInArrow(place, "doc_id long, position long, id long, start_char long, end_char long")
