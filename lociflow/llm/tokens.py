"""Token ids of a public byte-level tokenizer, through a sentencepiece model built from its vocabulary.

Byte-level BPE merges the pair whose join has the lowest rank; sentencepiece BPE merges the pair
whose join has the highest score. A model whose pieces are the vocabulary's entries, mapped byte
by byte to printable characters and scored by negative rank, under identity normalisation and
without dummy prefix or white-space handling, therefore makes the same merges in the same order.
Texts are first cut into pre-tokens, which merges never cross.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files, unless given.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how byte-level BPE of this vocabulary cuts a text into pre-tokens.
PRETOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens kept encoded in a Python worker; longer ones aren't kept.
CACHED, CACHED_LENGTH = 400_000, 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it prints, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def ranked_vocabulary(name: str, folder: str = TOKENIZERS) -> list[bytes]:
    """The byte strings of a .tiktoken file by rank; ranks must be 0, 1, 2, ..."""
    pairs = (line.split() for line in (Path(folder) / f"{name}.tiktoken").read_bytes().splitlines() if line)
    entries = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [r for r, _ in entries] != list(range(len(entries))):
        raise ValueError(f"{name}: the ranks are not consecutive")
    return [t for _, t in entries]


def sentencepiece_model(vocabulary: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model: entry k is piece k with score -k; the unknown piece comes last."""
    chars = byte_characters()
    pieces = bytearray()
    for rank, token in enumerate(vocabulary):
        piece = "".join(chars[b] for b in token).encode()
        pieces += _bytes(1, _bytes(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)))
    unknown = len(vocabulary)
    pieces += _bytes(1, _bytes(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    no_id = (1 << 64) - 1  # -1
    trainer = _number(3, 2) + _number(4, unknown + 1) + _number(40, unknown) + _number(41, no_id) + _number(42, no_id) + _number(43, no_id)
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


class Encoder(dict):
    """pre-token -> ids, filled as pre-tokens are met."""

    def __init__(self, name: str, folder: str) -> None:
        import regex
        import sentencepiece

        super().__init__()
        self.vocabulary = ranked_vocabulary(name, folder)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.vocabulary))
        self.mapping = {b: c for b, c in enumerate(byte_characters())}
        self.back = {c: b for b, c in self.mapping.items()}
        self.whole = {t: i for i, t in enumerate(self.vocabulary)}
        self.cut = regex.compile(PRETOKENS).findall

    def __missing__(self, pretoken: str) -> list[int]:
        raw = pretoken.encode("utf-8", "surrogatepass")
        known = self.whole.get(raw)
        ids = [known] if known is not None else self.model.encode(raw.decode("latin-1").translate(self.mapping))
        if len(pretoken) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[pretoken] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.cut(text))))

    def count(self, text: str) -> int:
        return sum(map(len, map(self.__getitem__, self.cut(text))))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, by mapping the pieces' characters back to bytes."""
        pieces = (self.model.id_to_piece(int(i)) for i in ids)
        return bytes(self.back[c] for piece in pieces for c in piece).decode("utf-8", "replace")


def shipped(df: DataFrame, name: str, folder: str) -> None:
    """Sends the vocabulary file to every executor with the job, so that it need not be there."""
    df.sparkSession.sparkContext.addFile(str(Path(folder) / f"{name}.tiktoken"))


@lru_cache(maxsize=4)
def encoder(name: str, folder: str) -> Encoder:
    """One encoder a Python worker; the model is built there from the vocabulary file."""
    return Encoder(name, folder)


def encode_documents(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, without special tokens.

    Empty and null texts have no tokens, so their ids are the empty list; strings that look like
    special tokens are ordinary text. Repeated rows are encoded each. No shuffle: one pass.
    """
    shipped(documents, name, folder)
    schema = pa.schema([(key, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(name, SparkFiles.getRootDirectory())
        for batch in batches:
            ids = [coder.encode(t) if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return documents.select(key, text).mapInArrow(encode, f"{key} long, ids array<int>")


def token_counts(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """(doc_id, kept columns, n_tokens) of every document; 0 for empty and null texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(name, SparkFiles.getRootDirectory())
        for batch in batches:
            yield batch.drop(columns=text).assign(n_tokens=[coder.count(t) if t else 0 for t in batch[text]])

    shipped(documents, name, folder)
    kept = documents.select(key, *keep, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text)
    return kept.mapInPandas(count, f"{fields}, n_tokens long")


def decode_ids(encoded: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, key: str = "doc_id") -> DataFrame:
    """(doc_id, text) back from ids."""
    shipped(encoded, name, folder)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(name, SparkFiles.getRootDirectory())
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "text": [coder.decode(i) for i in batch["ids"]]})

    return encoded.select(key, "ids").mapInPandas(decode, f"{key} long, text string")
