"""SentencePiece encoding and decoding with the original byte span of every piece.

The library makes the ids. Beside it, the text is normalised here by longest-prefix matches in the model's compiled
character map, and each normalised byte keeps the place of the original text that it came from; the pieces, laid end to
end over the normalised text, then project to spans of the original.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import binary_texts, id_text, read_table

SPACE = "▁".encode()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """A compiled character map: the size of a double-array trie, its units, then the replacement strings."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of text[at:] in the map, and its replacement."""
        if not self.units:
            return None
        found, node, unit = None, 0, self.units[0]
        node ^= self._offset(unit)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.strings[start : self.strings.index(b"\0", start)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normaliser:
    """What the model does to a text before it looks for pieces, with the source of every byte."""

    def __init__(self, model: bytes) -> None:
        spec = dict(message_fields(next((v for f, v in message_fields(model) if f == 3), b"")))
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy_prefix, self.strip, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the place in the original."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.map.units or self.strip:
            return self._by_prefix(text)
        raw = np.frombuffer(text, np.uint8)
        space = SPACE if self.escape else b" "
        sizes = np.where(raw == 32, len(space), 1)
        source = np.repeat(np.arange(len(raw)), sizes)
        prefix = space if self.dummy_prefix else b""
        return prefix + text.replace(b" ", space), np.concatenate([np.zeros(len(prefix), np.int64), source, [len(raw)]])

    def _by_prefix(self, text: bytes) -> tuple[bytes, np.ndarray]:
        parts, at = [], 0
        while at < len(text):
            found = self.map.longest(text, at)
            size = found[0] if found else next(n for b, n in ((0xF0, 4), (0xE0, 3), (0xC0, 2), (0, 1)) if text[at] >= b)
            parts.append((found[1] if found else text[at : at + size], at, at + size))
            at += size
        out, source, last = bytearray(), [], b" " if self.strip else b""
        space = SPACE if self.escape else b" "
        if self.dummy_prefix:
            out += space
            source += [0] * len(space)
        for piece, start, end in parts:
            for i in range(len(piece)):
                byte = piece[i : i + 1]
                if byte == b" " and self.strip and last == b" ":
                    continue
                new = space if byte == b" " else byte
                out += new
                source += [start] * len(new)
                last = byte
        end = len(text)
        if self.strip:
            while out.endswith(space) and len(out) >= len(space):
                end = source[-len(space)]
                del out[-len(space) :], source[-len(space) :]
        return bytes(out), np.array([*source, end], np.int64)


def piece_sizes(model: bytes) -> np.ndarray:
    """Bytes of the normalised text that each piece stands for: 1 for a byte piece, -1 where only the text can say."""
    sizes = []
    for piece in (dict(message_fields(v)) for f, v in message_fields(model) if f == 1):
        sizes.append({2: -1, 3: 0, 6: 1}.get(piece.get(3, 1), len(piece.get(1, b""))))
    return np.array(sizes, np.int64)


class Encoder:
    """One model in a task: ids, pieces, spans and back."""

    def __init__(self, model: bytes, sizes: np.ndarray) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalise, self.sizes = Normaliser(model), sizes
        self.digits = [str(i) for i in range(len(sizes))]

    def spans(self, text: bytes, ids: np.ndarray) -> np.ndarray:
        """(n, 2) start and end of every piece in bytes of the original text; a piece of inserted space is empty."""
        _, source = self.normalise(text)
        sizes = self.sizes[ids]
        if (sizes < 0).any():  # unknown pieces are as long as the text they stand for
            sizes = np.array([len(p.encode()) for p in self.library.encode(text.decode(), out_type=str)], np.int64)
        ends = np.cumsum(sizes)
        return np.stack([source[ends - sizes], source[ends]], 1)


def _digests(model):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(*model.value)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for raw in binary_texts(b.column("text")):
                ids = own.library.encode(raw.decode())
                spans = own.spans(raw, np.array(ids, np.int64)).astype("<i8")
                row = (
                    len(ids), hashlib.sha256(",".join([own.digits[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(own.library.decode(ids).encode()).hexdigest(),
                    int((spans[:, 1] - spans[:, 0]).sum()), hashlib.sha256(spans.tobytes()).hexdigest(),
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes", "spans_sha256"]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.string())], names=names)

    return encode


def _pieces(model):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(*model.value)
        for b in batches:
            ids, spans, texts = [], [], []
            for raw in binary_texts(b.column("text")):
                ids.append(own.library.encode(raw.decode()))
                found = own.spans(raw, np.array(ids[-1], np.int64))
                spans.append([{"start": int(s), "end": int(e)} for s, e in found])
                texts.append(own.library.decode(ids[-1]))
            kinds = (pa.list_(pa.int32()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (ids, spans, texts), kinds)], names=["doc_id", "ids", "spans", "decoded"])

    return encode


def _model(docs: DataFrame, model_path: str | None):
    with open(model_path or default_model(), "rb") as file:
        model = file.read()
    return docs.sparkSession.sparkContext.broadcast((model, piece_sizes(model)))


def encode(docs: DataFrame, model_path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, spans, decoded) for every row of docs: spans are byte ranges of the original text, end exclusive.

    No begin or end ids, no sampling. A null or empty text has no ids, no spans and decodes to the empty text. Rows
    that repeat are encoded each. The model file is read by the driver and sent to the tasks.
    """
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_pieces(_model(docs, model_path)), f"doc_id {kind}, ids array<int>, spans array<struct<start:long,end:long>>, decoded string")


def encode_digests(docs: DataFrame, model_path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `encode`, with sums instead of the lists: n_tokens, ids_sha256, decoded_sha256, span_bytes, spans_sha256."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long, spans_sha256 string"
    return rows.mapInArrow(_digests(_model(docs, model_path)), schema)


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""
    model = _model(encoded, model_path)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(*model.value)
        for b in batches:
            texts = [own.library.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(back, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))
