"""SentencePiece encoding that keeps, for every piece, the bytes of the text it came from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reviewlib.llm.common import map_texts

_SPACE = "▁".encode()


class CharMap:
    """The compiled character map of a model: a table of prefixes, each with what replaces it.

    Its bytes are the length of a double array of 32-bit units, the units, and the
    replacements, each ended by a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Length of the longest prefix of ``data[at:]`` in the map, and where its replacement
        starts."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            leaf = units[node] >> 8 & 1
            node ^= self._offset(units[node])
            if leaf:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def replacement(self, start: int) -> bytes:
        return self.replacements[start : self.replacements.index(b"\0", start)]


class Normalizer:
    """Normalised text with the source byte that each of its bytes starts from."""

    def __init__(self, spec, marks_end: bool = False):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.marks_end = marks_end
        self.space = _SPACE if spec.escape_whitespaces else b" "

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and one source place per byte and one for the end."""
        if not self.map.units and not self.squeeze:
            return self._identity(data)
        return self._mapped(data)

    def _identity(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)
        wide = np.where(raw == 32, len(self.space), 1)
        places = np.repeat(np.arange(len(raw)), wide)
        text = data.replace(b" ", self.space)
        if self.prefix and not self.marks_end:
            text = self.space + text
            places = np.concatenate([np.zeros(len(self.space), np.int64), places])
        elif self.prefix:
            text += self.space
            places = np.concatenate([places, np.full(len(self.space), len(raw))])
        return text, np.append(places, len(raw))

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        chars: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found:
                length, start = found
                new = self.map.replacement(start)
            else:
                length = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                new = data[at : at + length]
            chars += [(bytes([b]), at) for b in new]
            at += length
        if self.squeeze:
            kept: list[tuple[bytes, int]] = []
            for char in chars:
                if char[0] != b" " or kept and kept[-1][0] != b" ":
                    kept.append(char)
            while kept and kept[-1][0] == b" ":
                kept.pop()
            chars = kept
        if not chars:
            return b"", np.array([len(data)])
        out, places = [], []
        if self.prefix and not self.marks_end:
            out.append(self.space)
            places += [chars[0][1]] * len(self.space)
        for b, place in chars:
            new = self.space if b == b" " else b
            out.append(new)
            places += [place] * len(new)
        if self.prefix and self.marks_end:
            out.append(self.space)
            places += [len(data)] * len(self.space)
        return b"".join(out), np.array([*places, len(data)])


class Encoder:
    """Ids, byte spans and decoded texts of a model; one per task."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.normalizer = Normalizer(
            proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix
        )
        byte = sentencepiece_model_pb2.ModelProto.SentencePiece.Type.BYTE
        self.lengths = np.array(
            [1 if p.type == byte else len(p.piece.encode()) for p in proto.pieces], np.int64
        )
        self.unknown = self.library.unk_id()

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end byte in ``text`` of each piece.

        Pieces follow each other through the normalised text. The pieces of a character that
        falls back to bytes have that character's bytes; a mark put in front of the text has
        no bytes of its own.
        """
        data = text.encode()
        normal, places = self.normalizer(data)
        lengths = self.lengths[ids]
        if self.unknown >= 0 and (ids == self.unknown).any():
            return self._from_library(text)
        ends = np.cumsum(lengths)
        if len(ids) and ends[-1] != len(normal):
            raise ValueError("pieces do not cover the normalised text")
        starts = ends - lengths
        return places[starts], places[ends]

    def _from_library(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """An unknown piece has no length of its own: the library's character offsets."""
        proto = self.library.encode(text, out_type="immutable_proto")
        width = np.cumsum([0, *(len(c.encode()) for c in text)])
        begin = np.array([p.begin for p in proto.pieces], np.int64)
        end = np.array([p.end for p in proto.pieces], np.int64)
        return width[begin], width[end]


_SCHEMA = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` plus token ``ids``, the byte span ``starts``/``ends`` of each piece in the text, and
    the ``decoded`` text; columns of these names are replaced.

    A null text counts as empty and has no piece. No shuffle; a text is encoded whole.
    """

    def make():
        encoder = Encoder(model)

        def run(texts: pa.Array) -> list[pa.Array]:
            some = texts.fill_null("").to_pylist()
            every = encoder.library.encode(some, num_threads=1)
            decoded = encoder.library.decode(every, num_threads=1)
            ids, starts, ends = [], [], []
            for own, text in zip(every, some):
                ids.append(np.array(own, np.int32))
                begin, end = encoder.spans(text, ids[-1])
                starts.append(begin.astype(np.int32))
                ends.append(end.astype(np.int32))
            return [_lists(ids), _lists(starts), _lists(ends), pa.array(decoded, pa.string())]

        return run

    return map_texts(docs, text, _SCHEMA, make)
