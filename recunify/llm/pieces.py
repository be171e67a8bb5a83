"""SentencePiece encoding and decoding that keeps offsets.

The text is normalised here, not in the library: at every position the
longest prefix in the model's compiled character map (a double-array trie)
is replaced, and the source byte of every produced byte is recorded.  White
space is then escaped and the dummy prefix added as the model asks.  The
normalised text is cut before every run of the space symbol (no piece of
such a vocabulary holds a space symbol after another character, which is
checked), so merges never cross a cut and each distinct segment is merged
once per worker: a bounded memo maps a segment to its ids.  Merging a
segment calls the sentencepiece library with a copy of the model whose
normaliser is switched off.  Piece lengths give spans in the normalised
text, and the recorded alignment projects them to bytes of the original.
The digests are those of these ids and spans and of the text decoded from
the ids.

Results for odd input: a null or empty text has no ids, no spans, and
decodes to the empty text; repeated rows give repeated rows; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recunify.llm.text import map_slices, pick, texts_of

SPACE = "▁"
#: Segments that a worker remembers before it starts anew, and the longest one that it keeps.
MEMO_SEGMENTS, MEMO_CHARS = 400_000, 64


class CharMap:
    """The compiled character map of a model: a Darts double array over UTF-8
    bytes, and the replacement strings that its values point into."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.out = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes | None]:
        """Length of the longest mapped prefix of data[at:], and what replaces it."""
        units, best, value = self.units, 0, None
        if not units:
            return 0, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                best, value = k + 1 - at, units[node] & 0x7FFFFFFF
        if value is None:
            return 0, None
        return best, self.out[value:self.out.index(b"\0", value)]


class Normalizer:
    """The model's normaliser, with the source byte of every produced byte."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, trim: bool, escape: bool):
        self.map = CharMap(charsmap)
        self.dummy_prefix, self.trim, self.escape = dummy_prefix, trim, escape
        self.identity = not self.map.units and not trim

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the
        byte of the original that it came from."""
        data = text.encode()
        space = SPACE.encode() if self.escape else b" "
        if not data:
            return "", np.zeros(1, np.int64)
        out, src = [], []

        def put(piece: bytes, at: int):
            out.append(piece)
            src.append((at, len(piece)))

        at, n, started, gap = 0, len(data), False, False
        while at < n:
            took, new = self.map.longest(data, at)
            if not took:
                lead = data[at]
                took = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = data[at:at + took]
            if self.trim:
                if not started or gap:
                    new = new.lstrip(b" ")
                if not new:
                    at += took
                    continue
            if not started and self.dummy_prefix:
                put(space, at)
            started = True
            put(new.replace(b" ", space) if self.escape else new, at)
            gap = new.endswith(b" ")
            at += took
        if self.trim:
            while out and out[-1].endswith(space):
                piece = out.pop()[: -len(space)]
                from_, _ = src.pop()
                n = from_
                if piece:
                    put(piece, from_)
        starts = np.repeat([s for s, _ in src], [k for _, k in src]) if src else np.zeros(0, np.int64)
        return b"".join(out).decode(), np.append(starts, n).astype(np.int64)

    def aligned(self, text: str) -> tuple[str, np.ndarray]:
        """As calling it; without a map and trimming every character stays or is a space, which numpy aligns."""
        if not self.identity or not text:
            return self(text)
        data = np.frombuffer(text.encode(), np.uint8)
        kind = np.int32 if len(data) < 1 << 29 else np.int64
        at = np.arange(len(data), dtype=kind)
        at[(data & 0xC0) == 0x80] = 0
        source = np.maximum.accumulate(at, out=at)
        space = SPACE if self.escape else " "
        if self.escape:
            source = np.repeat(source, np.where(data == 32, len(SPACE.encode()), 1))
            text = text.replace(" ", SPACE)
        head = space if self.dummy_prefix else ""
        return head + text, np.concatenate([np.zeros(len(head.encode()), kind), source, np.array([len(data)], kind)])


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes, memo: int = MEMO_SEGMENTS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto.FromString(model)
        spec = proto.normalizer_spec
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix,
                                     spec.remove_extra_whitespaces, spec.escape_whitespaces)
        kinds = pb.ModelProto.SentencePiece
        self.surface = [p.piece.encode() for p in proto.pieces]
        self.is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        self.is_unknown = np.array([p.type == kinds.UNKNOWN for p in proto.pieces])
        self.silent = np.array([p.type == kinds.CONTROL for p in proto.pieces])
        self.unk_surface = proto.trainer_spec.unk_surface.encode()
        self.lengths = np.where(self.is_byte, 1, [len(s) for s in self.surface])
        self.decoded = [bytes([int(s[3:5], 16)]) if b else self.unk_surface if u else b"" if c else s
                        for s, b, u, c in zip(self.surface, self.is_byte, self.is_unknown, self.silent)]
        if any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces) or not spec.escape_whitespaces \
                or proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback \
                or any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("only BPE models with byte fallback whose pieces hold space symbols in front are cut into segments")
        spec.Clear()
        spec.name, spec.add_dummy_prefix = "identity", False
        spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.memo: dict[str, bytes] = {}  # the ids of a segment, 32 bits each
        self.id_text = [str(i) for i in range(len(self.surface))]
        self.spoken = [d if b else d.replace(SPACE.encode(), b" ") for d, b in zip(self.decoded, self.is_byte)]
        self.memo_size = memo
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def segments(self, normal: str) -> list[str]:
        return self.cut.findall(normal)

    def merge(self, segments: list[str]) -> list[list[int]]:
        return self.merger.encode(segments, num_threads=1) if segments else []

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, and the byte span [start, end) in the original of every piece."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
        """``encode`` of each text; segments that the memo doesn't know are merged together."""
        memo = self.memo
        views = [self.normalizer.aligned(t) for t in texts]
        parts = [self.segments(normal) for normal, _ in views]
        found = [[*map(memo.get, p)] for p in parts]
        new = [*{s for p, f in zip(parts, found) if not all(f) for s, ids in zip(p, f) if not ids}]
        for s, ids in zip(new, self.merge(new)):
            memo[s] = array("i", ids).tobytes()
        out = [self.located(source, np.frombuffer(b"".join(f if all(f) else map(memo.__getitem__, p)), np.int32))
               for (_, source), p, f in zip(views, parts, found)]
        for s in new:
            if len(s) > MEMO_CHARS:
                del memo[s]
        if len(memo) > self.memo_size:
            memo.clear()
        return out

    def located(self, source: np.ndarray, ids: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The ids of a text with their byte spans in it, from the alignment of its normalised bytes."""
        if not len(ids):
            none = np.zeros(0, np.int64)
            return [], none, none
        ends = np.cumsum(self.lengths[ids])
        if ends[-1] != len(source) - 1:
            raise ValueError("pieces don't cover the normalised text")
        return ids.tolist(), source[np.append(0, ends[:-1])].astype(np.int64), source[ends].astype(np.int64)

    def decode(self, ids) -> str:
        """As the library's decode(ids): the dummy prefix goes, broken bytes become U+FFFD.
        A run of byte pieces ends at any other piece, also at one without a text."""
        ids = list(ids)
        flags = self.is_byte[np.array(ids, np.int64)]
        cuts = [0, *(np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist(), len(ids)]
        out = []
        for a, z in zip(cuts[:-1], cuts[1:]):
            raw = b"".join(map(self.spoken.__getitem__, ids[a:z]))
            out.append(decode_utf8(raw) if a < z and flags[a] else raw.decode())
        text, head = "".join(out), next((i for i in ids if not self.silent[i]), 0)
        if self.normalizer.dummy_prefix and text.startswith(" ") and not (self.is_byte[head] or self.is_unknown[head]):
            text = text[1:]
        return text

    def digests(self, texts: list[str]) -> list[tuple[int, str, str, str]]:
        """(number of ids, hash of the joined ids, hash of the text decoded from the ids, hash of the
        spans as little-endian 64-bit numbers, all starts before all ends) of each text."""
        out = []
        for ids, starts, ends in self.encode_all(texts):
            joined = ",".join(map(self.id_text.__getitem__, ids))
            out.append((len(ids), *(hashlib.sha256(x).hexdigest() for x in (
                joined.encode(), self.decode(ids).encode(), np.concatenate([starts, ends]).astype("<i8").tobytes()))))
        return out


def decode_utf8(raw: bytes) -> str:
    """UTF-8 to text; each byte that isn't part of a character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[:e.start].decode() + "�" + decode_utf8(raw[e.start + 1:])


_codecs: dict[str, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    """One codec for each model in a worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _codecs:
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def _model(docs: DataFrame, path: str):
    """The model file as a broadcast: a tokenizer's file, whose size the data doesn't change."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, starts, ends: every piece with its byte span in the original text."""
    model = _model(docs, model_path)

    def run(batch: pa.RecordBatch):
        codec = _codec(model.value)
        got = codec.encode_all(texts_of(batch))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())),
             pa.array([g[1] for g in got], pa.list_(pa.int64())),
             pa.array([g[2] for g in got], pa.list_(pa.int64()))], ["doc_id", "ids", "starts", "ends"])
    return map_slices(pick(docs, doc_id=doc_id, text=text),
                      f"doc_id {_type(docs, doc_id)}, ids array<int>, starts array<bigint>, ends array<bigint>", run)


def decode(encoded: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text: what the ids stand for."""
    model = _model(encoded, model_path)

    def run(batches):
        codec = _codec(model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([codec.decode(i or []) for i in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])
    return pick(encoded, doc_id=doc_id, ids=ids).mapInArrow(run, f"doc_id {_type(encoded, doc_id)}, text string")


def digest(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of every text (a null is empty)."""
    model = _model(docs, model_path)

    def run(batch: pa.RecordBatch):
        got = _codec(model.value).digests(texts_of(batch))
        n, ids, dec, spans = zip(*got)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string()),
             pa.array(spans, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    return map_slices(pick(docs, doc_id=doc_id, text=text),
                      f"doc_id {_type(docs, doc_id)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                      "spans_sha256 string", run)


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
