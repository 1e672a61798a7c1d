"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest prefix in
its double array is replaced, and every byte of the result remembers the source byte it came from.
Spaces become the visible space mark, and the dummy prefix belongs to the place before the text.
The merges of the normalised text are the sentencepiece library's, with its own normaliser turned
off; the lengths of the pieces and the recorded alignment give each piece's span in the original
bytes. Decoding joins pieces by a table of their bytes.

The model is read once and broadcast (under a megabyte). Texts go through the library some
megabytes at a time; no shuffle.

Defined results: null counts as the empty text, which has no piece but the end id; spans are
byte offsets into the UTF-8 text, end exclusive, and cover it without gaps where the map removes
nothing; of the byte pieces of one character the last has the whole span and the others an empty one at its
start; control ids decode to nothing and have an empty span at the end; very long texts are encoded
whole, alone in their slice; equal rows give equal results; an empty table gives an empty one;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as model_format

from liftlens.llm.common import slices

MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()  # stands for a space
UNKNOWN, BYTE = 2, 6  # piece types of the model format
UNKNOWN_TEXT = " ⁇ ".encode()  # what an unknown id decodes to
# the library replaces every byte that is not part of a character
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class CharacterMap:
    """A compiled map: the size of a double array, the array, and replacements that end in a
    zero byte. Each unit of the array holds a label, a leaf flag and the offset of its children."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.texts = blob[4 + size:]
        root = self.offset(self.units[0]) if self.units else 0
        starts = [b for b in range(1, 256) if self.units and self.label(self.units[root ^ b]) == b]
        every = b"".join(re.escape(bytes([b])) for b in [*starts, 0x20])
        self.plain = re.compile(b"[^" + every + b"]+", re.DOTALL)  # no key begins here

    @staticmethod
    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    @staticmethod
    def label(unit: int) -> int:
        return unit & 0x800000FF

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key at this place, and the key's length."""
        if not self.units:
            return None
        found, node = None, self.offset(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = self.units[node]
            if self.label(unit) != text[i]:
                break
            node ^= self.offset(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = self.texts[value:self.texts.index(b"\0", value)], i + 1 - at
        return found


def width_of(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    def __init__(self, spec, suffix: bool):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.squeeze = spec.remove_extra_whitespaces
        self.space = MARK if spec.escape_whitespaces else b" "
        self.dummy, self.suffix = spec.add_dummy_prefix, suffix

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and for its end the source byte."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.map.units or self.squeeze:
            body, source, begin = self.mapped(text)
            if begin is None:
                return b"", source
        else:
            (body, source), begin = self.spaced(text), 0
        if self.dummy and not self.suffix:
            body = self.space + body
            source = np.r_[np.repeat(begin, len(self.space)), source]
        while self.squeeze and body.endswith(self.space):
            body = body[:-len(self.space)]
            source = source[:len(body) + 1]
        if self.dummy and self.suffix:
            body += self.space
            source = np.r_[source, np.repeat(source[-1], len(self.space))]
        return body, source

    def spaced(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map only spaces change."""
        widths = np.where(np.frombuffer(text, np.uint8) == 0x20, len(self.space), 1)
        return text.replace(b" ", self.space), np.r_[np.repeat(np.arange(len(text)), widths), len(text)]

    def steps(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Replacements with the place and length of what they replace; whole runs of bytes
        that no key begins with come as they are, with length 0."""
        at = 0
        while at < len(text):
            run = self.map.plain.match(text, at)
            if run:
                yield run.group(), at, 0
                at = run.end()
                continue
            new, length = self.map.longest(text, at) or (None, width_of(text[at]))
            yield text[at:at + length] if new is None else new, at, length
            at += length

    def mapped(self, text: bytes) -> tuple[bytes, np.ndarray, int | None]:
        """Replaced text and alignment, and where the text begins behind skipped spaces (None if
        there is nothing else)."""
        out, source = [], []
        after_space, begin = self.squeeze, None
        for new, at, length in self.steps(text):
            if begin is None:
                if self.squeeze and new == b" ":
                    continue
                begin = at
            if not length:
                out.append(new)
                source.append(character_starts(new) + at)
                after_space = False
                continue
            if after_space:
                new = new.lstrip(b" ")
            if new:
                shown = new.replace(b" ", self.space)
                out.append(shown)
                source.append(np.repeat(at, len(shown)))
                after_space = self.squeeze and new.endswith(b" ")
        return b"".join(out), np.concatenate([*source, [len(text)]]).astype(np.int64), begin


def character_starts(text: bytes) -> np.ndarray:
    """For each byte, where its character begins."""
    b = np.frombuffer(text, np.uint8)
    return np.maximum.accumulate(np.where((b & 0xC0) != 0x80, np.arange(len(b)), 0))


class Codec:
    """Encodes and decodes under one model."""

    def __init__(self, blob: bytes):
        model = model_format.ModelProto.FromString(blob)
        self.normalize = Normalizer(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        self.strip = model.normalizer_spec.add_dummy_prefix or model.normalizer_spec.remove_extra_whitespaces
        self.strip_all = model.normalizer_spec.remove_extra_whitespaces
        types = np.array([p.type for p in model.pieces])
        self.is_byte, self.unknown = types == BYTE, int(np.flatnonzero(types == UNKNOWN)[0])
        self.texts = [p.piece.encode() for p in model.pieces]
        self.lengths = np.array([1 if t == BYTE else len(p) for t, p in zip(types, self.texts)])
        self.bytes = np.array([int(p[3:5], 16) if t == BYTE else 0 for t, p in zip(types, self.texts)])
        self.plain = [bytes([b]) if t == BYTE else UNKNOWN_TEXT if t == UNKNOWN
                      else b"" if t == 3 else p.replace(MARK, b" ")
                      for t, p, b in zip(types, self.texts, self.bytes.tolist())]
        # the merges run on texts that are normalised already
        model.normalizer_spec.Clear()
        model.normalizer_spec.name = "identity"
        model.normalizer_spec.add_dummy_prefix = False
        model.normalizer_spec.remove_extra_whitespaces = False
        model.normalizer_spec.escape_whitespaces = False
        self.merges = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end = self.merges.eos_id()

    def encode(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """ids with the end id, and begin and end of each piece in the text's bytes."""
        normal = [self.normalize((t or "").encode()) for t in texts]
        found = self.merges.encode([n.decode() for n, _ in normal], num_threads=1)
        return [self.spans(np.array(ids, np.int64), body, source)
                for ids, (body, source) in zip(found, normal)]

    def spans(self, ids: np.ndarray, body: bytes, source: np.ndarray):
        lengths = self.lengths[ids]
        if not self.is_byte.any() and (ids == self.unknown).any():
            lengths[:] = [len(p.encode()) for p in self.merges.encode(body.decode(), out_type=str)]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        bytes_ = self.is_byte[ids]
        if bytes_.any():
            rest = bytes_ & ((self.bytes[ids] & 0xC0) == 0x80)
            # all byte pieces of a character begin where it begins, the last one ends it
            begins = begins[np.maximum.accumulate(np.where(rest, 0, np.arange(len(ids))))]
            inner = bytes_ & np.r_[rest[1:], False]
            ends = np.where(inner, begins, ends)
        begins, ends = source[begins], source[ends]
        last = source[-1]
        return np.r_[ids, self.end], np.r_[begins, last], np.r_[ends, last]

    def decode(self, ids: Sequence[int]) -> str:
        parts = list(map(self.plain.__getitem__, ids))
        if self.strip:
            for i, part in enumerate(parts):
                if part:
                    if not self.is_byte[ids[i]] and ids[i] != self.unknown and part[:1] == b" ":
                        parts[i] = part[1:]
                        if self.strip_all and not parts[i]:
                            continue
                    break
        return b"".join(parts).decode("utf-8", "each_byte")


def read_model(path: str | None = None) -> bytes:
    """The model file at `path`, or the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as file:
        return file.read()


def lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    every = np.concatenate(values).astype(np.int32) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(offsets, every)


def encode(docs: DataFrame, path: str | None = None, decoded: bool = False) -> DataFrame:
    """doc_id, ids, begins and ends (spans in the text's bytes); with `decoded` also the text
    that the ids decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in slices(batches, 1):
            found = codec.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), *(lists([f[i] for f in found]) for i in range(3))]
            if decoded:
                columns.append(pa.array([codec.decode(f[0].tolist()) for f in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "ids", "begins", "ends", *["decoded"] * decoded]
    schema = "doc_id long, ids array<int>, begins array<int>, ends array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", decoded string" * decoded)


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """doc_id and the text that the ids decode to; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(read_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "decoded"])

    return rows.select("doc_id", F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, decoded string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
