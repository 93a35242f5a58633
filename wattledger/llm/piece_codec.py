"""SentencePiece encoding that keeps byte offsets into the original text, and decoding.

Normalisation walks the model's compiled character map (a double-array trie and a pool of replacements): at each
place the longest prefix that the trie holds is replaced, and every byte written records the byte it came from.
Pieces of the normalised text then project to spans of the original bytes through that alignment. A model whose
map is empty normalises to the same text, and the alignment is the identity.

The text is cut before it is encoded: before a run of spaces and around line feeds, where no piece of the model
crosses. Merges on the two sides of such a cut never meet, so the ids of the cuts, one after the other, are the
ids of the whole text. A model with pieces that cross is encoded text by text.

Defined results: null and empty texts give the begin and end ids only, no spans, and decode to the empty text.
Repeated rows are encoded alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SegmentEncoder, cut_at, string_bytes, text_slices, with_marks

SPACE = "▁"


class CharsMap:
    """The compiled character map of a model: longest-prefix replacement with source alignment."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.pool = blob[4 + size :]

    def longest(self, key: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes at ``at`` are replaced, and by what."""
        units, found = self.units, None
        unit = units[0]
        node = self._step(0, unit)
        for i in range(at, len(key)):
            node ^= key[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != key[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, value = found
        return length, self.pool[value : self.pool.index(b"\0", value)]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def _step(self, node: int, unit: int) -> int:
        return node ^ self._offset(unit)


def normalise(text: bytes, charsmap: CharsMap | None) -> tuple[bytes, np.ndarray]:
    """The normalised bytes, and for each of them and for the end the place in ``text`` that it comes from."""
    if charsmap is None:
        return text, np.arange(len(text) + 1)
    out, align, at = bytearray(), [], 0
    while at < len(text):
        if hit := charsmap.longest(text, at):
            length, put = hit
        else:
            length = 1
            while at + length < len(text) and text[at + length] & 0xC0 == 0x80:
                length += 1
            put = text[at : at + length]
        out += put
        align += [at] * len(put)
        at += length
    return bytes(out), np.array([*align, len(text)])


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model folds or moves spaces, which this codec doesn't align")
        self.prefix = spec.add_dummy_prefix
        self.charsmap = CharsMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        kinds = proto.ModelProto.SentencePiece if hasattr(proto, "ModelProto") else type(proto.pieces[0])
        plain = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        self.cut_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)
        self.cut_lines = not any("\n" in p for p in plain)
        # how many bytes of normalised text, with plain spaces, a piece covers
        self.sizes = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.replace(SPACE, " ").encode()) for p in proto.pieces], np.int64)
        self.unk = self.whole.unk_id()
        self.begin, self.end = self.whole.bos_id(), self.whole.eos_id()
        # normalisation and the leading space are ours, so the processor for the cuts must add neither
        spec.add_dummy_prefix = False
        spec.precompiled_charsmap = b""
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.encoder = SegmentEncoder(self.bare.encode, "\n" if self.cut_lines else "")

    def _cuts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of the texts that can be encoded alone, and the bounds of each text among them."""
        raw, bounds, data, first = string_bytes(texts)
        mark = np.zeros(len(raw) + 1, bool)
        if self.cut_spaces:
            space = raw == 32
            mark[1:-1] |= space[1:] & ~space[:-1]
            mark[3:-1] &= ~((raw[:-3] == 0xE2) & (raw[1:-2] == 0x96) & (raw[2:-1] == 0x81))  # the space mark itself
        if self.cut_lines:
            line = raw == 10
            mark[:-1] |= line
            mark[1:] |= line
        return cut_at(mark, bounds, data, first)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts without marks, bounds between texts, and the byte span of each piece in its text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        given, aligned = texts, None
        if self.charsmap is not None:
            pairs = [normalise(t.encode(), self.charsmap) for t in texts.to_pylist()]
            given, aligned = pa.array([n.decode() for n, _ in pairs]), [a for _, a in pairs]
        lead = np.asarray(pc.greater(pc.binary_length(given), 0)) if self.prefix else np.zeros(len(given), bool)
        if self.prefix:
            given = pc.if_else(pa.array(lead), pc.binary_join_element_wise(pa.scalar(" "), given, ""), given)
        cuts, edges = self._cuts(given)
        ids, counts = self.encoder(cuts)
        passed = np.concatenate([[0], np.cumsum(counts)])
        bounds = passed[edges]
        sizes = self._sizes(ids, cuts, passed)
        ends = np.cumsum(sizes)
        at = np.concatenate([[0], ends])[bounds[:-1]] + lead
        base = np.repeat(at, np.diff(bounds))
        starts, ends = np.maximum(ends - sizes - base, 0), np.maximum(ends - base, 0)
        if aligned is not None:
            for i, align in enumerate(aligned):
                own = slice(bounds[i], bounds[i + 1])
                starts[own], ends[own] = align[starts[own]], align[ends[own]]
        return ids, bounds, starts, ends

    def _sizes(self, ids: np.ndarray, cuts: pa.Array, passed: np.ndarray) -> np.ndarray:
        """Bytes that each piece covers. The text itself tells where it holds the space mark or unknown characters."""
        sizes = self.sizes[ids]
        odd = np.asarray(pc.match_substring(cuts, SPACE))
        if (ids == self.unk).any():
            odd |= np.isin(np.arange(len(cuts)), np.searchsorted(passed, np.flatnonzero(ids == self.unk), "right") - 1)
        for i in np.flatnonzero(odd).tolist():
            found = self.bare.encode(cuts[i].as_py(), return_type="proto").pieces
            sizes[passed[i] : passed[i + 1]] = [len(p.surface.encode()) for p in found]
        return sizes

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids) if ids else []


_models: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    """One for each Python worker and model file."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, starts, ends): begin and end ids included; spans are bytes of the original text, empty for marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, bounds, starts, ends = model.encode(part["text"])
                sizes = np.asarray(pc.fill_null(pc.binary_length(part["text"]), 0), dtype=np.int64)
                marked, edges = with_marks(ids.astype(np.int32), bounds, model.begin, model.end)
                spans = []
                for values, last in ((starts, sizes), (ends, sizes)):
                    put, _ = with_marks(values.astype(np.int32), bounds, 0, 0)
                    put[edges[1:] - 1] = last
                    spans.append(put)
                at = pa.array(edges.astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (marked, *spans)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *lists], ["doc_id", "ids", "starts", "ends"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text): what the model decodes from ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.decode(batch["ids"].to_pylist()), pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode in one pass, without moving the ids between processes.

    (doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256, decoded) and the columns asked for; ``decoded``
    itself only when ``keep_columns`` holds "decoded". Digests are of little-endian 32-bit integers and of UTF-8.
    """
    others = [c for c in keep_columns if c != "decoded"]
    texts = "decoded" in keep_columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, bounds, starts, ends = model.encode(part["text"])
                spans = np.stack([starts, ends], 1).astype("<u4")
                marked, edges = with_marks(ids.astype("<u4"), bounds, model.begin, model.end)
                cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                decoded = model.decode([marked[a:b].tolist() for a, b in cuts])
                columns = {
                    "doc_id": part["doc_id"],
                    "n_tokens": pa.array(np.diff(edges)),
                    "ids_sha256": [hashlib.sha256(marked[a:b]).hexdigest() for a, b in cuts],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded],
                    "spans_sha256": [hashlib.sha256(spans[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                }
                if texts:
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_pydict(columns | {c: part[c] for c in others})

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *others)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string" + ", decoded string" * texts
    schema += "".join(f", `{c}` {given.schema[c].dataType.simpleString()}" for c in others)
    return given.mapInArrow(run, schema)
