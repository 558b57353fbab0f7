"""Operator 9: SentencePiece encoding and decoding by a streaming Viterbi walk.

The trellis has one node per character boundary. For a merge-ordered (BPE)
model exactly one piece may end at a boundary (see ``bpe.py``), so a node
keeps one path back. A new piece can only start at one of the last
``longest piece`` nodes: whatever the paths of all of these share is final and
its ids are committed, so a text of any length needs a small window. Nothing
but the ids of recent segments and pairs of pieces is remembered, in memos
that are bounded in bytes.

No piece has a blank after another character, so every path meets before a
blank that follows a non-blank. Texts are cut there and the walk is made once
per distinct segment of a slice.
"""

from __future__ import annotations

import hashlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.llm.bpe import Merges
from torque.llm.segments import distinct_segments, slices
from torque.llm.worker_memory import Memo, kept

MARK = "▁"                      # stands for a blank inside pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6   # piece types of the model format
BLOCK = 4096                    # characters between two attempts to commit
MEMO_BYTES, PAIR_BYTES = 64_000_000, 48_000_000   # what a worker remembers at most


class Codec:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or not norm.add_dummy_prefix
                or train.treat_whitespace_as_suffix or not train.byte_fallback):
            raise ValueError("a merge-ordered model with identity normalisation, a prefix "
                             "blank and byte fallback is needed")
        kinds = {p.type for p in proto.pieces}
        if not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"unsupported piece types {kinds}")
        score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in score):
            raise ValueError("a piece has a blank after another character")
        self.pieces = [p.piece for p in proto.pieces]
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces)
                         if p.type == BYTE}
        self.merges = Merges(lambda a, b: -score[a + b] if a + b in score else None)
        self.found = ahocorasick.Automaton()
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.found.add_word(p.piece, (i, len(p.piece)))
        self.found.make_automaton()
        self.longest = max(map(len, score))
        self.raw = [b"" if p.type == CONTROL else b" \xe2\x81\x87 " if p.type == UNKNOWN
                    else bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE
                    else p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        self.is_byte = np.array([p.type == BYTE for p in proto.pieces])
        self.pairs = Memo(self._survive, PAIR_BYTES, lambda pair, fits: 110)
        self.known = Memo(self._encode, MEMO_BYTES,
                          lambda segment, ids: 180 + len(segment) + len(ids))

    def _survive(self, pair: int) -> bool:
        """May the piece ``pair & (2**32 - 1)`` follow a path that ends in ``pair >> 32``?"""
        left, right = self.pieces[pair >> 32], self.pieces[pair & 0xFFFFFFFF]
        return self.merges.split(left + right) == [left, right]

    def _encode(self, segment: bytes) -> bytes:
        out = array("i")
        for ids in self.stream(segment.decode().replace(" ", MARK)):
            out.extend(ids)
        return out.tobytes()

    def stream(self, text: str):
        """Yield the ids of a text, in lists, as soon as they are final.

        ``last`` and ``back`` hold, for each boundary that is not committed, the
        last piece of its path (None: a character that is no piece) and where
        it starts. Pieces come in order of their ends, the longest first. After
        every block the window shrinks to what the paths of the boundaries that
        a piece may still start from do not share.
        """
        n, base, pairs = len(text), 0, self.pairs
        last: list[int | None] = [None]
        back = [-1]
        for at in range(0, n, BLOCK):
            before, stop = max(0, at - self.longest), min(n, at + BLOCK)
            last += [None] * (stop - at)
            back += range(at, stop)
            for end, (piece, size) in self.found.iter(text[before:stop]):
                end += before + 1
                to = end - base
                if end > at and last[to] is None:
                    left = last[to - size]
                    if left is None or pairs[left << 32 | piece]:
                        last[to], back[to] = piece, end - size
            at = stop
            shared = n if at == n else self._meeting(back, base, at)
            if shared > base:
                yield self._ids(text, last, back, base, shared)
                del last[:shared - base], back[:shared - base]
                base = shared

    def _meeting(self, back: list[int], base: int, at: int) -> int:
        """The boundary that the paths of all boundaries share from which a piece may
        start that ends after ``at``."""
        paths = set(range(max(base, at + 1 - self.longest), at + 1))
        while len(paths) > 1:
            latest = max(paths)
            paths.remove(latest)
            paths.add(back[latest - base])
        return paths.pop()

    def _ids(self, text: str, last: list, back: list[int], base: int, end: int) -> list[int]:
        """Ids on the path from boundary ``base`` to ``end``."""
        out: list[int] = []
        while end > base:
            piece, start = last[end - base], back[end - base]
            if piece is None:
                out.extend(self.byte_ids[b] for b in reversed(text[start:end].encode()))
            else:
                out.append(piece)
            end = start
        out.reverse()
        return out

    def encode_segment(self, segment: bytes) -> bytes:
        """Ids of a segment as packed 32-bit integers; short segments are remembered."""
        return self.known[segment] if len(segment) <= 64 else self._encode(segment)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the bounds of each text in it."""
        parts = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        data = b"".join(parts)
        ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)
        cut = np.zeros(len(raw) + 1, bool)
        if len(raw):
            cut[1:-1] = (raw[1:] == 32) & (raw[:-1] != 32)
        cut[ends] = True
        cut[-1] = True
        bounds = np.flatnonzero(cut)
        codes, segments = distinct_segments(data, bounds)
        ids = [self.encode_segment(s) for s in segments]
        lengths = np.array([len(x) for x in ids], np.int64) // 4
        out = np.frombuffer(b"".join([ids[c] for c in codes.tolist()]), np.int32)
        ids_at = np.concatenate(([0], np.cumsum(lengths[codes])))
        return out, ids_at[np.searchsorted(bounds, ends)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of an id sequence; invalid byte runs become U+FFFD per byte."""
        data = b"".join([b"".join(map(self.raw.__getitem__, ids[a:a + BLOCK].tolist()))
                         for a in range(0, len(ids), BLOCK)])
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._decode_bytewise(data)
        return text[1:] if text.startswith(" ") else text

    @staticmethod
    def _decode_bytewise(data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def sentencepiece_round_trip(docs: DataFrame, model: str, id_col: str = "doc_id",
                             text_col: str = "text") -> DataFrame:
    """Encode every whole text to ids and decode the ids again.

    ``model`` is the path of a model file, read by the driver and broadcast.
    Returns the id, ``ids``, ``n_ids``, ``decoded_sha256`` (lowercase hex of the
    decoded text's UTF-8) and ``round_trip`` (decoded text equals the text; a
    text with U+2581 comes back with blanks instead and gives false).

    Null texts count as empty: no ids, decoded to the empty text. Null and
    repeated ids pass through row by row; an empty table gives an empty
    result; other columns are not read.
    """
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        codec = kept(("codec", model), lambda: Codec(shared.value))
        for batch in batches:
            own, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(texts):
                part = texts[a:b]
                ids, bounds = codec.encode(part)
                decoded = [codec.decode(ids[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [own.slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                     pa.array(np.diff(bounds)),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                     pa.array([x == y for x, y in zip(decoded, part)], pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "decoded_sha256", "round_trip"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_ids bigint, "
                                "decoded_sha256 string, round_trip boolean")
