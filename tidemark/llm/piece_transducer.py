"""SentencePiece encoding and decoding with a weighted finite-state transducer.

The normaliser (word-begin mark, white space) and the pieces are compiled into one table of arcs, with byte arcs for
characters that no piece covers. A text is composed with it segment by segment (no piece has a mark after another
character, so paths never cross the begin of a word) and its tropical shortest path is the encoding:

* unigram models: an arc costs minus its piece's score;
* BPE models: a path is a merge result exactly when each two neighbours stay apart if merged alone, so a state is the
  last piece, an arc costs 0 after a piece it may follow and infinity otherwise, and one path of finite cost remains. It
  is searched depth first, longest arcs first, with the states that lead nowhere marked: few pairs are ever looked at.

Segments repeat, so each worker keeps the paths of the last CACHE to 2 * CACHE segments, and in a table of FOLLOWS slots
which piece may follow which (a newer pair takes the slot): about 75 MB a worker together, until its next task of another job. Decoding is the inverse: pieces and bytes
joined, marks turned into spaces, the first one dropped.

The vocabulary file is a parameter; it reaches the executors as bytes. Models whose normaliser has a character map are
refused. Defined cases: null text gives null ids and null text; empty text gives no ids; rows repeat as they come; further
columns pass through.
"""

from __future__ import annotations

import re
import struct
from array import array
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import common as C

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE, CACHED_CHARS, FOLLOWS = 150_000, 40, 524_287
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + n]
            at += n


@dataclass
class Transducer:
    """pieces by id, arcs from a piece's text to its id, byte arcs, and the normaliser's switches."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int
    dummy_prefix: bool
    squeeze: bool
    arcs: dict[str, int] = field(default_factory=dict)
    byte_arcs: list[int] = field(default_factory=lambda: [-1] * 256)
    paths: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    plain: list[str | None] = field(default_factory=list)
    follows: array = field(default_factory=lambda: array("q", [-1]) * FOLLOWS)
    ends: dict[str, tuple | None] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)
    shorter: list[int] = field(default_factory=list)
    closed: bool = False
    automaton: ahocorasick.Automaton | None = None

    @classmethod
    def compile(cls, model: bytes) -> Transducer:
        pieces, scores, kinds = [], [], []
        model_type, prefix, squeeze = UNIGRAM, True, True
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("a normaliser with a character map is not supported")
                prefix, squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model_type} is neither unigram nor BPE")
        t = cls(pieces, scores, kinds, model_type, prefix, squeeze)
        for i, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind in (NORMAL, USER_DEFINED):
                t.arcs[piece] = i
            elif kind == BYTE:
                t.byte_arcs[int(piece[3:5], 16)] = i
        t.lengths = [len(p) for p in pieces]
        t.shorter = [next((t.arcs[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in t.arcs), -1) for p in pieces]
        t.closed = all(c in t.arcs for p in t.arcs for c in p)
        t.automaton = ahocorasick.Automaton()
        for piece, i in t.arcs.items():
            t.automaton.add_word(piece, i)
        t.automaton.make_automaton()
        if any(MARK in p.lstrip(MARK) for p in t.arcs):
            t.segment = re.compile(r"(?s).+")
        return t

    segment = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (" " + text if self.dummy_prefix else text).replace(" ", MARK)

    def merged(self, text: str, until: int = 1) -> list[str]:
        """BPE of a short string, down to so many parts: the best-scored neighbours are merged first, the leftmost on ties."""
        parts = list(text)
        while len(parts) > until:
            best = None
            for i in range(len(parts) - 1):
                j = self.arcs.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.scores[j] > best[0]):
                    best = (self.scores[j], i)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def spines(self, piece: str) -> tuple[list, list] | None:
        """What the merges of a piece leave at its left and at its right end, from a character to the piece itself, with scores.

        None if the piece is not its own merge result, or a part scores no better than the whole: then order of merging
        and order of scores may differ.
        """
        if piece not in self.ends:
            found = None
            score = self.scores[self.arcs[piece]]
            if len(piece) == 1:
                found = ([(piece, score)], [(piece, score)])
            elif self.merged(piece) == [piece]:
                left, right = self.merged(piece, 2)
                x, y = self.spines(left), self.spines(right)
                if x and y and all(len(z) == 1 or self.scores[self.arcs[z]] > score for z in (left, right)):
                    found = (x[0] + [(piece, score)], y[1] + [(piece, score)])
            self.ends[piece] = found
        return self.ends[piece]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the pieces left + right (left -1: none) gives the two again. Only merges across their border can prevent it."""
        key = (left + 1) * len(self.pieces) + right
        slot = key % FOLLOWS  # shortest_path looks here first
        held = self.follows[slot]
        if held >> 1 == key:
            return held & 1 == 1
        a, b = self.pieces[left] if left >= 0 else "", self.pieces[right]
        x, y = self.spines(a) if a else None, self.spines(b)
        if not a and y:
            found = True
        elif x and y:
            found = self._apart(x[1], y[0])
        else:
            found = self.merged(a + b) == ([a, b] if a else [b])
        self.follows[slot] = key << 1 | found
        return found

    def _apart(self, left: list, right: list) -> bool:
        """left, right: the spines that meet. They grow in order of score; a better merge across them comes first."""
        i = j = 0
        while True:
            grow_left = left[i + 1][1] if i + 1 < len(left) else -np.inf
            grow_right = right[j + 1][1] if j + 1 < len(right) else -np.inf
            across = self.arcs.get(left[i][0] + right[j][0])
            if across is not None and self.scores[across] > grow_left and self.scores[across] >= grow_right:
                return False
            if grow_left == grow_right == -np.inf:
                return True
            if grow_left >= grow_right:
                i += 1
            else:
                j += 1

    def shortest_path(self, segment: str) -> list[int]:
        """Piece ids of a segment's best path; characters without a piece go over byte arcs (unknown where there are none)."""
        n = len(segment)
        if self.model_type == BPE:
            if segment in self.arcs and self.may_follow(-1, self.arcs[segment]):
                return [self.arcs[segment]]
            if self.closed and (found := self._depth_first(segment, n)) is not None:
                return found
            start, ids = self._finite_path(segment, n)
        else:
            start, ids = self._cheapest_path(segment, n)
        path: list[int] = []
        at = n
        while at:
            path += self._bytes(segment[start[at] : at])[::-1] if ids[at] < 0 else [ids[at]]
            at = start[at]
        return path[::-1]

    def _depth_first(self, segment: str, n: int) -> list[int] | None:
        """The ids of the path of cost 0 (None: there is none) of a model whose pieces hold no character that is no piece.

        So a character without a piece is in no arc, and its byte arcs begin the path anew. A state that was left without
        a way on is not entered again: one path of finite cost reaches it, whatever was tried before.
        """
        longest = [-1] * n
        lengths, shorter, follows, k = self.lengths, self.shorter, self.follows, len(self.pieces)
        for end, piece in self.automaton.iter(segment):
            longest[end + 1 - lengths[piece]] = piece  # ends ascend
        path: list[int] = []
        dead = bytearray(n + 1)
        at, last, piece, bare = 0, -1, longest[0], False
        while at < n:
            while piece >= 0:
                end = at + lengths[piece]
                if not dead[end]:
                    key = (last + 1) * k + piece
                    held = follows[key % FOLLOWS]
                    if held & 1 if held >> 1 == key else self.may_follow(last, piece):
                        break
                piece = shorter[piece]
            else:
                if longest[at] < 0:
                    end, piece, bare = at + 1, -1, True
                elif not path or path[-1] < 0:
                    return None
                else:
                    dead[at] = 1
                    piece = path.pop()
                    at -= lengths[piece]
                    last = path[-1] if path else -1
                    piece = shorter[piece]
                    continue
            path.append(piece)
            at, last = end, piece
            piece = longest[at] if at < n else -1
        if not bare:
            return path
        out: list[int] = []
        at = 0
        for piece in path:
            out += [piece] if piece >= 0 else self._bytes(segment[at])
            at += lengths[piece] if piece >= 0 else 1
        return out

    def _finite_path(self, segment: str, n: int) -> tuple[list[int], list[int]]:
        """For each state the start of the arc that reaches it at cost 0, and its piece (-1: none, or bytes; -2: not reached)."""
        start, ids = [0] * (n + 1), [-2] * (n + 1)
        ids[0] = -1
        done = 0  # states up to here are final
        lengths, follows, k = self.lengths, self.follows, len(self.pieces)
        for end, piece in self.automaton.iter(segment):
            end += 1
            if ids[end] != -2:
                continue
            at = end - lengths[piece]
            while done < at:
                done += 1
                if ids[done] == -2:
                    start[done], ids[done] = done - 1, -1
            if ids[at] == -2:
                continue
            key = (ids[at] + 1) * k + piece
            held = follows[key % FOLLOWS]
            if held & 1 if held >> 1 == key else self.may_follow(ids[at], piece):
                start[end], ids[end] = at, piece
        while done < n:
            done += 1
            if ids[done] == -2:
                start[done], ids[done] = done - 1, -1
        return start, ids

    def _cheapest_path(self, segment: str, n: int) -> tuple[list[int], list[int]]:
        """For each state the start of the last arc of its cheapest path, and that arc's piece (-1: bytes)."""
        cost, start, ids = [np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        cost[0] = 0.0
        done = 0
        for end, piece in [*self.automaton.iter(segment), (n, None)]:
            end += 1
            while done < min(end - 1, n):
                done += 1
                if cost[done] == np.inf:
                    cost[done], start[done] = cost[done - 1] + 1e6, done - 1
            if piece is not None and cost[end - self.lengths[piece]] - self.scores[piece] < cost[end]:
                start[end], ids[end] = end - self.lengths[piece], piece
                cost[end] = cost[start[end]] - self.scores[piece]
        return start, ids

    def _bytes(self, char: str) -> list[int]:
        ids = [self.byte_arcs[b] for b in char.encode("utf-8", "surrogatepass")]
        return ids if min(ids) >= 0 else [self.kinds.index(UNKNOWN)]

    def encode(self, text: str) -> np.ndarray:
        segments = self.segment.findall(self.normalise(text))
        out = list(map(self.paths.get, segments))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    out[i] = self._path(segments[i])
        return np.frombuffer(b"".join(out), np.int32)

    def _path(self, segment: str) -> bytes:
        """A segment's ids from the cache or found, and then kept."""
        got = self.paths.get(segment) or self.older.get(segment) or array("i", self.shortest_path(segment)).tobytes()
        if len(segment) <= CACHED_CHARS:
            if len(self.paths) >= CACHE and segment not in self.paths:
                self.older, self.paths = self.paths, {}
            self.paths[segment] = got
        return got

    @cached_property
    def raw(self) -> pa.Array:
        """The bytes that each id stands for."""
        text = {NORMAL: lambda p: p.encode(), USER_DEFINED: lambda p: p.encode(), UNKNOWN: lambda p: " ⁇ ".encode(), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        return pa.array([text.get(k, lambda p: b"")(p) for p, k in zip(self.pieces, self.kinds, strict=True)], pa.large_binary())

    def round_trips(self, texts: list[str | None], ids: list[np.ndarray | None]) -> list[bool | None]:
        """Whether decoding the ids of each text gives it back (null: null); all pieces of a batch are looked up at once.

        Bytes that are no UTF-8 when joined are left to ``decode``, which replaces them run by run.
        """
        found = [i for i in ids if i is not None]
        joined = self.raw.take(pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
        at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :]
        data, mark = memoryview(joined.buffers()[2] or b""), MARK.encode()
        out: list[bool | None] = []
        done = 0
        for text, i in zip(texts, ids, strict=True):
            if i is None:
                out.append(None)
                continue
            got = bytes(data[at[done] : at[done + len(i)]]).replace(mark, b" ") if len(i) else b""
            done += len(i)
            try:
                plain = got.decode()
            except UnicodeDecodeError:
                plain = self.decode(i.tolist())
            else:
                plain = plain[1:] if self.dummy_prefix and plain.startswith(" ") else plain
            out.append(plain == text)
        return out

    def decode(self, ids: list[int]) -> str:
        if not self.plain:  # pieces that stand for a text of their own, whatever their neighbours
            text = {NORMAL: lambda p: p, USER_DEFINED: lambda p: p, UNKNOWN: lambda p: " ⁇ ", BYTE: lambda p: chr(int(p[3:5], 16)) if int(p[3:5], 16) < 128 else None}
            self.plain = [text.get(k, lambda p: "")(p) for p, k in zip(self.pieces, self.kinds, strict=True)]
        parts = [self.plain[i] for i in ids]
        if None in parts:
            parts = self._with_bytes(ids)
        text = "".join(parts).replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def _with_bytes(self, ids: list[int]) -> list[str]:
        parts, raw = [], b""
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                raw += bytes([int(self.pieces[i][3:5], 16)])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw = b""
            parts.append(self.pieces[i] if kind in (NORMAL, USER_DEFINED) else " ⁇ " if kind == UNKNOWN else "")
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return parts


@dataclass
class Vocabulary:
    """The bytes of a model, broadcast. A worker compiles them once and keeps the transducer and its cache from task to task,
    in the broadcast's value: with its first task of another job it lets go of both, so they do not stay beside later work."""

    model: bytes

    @cached_property
    def transducer(self) -> Transducer:
        return Transducer.compile(self.model)


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str = MODEL, text_col: str = "text") -> DataFrame:
    """docs with ids, n_tokens and round_trip (whether decoding the ids gives the text back) added."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(_model(model_path)))
    kept = [c for c in docs.columns if c not in ("ids", "n_tokens", "round_trip")]
    frame = docs.select(*(docs[c] for c in kept))
    col = kept.index(text_col)
    fields = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        t = shared.value.transducer
        texts = batch.column(col).to_pylist()
        ids = [None if x is None else t.encode(x) for x in texts]
        return dict(zip(kept, batch.columns, strict=True)) | {"ids": pa.array(ids, pa.list_(pa.int32())), "n_tokens": [None if i is None else len(i) for i in ids], "round_trip": t.round_trips(texts, ids)}

    return C.map_arrow(frame, run, f"{fields}, ids array<int>, n_tokens long, round_trip boolean")


def decode(frame: DataFrame, model_path: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """frame with decoded added: the text of its ids (null for null)."""
    shared = frame.sparkSession.sparkContext.broadcast(Vocabulary(_model(model_path)))
    kept = [c for c in frame.columns if c != "decoded"]
    rows = frame.select(*(frame[c] for c in kept))
    col = kept.index(ids_col)
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        t = shared.value.transducer
        return dict(zip(kept, batch.columns, strict=True)) | {"decoded": [None if x is None else t.decode(x) for x in batch.column(col).to_pylist()]}

    return C.map_arrow(rows, run, f"{fields}, decoded string")
