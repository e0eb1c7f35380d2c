"""SentencePiece encoding and decoding that keeps byte offsets.

The normaliser walks the model's compiled character map, taking the longest known prefix at each
place, and records for every normalised byte the source byte it comes from. Merges run on stretches
that no piece of the vocabulary can cross, each distinct stretch once per Python worker while it stays in a
bounded cache, which holds nothing but its ids: the bytes that a piece covers and those it decodes to
are looked up by id, for a text at once. Every piece is then projected to the bytes of the original
text it covers.

The results equal the sentencepiece library's. A NULL or empty text has only the begin and end
ids; text of any length, repeated rows and extra columns (all of which are kept, those named like
an added one being replaced) need no special care. Models with user-defined or unused pieces or
without byte fallback are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
CACHED = 250_000  # distinct stretches in either of the two generations that a Python worker remembers
SHORT = 64  # characters of a stretch that is remembered, and merged by a list
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

ADDED = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "starts": T.ArrayType(T.IntegerType()),
    "ends": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "spans_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


class CharacterMap:
    """Longest-prefix rewriting by a compiled map: a double-array trie, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes from ``at`` on are replaced, and by what."""
        if not self.units:
            return None
        best, units = None, self.units
        node = self._children(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            has_value = units[node] >> 8 & 1
            node ^= self._children(units[node])
            if has_value:
                value = units[node] & 0x7FFFFFFF
                best = i + 1 - at, self.replacements[value : self.replacements.index(b"\0", value)]
        return best

    @staticmethod
    def _children(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class Remembered(dict):
    """What ``make`` gives for a stretch, asked for by ``[]``: the last ones made, and those asked for again of the ones before."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, stretch: str) -> bytes:
        found = self.older.get(stretch) or self.make(stretch)
        if len(stretch) <= SHORT:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[stretch] = found
        return found


class Model:
    """The tables of one model and the work on single texts."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(blob)
        kinds = [p.type for p in proto.pieces]
        if not proto.trainer_spec.byte_fallback or proto.trainer_spec.model_type != 2 or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge models with byte fallback and without user-defined or unused pieces")
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy_prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.bos, self.eos = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        # What an id decodes to: text, a byte, or nothing for a control id.
        self.surface: list[bytes] = [
            p.piece.replace(SPACE, " ").encode() if p.type == NORMAL
            else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b""
            for p in proto.pieces
        ]
        # The normalised bytes that an id covers, and those of the character that an id of a byte begins.
        self.sizes, self.begins = np.zeros(len(proto.pieces), "<u4"), np.zeros(len(proto.pieces), np.uint8)
        for piece, i in self.ids.items():
            self.sizes[i] = len(piece.encode())
        for byte, i in self.byte_ids.items():
            self.begins[i] = 1 if byte < 0x80 else 0 if byte < 0xC0 else 2 + (byte >= 0xE0) + (byte >= 0xF0)
        self._number_merges()
        self.stretches = self._splitter()
        self.cache = Remembered(self._pack)

    def _number_merges(self) -> None:
        """Number what merges make by falling score, then characters: the best of several merges is the least number.

        ``follows`` has by the number on the left, then on the right, what a merge of both makes; ``tied`` the numbers of equal score.
        """
        made = sorted((p for p in self.ids if len(p) > 1), key=self.scores.get, reverse=True)
        self.parts = [*made, *sorted(set("".join(self.ids)))]
        self.numbers = {p: n for n, p in enumerate(self.parts)}
        self.packed = [self._ids([p]) for p in self.parts]
        none: dict[int, int] = {}
        self.follows = [none] * (len(self.parts) + 1)  # the last is for all characters of no piece
        for n, p in enumerate(made):
            for cut in range(1, len(p)):
                left, right = self.numbers.get(p[:cut]), self.numbers.get(p[cut:])
                if left is not None and right is not None:
                    if self.follows[left] is none:
                        self.follows[left] = {}
                    self.follows[left][right] = n
        equal: dict[float, set[int]] = {}
        for n, p in enumerate(made):
            equal.setdefault(self.scores[p], set()).add(n)
        self.tied = {n: group for group in equal.values() if len(group) > 1 for n in group}

    def _splitter(self):
        """Cut a normalised text where no piece of the vocabulary can lie across, so merges on each side are independent.

        Letters stick together, with whatever else some piece joins to a letter; so does the rest; blanks lead.
        """
        long = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in long):
            return re.compile(r".+", re.S).findall
        pairs = {q for p in long for q in zip(p, p[1:])}
        sticky = {c for q in pairs if q[0].isalpha() != q[1].isalpha() for c in q if not c.isalpha()} - {SPACE}
        letter = r"[^\W\d_" + "]" if not sticky else rf"(?:[^\W\d_]|[{re.escape(''.join(sorted(sticky)))}])"
        alone = "" if any("\n" in p for p in long) else r"\n|"
        cut = r"\n" if alone else ""
        return re.compile(rf"{alone}{SPACE}*{letter}+|{SPACE}*(?:(?!{letter})[^{SPACE}{cut}])+|{SPACE}+").findall

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The text as the vocabulary sees it, and for each of its bytes (and its end) the source byte offset."""
        data = text.encode()
        if not self.map.units and not self.squeeze:
            # Only blanks change, from one byte to three.
            width = 1 + 2 * (np.frombuffer(data, np.uint8) == 32)
            source = np.repeat(np.arange(len(data), dtype=np.int32), width)
            out = text.replace(" ", SPACE)
        else:
            pieces: list[bytes] = []
            places: list[int] = []
            at, blank = 0, True
            while at < len(data):
                step, new = self.map.longest(data, at) or (0, b"")
                if not step:
                    step = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                    new = data[at : at + step]
                for c in new.decode():
                    if not (self.squeeze and c == " " and blank):
                        pieces.append(SPACE.encode() if c == " " else c.encode())
                        places.append(at)
                    blank = c == " "
                at += step
            while self.squeeze and pieces and pieces[-1] == SPACE.encode():
                pieces.pop(), places.pop()
            out = b"".join(pieces).decode()
            source = np.repeat(np.array(places, np.int32), [len(p) for p in pieces]) if pieces else np.zeros(0, np.int32)
        if out and self.dummy_prefix:
            out, source = SPACE + out, np.concatenate([np.full(3, source[0]), source])
        return out, np.append(source, np.int32(len(data)))

    def merge(self, stretch: str) -> list[str]:
        """Pieces of a stretch: the best-scored neighbours are merged first, of equal ones the leftmost."""
        scores = self.scores
        parts = list(stretch)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(-scores[p], i, p) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in scores]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, ""
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (p := parts[a] + parts[b]) in scores:
                    heapq.heappush(heap, (-scores[p], a, p))
        return [p for p in parts if p]

    def _merge_numbers(self, stretch: str) -> list[int]:
        """The same for a short stretch, in numbers; one beyond the last stands for a character of no piece."""
        follows, tied, none = self.follows, self.tied, len(self.parts)
        parts = [self.numbers.get(c, none) for c in stretch]
        gains = [follows[a].get(b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := min(gains)) < none:
            if best in tied:
                best = next(g for g in gains if g in tied[best])
            at = gains.index(best)
            parts[at] = best
            del parts[at + 1], gains[at]
            if at:
                gains[at - 1] = follows[parts[at - 1]].get(best, none)
            if at < len(gains):
                gains[at] = follows[best].get(parts[at + 1], none)
        return parts

    def _ids(self, parts: list[str]) -> bytes:
        """Packed ids; what is no piece has one for each byte."""
        ids: list[int] = []
        for part in parts:
            ids += [self.ids[part]] if part in self.ids else [self.byte_ids[b] for b in part.encode()]
        return array("I", ids).tobytes()

    def _pack(self, stretch: str) -> bytes:
        if len(stretch) <= SHORT:
            packed = self.packed
            try:
                return b"".join([packed[n] for n in self._merge_numbers(stretch)])
            except IndexError:  # a character of no piece
                pass
        return self._ids(self.merge(stretch))

    def _lengths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes that each id covers; of the ids of a character's bytes the last covers it."""
        lengths = self.sizes[ids]
        begins = self.begins[ids]
        at = np.flatnonzero(begins)
        lengths[at + begins[at] - 1] = begins[at]
        return lengths

    def _text(self, ids: Iterable[int]) -> str:
        """What ids decode to that all stand for something."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        try:
            return data.decode()
        except UnicodeDecodeError:  # a byte that is part of no character becomes one replacement character
            return "".join("�" if "\udc80" <= c <= "\udcff" else c for c in data.decode(errors="surrogateescape"))

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: bytes on both sides of one that stands for nothing make no character together."""
        runs = [list(run) for shown, run in groupby(ids, lambda i: self.surface[i] != b"") if shown]
        return self._first_blank("".join(map(self._text, runs)))

    def _first_blank(self, text: str) -> str:
        return text[1:] if self.dummy_prefix and text[:1] == " " else text

    def encode(self, text: str) -> tuple[bytes, bytes, np.ndarray, str]:
        """Packed ids and piece lengths (begin and end ids not included), source offsets, decoded text."""
        normal, source = self.normalise(text)
        packed = b"".join(map(self.cache.__getitem__, self.stretches(normal)))
        decoded = self._first_blank(self._text(array("I", packed)))
        return packed, self._lengths(np.frombuffer(packed, "<u4")).tobytes(), source, decoded


@lru_cache(maxsize=1)
def _held(blob: bytes) -> Model:
    """A worker's tables outlast its task, and so do the stretches it remembers."""
    return Model(blob)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, model_path: str, add: list[str], text_col: str = "text", begin_end: bool = True) -> DataFrame:
    """All columns of ``docs`` and those of ``ADDED`` asked for; spans are bytes of the UTF-8 text, the end exclusive.

    The begin and end ids cover the empty span at the text's ends. The model is read on the driver and sent along,
    so executors need no copy of the file.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [f for f in docs.schema.fields if f.name not in add]
    names = [f.name for f in kept]
    spans = not {"starts", "ends", "spans_sha256"}.isdisjoint(add)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _held(model.value)
        first, last = (np.array([[tables.bos], [tables.eos]], "<u4")) if begin_end else np.zeros((2, 0), "<u4")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):  # bounds what the lists of a batch take
                batch = whole.slice(at, 512)
                out: dict[str, list] = {name: [] for name in add}
                for text in batch.column(text_col).to_pylist():
                    ids, lengths, source, decoded = tables.encode(text or "")
                    ids = first.tobytes() + ids + last.tobytes()
                    if spans:
                        bounds = source[np.cumsum(np.frombuffer(b"\0" * 4 * (1 + len(first)) + lengths + b"\0" * 4 * len(last), "<u4"))].astype("<u4")
                        if len(first):
                            bounds[0] = bounds[1] = 0
                    for name in add:
                        out[name].append(
                            len(ids) // 4 if name == "n_tokens"
                            else np.frombuffer(ids, "<u4") if name == "ids"
                            else bounds[:-1] if name == "starts"
                            else bounds[1:] if name == "ends"
                            else decoded if name == "decoded"
                            else hashlib.sha256(ids).hexdigest() if name == "ids_sha256"
                            else hashlib.sha256(bounds.tobytes()).hexdigest() if name == "spans_sha256"
                            else hashlib.sha256(decoded.encode()).hexdigest()
                        )
                made = [_lists(out[n]) if n in ("ids", "starts", "ends") else pa.array(out[n], pa.int64() if n == "n_tokens" else pa.string()) for n in add]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *made], names=[*names, *add])

    return docs.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, ADDED[n]) for n in add]]))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns and the text of each id list; NULL lists decode to the empty text."""
    with open(model_path, "rb") as f:
        model = rows.sparkSession.sparkContext.broadcast(f.read())
    kept = [f for f in rows.schema.fields if f.name != to]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _held(model.value)
        for batch in batches:
            texts = pa.array([tables.decode(ids or []) for ids in batch.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], texts], names=[*names, to])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(to, T.StringType())]))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, model_path(), ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]).drop("text")
