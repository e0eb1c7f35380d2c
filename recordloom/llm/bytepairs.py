"""Byte-level BPE encoding and decoding without regular expressions, keeping byte offsets.

Texts of a batch lie in one byte buffer. Every character becomes a class, every class a transition function of a small
automaton that knows where the words of the split pattern (``public_tokenizers.PATTERN``) begin. The functions that arise by
composing these are few and closed under composition, so each has a number and composing two is one table lookup;
as composition is associative, the state before every character follows from a prefix scan over these numbers, done in
blocks side by side. The slices between the boundaries are merged pair by pair, each distinct slice once per Python worker
while it stays in a bounded cache. The length of every token is kept, so its bytes in the text are known, and decoding gathers them.

Which characters are letters, numbers and white space is asked of the tiktoken library on the driver, so that both follow the
same Unicode version; the ids equal that library's. A NULL or empty text has no ids; long texts are scanned in windows,
repeated rows and other columns are kept as they are, but those named like an added one, which it replaces; an
empty table gives an empty one. Rank files that lack a single byte are refused.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import read

CACHED = 250_000  # distinct slices in either of the two generations that a Python worker remembers
SHORT = 64  # bytes of a slice that is worth remembering, and up to which merging goes without a heap
WINDOW = 1 << 20  # bytes that are scanned at once
GROUP = 4 << 20  # bytes of texts that are worked on together; a longer text is alone
BLOCK = 256  # characters that one lane of the scan takes

END, SPACE, WHITE, QUOTE, STMD, RV, E, L, LETTER, NUMBER, OTHER = range(11)
START, AFTER_SPACE, AFTER_WHITE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, OPEN_QUOTE, QUOTE_RV, QUOTE_L, CLOSED = range(10)
SEPARATOR = 0xFF  # in no UTF-8 text
HERE, BEFORE = 1, 2  # a word begins at this character, at the one before it

ADDED = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "ends": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def step(state: int, kind: int) -> tuple[int, int]:
    """The automaton: the next state, and where a word turns out to begin."""
    white = state in (AFTER_SPACE, AFTER_WHITE)
    failed = BEFORE if state in (QUOTE_RV, QUOTE_L) else 0  # 'r, 'v and 'l are two words unless an e or l follows
    if kind == END:
        return START, HERE | failed
    if kind in (SPACE, WHITE):
        return (AFTER_SPACE if kind == SPACE else AFTER_WHITE), (0 if white else HERE) | failed
    if (state, kind) in ((OPEN_QUOTE, STMD), (QUOTE_RV, E), (QUOTE_L, L)):
        return CLOSED, 0
    if state == OPEN_QUOTE and kind in (RV, L):
        return (QUOTE_RV if kind == RV else QUOTE_L), 0
    # The last blank of several belongs to what follows.
    before = BEFORE if white else failed
    state = {QUOTE_RV: IN_LETTERS, QUOTE_L: IN_LETTERS, OPEN_QUOTE: IN_OTHERS}.get(state, state)
    into = {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}.get(kind, IN_LETTERS)
    joined = state in (into, AFTER_SPACE)
    if kind == QUOTE and not joined:
        into = OPEN_QUOTE
    return into, before | (0 if joined else HERE)


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each class its function; the product of two functions; each function's states; and the boundaries by state and class."""
    states, kinds = range(CLOSED + 1), range(OTHER + 1)
    table = [[step(s, k) for s in states] for k in kinds]
    functions = {tuple(s for s, _ in column): None for column in table}
    numbers = {f: i for i, f in enumerate(functions)}
    order, at = list(numbers), 0
    while at < len(order):  # close under composition, with each class's function on the right
        for column in table:
            product = tuple(column[s][0] for s in order[at])
            if product not in numbers:
                numbers[product] = len(order)
                order.append(product)
        at += 1
    of_kind = np.array([numbers[tuple(s for s, _ in column)] for column in table], np.uint8)
    product = np.array([[numbers[tuple(g[s] for s in f)] for g in order] for f in order], np.uint8)
    begins = np.array([[table[k][s][1] for k in kinds] for s in states], np.uint8)
    return of_kind, product, np.array(order, np.uint8), begins


def scan(kinds: np.ndarray, state: int) -> np.ndarray:
    """The states before each character and, last, after all of them."""
    of_kind, product, order, _ = automaton()
    n, m = len(kinds), len(order)
    flat = product.ravel()
    lanes = -(-n // BLOCK) or 1
    lane = np.full(lanes * BLOCK, of_kind[OTHER], np.uint8)
    lane[:n] = of_kind[kinds]
    lane = lane.reshape(lanes, BLOCK).T.copy()
    for j in range(1, BLOCK):
        lane[j] = flat[lane[j - 1].astype(np.intp) * m + lane[j]]
    total, reach = lane[-1].copy(), 1
    while reach < lanes:  # prefix products over the lanes, doubling their reach
        total[reach:] = flat[total[:-reach].astype(np.intp) * m + total[reach:]]
        reach *= 2
    entry = np.append(state, order[total[:-1], state]).astype(np.intp)
    after = order.ravel()[lane.astype(np.intp) * order.shape[1] + entry].T.ravel()[:n]
    return np.append(np.uint8(state), after)


def character_kinds(letters: str, numbers: str, white: str) -> bytes:
    """The class of each code point, as one byte each."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, members in ((LETTER, letters), (NUMBER, numbers), (WHITE, white), (SPACE, " "), (QUOTE, "'"), (STMD, "stmd"), (RV, "rv"), (E, "e"), (L, "l")):
        kinds[[ord(c) for c in members]] = kind
    return kinds.tobytes()


@lru_cache(maxsize=1)
def library_kinds() -> bytes:
    """The classes as the installed tiktoken library sees them."""
    import tiktoken

    characters = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}

    def members(pattern: str) -> str:
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        return bytes(found.encode_ordinary(characters)).decode()

    return character_kinds(members(r"\p{L}"), members(r"\p{N}"), members(r"\s"))


def boundaries(data: bytes, table: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Byte offsets at which the words of texts begin that ``SEPARATOR`` bytes end; each of these is one word, too."""
    begins = automaton()[3]
    whole = np.frombuffer(data, np.uint8)
    state, last, at, newest, found = START, 0, 0, -1, []
    while at < len(whole):
        stop = min(at + window, len(whole))
        while stop < len(whole) and whole[stop] & 0xC0 == 0x80:
            stop += 1
        part = whole[at:stop]
        if (part & 0x80).any():
            leads = np.flatnonzero((part & 0xC0) != 0x80)
            first = part[leads].astype(np.int32)
            code = first.copy()
            for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
                of = np.flatnonzero((first >= least) & (first < SEPARATOR))
                value = first[of] & mask
                for i in range(1, more + 1):
                    # A lead of a longer character is redone in its own round.
                    value = value << 6 | part[np.minimum(leads[of] + i, len(part) - 1)] & 0x3F
                code[of] = value
            kinds = table[code]
            kinds[first == SEPARATOR] = END
        else:
            leads, kinds = np.arange(len(part)), table[part]
        states = scan(kinds, state)
        bits = begins[states[:-1], kinds]
        marked = np.zeros(len(leads) + 1, bool)
        marked[1:] = bits & HERE
        marked[:-1] |= (bits & BEFORE) > 0
        places = np.append(last, at + leads)
        marked[0] &= newest != last  # the last character of a window may have been marked there
        found.append(places[marked])
        newest = int(found[-1][-1]) if len(found[-1]) else newest
        state, last, at = int(states[-1]), int(places[-1]), stop
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Ranks:
    """The tables of one rank file, and the work on slices."""

    def __init__(self, blob: bytes):
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, blob.splitlines()))}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("a rank file must hold every single byte")
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], np.int32)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = [self.ids[bytes([b])] for b in range(256)]
        # Every pair of tokens that make a token, both ids in one number.
        self.joins = {
            self.ids[token[:i]] << 32 | self.ids[token[i:]]: rank
            for token, rank in self.ids.items()
            for i in range(1, len(token))
            if token[:i] in self.ids and token[i:] in self.ids
        }
        self.cache: dict[bytes, bytes] = {}
        self.older = self.cache

    def merge(self, word: bytes) -> list[int]:
        """Ids of a slice: of all neighbours those of the lowest rank are joined first, of equal ones the leftmost.

        A rank is the id of what is joined, so ids alone are looked at.
        """
        if word in self.ids:
            return [self.ids[word]]
        joins, none = self.joins, len(self.lengths)
        parts = [self.single[b] for b in word]
        if len(word) <= SHORT:
            gains = [joins.get(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
            while gains and (best := min(gains)) < none:
                at = gains.index(best)
                parts[at : at + 2] = [best]
                del gains[at]
                if at:
                    gains[at - 1] = joins.get(parts[at - 1] << 32 | best, none)
                if at < len(gains):
                    gains[at] = joins.get(best << 32 | parts[at + 1], none)
            return parts
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        waiting = [(joins[p], i, p) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (p := a << 32 | b) in joins]
        heapq.heapify(waiting)
        while waiting:
            joined, i, pair = heapq.heappop(waiting)
            j = after[i]
            if parts[i] < 0 or j == len(parts) or parts[i] << 32 | parts[j] != pair:
                continue  # one of the two has been joined with something else
            parts[i], parts[j], after[i] = joined, -1, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (rank := joins.get(p := parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(waiting, (rank, a, p))
        return [p for p in parts if p >= 0]

    def word(self, word: bytes) -> bytes:
        """Packed ids of a slice that the younger generation of the cache lacks."""
        found = self.older.get(word) or array("I", self.merge(word)).tobytes()
        if len(word) <= SHORT:
            if len(self.cache) >= CACHED:
                self.older, self.cache = self.cache, {}
            self.cache[word] = found
        return found

    def encode(self, texts: list[bytes], table: np.ndarray) -> list[bytes]:
        """Packed ids of each text."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = bytes([SEPARATOR]).join([*texts, b""])
        places = boundaries(data, table)
        first = np.searchsorted(places, ends - [len(t) + 1 for t in texts])
        last = np.searchsorted(places, ends - 1)
        out = []
        for a, b in zip(first.tolist(), last.tolist()):
            cuts = places[a : b + 1].tolist()
            get = self.cache.get
            out.append(b"".join([get(w) or self.word(w) for w in [data[x:y] for x, y in zip(cuts, cuts[1:])]]))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered by their places in the vocabulary."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.lengths) and self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        out = []
        for at in range(0, len(ids), WINDOW):
            part = ids[at : at + WINDOW]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            out.append(self.bytes[np.repeat(self.starts[part] - ends + lengths, lengths) + np.arange(int(ends[-1]))].tobytes())
        return b"".join(out)


@lru_cache(maxsize=1)
def _held(blob: bytes) -> Ranks:
    """A worker's tables outlast its task, and so do the slices it remembers."""
    return Ranks(blob)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``GROUP`` bytes together."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > GROUP:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if held:
        yield start, len(texts)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def encode(docs: DataFrame, ranks_path: str, add: list[str], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and those of ``ADDED`` asked for.

    ``ends`` are the bytes of the UTF-8 text at which the tokens end; each begins where the one before ends. ``decoded`` comes
    from the ids. Both tables are read on the driver and sent along, so executors need no copy of the files.
    """
    context = docs.sparkSession.sparkContext
    with open(ranks_path, "rb") as f:
        sent = context.broadcast((f.read(), library_kinds()))
    kept = [f for f in docs.schema.fields if f.name not in add]
    names = [f.name for f in kept]

    def values(name: str, ranks: Ranks, ids: bytes, decoded: bytes):
        if name == "n_tokens":
            return len(ids) // 4
        if name == "ids":
            return np.frombuffer(ids, np.int32)
        if name == "ends":
            return np.cumsum(ranks.lengths[np.frombuffer(ids, np.int32)])
        if name == "decoded":
            return decoded.decode()
        return hashlib.sha256(ids if name == "ids_sha256" else decoded).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, table = _held(sent.value[0]), np.frombuffer(sent.value[1], np.uint8)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(text_col).to_pylist()]
            for start, stop in _groups(texts):
                out: dict[str, list] = {name: [] for name in add}
                for ids in ranks.encode(texts[start:stop], table):
                    decoded = ranks.decode(np.frombuffer(ids, np.int32))
                    for name in add:
                        out[name].append(values(name, ranks, ids, decoded))
                made = [_lists(out[n]) if n in ("ids", "ends") else pa.array(out[n], pa.int64() if n == "n_tokens" else pa.string()) for n in add]
                own = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*[own.column(n) for n in names], *made], names=[*names, *add])

    return docs.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, ADDED[n]) for n in add]]))


def decode(rows: DataFrame, ranks_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns and the text of each id list; bytes that are no UTF-8 become replacement characters, NULL lists the empty text."""
    with open(ranks_path, "rb") as f:
        sent = rows.sparkSession.sparkContext.broadcast(f.read())
    kept = [f for f in rows.schema.fields if f.name != to]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _held(sent.value)
        for batch in batches:
            texts = [ranks.decode(np.array(ids or [], np.int64)).decode(errors="replace") for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, to])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(to, T.StringType())]))


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, ranks_path(), ["n_tokens", "ids_sha256", "decoded_sha256"]).drop("text")
