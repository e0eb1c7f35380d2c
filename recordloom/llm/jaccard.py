"""Join of near copies: word n-grams with a Jaccard similarity of at least 0.8, by chosen paths.

Texts with the same set of n-grams are one class from the start, weighed by its size. Every class is embedded as
``COORDINATES`` minhashes. A tree of sets is grown from a root that holds all classes: at each node a few
coordinates are chosen by the node's own seed, and for each the members are split by their value, so sets sharing a
sampled token go the same way. A node is left alone once it is small, or once its members are so alike
that splitting no longer separates them; then all its members are compared. The root chooses
as many coordinates as runs are needed for ``RECALL``. Deeper nodes choose ``CHOSEN`` coordinates each, so a pair at
the threshold that shares a node is lost below it with a probability q = (1 - 0.8 * (1 - q)) ** 2 at most, 0.0625, and
altogether with (1 - 0.8 * (1 - q)) ** runs, 3.8e-6 for 9 runs.

Comparing has two steps, both in blocks of bounded size, so a node that holds a third of all rows is many
tasks. Minhash sketches first tell which members have any likely partner; then exact sets of n-grams
are intersected. A pair that meets in several nodes is judged in the first of them only. What leaves a block is one
number per member (its links) and a spanning forest of the links, never the pairs themselves; connected
components follow by repeated contraction. Where only classes are asked for, members already known to be of one class are
not compared with each other (``class_edges``).

A word is a run of letters, digits or underscores, lower-cased. Texts of fewer than five words, but not none,
are one n-gram of all their words; NULL, empty and wordless texts have no n-grams and stay alone. Repeated rows are
documents of one class; rows sharing an id are told apart by their text. Only the id and text columns are read.
Sets are numbered by 64 bits of hash; of two sets with the same number (some ten among 2e10) one stays without links.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import ROW, bundles, keyed, whole_rows

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99999
COORDINATES, CHOSEN, LOOKED_AT = 128, 2, 8
SMALL = 1_024  # members of a node that are compared without splitting further: their sketches take less work than one more level
DEEPEST = 16
ALIKE = 0.6  # of a node's pairs sharing a coordinate's value: splitting is of no use
BLOCK = 2_048  # sketches of a block, a quarter of a megabyte; two blocks meet in one task
EXACT_BLOCK, EXACT_BYTES = 512, 8 << 20  # the same for exact sets
LIKELY = 0.6  # sketch similarity below which a pair at the threshold lies with a probability of 7.6e-8

find_words = re.compile(r"\w+").findall


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor, shift), so nearby inputs become unrelated."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted distinct 64-bit hashes of their n-grams, and those to minhashes."""

    def __init__(self, n: int):
        self.n, self.known = n, {}
        self.seeds = _mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def _word(self, word: str) -> int:
        if len(self.known) > 150_000:
            self.known.clear()
        value = self.known[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return value

    def grams(self, text: str) -> np.ndarray:
        known = self.known
        ids = [known.get(w) or self._word(w) for w in find_words(text.lower())]
        h = np.array(ids, np.uint64)
        n = min(self.n, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - n + 1 + j])
        return np.unique(out)

    def minhashes(self, grams: np.ndarray) -> np.ndarray:
        """The smallest value of each coordinate's hash over the set, 32 bits of it."""
        least = np.full(COORDINATES, np.iinfo(np.uint64).max)
        with np.errstate(over="ignore"):
            for at in range(0, len(grams), 4096):
                part = grams[at : at + 4096, None] * self.seeds
                least = np.minimum(least, part.min(0))
        return (_mix(least) >> np.uint64(32)).astype(np.uint32)


def gram_sets(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """Of ``keyed`` documents: doc_id, k1, k2, set_key (digest of the set; NULL if empty), minhashes, and a byte of each as sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            sets = map(shingler.grams, batch.column("text").to_pylist())
            found = [(hashlib.md5(s.tobytes()).digest(), shingler.minhashes(s)) if len(s) else (None, None) for s in sets]
            columns = [[k for k, _ in found], *[[None if m is None else m.astype(kind).tobytes() for _, m in found] for kind in (np.uint32, np.uint8)]]
            arrays = [*[batch.column(c) for c in ("doc_id", *ROW)], *[pa.array(c, pa.binary()) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *ROW, "set_key", "minhashes", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *ROW, "text").mapInArrow(run, f"doc_id {kind}, k1 bigint, k2 bigint, set_key binary, minhashes binary, sketch binary")


def grams_of(texts: DataFrame, n: int = WORDS) -> DataFrame:
    """(id, grams): the sorted n-gram hashes of (id, text) as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                grams = [shingler.grams(t).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(grams, pa.binary())], names=["id", "grams"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, grams binary")


def _children(nodes: DataFrame, chosen: int) -> DataFrame:
    """Members of every node spread over its children; ``nodes`` has node, id, minhashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy().astype(np.int64).view(np.uint64)
            sketch = np.frombuffer(b"".join(batch.column("minhashes").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            ids = batch.column("id").to_numpy()
            which = np.arange(len(ids))
            first = _mix(node + np.uint64(1)) % np.uint64(COORDINATES)
            # An odd step visits every coordinate of a power of two once, so the chosen ones differ.
            step = _mix(node + np.uint64(2)) % np.uint64(COORDINATES) | np.uint64(1)
            out = []
            for j in range(chosen):
                coordinate = (first + np.uint64(j) * step) % np.uint64(COORDINATES)
                value = sketch[which, coordinate.astype(np.int64)].astype(np.uint64)
                with np.errstate(over="ignore"):
                    out.append(_mix(_mix(node * np.uint64(31) + coordinate) + value).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(ids, chosen)), pa.array(np.tile(node.view(np.int64), chosen)), pa.array(np.repeat(np.arange(chosen), len(ids)), pa.int32()), pa.array(np.concatenate(out))],
                names=["id", "parent", "choice", "node"],
            )

    return nodes.select("node", "id", "minhashes").mapInArrow(run, "id bigint, parent bigint, choice int, node bigint")


def _within(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose node is among ``nodes``; a node with very many rows is split like any hot key."""
    return sized_join(rows, nodes.select(F.col("node").alias("_node")), [(F.col("node"), F.col("_node"))], "left_semi")


def leaves(sketches: DataFrame, runs: int) -> DataFrame:
    """(node, id): the nodes to compare in, of two members or more; ``sketches`` has id and minhashes."""
    done, level = [], sketches.withColumn("node", F.lit(0).cast("bigint"))
    for depth in range(DEEPEST):
        split = materialize(_children(level, runs if depth == 0 else CHOSEN).select("node", "id"), f"paths_{depth}")
        sizes = materialize(split.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), f"sizes_{depth}")
        if depth + 1 == DEEPEST:
            done.append(_within(split, sizes))
            break
        done.append(_within(split, sizes.filter(F.col("size") <= SMALL)))
        large = sizes.filter(F.col("size") > SMALL)
        if large.isEmpty():
            break
        # The share of pairs that agree on a coordinate is the expected similarity of a node's members.
        members = materialize(_within(split, large).join(sketches, "id"), f"members_{depth}")
        ahead = _children(members, LOOKED_AT).groupBy("parent", "choice", "node").agg(F.count("*").cast("double").alias("n"))
        ahead = ahead.groupBy("parent").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("agree"), (F.sum("n") / LOOKED_AT).alias("n"))
        alike = F.col("agree") / (LOOKED_AT * F.col("n") * (F.col("n") - 1)) >= ALIKE
        judged = materialize(ahead.select(F.col("parent").alias("node"), alike.alias("alike")), f"alike_{depth}")
        done.append(_within(members.select("node", "id"), judged.filter("alike")))
        if judged.filter("NOT alike").isEmpty():
            break
        level = _within(members, judged.filter("NOT alike"))
    return materialize(reduce(DataFrame.union, done).distinct(), "leaves")


def _blocks(members: DataFrame, weight: str, most: int, block: int) -> DataFrame:
    """Add side and block pair (a <= b) for every meeting of blocks; a node is cut into blocks by the hash of the id.

    ``weight`` is summed per node; a block gets about ``most`` of it, and about ``block`` members.
    """
    sizes = members.groupBy("node").agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    cut = F.greatest(F.ceil(F.col("_n") / block), F.ceil(F.col("_w") / most), F.lit(1)).cast("int")
    cuts = sizes.select("node", cut.alias("cut"))
    own = F.pmod(F.xxhash64("id", "node"), F.col("cut")).cast("int")
    cuts = materialize(cuts.withColumnRenamed("node", "_node"), "cuts")
    met = sized_join(members, cuts, [(F.col("node"), F.col("_node"))], "inner").drop("_node").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("cut") - 1))
    return met.withColumn("other", other).withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")}).drop("cut", "other")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Complete groups of equal (node, a, b) from sorted batches, many groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("node", "a", "b")]
        last = np.ones(batch.num_rows, bool)
        for k in keys:
            last &= k == k[-1]
        start = int(np.argmax(last))  # sorted, so equal keys are one run at the end
        if held and start == 0:
            tail = held[-1]
            if all(tail.column(c)[-1].as_py() == batch.column(c)[0].as_py() for c in ("node", "a", "b")):
                held.append(batch)
                continue
        table = pa.Table.from_batches([*held, batch.slice(0, start)])
        if table.num_rows:
            yield table
        held = [batch.slice(start)]
    if held:
        yield pa.Table.from_batches(held)


class Meetings:
    """Which members met in a node before the present one: their sorted lists of earlier nodes, padded to a matrix."""

    def __init__(self, lists: pa.ChunkedArray, here: np.ndarray):
        whole = lists.combine_chunks()
        sizes = whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = whole.flatten().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        early = values < here[row]
        width = int(place[early].max(initial=-1)) + 1
        self.left = np.full((len(sizes), width), np.iinfo(np.int64).min)
        self.right = self.left + 1  # padding that equals nothing on the other side
        self.left[row[early], place[early]] = values[early]
        self.right[row[early], place[early]] = values[early]

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the members ``i`` and ``j`` have an earlier node in common."""
        out = np.zeros(len(i), bool)
        width = self.left.shape[1]
        for at in range(0, len(i) if width else 0, step := max(1, (1 << 20) // max(width, 1) ** 2)):
            part = slice(at, at + step)
            out[part] = (self.left[i[part]][:, :, None] == self.right[j[part]][:, None, :]).any((1, 2))
        return out


def _pairs_of_runs(starts: np.ndarray, stops: np.ndarray, distance: int) -> np.ndarray:
    """Positions i such that i + distance lies in the same run."""
    lengths = np.maximum(stops - starts - distance, 0)
    keep = lengths > 0
    if not keep.any():
        return np.zeros(0, np.int64)
    starts, lengths = starts[keep], lengths[keep]
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [table.column(c).to_numpy() for c in ("node", "a", "b")]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], table.num_rows)


def _cross(table: pa.Table, i: np.ndarray, j: np.ndarray, own: np.ndarray) -> np.ndarray:
    """In the meeting of two blocks only pairs across count; within a block it meets itself."""
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    return (a[i] == b[i]) | (own[i] != own[j])


def likely_members(members: DataFrame) -> DataFrame:
    """(node, id) of members with a partner likely to reach the threshold, judged there; from node, id, sketch, nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            starts, stops = _runs(table)
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            own, node = table.column("own").to_numpy(), table.column("node").to_numpy()
            meetings = Meetings(table.column("nodes"), node)
            found = np.zeros(table.num_rows, bool)
            for d in range(1, int((stops - starts).max(initial=0))):
                i = _pairs_of_runs(starts, stops, d)
                i = i[_cross(table, i, i + d, own) & ~(found[i] & found[i + d])] if len(i) else i
                for at in range(0, len(i), 1 << 16):
                    part = i[at : at + (1 << 16)]
                    near = part[(sketch[part] == sketch[part + d]).sum(1) >= LIKELY * COORDINATES]
                    near = near[~meetings.before(near, near + d)]
                    found[near] = found[near + d] = True
            yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(table.column("id").to_numpy()[found])], names=["node", "id"])

    rows = _blocks(members, "one", BLOCK, BLOCK)
    rows = rows.select("node", "a", "b", "own", "id", "sketch", "nodes")
    dealt = rows.repartition("node", "a", "b").sortWithinPartitions("node", "a", "b")
    return dealt.mapInArrow(run, "node bigint, id bigint").distinct()


def _links(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of the sets that reach the threshold, by one sparse count of shared n-grams."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        hit = shared >= THRESHOLD * (sizes.sum() - shared)
        return (np.array([0]), np.array([1])) if hit else (np.zeros(0, int), np.zeros(0, int))
    grams, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    keep = count[column] > 1  # an n-gram of one set is shared with none
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    new = np.cumsum(np.append(0, np.diff(column) > 0)) if len(column) else column
    for at in range(0, int(new[-1]) + 1 if len(new) else 0, 4096):  # columns of the incidence matrix at a time
        lo, hi = np.searchsorted(new, [at, at + 4096])
        dense = np.zeros((len(sets), 4096), np.float32)
        dense[row[lo:hi], new[lo:hi] - at] = 1
        shared += dense @ dense.T
    i, j = np.nonzero(np.triu(shared >= THRESHOLD * (sizes[:, None] + sizes - shared), 1))
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    root = list(range(n))
    out = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = a, b
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[y] = x
            out.append((a, b))
    return out


def exact_links(members: DataFrame) -> DataFrame:
    """(id, other, links): per member and meeting the weight of its partners (other NULL), and the forest's edges (links 0)."""
    rows = _blocks(members.withColumn("_bytes", F.octet_length("grams")), "_bytes", EXACT_BYTES, EXACT_BLOCK)
    return _linked(rows)


def _linked(rows: DataFrame) -> DataFrame:
    """``exact_links`` of members that meet as their columns own, a and b say; a pair that an earlier node of ``nodes`` holds is left to that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            starts, stops = _runs(table)
            ids, own, node, weight = (table.column(c).to_numpy() for c in ("id", "own", "node", "size"))
            grams, meetings = table.column("grams"), Meetings(table.column("nodes"), node)
            out: list[tuple] = []
            for start, stop in zip(starts.tolist(), stops.tolist()):
                if stop - start < 2:
                    continue
                i, j = _links([np.frombuffer(grams[p].as_py(), np.uint64) for p in range(start, stop)])
                keep = _cross(table, i + start, j + start, own)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                fresh = ~meetings.before(i + start, j + start)
                i, j = i[fresh], j[fresh]
                links = np.bincount(np.concatenate([i, j]), np.concatenate([weight[start + j], weight[start + i]]), stop - start)
                out += [(ids[start + p], None, int(n)) for p, n in enumerate(links) if n]
                out += [(ids[start + p], ids[start + q], 0) for p, q in _forest(stop - start, i, j)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["id", "other", "links"]
            )

    rows = rows.select("node", "a", "b", "own", "id", "size", "grams", "nodes")
    dealt = rows.repartition("node", "a", "b").sortWithinPartitions("node", "a", "b")
    return dealt.mapInArrow(run, "id bigint, other bigint, links bigint")


def _cuts(members: DataFrame) -> Column:
    """An aggregate: into how many blocks of bounded members and bytes a group of members is cut."""
    return F.greatest(F.ceil(F.count("*") / EXACT_BLOCK), F.ceil(F.sum(F.octet_length("grams")) / EXACT_BYTES), F.lit(1)).cast("int")


def _alone(members: DataFrame) -> DataFrame:
    """Every block of a node by itself, so each member is there once."""
    cuts = materialize(members.groupBy(F.col("node").alias("_node")).agg(_cuts(members).alias("cut")), "cuts")
    met = sized_join(members, cuts, [(F.col("node"), F.col("_node"))], "inner")
    own = F.pmod(F.xxhash64("id", "node"), F.col("cut")).cast("int")
    return met.withColumn("own", own).withColumns({"a": F.col("own"), "b": F.col("own"), "nodes": F.array().cast("array<bigint>")})


def _with_class(members: DataFrame, edges: DataFrame) -> DataFrame:
    roots = materialize(components(edges), "roots").withColumnRenamed("id", "_id")
    joined = sized_join(members, roots, [(F.col("id"), F.col("_id"))], "left", spread=["id", "node"])
    return joined.withColumn("class", F.coalesce("root", "id")).drop("_id", "root")


def _rest_meets_all(members: DataFrame) -> DataFrame:
    """Of nodes that hold several classes: the members outside the node's largest class meet each other and that class.

    Blocks of the rest come first in number, then those of the largest class, which do not meet each other.
    """
    classes = members.groupBy("node", "class").agg(F.count("*").alias("n"), _cuts(members).alias("cut"), F.sum(F.octet_length("grams")).alias("bytes"))
    nodes = classes.groupBy(F.col("node").alias("_node")).agg(
        F.max(F.struct("n", "class", "cut", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("classes")
    )
    rest = F.greatest(
        F.ceil((F.col("n") - F.col("top.n")) / EXACT_BLOCK), F.ceil((F.col("bytes") - F.col("top.bytes")) / EXACT_BYTES), F.lit(1)
    ).cast("int")
    mixed = materialize(
        nodes.filter("classes > 1").select("_node", F.col("top.class").alias("largest"), F.col("top.cut").alias("large"), rest.alias("rest")), "mixed_nodes"
    )
    met = sized_join(members, mixed, [(F.col("node"), F.col("_node"))], "inner")
    hashed = F.xxhash64("id", "node")
    inner = F.col("class") == F.col("largest")
    own = F.when(inner, F.col("rest") + F.pmod(hashed, F.col("large"))).otherwise(F.pmod(hashed, F.col("rest"))).cast("int")
    last = F.when(inner, F.col("rest") - 1).otherwise(F.col("rest") + F.col("large") - 1)
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return met.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})


def class_edges(members: DataFrame) -> DataFrame:
    """(id, other): links that connect every class of linked members, without comparing a large class with itself.

    First each block of a node is compared alone, then one member of every class so found with those of
    the others in its node. Near copies of one text are one class by then, and only members outside the largest
    class of a node still meet all others: the rows grow with a group, not with its square.
    """
    edges = lambda links: links.filter("other IS NOT NULL").select("id", "other")
    found = materialize(edges(_linked(_alone(members))), "block_links")
    classed = materialize(_with_class(members, found).select("node", "class", "id"), "block_classes")
    chosen = materialize(classed.groupBy(F.col("node").alias("_node"), "class").agg(F.min("id").alias("_id")).drop("class"), "chosen_members")
    spoken = sized_join(members, chosen, [(F.col("node"), F.col("_node")), (F.col("id"), F.col("_id"))], "left_semi", spread=["id"])
    met = _blocks(spoken.withColumns({"_bytes": F.octet_length("grams"), "nodes": F.array().cast("array<bigint>")}), "_bytes", EXACT_BYTES, EXACT_BLOCK)
    found = materialize(found.union(edges(_linked(met))), "class_links")
    rest = _rest_meets_all(_with_class(members, found))
    return found.union(edges(_linked(rest)))


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every end of the edges (id, other): contraction to a neighbour of least random rank, round by round.

    Each round shrinks every component by a constant factor on average, so the rounds grow with the logarithm
    of the largest; what a round maps is composed afterwards from the last round back.
    """
    steps = []
    live = materialize(edges.select("id", "other"), "edges")
    while not live.isEmpty():
        seed = len(steps)
        both = live.union(live.select("other", "id"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("rank"), F.col(c).alias("id"))
        to = both.groupBy("id").agg(F.min(rank("other")).alias("least")).select("id", F.least("least", rank("id"))["id"].alias("to"))
        to = materialize(to, f"contraction_{seed}")
        steps.append(to)
        a = live.join(to.withColumnRenamed("to", "x"), "id")
        moved = a.join(to.select(F.col("id").alias("other"), F.col("to").alias("y")), "other")
        kept = moved.filter("x <> y").select(F.least("x", "y").alias("id"), F.greatest("x", "y").alias("other")).distinct()
        live = materialize(kept, f"edges_{seed}")
    if not steps:
        return edges.select("id", F.col("other").alias("root")).limit(0)
    final = steps[-1]
    for step in reversed(steps[:-1]):
        up = final.select(F.col("id").alias("to"), F.col("to").alias("up"))
        final = step.join(up, "to", "left").select("id", F.coalesce("up", "to").alias("to"))
    return final.withColumnRenamed("to", "root")


def root_runs(recall: float) -> int:
    """Coordinates that the root chooses, so that a pair at the threshold is lost with 1 - ``recall`` at most, however deep the splits.

    The sketches' loss counts too.
    """
    below = 0.0  # what a shared node loses, level by level
    for _ in range(DEEPEST - 1):
        below = (1 - THRESHOLD * (1 - below)) ** CHOSEN
    kept = THRESHOLD * (1 - below)
    least = math.ceil(LIKELY * COORDINATES)
    unlikely = sum(math.comb(COORDINATES, k) * THRESHOLD**k * (1 - THRESHOLD) ** (COORDINATES - k) for k in range(least))
    if unlikely >= 1 - recall:
        raise ValueError(f"the sketches alone lose {unlikely:.1e} of the pairs at the threshold")
    return math.ceil(math.log(1 - recall - unlikely) / math.log(1 - kept))


def near_copies(docs: DataFrame, n: int = WORDS, recall: float = RECALL, count: bool = True) -> DataFrame:
    """Per document: doc_id, k1, k2, class_id (least id among its near copies and theirs) and n_links (other documents at the threshold).

    To count the links, all members of a node are compared. Without ``count`` the classes are the same, n_links is NULL, and
    members known to be of one class are not compared with each other.
    """
    rows = keyed(docs)
    sets = materialize(gram_sets(rows, n), "gram_sets")
    alone = sets.filter("set_key IS NULL").select("doc_id", *ROW, F.col("doc_id").alias("class_id"), F.lit(0 if count else None).cast("bigint").alias("n_links"))
    own = sets.filter("set_key IS NOT NULL").select("set_key", "doc_id", *ROW)
    listed = bundles(own, ["set_key"], ["doc_id", *ROW], n=F.count("*"), least=F.min("doc_id"), sample=F.min(F.struct(*ROW)))
    listed = materialize(listed, "same_sets")
    classes = listed.groupBy("set_key").agg(F.sum("n").alias("size"), F.min("least").alias("least"), F.min("sample").alias("sample"))
    classes = materialize(classes.withColumn("id", F.xxhash64("set_key")), "classes")
    # Equal sets have equal minhashes: the sample row of a class brings them.
    sketches = sets.select(*ROW, "minhashes", "sketch").join(classes.select("id", "sample.*"), ROW).select("id", "minhashes", "sketch")
    sketches = materialize(sketches.dropDuplicates(["id"]), "sketches")

    places = leaves(sketches.select("id", "minhashes"), root_runs(recall))
    lists = materialize(places.groupBy("id").agg(F.array_sort(F.collect_list("node")).alias("nodes")), "node_lists")
    members = lists.join(sketches.select("id", "sketch"), "id").select("id", "sketch", "nodes", F.lit(1).alias("one"), F.explode("nodes").alias("node"))
    likely = materialize(likely_members(members), "likely")
    chosen = materialize(likely.groupBy("id").agg(F.collect_list("node").alias("at")), "chosen")
    samples = chosen.join(classes, "id").select("id", F.col("sample.k1").alias("s1"), F.col("sample.k2").alias("s2"))
    on = [(F.col("k1"), F.col("s1")), (F.col("k2"), F.col("s2"))]
    texts = sized_join(rows.select(*ROW, "text"), materialize(samples, "samples"), on, "inner")
    grams = materialize(grams_of(texts, n).dropDuplicates(["id"]), "grams")
    compared = grams.join(chosen, "id").join(lists, "id").join(classes.select("id", "size"), "id")
    compared = compared.select("id", "size", "grams", "nodes", F.explode("at").alias("node"))
    if count:
        found = materialize(exact_links(compared), "links")
        links = found.filter("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
        roots = components(found.filter("other IS NOT NULL"))
    else:
        links = classes.limit(0).select("id", F.lit(0).cast("bigint").alias("links"))
        roots = components(class_edges(materialize(compared, "compared")))
    named = classes.join(links, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = materialize(named, "named_classes")
    # The least document of a component reaches all its classes through short lists, however many there are.
    spread = bundles(named.select("root", "set_key", "least", "links", "size"), ["root"], ["set_key", "links", "size"], low=F.min("least"))
    lowest = spread.groupBy("root").agg(F.min("low").alias("class_id"))
    per_class = spread.join(lowest, "root").select("class_id", F.inline("rows"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("size") - 1 if count else F.lit(None).cast("bigint")
    per_class = per_class.select("set_key", "class_id", n_links.alias("n_links"))
    together = listed.join(per_class, "set_key").select("class_id", "n_links", F.inline("rows"))
    return together.select("doc_id", *ROW, "class_id", "n_links").union(alone.select("doc_id", *ROW, "class_id", "n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, with all columns, of the least document of every class; of rows repeated in full one stays."""
    judged = materialize(near_copies(docs, count=False), "near_copies")
    copies = judged.filter(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(*[F.col(k).alias(f"c{k}") for k in ROW]).distinct()
    again = judged.groupBy(*[F.col(k).alias(f"c{k}") for k in ROW]).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    again = materialize(again, "repeated_rows")
    on = [(F.col(k), F.col(f"c{k}")) for k in ROW]
    left = sized_join(whole_rows(docs), materialize(copies, "later_copies"), on, "left_anti")
    once = sized_join(left, again, on, "left_anti").select("row.*")
    if again.isEmpty():
        return once
    return once.union(sized_join(left, again, on, "left_semi").dropDuplicates(ROW).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return near_copies(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
