"""Exact top-k search by inner product: ball-tree branch and bound in every shard.

Vectors become integers, floor(64 x) per component, in the narrowest type that holds them all. Distinct vectors keep their k + 1
smallest ids, which is all that any query can return of them, so copies cost nothing. They are dealt to shards of bounded size; each
shard is packed once with its ball tree. Shards form groups of bounded size, queries blocks. A block is first searched in one group;
what it finds there goes with it to more groups in every further round, until it has met all: a node is opened only for the queries
whose upper bound (q . centre + |q| radius) still reaches their k-th score so far. Nodes with the greater bounds come first, so that
score rises early; where hardly any bound rules anything out, rows are scored as a whole.

A task holds one group, and blocks pass it one after the other: shards and blocks are each sent once a round, never in pairs, and what a
task holds does not grow with the table. Scores are worked out in floats of the least width that is exact for the block and the shard.

Ties go to the smaller id. Vectors that are NULL or hold NULL or non-finite components take no part, nor do those of which 64 x
is beyond a double; vectors of different lengths never meet. Ids repeated with equal vectors count once; a NULL id takes no part.
Rows that share an id but not the vector are each a query of their own, with ranks of its own under the same id, and each a
candidate for other ids; none is a candidate for its own id. With fewer than k other vectors all are returned; an empty table gives
no rows. Only the named columns are read. Any finite component is taken: floor(64 x) is a double without rounding, products
that floats cannot hold are worked out in integers of any size, and a score beyond a long counts as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize, materialize_observed
from .common import read

SCALE = 64
SHARD_ROWS = 4_096  # distinct vectors of a shard, fewer if they are long
SHARD_BYTES = 512 << 10
BLOCK_ROWS = 1_024  # queries that search together, fewer if they are long
BLOCK_BYTES = 256 << 10
LEAF_ROWS = 64
TILE_ROWS = 256  # rows scored at a time
SAMPLE = 16  # of so many queries the bounds of one tell whether a shard's tree is worth asking
GROUP_BYTES = 32 << 20  # of shards that a task holds
SENT_BYTES = 256 << 20  # of query blocks that pass a task
GROUPS = 32  # at least, if there are as many shards: they are what runs side by side
GROWTH = 6  # groups met after a round for each one met before it

LAST_ID = np.iinfo(np.int64).max
TYPES = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}  # by bytes of a component
CENTRES = {1: np.float32, 2: np.float32, 4: np.float32, 8: np.float64}  # rounded to these; radii are taken from there


class BallTree:
    """Nodes in preorder over reordered vectors: centre, radius, rows [start, stop) and children."""

    def __init__(self, x: np.ndarray, kind: int = 8):
        self.order = np.arange(len(x))
        nodes: list[tuple[int, int]] = []  # start, stop
        children: list[tuple[int, int]] = []  # -1 for leaves
        centres, radii = [], []
        todo: list[tuple[int, int, int, int]] = [(0, len(x), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                children[parent] = (me, -1) if side == 0 else (children[parent][0], me)
            rows = x[self.order[start:stop]]
            centre = rows.mean(0).astype(CENTRES[kind])
            away = np.sqrt(((rows - centre) ** 2).sum(1))
            nodes.append((start, stop))
            children.append((-1, -1))
            centres.append(centre)
            radii.append(float(away.max()))
            if stop - start > LEAF_ROWS and away.max() > 0:
                # Split at the median of the projections on the line between two far points.
                a = rows[away.argmax()]
                b = rows[((rows - a) ** 2).sum(1).argmax()]
                middle = (stop - start) // 2
                part = np.argpartition(rows @ (b - a), middle)
                self.order[start:stop] = self.order[start:stop][part]
                todo += [(start + middle, stop, me, 1), (start, start + middle, me, 0)]
        self.nodes = np.array([(*n, *c) for n, c in zip(nodes, children)], np.int32)
        self.centres, self.radii = np.array(centres), np.array(radii)


def whole_numbers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def k_best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query: its position, ids and scores, in order, and the rank from 0."""
    order = np.lexsort((ids, ~scores, at))  # ~ falls as the value rises, and cannot overflow
    at = at[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    kept = rank < k
    return at[kept], ids[order][kept], scores[order][kept], rank[kept]


class Shard:
    """Vectors of one length and type in the order of their ball tree, each with its ids, the smallest first."""

    def __init__(self, dims: int, kind: int, v: bytes, counts: bytes, ids: bytes, nodes: bytes, centres: bytes, radii: bytes):
        self.x = np.frombuffer(v, TYPES[kind]).reshape(-1, dims)
        self.counts, self.ids = np.frombuffer(counts, np.int32), np.frombuffer(ids, np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.nodes = np.frombuffer(nodes, np.int32).reshape(-1, 4)
        self.centres, self.radii = np.frombuffer(centres, CENTRES[kind]).reshape(-1, dims).astype(float), np.frombuffer(radii)
        self.leaves = np.flatnonzero(self.nodes[:, 2] < 0)  # in the order of their rows
        self.leaf_starts = self.nodes[self.leaves, 0]
        self.most = np.abs(self.x.astype(float)).max(initial=0)


class Search:
    """The best k so far of a block's queries, among those scoring their ``bar`` or more.

    ``own`` is the id of each query, never its own candidate, and ``own_rows`` how many vectors a shard may hold under it at most.
    ``bar`` is the k-th score so far and ``last`` the id that has it, where there are k.
    """

    def __init__(self, own: np.ndarray, queries: np.ndarray, bar: np.ndarray, last: np.ndarray, own_rows: np.ndarray, k: int):
        self.own, self.bar, self.last, self.own_rows, self.k = own, bar.copy(), last.copy(), own_rows, k
        self.queries, self.most = queries.astype(float), np.abs(queries.astype(float)).max(initial=0)
        self.as_type = {np.dtype(float): self.queries}
        self.found, self.pending = [(np.empty(0, np.int64),) * 3], 0

    def typed(self, kind: type) -> np.ndarray:
        if np.dtype(kind) not in self.as_type:
            self.as_type[np.dtype(kind)] = whole_numbers(self.queries) if kind is object else self.queries.astype(kind)
        return self.as_type[np.dtype(kind)]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, ids, scores, rank = k_best(*(np.concatenate(c) for c in zip(*self.found)), self.k)
        self.found, self.pending = [(at, ids, scores)], 0
        full = rank == self.k - 1
        # The bar of a query that began with one may only rise.
        up = scores[full].astype(float) >= self.bar[at[full]]
        self.bar[at[full][up]], self.last[at[full][up]] = scores[full][up], ids[full][up]
        return at, ids, scores

    def shard(self, shard: Shard) -> None:
        """Branch and bound in one shard, for all queries at once."""
        with np.errstate(all="ignore"):
            top = shard.most * self.most * max(shard.x.shape[1], 1)
        kind = np.float32 if top < 2**24 else float if top < 2**53 else object  # floats are exact below these
        x = whole_numbers(shard.x.astype(float)) if kind is object else shard.x.astype(kind)
        coarse = np.float32 if kind is np.float32 else float
        some = slice(None, None, SAMPLE)
        if (self.bar > -np.inf).all() and (self.bounds(shard, coarse, some)[:, shard.leaves] >= self.bar[some, None]).mean() > 0.9:
            self.rows(shard, np.arange(len(self.bar)), kind, x, 0, len(x))  # other queries' bounds would rule out as little
            return
        bounds = self.bounds(shard, coarse, slice(None))
        todo = [0]
        while todo:
            node = todo.pop()
            active = np.flatnonzero(bounds[:, node] >= self.bar)
            if not len(active):
                continue
            start, stop, a, b = shard.nodes[node]
            if a >= 0:
                below = shard.leaves[slice(*np.searchsorted(shard.leaf_starts, (start, stop)))]
                bar = self.bar[active, None]
                if (bar == -np.inf).any() or (bounds[np.ix_(active, below)] >= bar).mean() < 0.5:
                    if bounds[active, a].sum() < bounds[active, b].sum():
                        a, b = b, a
                    todo += [b, a]
                    continue
            self.rows(shard, active, kind, x, start, stop)

    def rows(self, shard: Shard, active: np.ndarray, kind: type, x: np.ndarray, start: int, stop: int) -> None:
        """Score rows [start, stop) of ``x``, the shard's vectors in the type that is exact, for the active queries."""
        q = self.typed(kind)
        q = q if len(active) == len(q) else q[active]
        for at in range(start, stop, TILE_ROWS):
            self.tile(shard, active, q, x[at : min(at + TILE_ROWS, stop)], at)

    def bounds(self, shard: Shard, kind: type, of: slice) -> np.ndarray:
        """Of each query's scores in each node. They are floats; what rounding may take away is given back, and what they cannot hold bounds nothing."""
        slack = max(1e-9, 4 * (shard.x.shape[1] + 8) * float(np.finfo(kind).eps))
        with np.errstate(all="ignore"):
            lengths = np.sqrt((self.queries[of] ** 2).sum(1))
            reach = shard.radii + slack * (np.linalg.norm(shard.centres, axis=1) + shard.radii)
            bounds = self.typed(kind)[of] @ shard.centres.T.astype(kind)
            bounds += lengths[:, None].astype(kind) * reach.astype(kind)
            bounds += slack * np.abs(bounds) + 1
        bounds[~np.isfinite(bounds)] = np.inf
        return bounds

    def tile(self, shard: Shard, active: np.ndarray, q: np.ndarray, rows: np.ndarray, start: int) -> None:
        scores = exact = q @ rows.T
        if scores.dtype == object:
            exact = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
            scores = exact.astype(float)
        width, bar = scores.shape[1], self.bar[active].astype(scores.dtype)[:, None]
        hits = _where(scores >= bar)
        if len(hits) > len(active) * self.k:
            # Crowded: the k-th score of these rows alone, without those that may only have the query's own id, is a bar already.
            least = self.k + int(self.own_rows[active].max())
            crowded = np.flatnonzero(np.bincount(hits // width, minlength=len(active)) > least) if width > least else []
            if len(crowded):
                raised = np.partition(scores[crowded], width - least, axis=1)[:, width - least].astype(float)
                up = raised > self.bar[active[crowded]]
                self.bar[active[crowded[up]]], self.last[active[crowded[up]]] = raised[up], LAST_ID
                bar = self.bar[active].astype(scores.dtype)[:, None]
                hits = _where(scores >= bar)
        if not len(hits):
            return
        at, row = active[hits // width], start + hits % width
        # Of equal scores none beyond the last id is wanted (from 2^53 on floats may be equal where scores are not).
        reached = scores.ravel()[hits]
        wanted = (reached > self.bar[at]) | (shard.ids[shard.starts[row]] <= self.last[at]) | (np.abs(reached) >= 2**53)
        hits, at, row = hits[wanted], at[wanted], row[wanted]
        # Each distinct vector stands for its ids.
        counts = shard.counts[row]
        member = np.repeat(shard.starts[row], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at, ids, values = np.repeat(at, counts), shard.ids[member], np.repeat(exact.ravel()[hits].astype(np.int64), counts)
        other = ids != self.own[at]
        self.found.append((at[other], ids[other], values[other]))
        self.pending += int(other.sum())
        if self.pending > 2 * len(self.own) * self.k:
            self.best()


def _where(mask: np.ndarray) -> np.ndarray:
    """``flatnonzero``, eight at a time where there are few."""
    if mask.size % 8 or not mask.flags.c_contiguous:
        return np.flatnonzero(mask)
    eights = np.flatnonzero(mask.reshape(-1).view(np.uint64))
    if len(eights) * 4 > mask.size // 8:
        return np.flatnonzero(mask)
    at, of = np.nonzero(mask.reshape(-1, 8)[eights])
    return eights[at] * 8 + of


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, dims, kind, v): valid vectors as whole numbers, in the bytes of the narrowest of ``TYPES``."""
    x = F.col(vector_col)
    if not isinstance(vectors.schema[vector_col].dataType.elementType, (T.FloatType, T.DoubleType)):
        x = F.transform(x, lambda c: c.cast("double"))
    valid = vectors.filter(F.col(id_col).isNotNull() & (F.coalesce(F.size(F.col(vector_col)), F.lit(0)) > 0))

    def narrowed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, lists = batch.column(0), batch.column(1)
        dims = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(dims) - dims
        with np.errstate(all="ignore"):
            whole = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(float) * SCALE) + 0.0  # NULL is NaN, -0.0 is 0.0
        fine = np.isfinite(whole)
        whole[~fine] = 0
        fine = np.logical_and.reduceat(fine, starts)
        low, high = np.minimum.reduceat(whole, starts), np.maximum.reduceat(whole, starts)
        kinds = np.full(len(dims), 8)
        for kind in (4, 2, 1):
            span = np.iinfo(TYPES[kind])
            kinds[(low >= span.min) & (high <= span.max)] = kind
        for kind in np.unique(kinds[fine]):
            here = fine & (kinds == kind)
            values = whole[np.repeat(here, dims)].astype(TYPES[kind])
            ends = np.concatenate([[0], np.cumsum(dims[here] * kind)]).astype(np.int32)
            v = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])
            columns = [ids.filter(pa.array(here)), pa.array(dims[here], pa.int32()), pa.array(np.full(len(v), kind), pa.int32()), v]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "dims", "kind", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 20) * batch.num_rows // max(1, len(batch.column(1).flatten()))) if batch.num_rows else 1
            for at in range(0, batch.num_rows, step):
                yield from narrowed(batch.slice(at, step))

    return valid.select(F.col(id_col).cast("bigint").alias("id"), x.alias("v")).mapInArrow(run, "id bigint, dims int, kind int, v binary").distinct()


def _row(values: list, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], f.type) for v, f in zip(values, schema)], schema=schema)


def _fields(spec: str) -> pa.Schema:
    return pa.schema([(n, pa.int32() if t == "int" else pa.binary()) for n, t in (f.split() for f in spec.split(", "))])


SHARDS = "dims int, kind int, shard int, v binary, counts binary, ids binary, nodes binary, centres binary, radii binary"


def _packed(distinct: DataFrame) -> DataFrame:
    """One row per shard, vector length and type: its vectors in the order of their ball tree, their ids and the tree, as bytes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dims, kind, shard = (c.as_py() for c in key)
        x = np.frombuffer(b"".join(table.column("v").to_pylist()), TYPES[kind]).reshape(-1, dims)
        with np.errstate(all="ignore"):
            tree = BallTree(x.astype(float), kind)
        lists = table.column("ids").combine_chunks().take(pa.array(tree.order))
        counts, ids = lists.value_lengths().to_numpy().astype(np.int32), lists.flatten().to_numpy()
        return _row([dims, kind, shard, x[tree.order], counts, ids, tree.nodes, tree.centres, tree.radii], _fields(SHARDS))

    return distinct.groupBy("dims", "kind", "shard").applyInArrow(run, SHARDS)


# A block of queries: ids and vectors, the bar and last id of each, and the k best so far as positions, ids and scores.
BLOCKS = "dims int, kind int, block int, own binary, v binary, bars binary, lasts binary, at binary, found binary, scores binary"


def _blocks(queries: DataFrame) -> DataFrame:
    """One row per block, vector length and type."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own = table.column("id").to_numpy().astype(np.int64)
        v = np.frombuffer(b"".join(table.column("v").to_pylist()), np.uint8)
        none = np.empty(0, np.int64)
        return _row([*(c.as_py() for c in key), own, v, np.full(len(own), -np.inf), np.full(len(own), LAST_ID), none, none, none], _fields(BLOCKS))

    return queries.groupBy("dims", "kind", "block").applyInArrow(run, BLOCKS)


def _merged(blocks: DataFrame, k: int) -> DataFrame:
    """Blocks and what a round found for them (rows without ``own``), as blocks with the k best of both."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = next(r for r in table.select(["own", "v"]).to_pylist() if r["own"] is not None)
        at, ids, scores = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("at", "found", "scores"))
        at, ids, scores, rank = k_best(at, ids, scores, k)
        n, full = len(block["own"]) // 8, rank == k - 1
        bars, lasts = np.full(n, -np.inf), np.full(n, LAST_ID)
        bars[at[full]], lasts[at[full]] = scores[full], ids[full]
        return _row([*(c.as_py() for c in key), block["own"], block["v"], bars, lasts, at, ids, scores], _fields(BLOCKS))

    return blocks.groupBy("dims", "kind", "block").applyInArrow(run, BLOCKS)


def _searched(dealt: DataFrame, k: int) -> DataFrame:
    """What blocks find in the shards of their cell, which come before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shards, known = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i] for n, c in zip(batch.schema.names, batch.columns)}
                cell = (row["cell"].as_py(), row["dims"].as_py())
                if cell != held:
                    held, shards, known = cell, [], None
                dims, kind = cell[1], row["kind"].as_py()
                if not row["turn"].as_py():
                    shards.append(Shard(dims, kind, *(row[c].as_py() for c in ("v", "counts", "ids", "nodes", "centres", "radii"))))
                    continue
                if not shards:
                    continue
                if known is None:
                    known = np.sort(np.concatenate([s.ids for s in shards]))
                own = np.frombuffer(row["own"].as_buffer(), np.int64)
                queries = np.frombuffer(row["v"].as_buffer(), TYPES[kind]).reshape(-1, dims)
                bars, lasts = np.frombuffer(row["bars"].as_buffer()), np.frombuffer(row["lasts"].as_buffer(), np.int64)
                search = Search(own, queries, bars, lasts, np.searchsorted(known, own, "right") - np.searchsorted(known, own), k)
                for shard in shards:
                    search.shard(shard)
                found = _row([dims, kind, row["block"].as_py(), None, None, None, None, *search.best()], _fields(BLOCKS))
                yield from found.to_batches()

    return dealt.mapInArrow(run, BLOCKS)


def _ranked(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, at, ids, scores = (np.frombuffer(row[c], np.int64) for c in ("own", "at", "found", "scores"))
                rank = np.arange(len(at)) - np.searchsorted(at, at) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[at]), pa.array(rank, pa.int32()), pa.array(ids), pa.array(scores)], names=["query_id", "rank", "vec_id", "score"]
                )

    return blocks.select("own", "at", "found", "scores").mapInArrow(run, "query_id bigint, rank int, vec_id bigint, score bigint")


def top_inner_products(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """For each row where ``is_query`` (a function of the id column) holds: query_id, rank, vec_id, score of the k best others."""
    rows = quantised(vectors, id_col, vector_col).withColumn("asked", F.coalesce(is_query(F.col("id")), F.lit(False)))
    length = F.octet_length("v").cast("bigint")
    rows, asked = materialize_observed(rows, "integer_vectors", n=F.count(F.when(F.col("asked"), 1)), bytes=F.sum(F.when(F.col("asked"), length + 24)))
    vector = ["dims", "kind", "v"]
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*vector).orderBy("id"))).filter(F.col("_n") <= k + 1)  # cut before and after the shuffle
    distinct = few.groupBy(*vector).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct, kept = materialize_observed(distinct, "distinct_vectors", n=F.count(F.lit(1)), bytes=F.sum(length + 8 * F.size("ids")))

    needed = lambda amount, most: -(-(amount or 0) // most)
    shards = max(1, needed(kept["n"], shard_rows), needed(kept["bytes"], SHARD_BYTES))
    groups = max(1, needed(kept["bytes"], GROUP_BYTES), min(shards, GROUPS))
    blocks = max(1, needed(asked["n"], BLOCK_ROWS), needed(asked["bytes"], BLOCK_BYTES), min(groups, needed(asked["n"], 64)))
    parts = max(1, needed(asked["bytes"], SENT_BYTES))
    numbered = lambda n, *columns: F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
    packed = materialize(_packed(distinct.withColumn("shard", numbered(shards, "v"))), "ball_tree_shards")
    state = materialize(_blocks(rows.filter("asked").withColumn("block", numbered(blocks, "id", "v"))), "query_blocks")

    # A cell is a group of shards and a part of the blocks. Blocks start at groups of their own, so each round keeps all tasks busy.
    held = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("cell", F.col("shard") % groups * parts + F.col("part"))
    first, met = F.col("block") + numbered(groups, "dims", "kind"), 0
    while met < groups:
        upto = min(groups, max(1, met * GROWTH))
        turns = F.explode(F.sequence(F.lit(met), F.lit(upto - 1)))
        sent = state.drop("at", "found", "scores").withColumn("_j", turns).withColumn("cell", (first + F.col("_j")) % groups * parts + F.col("block") % parts)
        dealt = held.drop("part", "shard").withColumn("turn", F.lit(0)).unionByName(sent.drop("_j").withColumn("turn", F.lit(1)), allowMissingColumns=True)
        dealt = dealt.repartitionById(groups * parts, "cell").sortWithinPartitions("cell", "dims", "turn")
        state = materialize(_merged(state.union(_searched(dealt, k)), k), "query_blocks")
        met = upto
    return _ranked(state)


def query(spark, sf_dir: str) -> DataFrame:
    return top_inner_products(read(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(c::DOUBLE * 64)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
e AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS c FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, sum(q.c * d.c)::BIGINT AS score
  FROM e q JOIN e d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
