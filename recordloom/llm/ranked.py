"""Ranked lexical search: the best documents for each item of a query set, by range-maximum tables over posting lists.

One pass counts the terms of every whole document, keeps those that some item asks for, and writes them beside
the document's length; the corpus statistics are aggregated from that table. A task then reads its share of the table in shards of a
bounded number of documents, without a shuffle. In a shard every term has a posting list with the impact of each posting
and, over it, a sparse table that answers which posting of any range has the greatest impact. An interval of documents is bounded by the sum
of the range maxima of an item's terms. The intervals of greatest bound are taken first: the document that holds the
greatest of these maxima is scored exactly and splits its interval in two, each of which keeps only the terms that occur in it. An interval
whose bound no longer reaches the item's k-th score is dropped; one that equals it is kept, since equal scores are ordered
by id. The k-th score goes with the task from shard to shard, and a first round over a sixteenth of the documents gives every task
a score that at least k documents reach, so that most shards are cut short; no document is left out by that.

A term is a run of digits, letters a-z in either case and characters beyond ASCII. Scores are 64-bit integers
as ``impact`` says. Items are worked on in blocks of bounded bytes, one block after the other, so the terms that a task holds are
bounded however many items there are. Every row of documents is a document of its own, also rows that repeat or share an id;
their results stand beside each other, NULL ids after all others of the same score. Items repeated in full count once; items that share
an id but not the text are told apart by it and ranked each for itself. NULL, empty and wordless texts match nothing; very long texts are
counted whole; an empty table on either side gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize, scratch_path
from .common import read

BEST = 50
SHARD_DOCS, SHARD_POSTINGS = 4_096, 1 << 20  # a shard ends with the document that reaches either
POSTINGS_AT_ONCE = 4 << 20  # of the items whose intervals are held at the same time; an item of more is alone
BLOCK_BYTES = 4 << 20  # of item texts; their terms, some 700,000 at most, are sent to every task
FIRST_ROUND = 16  # one in so many documents
TAKEN = 16  # intervals of an item in its first step; each step doubles it
MOST_TAKEN = 1_024

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
find_terms = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall


def terms(text: str | None) -> list[str]:
    """``str.lower`` would also change letters beyond ASCII."""
    text = text or ""
    return find_terms(text.lower() if text.isascii() else text.translate(LOWER))


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impact(w: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term of weight ``w`` that occurs ``tf`` times in a document of ``n`` terms adds to its score."""
    m = 100 - 50 + (50 * n * documents) // length
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Shard:
    """Posting lists of up to ``SHARD_DOCS`` documents, which are numbered in the order of their ids."""

    def __init__(self, n: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, documents: int, length: int):
        self.documents = len(n)
        order = np.lexsort((at, term))
        at, term, tf = at[order], term[order], tf[order]
        self.keys = term * self.documents + at
        self.impacts = impact(weights[term], tf, n[at], documents, length)
        self.at = at
        present, self.starts = np.unique(term, return_index=True)
        self.stops = np.append(self.starts[1:], len(term))
        self.of_term = np.full(len(weights), -1)
        self.of_term[present] = np.arange(len(present))
        # best[j][i]: where the greatest impact among the postings i to i + 2 ** j - 1 is, the first of equal ones.
        self.best = [np.arange(len(term), dtype=np.int32)]
        reach = 1
        while 2 * reach <= int((self.stops - self.starts).max(initial=0)):
            a, b = self.best[-1][:-reach], self.best[-1][reach:]
            self.best.append(np.where(self.impacts[a] >= self.impacts[b], a, b))
            reach *= 2
        self.flat = np.concatenate(self.best)
        self.level = np.cumsum([0, *[len(b) for b in self.best[:-1]]])

    def maxima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The posting of greatest impact in each range [a, b), none of which is empty or goes beyond a list."""
        j = np.frexp((b - a).astype(float))[1] - 1
        left = self.flat[self.level[j] + a]
        right = self.flat[self.level[j] + b - (1 << j)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right)


class Intervals:
    """Intervals of documents, each with its item, its bound, the document that splits it, and a range of postings per term."""

    def __init__(self, item, bound, split, sizes, a, b):
        self.item, self.bound, self.split, self.sizes, self.a, self.b = item, bound, split, sizes, a, b

    @classmethod
    def bounded(cls, shard: Shard, item: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> Intervals:
        """Without empty ranges and intervals that have no others."""
        own = np.repeat(np.arange(len(item)), sizes)
        some = a < b
        own, a, b = own[some], a[some], b[some]
        sizes = np.bincount(own, minlength=len(item))
        item, sizes = item[sizes > 0], sizes[sizes > 0]
        if not len(item):
            return cls(item, *[np.zeros(0, np.int64)] * 5)
        best = shard.maxima(a, b)
        most, starts = shard.impacts[best], np.cumsum(sizes) - sizes
        bound, top = np.add.reduceat(most, starts), np.maximum.reduceat(most, starts)
        hit = np.flatnonzero(most == np.repeat(top, sizes))
        first = hit[np.searchsorted(hit, starts)]
        return cls(item, bound, shard.at[best[first]], sizes, a, b)

    def where(self, keep: np.ndarray) -> Intervals:
        ranges = np.repeat(keep, self.sizes)
        return Intervals(self.item[keep], self.bound[keep], self.split[keep], self.sizes[keep], self.a[ranges], self.b[ranges])

    def __add__(self, other: Intervals) -> Intervals:
        names = ("item", "bound", "split", "sizes", "a", "b")
        return Intervals(*[np.concatenate([getattr(self, n), getattr(other, n)]) for n in names])


def _rank_in(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The place of each row among those of its group, the greatest value first."""
    order = np.lexsort((-value, group))
    sorted_group = group[order]
    starts = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1])) if len(group) else np.zeros(0, int)
    place = np.empty(len(group), np.int64)
    place[order] = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    return place


def search(shard: Shard, items: list[np.ndarray], floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, score) of documents among which are the k best of each item that score ``floor`` or more, and more than 0.

    ``items`` has the distinct terms of each. Of equal scores the lowest documents are found.
    """
    lists = [shard.of_term[t] for t in items]
    lists = [x[x >= 0] for x in lists]
    terms_of = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    sizes = np.array([len(x) for x in lists], np.int64)
    pending = Intervals.bounded(shard, np.arange(len(items)), sizes, shard.starts[terms_of], shard.stops[terms_of])
    bar = np.maximum(floor, 1)
    kept = np.zeros((len(items), k), np.int64)  # the best scores so far
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    taken = TAKEN
    while len(pending.item):
        live = pending.bound >= bar[pending.item]
        pending = pending.where(live)
        now = _rank_in(pending.item, pending.bound) < taken
        taken = min(2 * taken, MOST_TAKEN)
        this, pending = pending.where(now), pending.where(~now)
        if not len(this.item):
            continue
        # Where the splitting document stands, or would stand, in each posting list.
        own = np.repeat(np.arange(len(this.item)), this.sizes)
        term_base = shard.keys[this.a] - shard.at[this.a]
        place = np.searchsorted(shard.keys, term_base + this.split[own])
        holds = (place < this.b) & (shard.at[np.minimum(place, len(shard.at) - 1)] == this.split[own])
        gained = np.where(holds, shard.impacts[np.minimum(place, len(shard.at) - 1)], 0)
        score = np.add.reduceat(gained, np.cumsum(this.sizes) - this.sizes)
        good = score >= bar[this.item]
        if good.any():
            found.append((this.item[good], this.split[good], score[good]))
            changed, values = this.item[good], score[good]
            order = np.lexsort((-values, changed))
            changed, values = changed[order], values[order]
            starts = np.flatnonzero(np.append(True, changed[1:] != changed[:-1]))
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(changed)]):
                i = changed[start]
                kept[i] = np.sort(np.concatenate([kept[i], values[start:stop]]))[-k:]
                bar[i] = max(bar[i], kept[i, 0])
        children = Intervals.bounded(
            shard, np.tile(this.item, 2), np.tile(this.sizes, 2), np.concatenate([this.a, place + holds]), np.concatenate([place, this.b])
        )
        pending = pending + children.where(children.bound >= bar[children.item])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


class Best:
    """The k best documents of every item that a task has met, by score and then id."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids: pa.Array | None = None

    def add(self, item: np.ndarray, ids: pa.Array, score: np.ndarray) -> None:
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        order = np.lexsort((ranks_of(ids), -score, item))
        item, score = item[order], score[order]
        starts = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        keep = place < self.k
        full = place == self.k - 1
        self.floor[item[full]] = np.maximum(self.floor[item[full]], score[full])
        self.item, self.score, self.ids = item[keep], score[keep], ids.take(pa.array(order[keep]))


def ranks_of(ids: pa.Array) -> np.ndarray:
    """The place of each id in ascending order, NULL last."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    return place


def _counted(docs: DataFrame, known, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, first, n, terms, tfs): lengths, and the numbers and counts of the terms that ``known`` has.

    ``first`` deals the documents of the first round. Documents without a term are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("first", F.pmod(F.xxhash64("doc_id", "text"), F.lit(FIRST_ROUND)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1_024):
                batch = whole.slice(at, 1_024)
                rows, lengths, sizes, found, counts = [], [], [], [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    all_terms = terms(text)
                    if not all_terms:
                        continue
                    own = [(numbers[t], c) for t, c in Counter(all_terms).items() if t in numbers]
                    rows.append(i)
                    lengths.append(len(all_terms))
                    sizes.append(len(own))
                    found += [t for t, _ in own]
                    counts += [c for _, c in own]
                offsets = pa.array(np.cumsum([0, *sizes]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (found, counts)]
                chosen = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(chosen), batch.column("first").take(chosen), pa.array(lengths, pa.int64()), *lists],
                    names=["doc_id", "first", "n", "terms", "tfs"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, first boolean, n bigint, terms array<int>, tfs array<int>")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = postings = 0
    for batch in batches:
        at = 0
        total = np.cumsum(batch.column("terms").value_lengths().to_numpy())
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            full = int(np.searchsorted(total, before + SHARD_POSTINGS - postings)) + 1
            stop = min(at + SHARD_DOCS - rows, full, batch.num_rows)
            held.append(batch.slice(at, stop - at))
            rows, postings, at = rows + stop - at, postings + total[stop - 1] - before, stop
            if rows >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _together(shard: Shard, items: list[np.ndarray]) -> Iterator[slice]:
    """Runs of items that have about ``POSTINGS_AT_ONCE`` postings together."""
    start = held = 0
    for i, own in enumerate(items):
        lists = shard.of_term[own]
        lists = lists[lists >= 0]
        size = int((shard.stops[lists] - shard.starts[lists]).sum())
        if held and held + size > POSTINGS_AT_ONCE:
            yield slice(start, i)
            start, held = i, 0
        held += size
    yield slice(start, len(items))


def _searched(index: DataFrame, sent, k: int) -> DataFrame:
    """(item, doc_id, score): the best of every task; ``sent`` has the items' terms, the terms' weights, the floors and the statistics."""
    kind = index.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, floor, documents, length = sent.value
        best = Best(len(items), k, floor)
        for table in _shards(batches):
            ids = table.column("doc_id").combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
            place = ranks_of(ids)
            lists = [table.column(c).combine_chunks() for c in ("terms", "tfs")]
            sizes = lists[0].value_lengths().to_numpy().astype(np.int64)
            term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            n = np.empty(len(ids), np.int64)
            n[place] = table.column("n").to_numpy()
            shard = Shard(n, np.repeat(place, sizes), term, tf, weights, documents, length)
            by_place = ids.take(pa.array(np.argsort(place)))
            for part in _together(shard, items):
                item, doc, score = search(shard, items[part], best.floor[part], k)
                best.add(item + part.start, by_place.take(pa.array(doc)), score)
        if best.ids is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), best.ids, pa.array(best.score, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, items: list, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """(item, rank, doc_id, score) for the items of one block, ``item`` being the place in the list."""
    spark = docs.sparkSession
    asked = [sorted(set(terms(row.text))) for row in items]
    numbers = {t: i for i, t in enumerate(sorted({t for own in asked for t in own}))}
    if not numbers:
        return None
    path = scratch_path(spark, "term_counts")
    counted = _counted(docs, spark.sparkContext.broadcast(numbers), id_col, text_col)
    counted.write.partitionBy("first").parquet(path)
    index = spark.read.schema(counted.schema).parquet(path)
    totals = index.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    if not totals.documents:
        return None
    holders = np.zeros(len(numbers), np.int64)
    for row in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        holders[row.t] = row.n  # at most one row per term of the block
    weights = np.array([weight(totals.documents, int(h)) for h in holders], np.int64)
    lists = [np.array([numbers[t] for t in own], np.int64) for own in asked]
    floor = np.zeros(len(items), np.int64)

    def searched(rows: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast((lists, weights, floor, totals.documents, totals.length))
        return _searched(rows.select("doc_id", "n", "terms", "tfs"), sent, k)

    first = materialize(_ranked(searched(index.filter("first")), k).select("item", "doc_id", "score"), "first_round")
    reached = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
    for row in reached.collect():  # at most one row per item of the block
        floor[row.item] = row.least
    return _ranked(first.union(searched(index.filter("NOT first"))), k)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per item: item_id, rank, doc_id and score of its k best documents."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    asked = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
    size = F.octet_length("text") + 64
    count, total = asked.agg(F.count("*"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    blocks = max(1, min(count, -(-2 * total // block_bytes)))  # half full on average, so that hashing hardly fills any beyond
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    out = None
    for block in range(blocks):
        own = asked.filter(F.col("block") == block).orderBy("item_id", "text").collect()
        found = _block(docs, own, k, id_col, text_col)
        if found is None:
            continue
        names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(own)], f"item int, item_id {kind}")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = materialize(found, "ranked") if blocks > 1 else found
        out = found if out is None else out.union(found)
    if out is not None:
        return out
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema[id_col].dataType.simpleString()}, score bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS doc, doc_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM documents),
lengths AS (SELECT doc, count(*) AS n FROM t GROUP BY doc),
totals AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM lengths),
tfs AS (SELECT doc, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, totals GROUP BY term, documents),
items AS (
  SELECT DISTINCT item_id, text,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, text, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // length))))::BIGINT AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc), totals GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) <= 50
"""
