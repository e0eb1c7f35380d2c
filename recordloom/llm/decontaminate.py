"""Benchmark decontamination: document windows are looked up in the hashed windows of the benchmark.

All of it runs as DataFrame expressions. A word is a run of digits, a-z and characters
beyond ASCII after lower-casing A-Z. A window is ``n`` consecutive words of an item; an item
with fewer words, but not none, is one window. Equal hashes are only candidates: the words
themselves are compared before anything counts as a hit.

NULL or empty texts and items have no words. Repeated rows are judged alike, each by itself.
Input columns other than the named ones are ignored, or passed through by ``decontaminate``.
An empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import ROW, keyed, whole_rows, words

WINDOW_WORDS = 10


def _window_hashes(df: DataFrame, n: int) -> tuple[DataFrame, str]:
    """Add the hash of the ``n`` words from each position on, from hashes of half the length.

    Positions near the end are hashed over fewer words and must not be used.
    """
    df = df.withColumn("_w1", F.transform("words", lambda w: F.xxhash64(w)))

    def build(df: DataFrame, n: int) -> tuple[DataFrame, str]:
        if f"_w{n}" in df.columns:
            return df, f"_w{n}"
        first = 1 << ((n - 1).bit_length() - 1)
        df, a = build(df, first)
        df, b = build(df, n - first)
        tail = F.slice(F.col(b), first + 1, F.size(b))
        return df.withColumn(f"_w{n}", F.zip_with(F.col(a), tail, lambda x, y: F.xxhash64(x, y))), f"_w{n}"

    return build(df, n)


def _windows(df: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """A row for each window of ``n`` words: ``keep``, n, pos (from 0) and hash."""
    df, name = _window_hashes(df, n)
    usable = F.slice(F.col(name), 1, F.greatest(F.size("words") - n + 1, F.lit(0)))
    # The outer form keeps Spark from testing the array's size first, which would compute all of it again.
    rows = df.select(*keep, F.lit(n).alias("n"), F.posexplode_outer(usable).alias("pos", "hash"))
    return rows.filter("pos IS NOT NULL")


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Every distinct window: hash, n, gram (its words, blank-separated) and items (ids as strings), written once."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("words"))
    items = items.filter(F.size("words") > 0)
    sizes = [row.n for row in items.select(F.least(F.size("words"), F.lit(n)).alias("n")).distinct().collect()]  # at most n
    parts = []
    for size in sorted(sizes) or [n]:
        own = items.filter(F.size("words") == size if size < n else F.size("words") >= n)
        gram = F.array_join(F.slice("words", F.col("pos") + 1, F.col("n")), " ")
        parts.append(_windows(own, size, ["item", "words"]).select("item", "n", "hash", gram.alias("gram")))
    windows = reduce(DataFrame.union, parts)
    return materialize(windows.groupBy("hash", "n", "gram").agg(F.collect_set("item").alias("items")), "windows")


def contaminated_spans(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Verified hits of ``keyed`` documents: k1, k2, spans (array of pos, n) and items, one row per document with any.

    The windows are broadcast within the size budget of ``sized_join`` and shuffled beyond it.
    """
    tokens = docs.select(*ROW, words(F.col("text")).alias("words"))
    sizes = [row.n for row in windows.select("n").distinct().collect()]  # at most the window size
    if not sizes:
        return docs.limit(0).select(*ROW, F.expr("array(struct(0 AS pos, 0 AS n))").alias("spans"), F.array(F.lit("")).alias("items"))
    scanned = reduce(DataFrame.union, [_windows(tokens, n, ROW) for n in sorted(sizes)])
    known = windows.select(F.col("hash").alias("known"), F.col("n").alias("known_n")).distinct()
    hits = sized_join(scanned, known, [(F.col("hash"), F.col("known")), (F.col("n"), F.col("known_n"))], "inner")
    found = materialize(hits.groupBy(*ROW).agg(F.collect_list(F.struct("pos", "n", "hash")).alias("hits")), "hits")

    found = found.withColumnsRenamed({k: f"f{k}" for k in ROW})
    suspects = sized_join(tokens, found, [(F.col(k), F.col(f"f{k}")) for k in ROW], "inner")
    gram = lambda h: F.array_join(F.slice("words", h.pos + 1, h.n), " ")
    rows = suspects.dropDuplicates(ROW).select(
        *ROW, F.explode_outer(F.transform("hits", lambda h: F.struct(h.pos, h.n, h.hash, gram(h).alias("gram")))).alias("h")
    ).select(*ROW, "h.*")
    exact = windows.select(F.col("hash").alias("w_hash"), F.col("gram").alias("w_gram"), "items")
    sure = sized_join(rows, exact, [(F.col("hash"), F.col("w_hash")), (F.col("gram"), F.col("w_gram"))], "inner")
    return sure.groupBy(*ROW).agg(
        F.collect_set(F.struct("pos", "n")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )


def _positions(spans: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s.pos, s.pos + s.n - 1))))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurring window), n_items, items (sorted), contaminated."""
    rows = keyed(docs)
    spans = contaminated_spans(rows, benchmark_windows(benchmark, n)).select(
        *[F.col(k).alias(f"s{k}") for k in ROW],
        F.size(_positions(F.col("spans"))).alias("n_hit"),
        F.array_sort("items").alias("items"),
    )
    counted = rows.select("doc_id", *ROW, F.size(words(F.col("text"))).alias("n_words"))
    joined = counted.join(spans, [F.col(k) == F.col(f"s{k}") for k in ROW], "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, remove: str = "documents") -> DataFrame:
    """The input columns without contaminated documents, or (``remove="spans"``) with the hit words cut out of the text."""
    rows = whole_rows(docs)
    spans = contaminated_spans(keyed(docs), benchmark_windows(benchmark, n)).withColumnsRenamed({k: f"s{k}" for k in ROW})
    on = [(F.col(k), F.col(f"s{k}")) for k in ROW]
    if remove == "documents":
        clean = sized_join(rows, materialize(spans.select("sk1", "sk2"), "contaminated"), on, "left_anti")
        return clean.select("row.*")
    cut = sized_join(rows, materialize(spans.select("sk1", "sk2", _positions(F.col("spans")).alias("hit")), "contaminated"), on, "left")
    text = F.col("row.text")
    own = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gaps = F.split(text, own, -1)
    kept = F.transform(
        F.regexp_extract_all(text, F.lit(own), F.lit(0)),
        lambda w, i: F.concat(F.when(F.array_contains("hit", i), F.lit("")).otherwise(w), F.get(gaps, i + 1)),
    )
    rest = F.when(F.col("hit").isNull(), text).otherwise(F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, "")))
    # A step of its own, so that input columns named like those used here cannot be meant.
    cut = cut.select("row", rest.alias("_text"))
    return cut.select(*[F.col("_text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT item_id, n, ws[i:i + n - 1] AS gram FROM (
    SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, n, i, ws[i:i + n - 1] AS gram FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
