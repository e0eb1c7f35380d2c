"""Line deduplication over content-defined chunks of lines.

All of it runs as DataFrame expressions. A rolling hash over the hashes of the last
``WINDOW_LINES`` lines decides where a chunk of lines ends, so the same passage is cut alike
wherever it stands in a document. Chunks of two lines or more that occur more than once
anywhere are compared byte by byte, and all but the first occurrence (by doc_id, then place
in the document) are removed.

``drop_repeated_passages``, used by the pipeline, starts from the same chunks and then extends what they found to the
ends of the repeated passage. Inside a chunk that stood before, every two neighbouring lines that are not blank stood
before as well, so they go without a further look. An exact check follows for those that the chunks leave, in chunks
seen for the first time and across boundaries: of every two neighbouring lines, with the blank ones between, all
but the first occurrence are removed, compared byte by byte as well. Of a repeated passage of two lines or more nothing
stays, whatever stands around it, and every line that goes still stands where it came first. One line alone is no passage.

A NULL text counts as empty and stays NULL in ``drop_repeated_lines``; a text of one line has
no multi-line chunk. Rows repeated in full, id included, count once and are treated alike.
Rows sharing only an id are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import ROW, bundles, keyed, whole_rows

WINDOW_LINES = 2
DIVISOR = 3  # one line in so many ends a chunk
BASE = 31


def _with_cuts(df: DataFrame, divisor: int) -> DataFrame:
    """Add ``_lines`` and the numbers of the first and last line of every chunk, ``_first`` and ``_last``.

    A line ends a chunk if its rolling hash is divisible by ``divisor`` and that of the line
    before is not. That rule looks at three lines only, and it leaves no chunk of one line but
    in texts of one line, the cut before the last line being left out.
    """
    df = df.withColumn("_lines", F.split("text", "\n", -1))
    df = df.withColumn("_hashes", F.transform("_lines", lambda s: F.conv(F.substring(F.md5(s), 1, 7), 16, 10).cast("bigint")))

    def divides(i: Column) -> Column:
        rolled = sum(F.get("_hashes", i - k) * BASE**k for k in range(WINDOW_LINES))
        return F.coalesce(rolled % divisor == 0, F.lit(False))

    n = F.size("_lines")
    ends = F.filter(F.sequence(F.lit(1), n - 3), lambda i: divides(i) & ~divides(i - 1))
    df = df.withColumn("_ends", F.when(n >= 4, ends).otherwise(F.array().cast("array<int>")))
    first = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda i: i + 1))
    last = F.concat(F.col("_ends"), F.array(n - 1))
    return df.withColumns({"_first": first, "_last": last}).drop("_hashes", "_ends")


def _passage(first: Column, last: Column) -> Column:
    return F.array_join(F.slice("_lines", first + 1, last - first + 1), "\n")


def _with_chunks(df: DataFrame, divisor: int) -> DataFrame:
    """Add ``chunks``, the text cut at line ends; joined by line breaks they are the text again."""
    return _with_cuts(df, divisor).withColumn("chunks", F.zip_with("_first", "_last", _passage)).drop("_lines", "_first", "_last")


def _written(lines: Column, first: Column, last: Column) -> Column:
    """The lines that are not blank, of those numbered ``first`` to ``last``."""
    return F.filter(F.sequence(first, last), lambda i: F.get(lines, i).rlike(r"\S"))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value worked out once; a column that only a lambda reads may be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _neighbours(at: Column) -> Column:
    """Every two neighbours of a list of line numbers, as one number: the first of them in the upper half."""
    n = F.greatest(F.size(at) - 1, F.lit(0))
    return F.zip_with(F.slice(at, F.lit(1), n), F.slice(at, F.lit(2), n), lambda a, b: F.shiftleft(a.cast("bigint"), 32) + b)


def _upper(pair: Column) -> Column:
    return F.shiftright(pair, 32).cast("int")


def _lower(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _with_pairs(df: DataFrame) -> DataFrame:
    """Add ``_lines``, ``_at`` (the lines that are not blank), ``_pairs`` of neighbours not among the ``settled`` and their ``chunks``."""
    df = df.withColumn("_lines", F.split("text", "\n", -1))
    df = df.withColumn("_at", _written(F.col("_lines"), F.lit(0), F.size("_lines") - 1))
    df = df.withColumn("_pairs", F.array_except(_neighbours(F.col("_at")), F.coalesce("settled", _none())))
    passages = lambda whole: F.transform("_pairs", lambda p: F.array_join(F.slice(whole, _upper(p) + 1, _lower(p) - _upper(p) + 1), "\n"))
    return df.withColumn("chunks", _once(F.col("_lines"), passages))


def _in_repeated_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """The pairs of neighbouring lines inside chunks that stood before, as ``settled``: ck1, ck2, settled, written once."""
    gone = repeated_chunks(docs, divisor).withColumnsRenamed({k: f"c{k}" for k in ROW})
    cut = _with_cuts(sized_join(docs, gone, [(F.col(k), F.col(f"c{k}")) for k in ROW], "inner"), divisor)
    ats = lambda t: F.transform("removed", lambda c: _written(t["_lines"], F.get(t["_first"], c), F.get(t["_last"], c)))
    cut = cut.withColumn("_ats", _once(F.struct("_lines", "_first", "_last"), ats))
    settled = F.flatten(F.transform("_ats", _neighbours)).alias("settled")
    # Rows repeated in full come here once each, with the same pairs.
    return materialize(cut.select("ck1", "ck2", settled).dropDuplicates(["ck1", "ck2"]), "settled_pairs")


def repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """Chunks of ``keyed`` documents to remove: k1, k2, removed (chunk numbers from 0) and n_chunks, written once."""
    return _repeated(docs, lambda df: _with_chunks(df, divisor))


def _repeated(docs: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    rows = cut(docs).select("doc_id", *ROW, "chunks")
    # The outer form keeps Spark from testing the array's size first, which would compute all of it again and again.
    places = rows.select(*ROW, F.posexplode_outer("chunks").alias("no", "chunk")).filter(F.instr("chunk", "\n") > 0)
    places = materialize(places.select(*ROW, "no", F.xxhash64("chunk").alias("hash")), "chunk_hashes").distinct()
    lists = bundles(places, ["hash"], [*ROW, "no"], n=F.count("*"))
    often = lists.groupBy("hash").agg(F.sum("n").alias("total")).filter("total > 1")
    suspects = lists.join(often, "hash").select("hash", "total", F.inline("rows")).groupBy(*[F.col(k).alias(f"s{k}") for k in ROW])
    suspects = materialize(suspects.agg(F.collect_list(F.struct("no", "total", "hash")).alias("suspects")), "suspects")

    on = [(F.col(k), F.col(f"s{k}")) for k in ROW]
    texts = sized_join(rows, suspects, on, "inner").select(
        "doc_id", *ROW, "chunks", F.explode("suspects").alias("s")
    ).select("doc_id", *ROW, F.size("chunks").alias("n_chunks"), "s.*", F.get("chunks", F.col("s.no")).alias("chunk")).distinct()
    place = ["doc_id", *ROW, "no"]
    copies = bundles(texts, ["hash", "chunk"], [*place, "n_chunks"], size=F.col("total"), n=F.count("*"), first=F.min(F.struct(*place)))
    copies = materialize(copies, "chunk_copies")
    firsts = copies.groupBy("hash", "chunk").agg(F.sum("n").alias("n"), F.min("first").alias("origin")).filter("n > 1")
    again = copies.drop("n", "first").join(firsts.drop("n"), ["hash", "chunk"]).select("origin", F.explode("rows").alias("at"))
    later = F.struct(*[F.col(f"at.{c}") for c in place]) != F.col("origin")
    gone = again.filter(later).select("at.k1", "at.k2", "at.no", "at.n_chunks").groupBy(*ROW)
    return materialize(gone.agg(F.collect_list("no").alias("removed"), F.max("n_chunks").alias("n_chunks")), "removed_chunks")


def drop_repeated_lines(docs: DataFrame, divisor: int = DIVISOR, drop_emptied: bool = False) -> DataFrame:
    """Every input row and column, ``text`` without the repeated chunks, and two counts.

    With ``drop_emptied`` the rows that lose all of their text go.

    Adds ``chunks_removed`` and ``lines_removed``; an input column of such a name is replaced.
    """
    rows = whole_rows(docs).withColumn("text", F.coalesce("row.text", F.lit("")))
    gone = repeated_chunks(keyed(docs), divisor).withColumnsRenamed({k: f"g{k}" for k in ROW})
    joined = sized_join(rows, gone, [(F.col(k), F.col(f"g{k}")) for k in ROW], "left")
    if drop_emptied:
        joined = joined.filter("removed IS NULL OR size(removed) < n_chunks")
    joined = _with_chunks(joined, divisor)
    kept = F.array_join(F.filter("chunks", lambda c, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(kept)
    cut = F.filter("chunks", lambda c, i: F.array_contains("removed", i))
    lines = F.aggregate(cut, F.lit(0), lambda a, c: a + F.size(F.split(c, "\n", -1)))
    none = F.col("removed").isNull()
    # A step of its own, so that input columns named like those used here cannot be meant.
    done = joined.select(
        "row",
        text.alias("_text"),
        F.when(none, 0).otherwise(F.size("removed")).cast("bigint").alias("_chunks"),
        F.when(none, 0).otherwise(lines).cast("bigint").alias("_lines"),
    )
    added = {"chunks_removed": "_chunks", "lines_removed": "_lines"}
    return done.select(
        *[F.col("_text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in added],
        *[F.col(own).alias(name) for name, own in added.items()],
    )


def drop_repeated_passages(docs: DataFrame, drop_emptied: bool = False, divisor: int = DIVISOR) -> DataFrame:
    """Every input row and column, ``text`` without the passages of two lines or more that stand earlier, and ``lines_removed``.

    With ``drop_emptied`` the rows that lose all of their lines but blank ones go. An input column ``lines_removed`` is replaced.
    ``divisor`` says how many lines a chunk has, which decides how much is left to the check by pairs and not what is removed.
    """
    rows = whole_rows(docs).withColumn("text", F.coalesce("row.text", F.lit("")))
    settled = _in_repeated_chunks(keyed(docs), divisor)
    of_chunks = [(F.col(k), F.col(f"c{k}")) for k in ROW]
    gone = _repeated(sized_join(keyed(docs), settled, of_chunks, "left"), _with_pairs).withColumnsRenamed({k: f"g{k}" for k in ROW})
    joined = sized_join(rows, settled, of_chunks, "left")
    joined = _with_pairs(sized_join(joined, gone, [(F.col(k), F.col(f"g{k}")) for k in ROW], "left")).drop("chunks")
    again = F.coalesce(_once(F.col("_pairs"), lambda pairs: F.transform("removed", lambda i: F.get(pairs, i))), _none())
    joined = joined.withColumn("_again", F.concat(again, F.coalesce("settled", _none())))
    if drop_emptied:
        covered = F.array_distinct(F.concat(F.transform("_again", _upper), F.transform("_again", _lower)))
        joined = joined.filter((F.size("_again") == 0) | (F.size(covered) < F.size("_at")))
    cut = F.flatten(F.transform("_again", lambda p: F.sequence(_upper(p), _lower(p))))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), cut)
    joined = joined.withColumn("_left", left)
    kept = _once(F.col("_lines"), lambda whole: F.array_join(F.transform("_left", lambda i: F.get(whole, i)), "\n"))
    none = F.size("_again") == 0
    # A step of its own, so that input columns named like those used here cannot be meant.
    done = joined.select(
        "row",
        F.when(none, F.col("row.text")).otherwise(kept).alias("_text"),
        F.when(none, 0).otherwise(F.size("_lines") - F.size("_left")).cast("bigint").alias("_removed"),
    )
    names = [c for c in docs.columns if c != "lines_removed"]
    return done.select(
        *[F.col("_text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names], F.col("_removed").alias("lines_removed")
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return drop_repeated_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "chunks_removed", "lines_removed")


SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS line, len(ls) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
r AS (SELECT *, (h + 31 * lag(h) OVER d) % 3 = 0 AS divides FROM h WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
e AS (
  SELECT *, i >= 1 AND i <= n - 3 AND coalesce(divides, false) AND NOT coalesce(lag(divides) OVER d, false) AS ends
  FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
c AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM e),
chunks AS (SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n_lines FROM c GROUP BY doc_id, no),
marked AS (SELECT *, n_lines > 1 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) > 1 AS gone FROM chunks)
SELECT d.doc_id, CASE WHEN sum(gone::INT) > 0 THEN coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '') ELSE any_value(d.text) END AS text,
  sum(gone::INT)::BIGINT AS chunks_removed, coalesce(sum(n_lines) FILTER (gone), 0)::BIGINT AS lines_removed
FROM marked m JOIN documents d ON d.doc_id = m.doc_id GROUP BY d.doc_id
"""
