"""Line dedup over overlapping three-line windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_key

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _normal(line: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed; blank lines become empty."""
    return F.trim(F.regexp_replace(F.lower(line), r"[ \t\x0B\f\r]+", " "))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tkey, starts): where later occurrences of repeated windows start, in non-blank lines.

    A window is WINDOW consecutive non-blank lines, compared in normal form by
    a 128-bit hash.  Its first occurrence by (doc_id, text hash, position) stays
    out of ``starts``.  Windows are narrow rows; the first occurrence comes from
    a map-side aggregated minimum, and goes back to the others by a join of two
    plain shuffles that adaptive execution splits where one window is very common.
    """
    ln = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), _lines(F.col(text_col)).alias("lines"))
    ln = ln.select("doc_id", "tkey", F.filter(F.transform("lines", _normal), lambda x: x != "").alias("lines"))
    ln = ln.filter(F.size("lines") >= WINDOW).select(
        "doc_id", "tkey", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))).alias("h"))
    windows = F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.struct(
        i.alias("pos"),
        F.xxhash64(*[F.col("h")[i + k]["a"] for k in range(WINDOW)]).alias("h1"),
        F.xxhash64(*[F.col("h")[i + k]["b"] for k in range(WINDOW)]).alias("h2")))
    occ = cut(ln.select("doc_id", "tkey", F.inline(windows)), "windows")
    first = (occ.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "tkey", "pos")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("h1", "h2", "first"))
    later = (occ.join(cut(first, "repeated"), ["h1", "h2"])
             .filter(~F.struct("doc_id", "tkey", "pos").eqNullSafe(F.col("first"))))
    return later.groupBy("doc_id", "tkey").agg(F.collect_set("pos").alias("starts"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that later occurrences of repeated three-line windows cover.

    Returns the columns of ``docs`` (the text without the removed lines) and a
    struct ``line_dedup`` of n_lines (non-blank), n_removed and n_spans (maximal
    runs of removed non-blank lines); a column of that name is replaced.  The
    merged positions of overlapping windows go; blank lines stay.  A line is
    only removed if an earlier copy of it exists, so the first one always stays.

    Null texts stay null; texts with fewer than three non-blank lines stay as
    they are.  Rows equal in id and text are one document: they are compared
    as one and get the same result.  A null id sorts first.
    """
    marks = repeated_windows(docs, id_col, text_col).select(F.col("doc_id").alias("id"), F.col("tkey").alias("key"), "starts")
    names = [c for c in docs.columns if c != "line_dedup"]
    # the row travels in one struct, so no helper can clash with its columns
    keyed = docs.select(F.struct(*names).alias("row"), F.col(id_col).alias("doc"), text_key(text_col).alias("text_hash"))
    out = keyed.join(marks, F.col("doc").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("key")), "left")
    out = out.select("row", F.col(f"row.`{text_col}`").alias("text"), "starts").select("*", _lines(F.col("text")).alias("lines"))
    full = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), (_normal(x) != "").alias("full"))), lambda s: s["full"])
    out = out.select("row", "text", "starts", "lines", F.transform(full, lambda s: s["i"]).alias("full"))
    spans = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1))))
    out = out.select("row", "text", "lines", "full", F.array_sort(F.array_distinct(spans)).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.transform("gone", lambda o: F.col("full")[o]))
    text = F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")
    starts = F.filter(F.transform("gone", lambda o, i: (i == 0) | (F.col("gone")[i - 1] != o - 1)), lambda new: new)
    count = lambda a: F.when(F.col("gone").isNull(), 0).otherwise(F.size(a)).cast("long")
    marked = F.struct(F.size("full").cast("long").alias("n_lines"), count("gone").alias("n_removed"), count(starts).alias("n_spans"))
    out = out.select("row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(text).alias("left"), marked.alias("counts"))
    return out.select(*[F.col("left").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names], F.col("counts").alias("line_dedup"))
