"""Quality rules: base statistics and cross-document line frequency per host."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, grams, hasher, small_batches, text_key

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
_word = re.compile(r"[^\x20\x09-\x0D]+")
_digit = re.compile(r"[0-9]")

LINE = pa.struct([("hash", pa.int64()), ("words", pa.int64())])
STATS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("host", pa.string()), ("n_words", pa.int64()),
                   ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                   ("n_repeat_words", pa.int64()), ("lines", pa.list_(LINE))])
STATS_DDL = ("doc_id long, tkey long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, lines array<struct<hash: long, words: long>>")


def line_hash(words: list[str]) -> int:
    """Hash of a line by its words: lower case, digits alike, any white space between."""
    return xxhash.xxh3_64_intdigest(_digit.sub("0", " ".join(words).lower()).encode("utf-8", "surrogatepass")) - (1 << 63)


def repeated_words(words: np.ndarray, window: int = 8) -> int:
    """Words inside a window of ``window`` words that occurs at least twice."""
    g = grams(words, window)
    if g.size < 2:
        return 0
    order = np.argsort(g, kind="stable")
    same = np.zeros(g.size + 1, bool)
    same[1:-1] = g[order][1:] == g[order][:-1]
    starts = order[same[1:] | same[:-1]]
    edge = np.zeros(words.size + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1  # starts are distinct
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _stats(it):
    for batch in it:
        ids, tkeys, hosts, texts = (batch.column(i) for i in range(4))
        texts, out = texts.to_pylist(), []
        for text, words in zip(texts, hasher(lower_case=False).many(texts)):
            text = text or ""
            lines, seen, dup = {}, set(), 0
            for raw in text.split("\n"):
                w = _word.findall(raw)
                if w:
                    dup += raw in seen
                    seen.add(raw)
                    h = line_hash(w)
                    lines[h] = lines.get(h, 0) + len(w)
            out.append((words.size, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
                        repeated_words(words), [{"hash": h, "words": n} for h, n in lines.items()]))
        yield pa.RecordBatch.from_arrays(
            [ids, tkeys, hosts] + [pa.array([r[c] for r in out], f.type) for c, f in enumerate(list(STATS)[3:])], schema=STATS)


def line_frequency(docs: DataFrame, min_docs: int = 20, share_pct: int = 5, min_words: int = 20, left_pct: int = 50,
                   id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Statistics and verdict of each row of ``docs``.

    A line (lower case, digits alike, white space collapsed) is *frequent* on
    its host if at least ``min_docs`` and ``share_pct`` % of the host's distinct
    texts hold it.  Exact copies are one text, so that a much-copied clean
    document does not turn its own lines into boilerplate.  A document fails
    when its base statistics fail, or when it is depleted: without its frequent
    lines fewer than ``min_words`` words or ``left_pct`` % of them are left.

    Columns: doc_id, tkey, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_frequent_words, frequent (hashes of its
    frequent lines), kept.  Null texts count as empty (and fail, having no
    words); a null host is a host of its own; repeated rows each get their row
    and count as one text.

    Scale: one pass makes the statistics; lines are counted as (host, line,
    text) and then (host, line), both pre-aggregated map-side, so a line or a
    host that holds a third of all rows is spread; frequent lines go back to
    their documents by a join that adaptive execution may split.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tkey"),
                      F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text"))
    stats = cut(src.mapInArrow(_stats, STATS_DDL), "quality")
    hosts = stats.select("host", "tkey").distinct().groupBy("host").agg(F.count("*").alias("host_texts"))
    lines = stats.select("host", "doc_id", "tkey", F.explode("lines").alias("l")).select(
        "host", "doc_id", "tkey", F.col("l.hash").alias("hash"), F.col("l.words").alias("words"))
    often = (lines.select("host", "hash", "tkey").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
             .filter(F.col("n") >= min_docs).join(hosts, "host")
             .filter(100 * F.col("n") >= share_pct * F.col("host_texts")).select("host", "hash"))
    hits = (lines.join(cut(often, "frequent"), ["host", "hash"])
            .groupBy("host", "doc_id", "tkey").agg(F.collect_set(F.struct("hash", "words")).alias("hit"))
            .select(F.col("host").alias("host2"), F.col("doc_id").alias("id2"), F.col("tkey").alias("key2"), "hit"))
    out = stats.join(hits, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("tkey") == F.col("key2")) & (F.col("host") == F.col("host2")), "left")
    gone = F.coalesce(F.aggregate("hit", F.lit(0).cast("long"), lambda a, h: a + h["words"]), F.lit(0).cast("long"))
    out = out.withColumn("n_frequent_words", gone)
    rest = F.col("n_words") - F.col("n_frequent_words")
    return (out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
            .withColumn("depleted", (rest < min_words) | (100 * rest < left_pct * F.col("n_words")))
            .select("doc_id", "tkey", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "n_frequent_words", F.coalesce(F.transform("hit", lambda h: h["hash"]), F.array().cast("array<long>")).alias("frequent"),
                    (~F.col("base_failed") & ~F.col("depleted")).alias("kept")))


def drop_poor(docs: DataFrame, **options) -> DataFrame:
    """``docs`` that :func:`line_frequency` keeps, without their frequent lines; ``n_chars`` follows the text.

    Null and empty texts are rejected (they have no words); equal rows are kept
    or rejected together and each stays; a row without id is judged like any
    other.  All columns pass through, whatever their names.
    """
    marks = (line_frequency(docs, **options).filter("kept")
             .groupBy(F.col("doc_id").alias("id"), F.col("tkey").alias("key"), "host").agg(F.first("frequent").alias("frequent")))
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc"), text_key().alias("text_hash"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("from"))
    joined = keyed.join(marks, F.col("doc").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("key")) & (F.col("from") == F.col("host")))
    at, names = docs.columns.index("text"), docs.columns
    last = "frequent"
    while last in names:
        last += "_"

    def run(it):
        for batch in it:
            texts = batch.column(at).to_pylist()
            frequent = batch.column(len(names)).to_pylist()
            for i, bad in enumerate(frequent):
                if bad:
                    bad = set(bad)
                    texts[i] = "\n".join(x for x in texts[i].split("\n") if not ((w := _word.findall(x)) and line_hash(w) in bad))
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[at] = pa.array(texts, arrays[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                arrays[k] = pa.array([None if t is None else len(t) for t in texts], arrays[k].type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.select("row.*", F.col("frequent").alias(last)).mapInArrow(run, docs.schema)
