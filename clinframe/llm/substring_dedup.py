"""Exact substring dedup: repeated byte strings found with suffix arrays of shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, cut, mix, small_batches, text_key
from .suffix_array import repeated_starts, suffix_array

SEED = 64
#: Aimed bytes of a shard, and the most that one anchor's distinct strings may have in it.
SHARD_BYTES, GROUP_BYTES = 2_000_000, 4_000_000

RUN = pa.struct([("anchor", pa.int64()), ("start", pa.int64()), ("starts", pa.int64()), ("twice", pa.bool_())])
ANCHORS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("runs", pa.list_(RUN))])
SEGMENTS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int64()), ("starts", pa.int64()),
                      ("anchor", pa.int64()), ("twice", pa.bool_()), ("segment", pa.binary()), ("bytes", pa.binary())])
SPAN = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])

_value = mix(np.arange(256, dtype=np.uint64), 123)


def anchors(b: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, starts, twice) of the runs of string starts that share an anchor.

    The anchor of the ``length``-byte string at a start is the least hash of
    the SEED-byte strings inside it, so equal strings have equal anchors.
    ``twice``: the anchor leaves the string inside its run and is still there,
    without which no two strings of a run are equal.  Long texts go through in overlapping pieces.
    """
    a, parts = np.frombuffer(b, np.uint8), []
    for lo in range(0, max(0, a.size - length + 1), CHUNK):
        parts.append(_least(a[lo:lo + CHUNK + length - 1], length))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    m, leaves = (np.concatenate(p) for p in zip(*parts))
    leaves[-1] = False
    leaves[:-1] &= m[1:] == m[:-1]
    at = np.concatenate(([0], np.flatnonzero(m[1:] != m[:-1]) + 1))
    return m[at].view(np.int64), at, np.diff(np.concatenate((at, [m.size]))), np.logical_or.reduceat(leaves, at)


def _least(a: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per start: the least hash of the SEED-byte strings in its string, and whether the first of them has it."""
    h, k, power = _value[a], 1, 0x9E3779B97F4A7C15
    while k < SEED:  # hash of 2k bytes from two hashes of k bytes
        h = h[:-k] * np.uint64(power) + h[k:]
        power, k = power * power & 0xFFFFFFFFFFFFFFFF, 2 * k
    h = first = mix(h)
    span, k = length - SEED + 1, 1
    while 2 * k <= span:  # least of 2k hashes from two of k
        h, k = np.minimum(h[:-k], h[k:]), 2 * k
    h = np.minimum(h[: h.size - (span - k)], h[span - k:])
    return h, first[: h.size] == h


def _anchors(length: int):
    def run(it):
        for batch in it:
            out = []
            for t in batch.column(2).to_pylist():
                b = (t or "").encode("utf-8", "surrogatepass")
                out.append((len(b), hashlib.sha256(b).hexdigest(), [{"anchor": x, "start": y, "starts": z, "twice": w} for x, y, z, w in
                                                                    zip(*(v.tolist() for v in anchors(b, length)))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)] + [
                pa.array([r[c] for r in out], f.type) for c, f in enumerate(list(ANCHORS)[2:])], schema=ANCHORS)
    return run


def _segments(length: int):
    def run(it):
        for batch in it:
            out, size = [], 0

            def made():
                return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(SEGMENTS)], schema=SEGMENTS)

            for doc, key, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                b = (text or "").encode("utf-8", "surrogatepass")
                for r in runs:
                    part = b[r["start"]:r["start"] + r["starts"] + length - 1]
                    out.append((doc, key, r["start"], r["starts"], r["anchor"], r["twice"], xxhash.xxh3_128_digest(part), part))
                    size += len(part)
                if size > 4_000_000:
                    yield made()
                    out, size = [], 0
            yield made()
    return run


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def _sort_shard(length: int):
    """A shard's distinct segments -> (segment, spans of starts that occur elsewhere in the shard)."""
    def run(table: pa.Table) -> pa.Table:
        ids, parts = table.column("segment").to_pylist(), table.column("bytes").to_pylist()
        symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32) + 2
        sizes = np.array([len(p) for p in parts])
        ends = np.cumsum(sizes + 1)
        t = np.ones(symbols.size + sizes.size + 1, np.int32)  # 1 ends a segment, 0 the shard
        inside = np.ones(t.size, bool)
        inside[ends - 1] = inside[-1] = False
        t[inside] = symbols
        t[-1] = 0
        twice = repeated_starts(t, suffix_array(t, 258), length)
        spans = []
        for size, end in zip(sizes, ends):
            lo, hi = _spans(twice[end - 1 - size:end - length])
            spans.append([{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())])
        return pa.table({"segment": pa.array(ids, pa.binary()), "spans": pa.array(spans, pa.list_(SPAN))})
    return run


def _windows(length: int):
    """(segment, bytes) -> (segment, start, 128-bit hash) of each string; for groups too large for a shard."""
    def run(it):
        for batch in it:
            for seg, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(part) - length + 1
                yield pa.RecordBatch.from_arrays([pa.array([seg] * n, pa.binary()), pa.array(range(n), pa.int64()), pa.array(
                    [xxhash.xxh3_128_digest(part[i:i + length]) for i in range(n)], pa.binary())], names=["segment", "start", "hash"])
    return run


def _cover(length: int):
    """(doc_id, tkey, text, spans of repeated starts) -> removed bytes and the hash of what is left."""
    def run(it):
        for batch in it:
            out = []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                b = (text or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for lo, hi in sorted((s["lo"], s["hi"] + length - 1) for s in spans):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                at, kept = 0, []
                for lo, hi in merged:
                    kept.append(b[at:lo])
                    at = hi
                rest = b"".join([*kept, b[at:]])
                out.append((len(b) - len(rest), hashlib.sha256(rest).hexdigest(), [{"lo": lo, "hi": hi} for lo, hi in merged]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r[0] for r in out], pa.int64()),
                                              pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.list_(SPAN))],
                                             names=["doc_id", "tkey", "n_removed", "kept_sha256", "removed"])
    return run


def repeated_bytes(docs: DataFrame, length: int = 400, shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes covered by ``length``-byte strings that start twice or more anywhere in the texts.

    Columns: doc_id, tkey, n_bytes, n_removed, kept_sha256, removed (maximal
    spans of UTF-8 bytes, lo inclusive, hi exclusive).

    1. Every string start gets an anchor (:func:`anchors`).  Equal strings have
       equal anchors, so only runs whose anchor occurs twice, in two runs or
       inside one, can repeat; their
       bytes are the *segments*.  Anchors are counted map-side.
    2. Equal segments are one; where a segment occurs twice, all its starts
       repeat.  Anchors with several distinct segments are dealt to shards of
       about ``shard_bytes``, and each shard is sorted by induced sorting; the
       permuted common prefixes tell which starts repeat.  Equal strings share
       the anchor and so the shard: results are exact.
    3. An anchor whose distinct segments exceed ``group_bytes`` is not put in
       one shard: its strings are compared by 128-bit hash, counted map-side.
    4. Spans go back to the documents by joins that adaptive execution splits.

    Null texts count as empty.  Repeated rows are further copies: all their
    long enough strings repeat; each row gets its result.  Matches never cross
    rows.  Other columns are ignored.
    """
    assert length >= 2 * SEED
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    runs = cut(src.mapInArrow(_anchors(length), "doc_id long, tkey long, n_bytes long, sha256 string, "
                              "runs array<struct<anchor: long, start: long, starts: long, twice: boolean>>"), "anchors")
    each = runs.select("doc_id", "tkey", F.explode("runs").alias("run"))
    twice = cut(each.groupBy(F.col("run.anchor").alias("anchor"))
                .agg(F.count("*").alias("n"), F.max("run.twice").alias("twice")).filter("n > 1 OR twice").select("anchor"), "twice")
    hits = (each.withColumn("anchor", F.col("run.anchor")).join(twice, "anchor").groupBy("doc_id", "tkey")
            .agg(F.collect_set("run").alias("runs")).select(F.col("doc_id").alias("id2"), F.col("tkey").alias("key2"), "runs"))
    held = cut(src.join(hits, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("tkey") == F.col("key2"))).select("doc_id", "tkey", "text", "runs"), "held")
    parts = cut(held.mapInArrow(_segments(length), "doc_id long, tkey long, start long, starts long, anchor long, twice boolean, segment binary, bytes binary"), "segments")
    counts = cut(parts.groupBy("segment", "anchor").agg(F.count("*").alias("n"), F.first("starts").alias("starts"), F.max("twice").alias("twice")), "counts")
    groups = (counts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("twice").alias("twice"), F.sum(F.col("starts") + (length - 1)).alias("size"))
              .filter("kinds > 1 OR twice").select("anchor", "size"))
    groups = cut(groups, "groups")
    total = groups.filter(F.col("size") <= group_bytes).agg(F.sum("size")).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    distinct = (parts.join(groups, "anchor").groupBy("segment", "anchor", "size").agg(F.first("bytes").alias("bytes")))
    distinct = cut(distinct, "distinct")
    sorted_ = (distinct.filter(F.col("size") <= group_bytes)
               .select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "segment", "bytes")
               .groupBy("shard").applyInArrow(_sort_shard(length), "segment binary, spans array<struct<lo: long, hi: long>>"))
    large = distinct.filter(F.col("size") > group_bytes).select("segment", "bytes").mapInArrow(_windows(length), "segment binary, start long, hash binary")
    again = large.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    hashed = (large.join(again, "hash").groupBy("segment")
              .agg(F.collect_list(F.struct(F.col("start").alias("lo"), (F.col("start") + 1).alias("hi"))).alias("spans")))
    spans = cut(sorted_.unionAll(hashed), "spans")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("starts").alias("hi")))
    found = (counts.join(spans, "segment", "left")
             .select("segment", F.when(F.col("n") > 1, whole).otherwise(F.col("spans")).alias("spans")).filter("size(spans) > 0"))
    back = (parts.select("doc_id", "tkey", "start", "segment").join(cut(found, "found"), "segment")
            .select("doc_id", "tkey", F.explode(F.transform("spans", lambda s: F.struct(
                (s["lo"] + F.col("start")).alias("lo"), (s["hi"] + F.col("start")).alias("hi")))).alias("span"))
            .groupBy("doc_id", "tkey").agg(F.collect_set("span").alias("spans")).select(F.col("doc_id").alias("id2"), F.col("tkey").alias("key2"), "spans"))
    done = (held.select("doc_id", "tkey", "text").join(back, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("tkey") == F.col("key2")))
            .select("doc_id", "tkey", "text", "spans")
            .mapInArrow(_cover(length), "doc_id long, tkey long, n_removed long, kept_sha256 string, removed array<struct<lo: long, hi: long>>"))
    done = (done.groupBy("doc_id", "tkey").agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept_sha256"), F.first("removed").alias("removed"))
            .withColumnsRenamed({"doc_id": "id2", "tkey": "key2"}))
    return (runs.drop("runs").join(cut(done, "covered"), F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("tkey") == F.col("key2")), "left")
            .select("doc_id", "tkey", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
                    F.coalesce("removed", F.array().cast("array<struct<lo: long, hi: long>>")).alias("removed")))
