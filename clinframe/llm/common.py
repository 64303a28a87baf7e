"""Shared helpers of the training-data operators: scratch tables, word hashes, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_scratch: list[str] = []
MASK48 = np.uint64((1 << 48) - 1)


# --------------------------------------------------------------------- scratch tables

def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; one of our own only where it is unset, on a local master (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        if not _own_scratch:
            _own_scratch.append(tempfile.mkdtemp(prefix="llm-scratch-"))
        path = _own_scratch[0]
    return path.rstrip("/")


#: Tables made in open :func:`scratch_tables` blocks, innermost last.
_made: list[list[DataFrame]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that :func:`cut` writes inside the block when it ends, but for ``lasting`` ones."""
    mine: list[DataFrame] = []
    _made.append(mine)
    try:
        yield
    finally:
        _made.remove(mine)
        for table in mine:
            drop_cut(table)


def cut(df: DataFrame, name: str, compression: str = "snappy", lasting: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage (a lost executor costs one stage, not the whole chain),
    keeps a result from being computed once per use, and gives the optimizer
    the real size for its broadcast decision.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    if _made and not lasting:
        _made[-1].append(out)
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete a table written by :func:`cut` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._llm_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python a thousand at a time, so that a batch of long ones fits in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_key(text_col: str = "text"):
    """Hash that, with the id, names a row: two rows equal in both are one document repeated."""
    return F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))


# --------------------------------------------------------------------- hashing

def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser (murmur style) of a uint64 array."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20
WHITE = b" \t\n\v\f\r"


class WordHasher:
    """64-bit hashes of the words of UTF-8 texts, computed on whole byte arrays.

    Plain: words are runs without ASCII white space, A-Z lower-cased on request.
    ``folded``: words are runs of letters, digits and non-ASCII bytes; ASCII and
    general punctuation separates; callers fold case before.
    """

    def __init__(self, folded: bool = False, lower_case: bool = True):
        lower = np.arange(256, dtype=np.uint64)
        if lower_case:
            lower[65:91] += np.uint64(32)
        self.value = mix(lower, 77)
        self.sep = np.zeros(256, bool)
        self.sep[list(WHITE)] = True
        self.folded = folded
        if folded:
            self.sep[:128] = [not chr(i).isalnum() for i in range(128)]
        self.pow = self._powers(BASE, CHUNK + 2)
        self.inv = self._powers(BASE_INV, CHUNK + 2)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _piece(self, a: np.ndarray) -> np.ndarray:
        """Hashes of the words of one byte array of at most CHUNK bytes that no word crosses."""
        sep = self.sep[a]
        if self.folded:  # U+2000..U+203F: dashes, quotes, bullets
            p = np.flatnonzero((a[:-2] == 0xE2) & (a[1:-1] == 0x80))
            for i in range(3):
                sep[p + i] = True
        if a.size == 0 or sep.all():
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        total = np.zeros(a.size + 1, np.uint64)
        np.cumsum(self.value[a] * self.pow[: a.size], out=total[1:])
        h = (total[end] - total[start]) * self.inv[start]
        return mix(h + (end - start).astype(np.uint64)), start

    def many(self, texts: list) -> list[np.ndarray]:
        """One uint64 array of word hashes for each text (None counts as empty)."""
        out: list = [None] * len(texts)
        group: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            nonlocal size
            if group:
                joined = np.frombuffer(b" ".join(b for _, b in group), np.uint8)
                h, start = self._piece(joined)
                ends = np.cumsum([len(b) + 1 for _, b in group])
                cut_at = np.searchsorted(start, ends)
                lo = 0
                for (i, _), hi in zip(group, cut_at):
                    out[i] = h[lo:hi]
                    lo = hi
                group.clear()
            size = 0

        for i, t in enumerate(texts):
            b = (t or "").encode("utf-8", "surrogatepass")
            if len(b) > CHUNK // 2:
                out[i] = self._long(b)
                continue
            if size + len(b) + 1 > CHUNK:
                flush()
            group.append((i, b))
            size += len(b) + 1
        flush()
        return out

    def _long(self, b: bytes) -> np.ndarray:
        """A text of any length, in pieces cut at separators."""
        a, parts, lo = np.frombuffer(b, np.uint8), [], 0
        while lo < a.size:
            hi = min(lo + CHUNK, a.size)
            if hi < a.size:
                back = np.flatnonzero(self.sep[a[lo:hi]])
                if back.size:
                    hi = lo + int(back[-1]) + 1
                else:  # one word longer than a piece: hash its run on its own
                    more = np.flatnonzero(self.sep[a[hi:]])
                    end = hi + int(more[0]) if more.size else a.size
                    word = self.value[a[lo:end]]
                    acc = np.uint64(0)
                    for k in range(0, word.size, CHUNK):
                        w = word[k:k + CHUNK]
                        acc = mix(np.add.reduce(w * self.pow[: w.size], keepdims=True) + acc)[0]
                    parts.append(np.array([acc], np.uint64))
                    lo = end
                    continue
            parts.append(self._piece(a[lo:hi])[0])
            lo = hi
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


_hashers: dict = {}


def hasher(folded: bool = False, lower_case: bool = True) -> WordHasher:
    """A hasher, made once per task."""
    key = (folded, lower_case)
    if key not in _hashers:
        _hashers[key] = WordHasher(folded, lower_case)
    return _hashers[key]


def shingles(words: np.ndarray, k: int, whole_if_short: bool = True) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter sequence is one shingle."""
    n = words.size
    if n == 0 or (n < k and not whole_if_short):
        return np.zeros(0, np.uint64)
    return np.unique(grams(words, min(n, k)))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in text order."""
    n = words.size - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[i:i + n])
    return h


# --------------------------------------------------------------------- components

def components(edges: DataFrame, a: str = "a", b: str = "b", edges_per_task: int = 200_000) -> DataFrame:
    """Connected components of ``edges``: (node, comp), comp the smallest node.

    Union-find on Spark.  Edges are dealt to tasks of about ``edges_per_task``;
    each task unites its own (path-halving union-find) and emits one edge per
    node to its root.  With one task that is the result; otherwise the forests
    are contracted with alternating large-star and small-star steps until
    nothing changes.  Each step aggregates a minimum map-side, so a node with
    very many edges costs no more than its partial minima.
    """
    e = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")), "edges")
    tasks = e.count() // edges_per_task + 1
    forest = cut(e.repartition(int(tasks)).mapInArrow(_local_union, edges_schema(edges, a)), "forest")
    drop_cut(e)
    e = forest
    if tasks == 1:
        roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
        return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(roots)
    while True:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        big = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = cut(big.filter("u <> v"), "star")
        # small star: every edge points from the larger to the smaller node
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        small = cut(small, "star")
        drop_cut(big)
        # done when every node has one edge and no target has an edge of its own
        multi = small.groupBy("u").count().filter("count > 1").select("u")
        chain = small.join(small.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u")
        done = not multi.unionAll(chain).take(1)
        drop_cut(e)
        e = small
        if done:
            roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(roots)


def edges_schema(edges: DataFrame, a: str):
    kind = dict(edges.dtypes)[a]
    return f"u {kind}, v {kind}"


def _local_union(it):
    """Unite a task's edges and emit (node, root) pairs, root the smallest node."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    schema = None
    for batch in it:
        schema = batch.schema
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    if schema is not None:
        pairs = [(x, find(x)) for x in list(parent) if find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], schema[i].type) for i in (0, 1)], names=["u", "v"])
