"""Packing tokenised documents into fixed windows: non-negative least squares over length combinations."""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

CACHE = 300_000
TOKENS = pa.schema([("doc_id", pa.int64()), ("bucket", pa.int32()), ("rank", pa.int64()), ("full_before", pa.int64()),
                    ("n_tokens", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


# --------------------------------------------------------------------- tokens

class ByteBpe:
    """Ids of a byte-level BPE ``tokenizers`` file, with a cache of space-separated words.

    The file's vocabulary is read as merge ranks and encoded by tiktoken, which
    gives the same ids several times faster.  The split pattern never joins
    text across a single space or line break between two visible characters, so
    such words are encoded on their own and remembered; any other white space
    sends the whole text through the encoder.  Added tokens of the file are cut
    out first and get their own ids, as ``tokenizers`` does.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that a vocabulary file shows as they are
        byte = {chr(b): b for b in visible}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(visible))}
        ranks = {}
        for token, i in vocab.items():
            if token not in self.added and all(c in byte for c in token):
                ranks[bytes(byte[c] for c in token)] = i
        self.encoder = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = "<u2" if max(*ranks.values(), *self.added.values(), 0) < 1 << 16 else "<u4"
        self.line_break = self._plain("\n")
        self.end = np.zeros(1, self.kind).tobytes()
        self.words: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.encoder.encode_ordinary(text), self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            ids = self._plain(word)
            if len(word) < 64:
                self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of the text and the end id 0, as little-endian integers."""
        text = re.sub("[\ud800-\udfff]", "�", text) if text and not text.isascii() else text
        if not text:
            return self.end
        if self.cut and self.cut.search(text):
            pieces = [np.array([self.added[p]], self.kind).tobytes() if p in self.added else self._segment(p) for p in self.cut.split(text) if p]
            return b"".join(pieces) + self.end
        return self._segment(text) + self.end

    def _segment(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        out, word = [], self._word
        for i, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if "" in parts or len(line.split()) != len(parts):
                return self._plain(text)
            if i:
                out.append(self.line_break)
            out.append(word(parts[0]))
            out += [word(" " + p) for p in parts[1:]]
        return b"".join(out)


def _tokenise(path: str, window: int):
    def run(it):
        bpe, bucket = ByteBpe(path), TaskContext.get().partitionId()
        size, seen, full = np.dtype(bpe.kind).itemsize, np.zeros(window, np.int64), 0
        for batch in it:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            rank, before, n = [], [], [len(x) // size for x in ids]
            for k in n:
                rank.append(int(seen[k % window]))
                before.append(full)
                seen[k % window] += 1
                full += k // window
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bucket] * len(n), pa.int32()), pa.array(rank, pa.int64()),
                                              pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], schema=TOKENS)
    return run


# --------------------------------------------------------------------- plan

def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of the given lengths that fill a window exactly: (n, 3), 0 for no third."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = []
    for a in np.sort(lengths).tolist():
        if 2 * a <= window and have[window - a]:
            out.append(np.array([[a, window - a, 0]]))
        b = np.arange(a, (window - a) // 2 + 1)
        b = b[have[b] & have[window - a - b]] if b.size else b
        if b.size:
            out.append(np.stack([np.full(b.size, a), b, window - a - b], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def nnls(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, column j of A counting the lengths of combination j.

    Accelerated projected gradient; A is never formed (three entries a column).
    """
    n = histogram.size
    used = combos > 0

    def times(x):
        return np.bincount(combos.ravel(), (x[:, None] * used).ravel(), minlength=n)

    def back(r):
        return (r[combos] * used).sum(axis=1)

    probe = np.ones(len(combos))
    for _ in range(20):  # largest eigenvalue of A'A
        probe = back(times(probe))
        top = np.linalg.norm(probe)
        probe /= top
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(times(y) - histogram) / (1.02 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: np.ndarray, window: int, first_sequence: int) -> np.ndarray:
    """Where the remainders go: rows (length, start, piece, rank from, rank to, sequence, offset).

    ``histogram[l]`` remainders have length l; the r-th of them puts its tokens
    from ``start`` on, ``piece`` of them, into ``sequence + r - from`` at
    ``offset``, for each row with from <= r < to.  Combinations get their
    rounded least-squares counts first.  The residuals are packed greedily,
    whole runs of equal lengths at a time: longest first, then the longest that
    still fits, then a cut piece that closes the gap.  The last tokens, fewer
    than a window, form sequences of power-of-two length.
    """
    rows, seq = [], first_sequence
    left = histogram.copy()
    left[0] = 0
    given = np.zeros_like(left)
    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        x = nnls(combos, left.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            lengths = [int(v) for v in combos[j] if v]
            need = {v: lengths.count(v) for v in lengths}
            t = min(int(x[j] + 0.5), *(int(left[v]) // k for v, k in need.items()))
            if t <= 0:
                continue
            offset = 0
            for v in lengths:
                rows.append((v, 0, v, given[v], given[v] + t, seq, offset))
                given[v] += t
                left[v] -= t
                offset += v
            seq += t
    # runs by length: [origin length, start, rank from, rank to]
    runs: dict[int, list] = {int(v): [[int(v), 0, int(given[v]), int(given[v] + left[v])]] for v in np.flatnonzero(left)}
    total = int((left * np.arange(left.size)).sum())
    while total >= window:
        picks, used, gap = [], {}, window

        def take(v, size):
            """A run of length v with a piece that this sequence hasn't taken; size of it goes in."""
            for run in runs[v]:
                if used.get(id(run), 0) < run[3] - run[2]:
                    used[id(run)] = used.get(id(run), 0) + 1
                    picks.append((v, run, size))
                    return True
            return False

        while gap:
            fit = next((v for v in sorted(runs, reverse=True) if v <= gap and take(v, v)), None)
            if fit is None:
                fit, size = next((v for v in sorted(runs) if v > gap and take(v, gap)), None), gap
                assert fit is not None, "tokens are left, so some run is"
                gap -= size
            else:
                gap -= fit
        t = min((run[3] - run[2]) // used[id(run)] for _, run, _ in picks)
        offset, rests = 0, []
        for v, run, size in picks:
            origin, start, lo = run[0], run[1], run[2]
            rows.append((origin, start, size, lo, lo + t, seq, offset))
            run[2] += t
            offset += size
            if size < v:
                rests.append((v - size, [origin, start + size, lo, lo + t]))
        seq += t
        total -= t * window
        for v in {v for v, _, _ in picks}:
            runs[v] = [r for r in runs[v] if r[2] < r[3]]
            if not runs[v]:
                del runs[v]
        for v, run in rests:
            runs.setdefault(v, []).append(run)
    room, offset = (1 << total.bit_length() - 1 if total else 0), 0
    for v in sorted(runs, reverse=True):
        for origin, start, lo, hi in runs[v]:
            for r in range(lo, hi):
                at, rest = start, v
                while rest:
                    size = min(rest, room - offset)
                    rows.append((origin, at, size, r, r + 1, seq, offset))
                    at, rest, offset, total = at + size, rest - size, offset + size, total - size
                    if offset == room:
                        seq, offset, room = seq + 1, 0, (1 << total.bit_length() - 1 if total else 0)
    table = np.array(rows, np.int64).reshape(-1, 7)
    return table[np.lexsort((table[:, 3], table[:, 0]))]


# --------------------------------------------------------------------- operator

def pack(docs: DataFrame, window: int = 1024, tokenizer: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset.  A document's ids are those of its text and
    a final 0; a null or empty text is the final 0 alone.  Repeated rows are
    packed each; null ids stay null; other columns are ignored.

    1. Tokenise once into a scratch table.  Each task numbers, for its own
       partition, the remainders (tokens modulo the window) of equal length.
    2. Whole windows are sequences of their own.  Only the histogram of the
       remainders (window - 1 numbers) reaches the driver, which solves the
       plan; its size depends on the window, not on the rows.
    3. Counts per partition give each remainder its global number among those
       of its length, hence its sequence and offset.  A length shared by a third
       of all rows is spread like any other, as numbers are dealt per partition.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = cut(src.mapInArrow(_tokenise(path, window), "doc_id long, bucket int, rank long, full_before long, n_tokens long, ids binary"),
                 "tokens", compression="zstd")
    shape = tokens.select("bucket", (F.col("n_tokens") % window).cast("int").alias("rest"),
                          F.floor(F.col("n_tokens") / window).cast("long").alias("full"))
    counts = cut(shape.groupBy("bucket", "rest").agg(F.count("*").alias("n"), F.sum("full").alias("full")), "counts")
    histogram = np.zeros(window, np.int64)
    whole = 0
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect():  # window rows at most
        histogram[r["rest"]] += r["n"]
        whole += r["full"]
    sent = spark.sparkContext.broadcast(plan(histogram, window, whole))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_rest = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.select("bucket", "rest", F.coalesce(F.sum("n").over(by_rest), F.lit(0)).alias("base"))
             .groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("rest", "base"))).alias("bases")))
    fulls = (counts.groupBy("bucket").agg(F.sum("full").alias("full"))  # one row per input partition
             .select("bucket", F.coalesce(F.sum("full").over(before), F.lit(0)).alias("full_base")))
    placed = tokens.join(cut(ranks.join(fulls, "bucket"), "bases"), "bucket").select(
        "doc_id", (F.col("rank") + F.coalesce(F.col("bases")[(F.col("n_tokens") % window).cast("int")], F.lit(0))).alias("rank"),
        (F.col("full_before") + F.col("full_base")).alias("full"), "n_tokens", "ids")

    def run(it):
        table = sent.value
        lo = np.searchsorted(table[:, 0], np.arange(window + 1))
        for batch in it:
            out = []
            for doc, rank, full, n, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                for k in range(n // window):
                    out.append((doc, k * window, window, ids[4 * k * window:4 * (k + 1) * window], n, full + k, 0))
                rest, at = n % window, n - n % window
                if rest:
                    mine = table[lo[rest]:lo[rest + 1]]
                    mine = mine[(mine[:, 3] <= rank) & (rank < mine[:, 4])]
                    for _, start, size, first, _, seq, offset in mine[np.argsort(mine[:, 1])].tolist():
                        s = at + start
                        out.append((doc, s, size, ids[4 * s:4 * (s + size)], n, seq + rank - first, offset))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(PIECES)], schema=PIECES)

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
