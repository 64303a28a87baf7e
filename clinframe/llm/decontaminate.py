"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams, hasher, mix, small_batches

#: A benchmark is searched in blocks of at most so many characters of items, each sent to the tasks.
BLOCK_CHARS = 32_000_000
BITS = 20
PAIRS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_matched", pa.int64()),
                   ("n_item", pa.int64()), ("n_tiles", pa.int64()), ("coverage", pa.float64())])


# Scripts written without spaces (Thai to Lao, Burmese, Khmer, kana, Han) and the marks used with them (fixed values).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKS = re.compile("[\u3000-\u303f\uff00-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def _folded(text: str) -> str:
    text = text.casefold()
    return text if text.isascii() else _MARKS.sub(" ", _UNSPACED.sub(r" \g<0> ", text))


def _words(texts: list) -> list[np.ndarray]:
    """Word hashes: case folded, punctuation separates; letters of unspaced scripts are words of their own."""
    return hasher(folded=True).many([None if t is None else _folded(t) for t in texts])


def _rolling(x: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``s`` tokens, from prefix sums."""
    n = x.size - s + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, inv = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
    power, back = np.full(x.size, base, np.uint64), np.full(x.size, inv, np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * power)))
    return mix((total[s:] - total[:n]) * back[:n])


def tiles(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: non-overlapping common runs (item position, text position, length).

    The longest common run of unmarked tokens is marked first, earliest item
    then text position among equals, down to ``shortest`` tokens.  Runs are
    found by Karp-Rabin hashes at a search length that starts long and halves;
    a run much longer than the search length raises it again.
    """
    free_i, free_t, out = np.ones(item.size, bool), np.ones(text.size, bool), []
    s = max(shortest, min(item.size, text.size, 64))
    while True:
        found, longest = [], s
        n_i, n_t = item.size - s + 1, text.size - s + 1
        if n_i > 0 and n_t > 0:
            def whole(free, n):
                c = np.concatenate(([0], np.cumsum(free)))
                return c[s:] - c[:n] == s
            pi, pt = np.flatnonzero(whole(free_i, n_i)), np.flatnonzero(whole(free_t, n_t))
            hi, ht = _rolling(item, s)[pi], _rolling(text, s)[pt]
            order = np.argsort(ht, kind="stable")
            lo, up = np.searchsorted(ht[order], hi, "left"), np.searchsorted(ht[order], hi, "right")
            for i, a, b in zip(pi.tolist(), lo, up):
                for j in pt[order[a:b]].tolist():
                    if i and j and free_i[i - 1] and free_t[j - 1] and item[i - 1] == text[j - 1]:
                        continue  # part of the run that starts one token earlier
                    k = s
                    while i + k < item.size and j + k < text.size and free_i[i + k] and free_t[j + k] and item[i + k] == text[j + k]:
                        k += 1
                    found.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * s:
            s = longest
            continue
        again = False
        for k, i, j in sorted(found):
            k = -k
            if free_i[i:i + k].all() and free_t[j:j + k].all():
                free_i[i:i + k] = free_t[j:j + k] = False
                out.append((i, j, k))
            else:  # a part of it may still be free and longer than what follows: look again
                again = True
                break
        if again:
            continue
        if s == shortest:
            return out
        s = max(shortest, s // 2)


class _Block:
    """Items of a benchmark with the seeds (runs of ``seed`` words) that find them."""

    def __init__(self, ids: list, texts: list, seed: int, percent: int):
        self.seed, self.percent = seed, percent
        self.ids, self.items = ids, _words(texts)
        found = [(grams(w, seed), i) for i, w in enumerate(self.items) if w.size >= seed]
        key = np.concatenate([g for g, _ in found]) if found else np.zeros(0, np.uint64)
        owner = np.concatenate([np.full(g.size, i) for g, i in found]) if found else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(g.size) for g, _ in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.place = key[order], owner[order].astype(np.int32), place[order].astype(np.int32)
        # an item shorter than a seed has one seed, itself
        self.short = {}
        for n in sorted({w.size for w in self.items if 0 < w.size < seed}):
            mine = np.array([i for i, w in enumerate(self.items) if w.size == n])
            whole = np.array([grams(self.items[i], n)[0] for i in mine], np.uint64)
            order = np.argsort(whole, kind="stable")
            self.short[n] = whole[order], mine[order]
        self.filter = np.zeros(1 << BITS, bool)
        self.filter[(key >> np.uint64(64 - BITS)).astype(np.int64)] = True

    @classmethod
    def sent(cls, state: dict) -> "_Block":
        """A block from its broadcast fields (plain arrays and lists)."""
        block = cls.__new__(cls)
        vars(block).update(state)
        return block

    def search(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item index, matched tokens, tiles) of the items that the text covers enough of."""
        return self._short(words) + self._seeded(words)

    def _short(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        out = []
        for n, (whole, owner) in self.short.items():
            held = np.unique(grams(words, n))
            lo, hi = np.searchsorted(whole, held, "left"), np.searchsorted(whole, held, "right")
            out += [(int(i), n, 1) for a, b in zip(lo[hi > lo], hi[hi > lo]) for i in owner[a:b]]
        return out

    def _seeded(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        g = grams(words, self.seed)
        at = np.flatnonzero(self.filter[(g >> np.uint64(64 - BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(self.key, g[at], "left"), np.searchsorted(self.key, g[at], "right")
        n = hi - lo
        if not n.sum():
            return []
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        where = np.repeat(at, n)
        entry = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        owner, place, out = self.owner[entry], self.place[entry], []
        for item in np.unique(owner):
            mine = owner == item
            size = self.items[item].size
            if 100 * _covered(place[mine], self.seed).size < self.percent * size:
                continue  # no tiling can cover more than its seeds do
            spots = _covered(where[mine], self.seed)
            gaps = np.flatnonzero(np.diff(spots) > 1) + 1  # a token that equals no other keeps runs apart
            text = np.insert(words[spots], gaps, np.arange(1, gaps.size + 1, dtype=np.uint64))
            found = tiles(self.items[item], text, self.seed)
            matched = sum(k for _, _, k in found)
            if 100 * matched >= self.percent * size:
                out.append((int(item), matched, len(found)))
        return out


def _covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct positions within ``length`` of the starts."""
    return np.unique((np.unique(starts)[:, None] + np.arange(length)).ravel())


def _blocks(benchmark: DataFrame, seed: int, percent: int) -> list[_Block]:
    """The benchmark's items on the driver, block by block: each bounded by BLOCK_CHARS and one item."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(chars // BLOCK_CHARS) + 1
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").toPandas()
        yield _Block(part["item_id"].astype(object).where(part["item_id"].notna(), None).tolist(), part["text"].tolist(), seed, percent)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, seed: int = 5, percent: int = 60,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id) pairs whose document covers at least ``percent`` % of the item's words.

    Words are case folded, punctuation separates them.  Shared runs of ``seed``
    words select the pairs and bound their coverage; greedy string tiling of
    what the seeds cover then gives ``n_matched`` (words in tiles of at least
    ``seed`` words), ``n_tiles`` and ``coverage``.  Reordered passages count in
    full, since tiles may come in any order.  Documents stream past the
    benchmark's blocks (BLOCK_CHARS each), so nothing is shuffled and a common
    passage is no hot key.

    An item shorter than ``seed`` words matches where it occurs whole.  Letters
    of scripts without spaces are words of their own.  Null or empty texts and
    items match nothing; repeated rows of either table each give their own
    pair; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, seed, percent):
        sent = docs.sparkSession.sparkContext.broadcast(vars(block))

        def run(it, sent=sent):
            b = _Block.sent(sent.value)
            for batch in it:
                rows = []
                for doc, w in zip(batch.column(0).to_pylist(), _words(batch.column(1).to_pylist())):
                    rows += [(doc, b.ids[i], m, b.items[i].size, t, m / b.items[i].size) for i, m, t in b.search(w)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(PAIRS)], schema=PAIRS)

        found = src.mapInArrow(run, "doc_id long, item_id long, n_matched long, n_item long, n_tiles long, coverage double")
        out = found if out is None else out.unionAll(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = 5, percent: int = 60,
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`contaminated_pairs` names; all columns pass through, nothing is shuffled.

    Null and empty texts hold no item and stay; equal rows stay or go together;
    an empty benchmark leaves all rows.
    """
    small_batches(docs.sparkSession)
    at, out = docs.columns.index(text_col), docs
    for block in _blocks(benchmark, seed, percent):
        sent = docs.sparkSession.sparkContext.broadcast(vars(block))

        def run(it, sent=sent):
            b = _Block.sent(sent.value)
            for batch in it:
                clean = [not b.search(w) for w in _words(batch.column(at).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
