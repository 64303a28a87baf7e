"""Language identification by interpolated Kneser-Ney character models in sorted arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, small_batches, text_key

ORDER = 4
PIECE = 1 << 20
#: Bytes of model tables that a task keeps.
CACHE_BYTES = 256 << 20
SPACE = 32


class Alphabet:
    """Texts as 16-bit codes: letters in lower case, everything else one space."""

    def __init__(self):
        table = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        self.table = np.where(table > 0xFFFE, 0x8000 + table % 0x7FFF, table).astype(np.uint16)

    def codes(self, text: str) -> np.ndarray:
        """Codes of a text with runs of spaces collapsed, a space before and after."""
        a = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        a = np.concatenate(([SPACE], a, [SPACE])).astype(np.uint16)
        keep = np.ones(a.size, bool)
        keep[1:] = (a[1:] != SPACE) | (a[:-1] != SPACE)
        return a[keep]


_alphabet: list = []


def alphabet() -> Alphabet:
    if not _alphabet:
        _alphabet.append(Alphabet())
    return _alphabet[0]


def gram_codes(codes: np.ndarray) -> np.ndarray:
    """Each run of ORDER codes as one 64-bit integer, the latest in the low bits; spaces come before the first."""
    return _runs(np.concatenate((np.full(ORDER - 1, SPACE, np.uint64), codes.astype(np.uint64))))


def _runs(a: np.ndarray) -> np.ndarray:
    out = np.zeros(max(a.size - ORDER + 1, 0), np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | a[i:i + out.size]
    return out


def _pieces(text: str):
    """(codes, grams) of a text in pieces of bounded size, together those of the whole text."""
    table = alphabet().table
    before, last = np.full(ORDER - 1, SPACE, np.uint64), -1
    for lo in range(0, max(len(text), 1), PIECE):
        a = table[np.frombuffer(text[lo:lo + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        a = np.concatenate(([SPACE] * (lo == 0), a, [SPACE] * (lo + PIECE >= len(text)))).astype(np.uint16)
        keep = a != SPACE
        keep[1:] |= a[:-1] != SPACE
        keep[0] |= last != SPACE
        codes = a[keep]
        if codes.size:
            context = np.concatenate((before, codes.astype(np.uint64)))
            yield codes, _runs(context)
            before, last = context[1 - ORDER:], int(codes[-1])


def _count(it):
    """Gram counts per language of a partition, merged as sorted arrays and handed on when large."""
    def rows(lang, keys, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * keys.size, pa.string()), pa.array(keys.view(np.int64)),
                                           pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    held: dict = {}
    for batch in it:
        found: dict = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for codes, grams in _pieces(text):
                found.setdefault(lang, []).append(grams)
        for lang, parts in found.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            if lang in held:
                both = np.concatenate((held[lang][0], keys))
                keys, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, np.concatenate((held[lang][1], n))).astype(np.int64)
            held[lang] = keys, n
            if keys.size > 1_000_000:
                yield rows(lang, *held.pop(lang))
    for lang, (keys, n) in held.items():
        yield rows(lang, keys, n)


class SortedTable:
    """A table sorted by a 64-bit key, in files of the shared folder, that tasks look keys up in.

    Files and row groups hold ascending key ranges, so a lookup of many keys
    reads the row groups that their ranges meet, one at a time, and keeps at
    most CACHE_BYTES of them: the table may be of any size.
    """

    def __init__(self, files: list[tuple[int, int, str]], width: int):
        self.files, self.width, self.held, self.bytes = sorted(files), width, {}, 0

    def _chunks(self, name: str, lo: int, hi: int):
        """(keys, values) of the row groups of a file that may hold keys from ``lo`` to ``hi``."""
        if name not in self.held:
            file = pq.ParquetFile(_opened(name))
            spans = [file.metadata.row_group(g).column(0).statistics for g in range(file.num_row_groups)]
            self.held[name] = file, [(x.min, x.max) for x in spans], {}
        file, spans, groups = self.held[name]
        for g, (least, most) in enumerate(spans):
            if least <= hi and lo <= most:
                if g not in groups:
                    if self.bytes > CACHE_BYTES:
                        for _, _, old in self.held.values():
                            old.clear()
                        self.bytes = 0
                    table = file.read_row_group(g).combine_chunks()
                    values = pa.concat_arrays(table.column(1).chunks).flatten().to_numpy(zero_copy_only=False)
                    groups[g] = table.column(0).to_numpy(), values.astype(np.float32).reshape(-1, self.width)
                    self.bytes += sum(x.nbytes for x in groups[g])
                yield groups[g]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, values) of int64 keys; the values of keys that aren't found are 0."""
        order = np.argsort(keys, kind="stable")
        asked = keys[order]
        hit, values = np.zeros(keys.size, bool), np.zeros((keys.size, self.width), np.float32)
        for low, high, name in self.files:
            lo, hi = np.searchsorted(asked, low, "left"), np.searchsorted(asked, high, "right")
            if lo == hi:
                continue
            for have, rows in self._chunks(name, int(asked[lo]), int(asked[hi - 1])):
                at = np.minimum(np.searchsorted(have, asked[lo:hi]), have.size - 1)
                same = np.flatnonzero(have[at] == asked[lo:hi])
                hit[order[lo + same]] = True
                values[order[lo + same]] = rows[at[same]]
        return hit, values


def _opened(name: str):
    """A file that Spark names, opened by pyarrow (whose name for s3a is s3)."""
    fs, path = pafs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))
    return fs.open_input_file(path)


def _shelved(df: DataFrame, key: str, columns: list, name: str) -> tuple[DataFrame, list]:
    """``columns`` by ``key`` in a sorted table, and the key range of each of its files."""
    table = cut(df.select(F.col(key).alias("key"), F.array(*columns).alias("logs")).orderBy("key"), name)
    ranges = table.groupBy(F.input_file_name().alias("name")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    return table, [(r.lo, r.hi, r.name) for r in ranges.collect()]  # a row per file


class KneserNey:
    """Interpolated Kneser-Ney models of all languages, in sorted tables of the shared folder.

    ``grams[k]`` names the files of the grams of order k+1 seen in any language
    with their log probability in each, ``contexts[k]`` those of their contexts
    with the log back-off weights.  A gram that is in no table takes its context's
    back-off weight and the probability of its shorter form.
    """

    def __init__(self, langs: list[str], grams: list, contexts: list, unseen: float):
        self.langs, self.files, self.unseen, self.tables = langs, (grams, contexts), unseen, None

    def log_probs(self, grams: np.ndarray) -> np.ndarray:
        """(grams, languages) log probabilities of 64-bit grams."""
        if self.tables is None:
            self.tables = [[SortedTable(files, len(self.langs)) for files in orders] for orders in self.files]
        out = np.zeros((grams.size, len(self.langs)), np.float32)
        rest = np.arange(grams.size)
        for k in range(ORDER - 1, -1, -1):
            keys = grams[rest] & np.uint64((1 << 16 * (k + 1)) - 1)
            hit, logs = self.tables[0][k].find(keys.view(np.int64))
            out[rest[hit]] += logs[hit]
            rest, ctx = rest[~hit], keys[~hit] >> np.uint64(16)
            if not rest.size:
                return out
            known, back = self.tables[1][k].find(ctx.view(np.int64))
            out[rest[known]] += back[known]
        out[rest] += np.float32(self.unseen)
        return out

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per character (texts, languages), and characters scored (0: no letter)."""
        total, size, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts)), np.zeros(len(texts))
        held, owner, waiting = [], [], 0

        def flush():
            nonlocal waiting
            if held:
                different, at = np.unique(np.concatenate(held), return_inverse=True)
                logs = self.log_probs(different)[at]
                starts = np.concatenate(([0], np.cumsum([h.size for h in held])[:-1]))
                np.add.at(total, owner, np.add.reduceat(logs, starts, axis=0, dtype=np.float64))
                held.clear()
                owner.clear()
            waiting = 0

        for i, text in enumerate(texts):
            for codes, grams in _pieces(text or ""):
                letters[i] += (codes != SPACE).sum()
                size[i] += codes.size
                held.append(grams)
                owner.append(i)
                waiting += codes.size
                if waiting >= PIECE:
                    flush()
        flush()
        return -total / np.maximum(size, 1)[:, None], np.where(letters > 0, size, 0)


def in_training(doc_id: Column) -> Column:
    """Four of five documents are learned from, by the CRC of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit(docs: DataFrame, discount: float = 0.75, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """A model of the languages of the training documents with the tables it reads; None if there are none.

    All grams of all training texts count; nothing is cut.  Spark counts them
    per language, derives the lower orders (a gram counts the distinct
    characters before it), the contexts' totals and types, and joins each order
    with its contexts and with the probabilities of the order below.  Every
    order is written sorted to the shared folder; the driver sees the
    languages' names and one number.
    """
    src = docs.filter(in_training(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = cut(src.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
                  .mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs = [r.lang for r in counted.select("lang").distinct().orderBy("lang").collect()]  # the values of a label column
    if not langs:
        return None, []
    every = range(len(langs))
    pivot = [F.coalesce(F.sum(F.when(F.col("lang") == F.lit(name), F.col("n"))), F.lit(0)).cast("double").alias(f"c{j}") for j, name in enumerate(langs)]
    counts, tables = [cut(counted.groupBy("gram").agg(*pivot), "counts")], [counted]
    for k in range(ORDER - 1, 0, -1):  # types of the order above, per language
        shorter = F.col("gram").bitwiseAND((1 << 16 * k) - 1).alias("gram")
        counts.insert(0, cut(counts[0].groupBy(shorter).agg(*[F.sum((F.col(f"c{j}") > 0).cast("double")).alias(f"c{j}") for j in every]), "counts"))
    floor = 1.0 / (counts[0].count() + 1.0)
    tables += counts
    grams, contexts, kept, lower = [], [], [], None
    for k in range(ORDER):
        ctx = F.shiftrightunsigned("gram", 16).alias("ctx")
        sums = counts[k].groupBy(ctx).agg(*[F.sum(f"c{j}").alias(f"t{j}") for j in every],
                                          *[F.sum((F.col(f"c{j}") > 0).cast("double")).alias(f"y{j}") for j in every])
        back = sums.select("ctx", *[f"t{j}" for j in every],
                           *[F.when(F.col(f"t{j}") > 0, discount * F.col(f"y{j}") / F.col(f"t{j}")).otherwise(1.0).alias(f"b{j}") for j in every])
        back = cut(back, "contexts")
        rows = counts[k].withColumn("ctx", ctx).join(back, "ctx")
        if lower is not None:
            rows = rows.withColumn("short", F.col("gram").bitwiseAND((1 << 16 * k) - 1)).join(lower, "short")
        below = [F.col(f"p{j}") if lower is not None else F.lit(floor) for j in every]
        probs = cut(rows.select("gram", *[(F.greatest(F.col(f"c{j}") - discount, F.lit(0.0)) / F.greatest(f"t{j}", F.lit(1.0))
                                           + F.col(f"b{j}") * below[j]).alias(f"q{j}") for j in every]), "probs")
        lower = probs.select(F.col("gram").alias("short"), *[F.col(f"q{j}").alias(f"p{j}") for j in every])
        for out, df, key, c in ((grams, probs, "gram", "q"), (contexts, back, "ctx", "b")):
            table, files = _shelved(df, key, [F.log(f"{c}{j}").cast("float") for j in every], f"order{k + 1}")
            out.append(files)
            kept.append(table)
        tables += [back, probs]
    for t in tables:
        drop_cut(t)
    return KneserNey(langs, grams, contexts, float(np.log(floor))), kept


def identify(docs: DataFrame, rejected_share: float = 0.001, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Language of each row: doc_id, held_out, lang_pred, score, entropy, rejected.

    The prediction is the language of least cross-entropy per character;
    ``und`` if the text is null or has no letter, or nothing could be learned.
    ``score`` is the winner's posterior over the languages, with the evidence
    of at most 50 characters.  The models are tables in the shared folder, which
    the tasks read (:class:`SortedTable`).  ``rejected`` is calibrated: true when the
    entropy exceeds the quantile that ``rejected_share`` of the training
    documents of that language exceed.  Only text and language of the training
    documents are learned from; predictions see the text alone.  Whole texts
    are read, in bounded pieces.  Repeated rows each get their row; null ids
    are neither held out nor learned from; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model, tables = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = (model.langs, *model.files, model.unseen) if model else None

    def run(it):
        m = KneserNey(*known) if known else None
        for batch in it:
            n = batch.num_rows
            lang, score, best = ["und"] * n, np.zeros(n), np.full(n, np.nan)
            if m is not None and n:
                h, size = m.entropies(batch.column(1).to_pylist())
                win = h.argmin(axis=1)
                weight = np.exp((h.min(axis=1, keepdims=True) - h) * np.minimum(size, 50)[:, None])
                real = size > 0
                score = np.where(real, 1 / weight.sum(axis=1), 0.0)
                best = np.where(real, h.min(axis=1), np.nan)
                lang = [m.langs[w] if ok else "und" for w, ok in zip(win, real)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(best, pa.float64(), from_pandas=True)], names=["doc_id", "lang_pred", "score", "entropy"])

    scored = cut(src.mapInArrow(run, "doc_id long, lang_pred string, score double, entropy double"), "languages")
    for t in tables:
        drop_cut(t)
    limits = (scored.filter(in_training(F.col("doc_id")) & F.col("entropy").isNotNull()).groupBy("lang_pred")
              .agg(F.percentile_approx("entropy", 1 - rejected_share, 10_000).alias("limit")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return (scored.join(F.broadcast(limits), "lang_pred", "left")  # one row per learned language
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy",
                    F.coalesce(F.col("entropy") > F.col("limit"), F.col("lang_pred") == "und").alias("rejected")))
