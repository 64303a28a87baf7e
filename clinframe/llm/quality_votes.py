"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hasher, text_key

#: Hashed features: three-character shapes, then word and length features.
SHAPES, EXTRA = 1024, 32
FEATURES = SHAPES + EXTRA
#: A word feature counts as much as this many characters.
WORD_WEIGHT = 4
PIECE = 1 << 20
#: Documents of a block of cosine products.
BLOCK = 512


def _classes() -> np.ndarray:
    """Byte -> class: small, capital, digit, line end, other blank, non-ASCII, control, and every ASCII mark its own."""
    out = np.full(256, 7, np.uint64)
    out[97:123], out[65:91], out[48:58], out[128:] = 1, 2, 3, 6
    out[[9, 11, 12, 13, 32]] = 5
    out[10] = 4
    marks = [i for i in range(33, 127) if not chr(i).isalnum()]
    out[marks] = np.arange(8, 8 + len(marks), dtype=np.uint64)
    return out


def features(texts: list) -> np.ndarray:
    """Feature counts of whole texts, (len(texts), FEATURES): shapes of three
    characters (hashed), words that repeat the word before or one of the last
    eight, words of either kind that don't, and one length class each."""
    classes = _classes()
    out = np.zeros((len(texts), FEATURES))
    for row, text, words in zip(out, texts, hasher(lower_case=False).many(texts)):
        a = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        for lo in range(0, max(a.size - 2, 0), PIECE):  # two characters of the next piece complete the last shapes
            c = classes[a[lo:lo + PIECE + 2]]
            code = (c[:-2] << np.uint64(12)) | (c[1:-1] << np.uint64(6)) | c[2:]
            code = code * np.uint64(0x9FB21C651E98DF25)
            row[:SHAPES] += np.bincount((code >> np.uint64(54)).astype(np.int64), minlength=SHAPES)
        if words.size > 1:
            again = words[1:] == words[:-1]
            near = again.copy()
            for d in range(2, 9):
                near[d - 1:] |= words[d:] == words[:-d]
            row[SHAPES] = WORD_WEIGHT * np.count_nonzero(again)
            row[SHAPES + 1] = WORD_WEIGHT * np.count_nonzero(near & ~again)
            row[SHAPES + 2] = WORD_WEIGHT * np.count_nonzero(~near)
        row[SHAPES + 3 + min(int(words.size).bit_length(), EXTRA - 4)] = WORD_WEIGHT
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square-root term frequencies times inverse document frequencies, rows of length one."""
    z = np.sqrt(counts) * idf
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def _frequencies(it):
    """Texts -> (feature, documents that have it), added up over the task; feature -1 counts documents."""
    n, df = 0, np.zeros(FEATURES, np.int64)
    for batch in it:
        texts = batch.column(0).to_pylist()
        for lo in range(0, len(texts), BLOCK):
            df += np.count_nonzero(features(texts[lo:lo + BLOCK]), axis=0)
        n += len(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES)), pa.array(np.concatenate([[n], df]))], names=["feature", "n"])


def _sampled(it):
    for batch in it:
        texts = batch.column(1).to_pylist()
        for lo in range(0, len(texts), BLOCK):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, BLOCK),
                                              pa.array([r.astype(np.float32).tobytes() for r in features(texts[lo:lo + BLOCK])], pa.binary())], names=["good", "counts"])


class Votes:
    """Labelled vectors in the latent space and the vote of the nearest ones."""

    def __init__(self, counts: np.ndarray, good: np.ndarray, idf: np.ndarray, prior: float,
                 rank: int = 32, neighbours: int = 15, power: int = 4):
        self.idf, self.prior, self.neighbours, self.power = idf, prior, neighbours, power
        z = weigh(counts, idf)
        # right singular vectors of the weighted sample, by the eigenvectors of its small Gram matrix
        values, vectors = np.linalg.eigh(z.T @ z)
        self.axes = vectors[:, np.argsort(-values)[:rank]]
        self.vectors, self.good = self._unit(z @ self.axes), good.astype(np.float64)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def latent(self, texts: list) -> np.ndarray:
        return self._unit(weigh(features(texts), self.idf) @ self.axes)

    def score(self, texts: list) -> np.ndarray:
        """Similarity-weighted share of good labels among the nearest labelled vectors."""
        k = min(self.neighbours, self.good.size)
        if not k:
            return np.full(len(texts), self.prior)
        cosine = np.round(self.latent(texts) @ self.vectors.T, 12)  # equal texts tie, whatever block they are in
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, near, 1), 0, None) ** self.power
        total = weight.sum(axis=1)
        vote = (weight * self.good[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.round(np.clip(np.where(total > 1e-12, vote, self.prior), 0, 1), 9)


def fit(docs: DataFrame, labels: DataFrame, *, max_per_label: int = 2048, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", **options) -> Votes:
    """Vote among the labelled rows of ``docs``.

    Document frequencies are counted over all documents.  The labelled vectors
    are at most ``max_per_label`` distinct texts of each label (a text is good
    if at least half of its labels are 1), those of smallest text hash, so that
    no number of copies displaces other texts; a small table has all of them.
    """
    counted = (docs.select(F.col(text_col).alias("text")).mapInArrow(_frequencies, "feature long, n long")
               .groupBy("feature").agg(F.sum("n").alias("n")))  # FEATURES + 1 rows
    df = {r.feature: r.n for r in counted.collect()}
    total = df.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + df.get(i, 0))) + 1 for i in range(FEATURES)])

    marks = (labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("double").alias("good"))
             .filter("lid is not null and good in (0, 1)").groupBy("lid").agg(F.avg("good").alias("good")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tkey"))
    labelled = (rows.join(marks, F.col("id") == F.col("lid")).groupBy("tkey")
                .agg(F.min("id").alias("id"), (F.avg("good") >= 0.5).cast("int").alias("good"), F.count("*").alias("n")))
    labelled = cut(labelled, "labelled")
    shares = {r.good: r.n for r in labelled.groupBy("good").agg(F.sum("n").alias("n")).collect()}
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    chosen = None
    for good in (0, 1):
        part = labelled.filter(F.col("good") == good).orderBy("tkey").limit(max_per_label)
        chosen = part if chosen is None else chosen.unionAll(part)
    chosen = cut(chosen.select(F.col("id").alias("sid"), F.col("tkey").alias("skey"), "good"), "chosen")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    found = (texts.join(F.broadcast(chosen), (F.col("id") == F.col("sid")) & (F.col("tkey") == F.col("skey")))  # at most 2 * max_per_label rows
             .groupBy("id", "tkey").agg(F.first("good").alias("good"), F.first("text").alias("text")))
    sample = found.select("good", "text").mapInArrow(_sampled, "good int, counts binary").toPandas()
    counts = np.frombuffer(b"".join(bytes(c) for c in sample["counts"]), np.float32).reshape(-1, FEATURES).astype(float)
    order = np.lexsort(counts.T[::-1][:8]) if len(sample) else np.zeros(0, np.int64)  # the result doesn't depend on the order of arrival
    return Votes(counts[order], sample["good"].to_numpy()[order], idf, prior, **options)


def vote(docs: DataFrame, model: Votes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``; exact cosine products, block by block."""
    def run(it):
        for batch in it:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo in range(0, len(texts), BLOCK):
                score = model.score(texts[lo:lo + BLOCK])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, BLOCK), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "score", "predicted"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def classify(docs: DataFrame, labels: DataFrame, held_out_rest: int = 1, folds: int = 3, **options) -> DataFrame:
    """Quality of every row of ``docs``: doc_id, held_out, score, predicted.

    Labels of rows whose crc32(doc_id as text) mod ``folds`` is
    ``held_out_rest`` are never read.  A text is its feature counts
    (:func:`features`), weighed by tf-idf, reduced to the leading right
    singular vectors of the labelled sample (latent-semantic vectors) and
    compared with every labelled vector; the nearest vote with their label,
    weighed by a power of the cosine.

    Null, empty and blank texts have a length class only and are scored like
    any other; without labelled rows, or where no labelled vector has a
    positive cosine, the score is the share of good labels (0.5 without any).
    Rows without an id aren't held out and never carry a label; repeated rows
    each get their score; several labels of one document are averaged; label
    rows without id or with another label than 0 and 1 don't count.  Extra
    columns are ignored.
    """
    rest = lambda c: F.crc32(F.col(c).cast("long").cast("string")) % folds
    id_col = options.get("id_col", "doc_id")
    model = fit(docs, labels.filter(rest(id_col) != held_out_rest), **options)
    keep = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    out = vote(docs, model, **keep)
    return out.select("doc_id", F.coalesce(rest("doc_id") == held_out_rest, F.lit(False)).alias("held_out"), "score", "predicted")
