"""Quality votes, Merkle manifest and whitening against brute force, SQL and hand-made cases."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinframe.llm import merkle, quality_votes, whitening
from clinframe.llm.queries import QUERIES
from conftest import SMOKE_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = {"id": 1, "key": "x", "node": 2, "tkey": 3, "score": 4, "x": 5, "size": 6, "root": "y", "good": 7, "pos": 8}


def clash(df):
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items() if c not in df.columns})


# --------------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def reference(rows):
    """Whitening of integer vectors with exact sums and a full eigendecomposition."""
    x = [[int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(d)]
    deviation = [sum((n * r[i] - total[i]) ** 2 for i in range(d)) for r in x]
    b = np.array(x, float) - np.array([t / n for t in total])
    e, v = np.linalg.eigh(b.T @ b / n)
    order = np.argsort(-e)
    return deviation, b, e[order], v[:, order]


def check_whitening(out, rows, k):
    deviation, b, e, v = reference(rows)
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(i for i, _ in rows)
    for (i, _), dev, row in zip(rows, deviation, b):
        assert sorted(got[i]) == list(range(1, k + 1))
        for c, r in got[i].items():
            assert int(r.deviation) == dev and r.n == len(rows)
            assert abs(r.explained - e[c - 1] / e.sum()) <= 1e-9 * max(1, r.explained)
            assert r.identity_error < 1e-8
    for c in range(1, k + 1):
        mine = np.array([got[i][c].whitened for i, _ in rows])
        theirs = b @ v[:, c - 1] / np.sqrt(e[c - 1])
        if min(abs(e[c - 1] - e[j]) for j in range(len(e)) if j != c - 1) > 1e-6 * e[0]:
            assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8


def test_whitening_equals_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(0, np.arange(1, 13) / 7)]) for i in range(230)]
    bad = [(900, None), (901, [None] + [0.1] * 11), (902, [float("nan")] + [0.1] * 11), (903, [float("inf")] * 12),
           (904, [0.5] * 3), (905, [])]
    df = clash(spark.createDataFrame([(i, v, 0) for i, v in rows + bad], VECTORS).repartition(5))
    check_whitening(whitening.whiten(df), rows, 8)


def test_whitening_of_copies_repeated_rows_and_missing_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(20)] + [(100 + i, [1.0, 2.0, -1.0]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    check_whitening(whitening.whiten(df), rows, 3)
    twice = whitening.whiten(df.unionAll(df).unionAll(spark.createDataFrame([(None, [0.0, 0.0, 0.0], 1)], VECTORS)))
    assert twice.count() == 3 * 121 and twice.filter("vec_id is null").count() == 3


def test_whitening_finds_equal_eigenvalues_and_survives_low_rank(spark):
    corners = [(2 * i + s, [float((1 - 2 * s) * (3 if i < 4 else 1) * (i == j)) for j in range(10)]) for i in range(10) for s in range(2)]
    out = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in corners], VECTORS))
    shares = sorted({(r.component, round(r.explained, 9)) for r in out.collect()})
    assert [s for _, s in shares] == [round(9 / 42, 9)] * 4 + [round(1 / 42, 9)] * 4
    assert out.first().identity_error < 1e-9
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)], VECTORS)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert abs(got[0, 1].explained - 1) < 1e-9 and all(got[i, c].whitened == 0 for i in range(9) for c in (2, 3))
    single = whitening.whiten(spark.createDataFrame([(7, [1.0, 2.0], 0)], VECTORS)).collect()
    assert [(r.vec_id, r.component, r.whitened, int(r.deviation)) for r in single] == [(7, 1, 0.0, 0), (7, 2, 0.0, 0)]


def test_whitening_of_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)).count() == 0


def test_whitening_stops_early_on_request():
    rng = np.random.default_rng(5)
    b = rng.normal(size=(400, 40)) * np.concatenate([[30, 20, 12], np.full(37, 0.5)])
    passes = []

    def product(q, w):
        passes.append(1)
        u = b @ q
        return b.T @ u, (b @ w).T @ u, u @ u
    values, axes = whitening.bidiagonalise(product, 40, 3, steps=40)
    want = np.linalg.svd(b)
    assert len(passes) < 40 and np.allclose(values, want[1][:3], rtol=1e-12)
    assert np.allclose(np.abs((axes.T @ want[2][:3].T).diagonal()), 1, atol=1e-12)


def test_squares_are_exact_at_any_size():
    d = np.array([[2 ** 40 + 1, -(2 ** 45) - 3, 7], [0, 1, -2]], np.int64)
    assert [int(v.as_py()) for v in whitening._exact_squares(d)] == [sum(int(c) ** 2 for c in r) for r in d]


# --------------------------------------------------------------------- Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """(root, sibling lists of every node) by whole levels."""
    paths = [[] for _ in nodes]
    level, holds = list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        for j, leaves in enumerate(holds):
            run = range(j // 16 * 16, min(j // 16 * 16 + 16, len(level)))
            for leaf in leaves:
                paths[leaf].append(("".join(level[i] for i in run if i < j), "".join(level[i] for i in run if i > j)))
        level = [H(*level[i:i + 16]) for i in range(0, len(level), 16)]
        holds = [sum(holds[i:i + 16], []) for i in range(0, len(holds), 16)]
    return level[0], paths


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 31, 33, 255, 256])
def test_appender_equals_whole_levels(n):
    nodes = [H(str(i)) for i in range(n)]
    tree = merkle.Appender()
    for node in nodes:
        tree.append(node)
    root, paths = climb(nodes)
    assert tree.close() == root
    assert [[(w["before"], w["after"]) for w in p] for p in tree.witness] == paths


def documents(spark):
    rows = [(i, f"Text {i} Äß", "en", "hot", i) for i in range(4400)]  # three layers of blocks of 256
    rows += [(5000 + i, None if i % 3 == 0 else "", None, None, None) for i in range(18)]
    rows += [(6000 + i, "LOUD" * 9, "de", f"s{i}", 36) for i in range(20)] + [(6000, "LOUD" * 9, "de", "s0", 36)] * 2
    rows += [(None, "no id", "en", "s1", 5), (None, None, None, None, None)]
    return rows, spark.createDataFrame(rows, DOCS).repartition(6)


def leaf(row, text):
    i, _, lang, source, n = row
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def test_manifest_equals_whole_levels(spark):
    rows, df = documents(spark)
    groups = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        text = r[1].translate({c: c + 32 for c in range(65, 91)}) if hit and r[1] else r[1]
        groups.setdefault(r[3], []).append((r[0], leaf(r, r[1]), leaf(r, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    trees = [climb([t[1] for t in groups[s]]) for s in names]
    root, tops = climb([t[0] for t in trees])
    want = []
    for s, (subroot, paths), top in zip(names, trees, tops):
        for (i, node, changed), path in zip(groups[s], paths):
            back = changed
            for before, after in path + top:
                back = H(before, back, after)
            want.append((i, node, subroot, root, H(*(b + a for b, a in path + top)), back, back == root))
    got = [tuple(r) for r in merkle.verified_manifest(clash(df)).collect()]
    order = lambda t: (t[0] is not None, t[0] or 0, t[1], t[4])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert any(not g[6] for g in got) and any(g[6] for g in got)


def test_manifest_of_few_rows(spark):
    one = merkle.verified_manifest(spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == H("")
    assert merkle.verified_manifest(spark.createDataFrame([], DOCS)).count() == 0


# --------------------------------------------------------------------- quality votes

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, good, bad, extra=()):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*good, *bad])]
    marks = [(i, int(i < len(good)), 0) for i in range(len(rows))]
    return spark.createDataFrame([*rows, *extra], DOCS), spark.createDataFrame(marks, LABELS)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), int(k))) for k in rng.integers(2, 9, n)).capitalize() + "."


def shouting(seed, n):
    return prose(seed, n).upper().replace(" ", "!! $")


def test_quality_on_held_out_documents(spark):
    sf = SMOKE_DIR.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_votes.classify(docs, labels)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good = [p for p, q in held if q == 1]
    bad = [p for p, q in held if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_quality_ignores_labels_of_held_out_documents(spark):
    docs, labels = labelled(spark, [prose(i, 60) for i in range(40)], [shouting(i, 60) for i in range(40)])
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    turned = labels.withColumn("quality", F.when(rest == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    same = [sorted((r.doc_id, r.score) for r in quality_votes.classify(docs, t).collect()) for t in (labels, turned)]
    assert same[0] == same[1]


def test_votes_equal_brute_force(spark):
    good, bad = [prose(i, 60) for i in range(30)], [shouting(i, 60) for i in range(25)]
    docs, labels = labelled(spark, good, bad)
    model = quality_votes.fit(docs, labels)
    assert model.good.size == 55
    texts = [prose(99, 40), shouting(98, 30), prose(97, 20) + shouting(96, 20)]
    z = model.latent(texts)
    for text, v, score in zip(texts, z, model.score(texts)):
        sims = sorted(((float(v @ w), g) for w, g in zip(model.vectors, model.good)), reverse=True)[:15]
        weight = [max(s, 0) ** 4 for s, _ in sims]
        assert abs(score - sum(w * g for w, (_, g) in zip(weight, sims)) / sum(weight)) < 1e-8, text


def test_copies_displace_no_labelled_text(spark):
    good, bad = [prose(i, 60) for i in range(12)], [shouting(i, 60) for i in range(10)]
    docs, labels = labelled(spark, good, bad)
    copies = spark.range(1000, 1300).select(F.col("id").alias("doc_id"), F.lit(bad[0]).alias("text"), F.lit("en").alias("lang"),
                                            F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    marks = copies.select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    model = quality_votes.fit(docs.unionAll(copies), labels.unionAll(marks), max_per_label=20)
    assert model.good.size == 22
    assert model.score([prose(77, 50)])[0] > 0.5


def test_quality_of_odd_rows(spark):
    long = " ".join([prose(5, 2000)] * 40)
    extra = [(500, None, "en", "s", None), (501, "", None, None, 0), (502, " \n\t", "en", "s", 3), (503, "word " * 50_000, "en", "s", 1),
             (504, long, "en", "s", 1), (None, "no id", "en", "s", 5), (505, "퟿漢字かな", "zh", "s", 4)]
    docs, labels = labelled(spark, [prose(i, 60) for i in range(20)], [shouting(i, 60) for i in range(20)], extra)
    odd = labels.unionAll(spark.createDataFrame([(None, 1, 0), (1, None, 0), (9_999, 1, 1), (2, 7, 0), (3, 1, 0)], LABELS))
    docs = clash(docs.unionAll(docs.filter("doc_id < 3")))
    out = quality_votes.classify(docs, clash(odd)).collect()
    assert len(out) == 50 and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert len({(r.doc_id, r.score) for r in out}) == 47
    none = quality_votes.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_votes.classify(docs.limit(0), labels).count() == 0


def test_features_of_long_texts_are_those_of_the_whole(monkeypatch):
    text = prose(1, 3000) + shouting(2, 500)
    whole = quality_votes.features([text])
    monkeypatch.setattr(quality_votes, "PIECE", 100)
    assert (quality_votes.features([text]) == whole).all()


@pytest.mark.parametrize("name", ["op11_neighbour_votes", "op12_merkle_witnesses", "op13_lanczos_whitening"])
def test_new_queries_return_their_contract(spark, name):
    out = QUERIES[name](spark, SMOKE_DIR)
    want = {"op11_neighbour_votes": "doc_id bigint, held_out boolean, score double, predicted int",
            "op12_merkle_witnesses": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
            "op13_lanczos_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"}[name]
    assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == want and out.count() > 0
