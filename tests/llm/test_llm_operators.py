"""The training-data operators against SQL, brute force and hand-made cases."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clinframe.llm import common, decontaminate, html_text, language_id, licenses, line_dedup, near_dup, packing, quality
from clinframe.llm import substring_dedup, suffix_array, url_filter
from clinframe.llm.oracle import ORACLE
from clinframe.llm.queries import QUERIES
from conftest import SMOKE_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(30_000))


def docs(spark, texts, ids=None, **extra):
    rows = [(i if ids is None else ids[k], t, "en", "src0", len(t or "")) for k, (i, t) in enumerate(enumerate(texts))]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def smoke(spark):
    return spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")


# --------------------------------------------------------------------- every query

CLASH = {"tkey": 1, "node": 2, "kept": "x", "n_words": 3, "line_dedup": 4, "sequence_id": 5, "verdict": "y", "label": 6, "host": 7}
ODD = ["", " \n\t ", None, "short", "short", "a b c\nd e f\n\ng h i\na b c\nd e f\ng h i", LONG, LONG, "ünï çødé \U0001F600 ✓"]
OPERATORS = {
    "near_duplicates": lambda d: near_dup.near_duplicates(d),
    "drop_near_duplicates": lambda d: near_dup.drop_near_duplicates(d),
    "line_frequency": lambda d: quality.line_frequency(d),
    "drop_poor": lambda d: quality.drop_poor(d),
    "line_dedup": lambda d: line_dedup.line_dedup(d),
    "contaminated_pairs": lambda d: decontaminate.contaminated_pairs(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text").limit(0)),
    "pack": lambda d: packing.pack(d),
    "repeated_bytes": lambda d: substring_dedup.repeated_bytes(d),
    "identify": lambda d: language_id.identify(d),
    "scan": lambda d: licenses.scan(d),
    "extract": lambda d: html_text.extract(d.withColumnRenamed("text", "html")),
    "url_verdicts": lambda d: url_filter.url_verdicts(d.withColumnRenamed("text", "url")),
}
ROW_FOR_ROW = {"near_duplicates", "line_frequency", "line_dedup", "repeated_bytes", "identify", "extract", "url_verdicts", "drop_contaminated"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    rows = docs(spark, ODD, ids=[1, 2, 3, 4, 4, None, 7, 8, 9], **CLASH)
    got = OPERATORS[name](rows).collect()
    if name in ROW_FOR_ROW:
        assert len(got) == len(ODD)
    assert OPERATORS[name](rows.limit(0)).collect() == []


# --------------------------------------------------------------------- against SQL

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SMOKE_DIR).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMOKE_DIR}/documents.parquet'")
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).values.tolist()))
    assert key(got) == key(want)


# --------------------------------------------------------------------- 1 decontamination

def test_tiling_finds_reordered_and_not_shuffled_passages(spark):
    item = prose(1, 40).split()
    halves = prose(2, 30) + " " + " ".join(item[20:]) + ". " + prose(3, 9) + ", " + " ".join(item[:20]).upper()
    shuffled = " ".join(np.random.default_rng(4).permutation(item))
    bench = spark.createDataFrame([(5, " ".join(item)), (6, "too short"), (7, None)], "item_id long, text string")
    rows = docs(spark, [halves, shuffled, prose(5, 200), " ".join(item[:15])])
    got = [(r.doc_id, r.item_id, r.n_matched, r.n_tiles) for r in decontaminate.contaminated_pairs(rows, bench).collect()]
    assert got == [(0, 5, 40, 2)]
    assert {r.doc_id for r in decontaminate.drop_contaminated(rows, bench).collect()} == {1, 2, 3}


def test_tiles_against_plain_greedy_search():
    def plain(a, b, least):
        fa, fb, out = [True] * len(a), [True] * len(b), []
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and fa[i + k] and fb[j + k] and a[i + k] == b[j + k]:
                        k += 1
                    if k > best[0]:
                        best = (k, i, j)
            if best[0] < least:
                return out
            k, i, j = best
            for d in range(k):
                fa[i + d] = fb[j + d] = False
            out.append((i, j, k))
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 3, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
        got, want = decontaminate.tiles(a, b, 2), plain(a.tolist(), b.tolist(), 2)
        assert got == want


def test_blocks_give_the_same_pairs(spark, smoke, monkeypatch):
    bench = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet")
    one = sorted(map(tuple, decontaminate.contaminated_pairs(smoke, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)
    assert sorted(map(tuple, decontaminate.contaminated_pairs(smoke, bench).collect())) == one and one


# --------------------------------------------------------------------- 2 near-dedup

def brute_components(rows, k=4):
    sets = {i: (lambda w: {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())(
        [x.lower() for x in (t or "").split()]) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, smoke):
    want = brute_components([(r.doc_id, r.text) for r in smoke.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(smoke).collect()}
    assert got == want


def test_near_copies_of_one_text_form_one_group(spark):
    base, rng, texts = prose(7, 200).split(), np.random.default_rng(8), []
    for _ in range(60):  # up to four changed words: similar to the base, not always to each other
        w = list(base)
        for p in rng.choice(200, rng.integers(0, 5), replace=False):
            w[p] = "changed" + str(rng.integers(1e9))
        texts.append(" ".join(w))
    rows = docs(spark, [*texts, " ".join(base), prose(9, 200)])
    want = brute_components([(r.doc_id, r.text) for r in rows.collect()])
    marks = near_dup.near_duplicates(rows, quiet_rounds=None).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in marks} == want
    assert sorted(r.doc_id for r in near_dup.drop_near_duplicates(rows).collect()) == sorted({c for _, c in want.values()})


@pytest.mark.parametrize("block", [1024, 7])
def test_a_pair_in_a_large_bucket_of_templates_is_found(spark, monkeypatch, block):
    base, texts = prose(11, 200).split(), []
    for i in range(160):  # templates of similarity 0.6 to 0.8 with different fill-ins
        w = list(base)
        for p in range(0, 200, 24):
            w[p] = f"fill{i}x{p}"
        texts.append(" ".join(w))
    for i in (70, 101, 130):  # one word off
        texts.append(texts[i].replace(base[3], f"other{i}"))
    rows = docs(spark, texts)
    want = brute_components([(r.doc_id, r.text) for r in rows.collect()])
    assert len({c for _, c in want.values()}) == 160
    monkeypatch.setattr(near_dup, "HUBS", 1)  # random hubs of the one bucket hardly ever meet the pairs
    monkeypatch.setattr(near_dup, "BLOCK", block, raising=False)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(rows, bands=1, rows=1).collect()} == want


def test_small_buckets_are_settled_by_one_round(spark, monkeypatch):
    rng, texts = np.random.default_rng(12), []
    for g in range(60):  # 3 to 16 texts: a chain of near pairs, its ends not similar
        w = prose(100 + g, 150).split()
        for i in range(3 + g % 14):
            w = list(w)
            for p in rng.choice(150, 3, replace=False):
                w[p] = f"step{g}x{i}x{p}"
            texts.append(" ".join(w))
    base = prose(13, 200).split()  # 12 templates that no link unites
    texts += [" ".join(f"fill{i}x{p}" if p % 24 == 0 else x for p, x in enumerate(base)) for i in range(12)]
    rows = docs(spark, texts)
    want = brute_components([(r.doc_id, r.text) for r in rows.collect()])
    whole, left = near_dup._whole, []
    monkeypatch.setattr(near_dup, "_whole", lambda pct: left.append(pct) or whole(pct))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(rows).collect()} == want
    assert not left  # nothing was left for the whole comparison


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2 ** 63, 1000).astype(np.uint64)
    sig = near_dup.superminhash([a, a[:800], a[::-1].copy()], 192)
    assert (sig[0] == sig[2]).all() and abs((sig[0] == sig[1]).mean() - 0.8) < 0.12


def test_difference_bound_never_loses_a_pair():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
        b = np.concatenate((a[: rng.integers(200, 300)], rng.integers(0, 2 ** 63, rng.integers(0, 60)).astype(np.uint64)))
        parts = [np.bincount((common.mix(s, 9) >> np.uint64(56)).astype(int), minlength=256) for s in (a, b)]
        both = np.intersect1d(a, b).size
        assert np.abs(parts[0] - parts[1]).sum() <= a.size + b.size - 2 * both


@pytest.mark.parametrize("per_task", [200_000, 20])
def test_components_of_chains_and_stars(spark, per_task):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(300, 200), (250, 200), (300, 7)]
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "a long, b long"), edges_per_task=per_task).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in [*range(1, 50), 200, 250, 300]} == {1}


def test_word_hashes_of_long_and_odd_texts():
    h = common.hasher()
    words = "Alpha beta\tGAMMA\x0bd\x0ce\rf\n\n g  É É".split()
    one = h.many([" ".join(words), None, ""])
    assert one[0].size == len(words) and one[1].size == one[2].size == 0
    assert (h.many(["alpha beta"])[0] == h.many(["ALPHA", "x", "Beta"])[0][0]).sum() == 1
    text = " ".join(f"w{i}" for i in range(400_000))
    assert (h.many([text])[0][-3:] == h.many(["w399997 w399998 w399999"])[0]).all()
    assert h.many(["a" * 3_000_000 + " b"])[0].size == 2


# --------------------------------------------------------------------- 3 HTML

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></ul></nav><div class="cookie-notice">We use the cookies of this site.</div>
<!-- <p>hidden</p> --><article><header><h1>A &amp; B</h1></header><p>First <b>bold</b>&nbsp;text<br>goes
on.<p>Short.</p><aside>An aside that is in the article.</aside><div class="ad">Buy this and that now.</div>
<section id="comments"><p>A reader says that this is the best of all the articles.</p></section></article>
<form><p>Name</p><input></form><div class="sidebar"><p>More of the same and of that.</p></div><footer>&copy; us</footer></body></html>"""


def test_main_text_of_an_article():
    assert html_text.main_text(PAGE) == "A & B\n\nFirst bold text goes on.\n\nShort."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<br><!-- x") == ""


def test_pages_without_article_follow_the_block_rules():
    good = "This is the text of the page and it has more than enough of the words that are in all of the texts we know, " * 3
    page = f"<body><div><a href=1>One link here</a> <a href=2>Two</a></div><p>{good}</p><p>Short line.</p><p>{good}</p><div>Tiny</div><ul><li><a>x</a></ul>"
    assert html_text.main_text(page).split("\n\n") == [good.strip(), "Short line.", good.strip()]


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><article>{}</article></body>',
    '<body class="overflow-hidden"><article>{}</article></body>',
    '<body id="search"><main>{}</main></body>',
    '<div style="overflow:hidden"><article>{}</article></div>',
    '<div data-x="hidden" class=no-menu><article>{}</article></div>',
    '<article class="post comments-open">{}</article>',
    '<article class="post social">{}</article>',
    '<div class="content-sidebar"><div class="widget"><article>{}</article></div></div>',
    '<main><div class="sidebar-left"><article>{}</article></div></main>',
    '<section class="search"><main class="share">{}</main></section>',
    '<body class="no-nav"><div class="has-menu">{}</div></body>',
])
def test_loose_marks_lose_no_article(page):
    text = "This is the text of the article and it is long enough to be taken as one of the good blocks on the page. " * 3
    assert html_text.main_text(page.format(f"<p>{text}</p>")) == text.strip()


@pytest.mark.parametrize("part", [
    '<div class="comments-area"><article class="comment">{}</article></div>', '<article class="comment">{}</article>', '<div hidden>{}</div>',
    '<div aria-hidden="true">{}</div>', '<div style="color:red;display: none">{}</div>', '<div class="box related">{}</div>', '<div id=comments>{}</div>'])
def test_marked_and_hidden_parts_stay_out(part):
    text = "This is the text of the article and it is long enough to be taken as one of the good blocks on the page. " * 3
    other = part.format(f"<p>Not {text}</p>")
    assert html_text.main_text(f"<body><main><article><p>{text}</p>{other}</article></main></body>") == text.strip()
    if "<article" not in part or "area" in part:
        assert html_text.main_text(f"<body><main><article><p>{text}</p></article>{other}</main></body>") == text.strip()


def test_ids_of_an_articles_sections():
    """A section's id names reader comments or else the section's subject."""
    text = "This is the text of the article and it is long enough to be taken as one of the good blocks on the page. " * 3
    page = "<body><article><p>" + text + '</p><section id="{}"><p>Not ' + text + "</p></section></article></body>"
    for name in ("comments", "Comments-section", "reader-comments", "disqus_thread"):
        assert html_text.main_text(page.format(name)) == text.strip()
    for name in ("search", "comments-in-python", "how-to-comment", "navigation"):
        assert html_text.main_text(page.format(name)) == f"{text.strip()}\n\nNot {text.strip()}"


def test_second_pass_takes_the_nearest_decided_neighbours():
    labels = ["bad", "short", "good", "short", "near", "good", "short", "bad", "near"]
    assert html_text.second_pass(labels, [0] * 9) == [False, False, True, True, True, True, False, False, True]


# --------------------------------------------------------------------- 4 quality

def test_frequent_lines_and_depleted_documents(spark):
    body = [prose(100 + i, 60) for i in range(60)]
    texts = [f"The common line of host 7\n{b}" for b in body] + ["the COMMON  line of host 9\n" + prose(999, 10) + "\n" + "the common line of host 1\n" * 8]
    copies = [prose(50, 40)] * 40
    out = {r.doc_id: r for r in quality.line_frequency(docs(spark, texts + copies)).collect()}
    assert all(out[i].kept and out[i].n_frequent_words == 6 for i in range(60))
    assert not out[60].kept and out[60].n_frequent_words == 54 and out[60].n_dup_lines == 7
    assert all(out[61 + i].kept for i in range(40))  # copies are one text: their line is no boilerplate
    clean = {r.doc_id: r for r in quality.drop_poor(docs(spark, texts + copies)).collect()}
    assert clean[0].text == body[0] and clean[0].n_chars == len(body[0]) and 60 not in clean


def test_repeated_words():
    h = common.hasher(lower_case=False)
    assert quality.repeated_words(h.many(["a b c d e f g h " * 2])[0]) == 16
    assert quality.repeated_words(h.many(["a b c d e f g h x a b c d e f g"])[0]) == 0


# --------------------------------------------------------------------- 5 packing

@pytest.mark.parametrize("window", [1024, 64])
def test_pieces_are_the_documents_and_fill_their_sequences(spark, smoke, window):
    import public_tokenizers
    from tokenizers import Tokenizer
    odd = docs(spark, ODD + ["<|endoftext|> it's  two  spaces \n\n x", "\ttab", "a\r\nb", "trailing "], ids=range(-20, -7))
    rows = smoke.select("doc_id", "text").unionAll(odd.select("doc_id", "text"))
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: np.array(encoder.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4") for r in rows.collect()}
    got = packing.pack(rows, window).toPandas()
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        assert b"".join(pieces.ids) == want[doc].tobytes() and set(pieces.doc_tokens) == {want[doc].size}
        assert (pieces.start.to_numpy() == np.concatenate(([0], np.cumsum(pieces.length)[:-1]))).all()
    assert set(got.doc_id) == set(want)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    sizes = got.groupby("sequence_id").length.sum()
    assert all(n == window or n & (n - 1) == 0 and n < window for n in sizes)


def test_plan_places_every_remainder_once():
    rng = np.random.default_rng(5)
    for trial in range(12):
        h = np.zeros(64, np.int64)
        for v in rng.integers(1, 64, rng.integers(1, 9)):
            h[v] = rng.integers(1, 3000 if trial % 2 else 5)
        table, seen, fill = packing.plan(h, 64, 10), Counter(), Counter()
        for length, start, size, lo, hi, seq, offset in table.tolist():
            for r in range(lo, hi):
                seen.update((length, r, start + d) for d in range(size))
                fill.update((seq + r - lo, offset + d) for d in range(size))
        assert set(seen) == {(v, r, d) for v in range(64) for r in range(h[v]) for d in range(v)} and set(seen.values()) == {1}
        assert set(fill.values()) == {1}
        sizes = Counter(s for s, _ in fill)
        assert all(n & (n - 1) == 0 for n in sizes.values()) and sum(n != 64 for n in sizes.values()) <= 6


def test_nnls_solves_a_small_system():
    combos = np.array([[1, 3, 0], [2, 2, 0], [1, 1, 2]])
    x = packing.nnls(combos, np.array([0.0, 10, 12, 4]), 2000)
    assert np.allclose(x, [4, 4.5, 3], atol=0.05)


# --------------------------------------------------------------------- 6 substrings

def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(1)
    for names in (2048, 3, 0):
        for trial in range(80):
            t = rng.integers(1, rng.integers(2, 6), rng.integers(1, 50))
            t = np.concatenate((np.tile(t, 3) if trial % 3 == 0 else t, [0])).astype(np.int64)
            old, suffix_array.MAX_NAMES = suffix_array.MAX_NAMES, names
            try:
                sa = suffix_array.suffix_array(t, 7)
            finally:
                suffix_array.MAX_NAMES = old
            b = t.tolist()
            assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
            n = int(rng.integers(1, 7))
            count = Counter(tuple(b[i:i + n]) for i in range(len(b) - n + 1))
            assert suffix_array.repeated_starts(t, sa, n).tolist() == [i + n <= len(b) and count[tuple(b[i:i + n])] > 1 for i in range(len(b))]


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    for b in raw:
        edge = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                edge[p] += 1
                edge[p + length] -= 1
        cover = np.cumsum(edge)[:-1] > 0
        yield len(b), int(cover.sum()), int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum()), hashlib.sha256(
            bytes(np.frombuffer(b, np.uint8)[~cover])).hexdigest()


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 3000}, {"group_bytes": 2000}])
def test_repeated_bytes_equal_brute_force(spark, smoke, options):
    passage, texts = prose(20, 80), [r.text for r in smoke.limit(60).collect()]
    texts += [prose(21, 30) + passage + prose(22, 50), "x" + passage, passage[5:] + "é" + passage, "ab" * 900, prose(23, 90), None, ""]
    texts += [prose(24, 100)] * 3
    got = substring_dedup.repeated_bytes(docs(spark, texts), **options).collect()
    want = dict(enumerate(brute_repeats(texts, 400)))
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in got} == want


# --------------------------------------------------------------------- 7 lines

def test_line_windows_merge_and_keep_the_first(spark):
    a = "one\ntwo\nthree\nfour\nfive"
    rows = docs(spark, [a, "x\nONE\n\n two \nthree\nFour\ny", "two\nthree\nfive", None, "p\np\np\np\np", "five"])
    got = {r.doc_id: (r.text, *r.line_dedup) for r in line_dedup.line_dedup(rows).collect()}
    assert got[0] == (a, 5, 0, 0)
    assert got[1] == ("x\n\ny", 6, 4, 1)
    assert got[2] == ("two\nthree\nfive", 3, 0, 0) and got[5] == ("five", 1, 0, 0)
    assert got[3] == (None, 0, 0, 0)
    assert got[4] == ("p", 5, 4, 1)


def test_line_dedup_runs_without_python(spark, smoke):
    plan = line_dedup.line_dedup(smoke)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --------------------------------------------------------------------- 8 language

def test_held_out_accuracy_and_undetermined(spark):
    out = QUERIES["op8_kneser_ney"](spark, SMOKE_DIR).join(spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() >= 0.95 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    train = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").unionByName(spark.createDataFrame(
        [(-1, None, "en", "s", 0), (-2, "12 !? 34", "en", "s", 8), (None, "the and of that with this", None, "s", 0)], DOCS))
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in language_id.identify(train).filter("doc_id < 0 OR doc_id IS NULL").collect()}
    assert got[-1][:2] == got[-2][:2] == ("und", 0.0) and got[None][0] == "en" and not got[None][2]


def brute_kneser_ney(texts, discount=0.75):
    """Log probability of (language, gram of four codes) by recursion over plain dictionaries."""
    counts = {}
    for lang, text in texts:
        codes = [32] * 3 + language_id.alphabet().codes(text).tolist()
        c = counts.setdefault(lang, Counter())
        c.update(tuple(codes[i:i + 4]) for i in range(len(codes) - 3))
    orders = {lang: {4: c} for lang, c in counts.items()}
    for o in orders.values():
        for k in (3, 2, 1):
            o[k] = Counter(g[1:] for g in o[k + 1])
    vocabulary = {g for o in orders.values() for g in o[1]}
    held = {lang: {k: {} for k in range(1, 5)} for lang in orders}
    for lang, o in orders.items():
        for k in range(1, 5):
            for g, n in o[k].items():
                held[lang][k].setdefault(g[:-1], []).append(n)

    def p(lang, g):
        if not g:
            return 1 / (len(vocabulary) + 1)
        seen = held[lang][len(g)].get(g[:-1])
        if not seen:
            return p(lang, g[1:])
        return max(orders[lang][len(g)][g] - discount, 0) / sum(seen) + discount * len(seen) / sum(seen) * p(lang, g[1:])
    return p


def test_kneser_ney_equals_brute_force(spark, monkeypatch):
    texts = [("x", "abracadabra cadabra Äb"), ("x", "abba"), ("y", "barbara abba ca 漢字 \U00020000x"), ("y", prose(3, 300)), ("z", prose(4, 200))]
    monkeypatch.setattr(language_id, "in_training", lambda c: F.lit(True))
    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(texts)], DOCS)
    m, _ = language_id.fit(df)
    p = brute_kneser_ney(texts)
    rng = np.random.default_rng(1)
    alphabet = [*map(ord, "abcdr z"), *language_id.alphabet().codes("漢Ä")[1:-1].tolist(), 9999]
    grams = [tuple(rng.choice(alphabet, 4).tolist()) for _ in range(400)]
    grams += [g for _, t in texts for g in zip(*[([32] * 3 + language_id.alphabet().codes(t).tolist())[i:] for i in range(4)])]
    got = m.log_probs(np.array([sum(c << 16 * (3 - i) for i, c in enumerate(g)) for g in grams], np.uint64))
    want = np.log([[p(lang, g) for lang in m.langs] for g in grams])
    assert m.langs == ["x", "y", "z"] and np.abs(got - want).max() < 2e-6 * np.abs(want).max()
    for context in ("abr", " ca", "zzz"):  # all seen characters and one unseen make 1
        codes = sorted({c for _, t in texts for c in language_id.alphabet().codes(t).tolist()}) + [9999]
        q = np.exp(m.log_probs(np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context)) | c2 for c2 in codes], np.uint64)).astype(float))
        assert np.abs(q.sum(axis=0) - 1).max() < 1e-5


def test_grams_of_long_texts_are_those_of_the_whole(monkeypatch):
    text = prose(1, 400) + "  12 \n漢字 .. " + prose(2, 300)
    whole = language_id.gram_codes(language_id.alphabet().codes(text))
    for piece in (1, 2, 7, 100, len(text), len(text) + 1):
        monkeypatch.setattr(language_id, "PIECE", piece)
        parts = list(language_id._pieces(text))
        assert np.concatenate([g for _, g in parts]).tolist() == whole.tolist()
        assert np.concatenate([c for c, _ in parts]).tolist() == language_id.alphabet().codes(text).tolist()
    assert [c.tolist() for c, _ in language_id._pieces("")] == [[32]]


# --------------------------------------------------------------------- 9 URLs

URLS = {
    "https://Example.ORG/en/1x?q#f": ("example.org", "/en/1x", "example.org/en/1", "block"),
    "http://a.example.org/es/2": ("a.example.org", "/es/2", "example.org/es/", "block"),
    "http://a.example.org/fr/2#x/y": ("a.example.org", "/fr/2", "org/", "allow"),
    "http://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"), "http://x.com/de/a": ("x.com", "/de/a", "com/de/", "block"),
    "http://notexample.org": ("notexample.org", "", None, None), "http://xorg/": ("xorg", "/", None, None),
    "x.org/a": ("", "", None, None), None: ("", "", None, None), "ftp://É.COM?x=/fr/": ("É.com", "", None, None),
}


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(URLS.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    none = url_filter.url_verdicts(pages, rules=[]).collect()
    assert {r.verdict for r in none} == {"allow"}


def test_trees_learn_the_labelled_urls(spark):
    rows = [(i, f"https://h{i % 7}.example.{'com' if i % 2 else 'net'}/{'de' if i % 4 < 2 else 'fr'}/{i}") for i in range(400)]
    out = url_filter.url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).toPandas()
    unruled = out[out.rule.isna()]
    assert (unruled.verdict == np.where(unruled.path.str.startswith("/de/"), "block", "allow")).mean() > 0.9


# --------------------------------------------------------------------- 10 licenses

def test_license_scan(spark):
    apache = dict(licenses.TEMPLATES)["Apache-2.0-notice"]
    texts = [prose(1, 60) + "\nReleased under the MIT license\n" + prose(2, 60), apache.upper().replace(" ", "\n "), " ".join(apache.split()[:40]),
             "all RIGHTS reserved", "rights all reserved", "Licensed under CC BY-NC 4.0."]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(docs(spark, texts)).collect())
    assert got == [(0, "MIT"), (1, "Apache-2.0"), (1, "Apache-2.0-notice"), (2, "Apache-2.0"), (3, "All-rights-reserved"), (5, "CC-BY-NC")]


def test_license_scan_runs_without_python(spark, smoke):
    plan = licenses.scan(smoke)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --------------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as C
    columns, kept = ["doc_id", "text", "lang", "source", "n_chars"], [spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")]
    for name, stage in C.STAGES[:-1]:
        out = common.cut(stage(spark, kept[-1], SMOKE_DIR), f"test-{name}")
        assert out.columns == columns and out.dtypes == kept[0].dtypes
        assert out.join(kept[-1], "doc_id", "left_anti").count() == 0 and out.count() == out.select("doc_id").distinct().count()
        assert out.filter("n_chars <> length(text)").count() == 0
        kept.append(out)
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    assert set(texts[1]) == {r.doc_id for r in quality.line_frequency(kept[0]).filter("kept").collect()}
    groups = brute_components(texts[2].items(), 5)
    assert set(texts[3]) == {c for _, c in groups.values()}
    assert not decontaminate.contaminated_pairs(kept[4], spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet")).take(1)
    packed = C.run(spark, SMOKE_DIR).toPandas()
    assert set(packed.doc_id) == set(texts[4])
    assert packed.groupby("doc_id").length.sum().equals(packed.groupby("doc_id").doc_tokens.first().rename("length"))
