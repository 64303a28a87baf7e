"""Cases that the operators' contracts name: whole articles, added tokens, hosts, short items, repeated URLs, clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinframe.llm import decontaminate, line_dedup, packing, quality, url_filter
from clinframe.llm.html_text import main_text
from test_llm_operators import docs, prose

GOOD = ("The committee of the town has been asked to look at the bridge, and it is not the first time that they have done so, "
        "because the water was on the road for days and the people in the valley could not go to work or to the school of the village.")
POLISH = ("Komisja miejska została poproszona o zbadanie mostu, ponieważ woda zalewała drogę przez wiele dni, mieszkańcy doliny nie mogli "
          "dojechać do pracy ani szkoły, natomiast burmistrz obiecał szybkie rozpoczęcie robót budowlanych jeszcze przed nadejściem zimy.")


def page(body):
    return f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a> <a href='/n'>News</a></nav>{body}<footer>© 2024 Example</footer></body></html>"


@pytest.mark.parametrize("part", [
    "<h2 id='social-history'>Social history</h2>", "<p id='search-and-rescue'>" + GOOD + " Rescue.</p>",
    "<section class='side-effects'><p>" + GOOD + " Effects.</p></section>", "<section id='related-work'><p>" + GOOD + " Work.</p></section>",
    "<h3 class='alert-systems'>Alert systems</h3>", "<p>" + GOOD + " The sign © was painted on the wall.</p>"])
def test_article_parts_stay(part):
    import re
    words = " ".join(re.sub("<[^>]*>", " ", part).split())
    got = main_text(page(f"<article><h1>Bridge</h1><p>{GOOD}</p>{part}<p>{GOOD} End.</p></article>"))
    assert words in got and got.startswith("Bridge") and "Home" not in got and "2024" not in got


def test_marked_parts_of_an_article_go():
    got = main_text(page(f"<article><p>{GOOD}</p><div class='share'>Share this with all of your friends now</div><div class='related-posts'><p>{GOOD} Other.</p></div>"
                         f"<section class='comments'><p>{GOOD} Reader.</p></section><p>{GOOD} End.</p></article>"))
    assert "Share" not in got and "Other" not in got and "Reader" not in got and got.endswith("End.")


def test_page_in_an_unlisted_language_keeps_its_text():
    got = main_text(page(f"<div><p>{POLISH}</p><p>{POLISH} Koniec.</p></div>"))
    assert got == f"{POLISH}\n\n{POLISH} Koniec."


def test_sign_in_prose_and_copyright_lines_without_article():
    got = main_text(page(f"<div><p>{GOOD}</p><p>{GOOD} The © sign.</p><p>© 2023 The Company. All rights reserved by the owners of the works and of the site.</p></div>"))
    assert got == f"{GOOD}\n\n{GOOD} The © sign."


def test_short_blocks_go_with_the_nearest():
    got = main_text(page(f"<div><h1>Bridge</h1><p>{GOOD}</p><p>That was all.</p></div>"))
    assert got == f"Bridge\n\n{GOOD}\n\nThat was all."


def test_added_tokens_have_their_own_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = ["end <|endoftext|> more", "<|endoftext|>", "<|endoftext|><|endoftext|> x\n<|endoftext", "a<|endoftext|>b  c", "no token"]
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: encoder.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pack(docs(spark, texts)).collect()}
    assert got == want and len(want[0]) == 5


def test_frequent_lines_belong_to_their_host(spark):
    line = " ".join(f"boiler{i}" for i in range(17))
    rows = [(i, f"{line}\n{prose(i, 60)}", "en", "A", 0) for i in range(30)] + [(1000 + i, prose(500 + i, 60), "en", "B", 0) for i in range(30)]
    rows += [(7, rows[7][1], "en", "B", 0)]
    got = {(r.doc_id, r.host): r.n_frequent_words for r in quality.line_frequency(spark.createDataFrame(rows, docs(spark, []).schema)).collect()}
    assert got[7, "A"] == 17 and got[7, "B"] == 0


def test_short_and_unspaced_items_are_found(spark):
    items = [(1, "purple monkey dishwasher sings"), (2, "量子コンピュータは従来の計算機より高速に素因数分解を行うことができる"), (3, "ราคาของแพงขึ้นทุกปีในเมืองใหญ่"), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [prose(1, 50) + " Purple, monkey: dishwasher SINGS " + prose(2, 50), "前文。" + items[1][1] + "。後文が続きます", "x" + items[2][1] + "y",
             prose(3, 80), "purple monkey sings dishwasher", "量子コンピュータは高い", None]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs(spark, texts), bench).collect()}
    assert got == {(0, 1), (1, 2), (2, 3)}
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs(spark, texts), bench).collect()}
    assert left == {3, 4, 5, 6}


def test_repeated_urls_count_once(spark):
    bad = [(i, f"https://a{i}.com/de/shop{i}?x={i}") for i in range(60)]
    good = [(100 + i, f"https://b{i}.com/fr/story/{i}") for i in range(60)]
    new = [(300 + i, f"https://c{i}.net/de/shop{i}?x={i}") for i in range(50)]

    def verdicts(copies):
        rows = bad + good + new + [(1000 + i, good[0][1]) for i in range(copies)]
        out = url_filter.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), max_training=150)
        return {r.page_id: r.verdict for r in out.collect() if 300 <= r.page_id < 400}
    one, many = verdicts(1), verdicts(400)
    assert one == many and set(one.values()) == {"block"}


def test_helper_names_may_be_columns(spark):
    names = ("__id", "__key", "__frequent", "__host", "__tkey", "__starts", "__lines", "__full", "__gone", "id", "key", "frequent", "host",
             "doc", "row", "from", "text_hash", "lines", "starts", "gone", "full")
    df = docs(spark, [prose(1, 60) + "\na b c\nd e f\ng h i", prose(2, 60) + "\na b c\nd e f\ng h i", None, ""]).withColumns({c: F.lit(f"v-{c}") for c in names})
    kept = quality.drop_poor(df)
    assert kept.columns == df.columns and kept.count() == 2
    out = line_dedup.line_dedup(df)
    assert out.columns == [*df.columns, "line_dedup"] and [r.line_dedup.n_removed for r in out.orderBy("doc_id").collect()] == [0, 3, 0, 0]
    assert all(r[c] == f"v-{c}" for r in [*kept.collect(), *out.collect()] for c in names)


def test_pipeline_keeps_only_the_tables_of_its_result(spark):
    import os

    import corpus_pipeline
    from clinframe.llm.common import scratch_dir
    from conftest import SMOKE_DIR
    folder = scratch_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, SMOKE_DIR).count() > 0
    made = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert [n for n in made if n.startswith("llm-stage")] == ["llm-stage-decontamination"]
    assert not made & {"llm-sketch", "llm-nodes", "llm-texts", "llm-quality", "llm-repeated", "llm-members", "llm-labels"}
