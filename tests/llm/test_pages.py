import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandstand.llm.html_text import BlockRules, extract_pages, main_text, page_blocks
from bandstand.llm.language import LanguageRules, codewords, held_out, predict_languages, train_language_model

PROSE = "The cat is on the mat and it was there for a long time with the dog of the house."
MORE = "And this is another paragraph of the text that we have to keep in the article."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        (f"<p>{PROSE}</p>", PROSE),
        (f"<body><nav><ul><li><a href=x>The one</a></li></ul></nav><article><h1>Title</h1><p>{PROSE}<p>Short.</article><footer>&copy; x</footer>", f"Title\n{PROSE}\nShort."),
        (f"<article><p>{PROSE}</p><div class='ad box'><p>{MORE}</p></div><aside>{MORE}</aside><form><p>{MORE}</p></form></article>", PROSE),
        (f"<div class='menu'>{MORE}</div><div id=main><h2>Title</h2><p>{PROSE}</p></div><div id='user-comments'><p>{MORE}</p></div>", f"Title\n{PROSE}"),
        (f"<article><header><h1>A &amp; B &#39;c&#39; &eacute;</h1></header><p>{PROSE}\n  <b>bold</b>  x<br>y</p></article>", f"A & B 'c' é\n{PROSE} bold x y"),
        (f"<script>var t='<p>{MORE}</p>'</script><style>p{{}}</style><!-- <p>{MORE}</p> --><p>{PROSE}</p>", PROSE),
        (f"<article><p>{PROSE} 3 < 4 &lt;x&gt;</p><p>{MORE} <a hre", f"{PROSE} 3 < 4 <x>\n{MORE}"),
        (f"<p>{PROSE}</p><p>" + " ".join(f"<a href=x>the link of it and this {k}</a>" for k in range(9)) + "</p>", PROSE),
        ("<article><p>Only short.</p></article>", "Only short."),
        (f"<article><p>{PROSE}</p><article class='comment'><p>{MORE}</p></article></article><p hidden>{MORE}</p>", PROSE),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("opened, closed", [("<div>", "</section>"), ("<div class='menu'>", ""), ("<div>", "<article></article>"), ("<article>", "</main>")])
def test_deep_pages_take_linear_time_and_memory(opened, closed):
    """End tags that close nothing, and named elements in each other, 20,000 deep."""
    page = opened * 20_000 + closed * 20_000
    tracemalloc.start()
    began = time.process_time()
    assert main_text(page) == ""
    assert time.process_time() - began < 20
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * 2**20


def test_unmatched_end_tags_close_nothing():
    assert main_text(f"<article><p>{PROSE}</section></main></div><p>{MORE}</article>") == f"{PROSE}\n{MORE}"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body class='has-sidebar'><p>{PROSE}</p></body>", PROSE),
        (f"<div id='page' class='no-sidebar comments-open'><h1>Title</h1><p>{PROSE}</p><div class='sidebar'>{MORE}</div></div>", f"Title\n{PROSE}"),
        (f"<p>{PROSE}</p><div id='comments'><p>{MORE}</p><p>{MORE}</p><p>{MORE}</p></div>", PROSE),
        ("<div><p>\u201cYes.\u201d</p><p>\u201cNo.\u201d</p><p><a href=x>Next page</a></p></div>", "\u201cYes.\u201d\n\u201cNo.\u201d"),
        ("<nav>\u83dc\u5355</nav><p>\u732b\u5728\u57ab\u5b50\u4e0a\u3002</p><p>\u5b83\u7761\u7740\u4e86\u3002</p>", "\u732b\u5728\u57ab\u5b50\u4e0a\u3002\n\u5b83\u7761\u7740\u4e86\u3002"),
        (f"<div><p>{PROSE}</p><p>{MORE}</p></div><article><h3>Teaser</h3></article>", f"{PROSE}\n{MORE}\nTeaser"),
        (f"<article><p>{PROSE} The \N{COPYRIGHT SIGN} is a sign.</p><p>\N{COPYRIGHT SIGN} 2020 the paper</p></article>", f"{PROSE} The \N{COPYRIGHT SIGN} is a sign."),
    ],
)
def test_whole_articles_stay(page, text):
    assert main_text(page) == text


def test_open_blocks_take_the_side_of_their_neighbours():
    page = f"<div><p>{PROSE}</p><p>Near it.</p></div><section><p>Far away.</p></section>"
    assert main_text(page) == f"{PROSE}\nNear it."
    assert [b.text for b in page_blocks(page)] == [PROSE, "Near it.", "Far away."]


def test_long_and_broken_markup_ends():
    assert main_text("<div>" * 5000 + PROSE) == PROSE
    assert main_text("<p title='" + "x" * 50_000) == ""
    assert main_text(f"<p>{PROSE}</p>" * 2000).count("\n") == 1999


def test_pages(spark):
    rows = [(1, "u", f"<p>{PROSE}</p>", "x"), (1, "u", f"<p>{PROSE}</p>", "x"), (None, None, None, None), (2, None, "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_pages(df, "page_id", "url", "html", BlockRules()).collect()), key=str)
    assert got == sorted([(1, "u", PROSE, len(PROSE)), (1, "u", PROSE, len(PROSE)), (None, None, "", 0), (2, None, "", 0)], key=str)
    assert extract_pages(df.where("false"), "page_id", "url", "html").count() == 0


def test_codewords():
    for k in (2, 3, 4, 7, 12, 40):
        code = codewords(k, 1)
        distance = (code.shape[1] - code @ code.T) // 2 + np.eye(k, dtype=int) * code.shape[1]
        assert code.shape[0] == k and distance.min() >= max(1, code.shape[1] // 4) and set(np.unique(code)) <= {-1, 1}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train_language_model(docs, "doc_id", "text", "lang", LanguageRules(sample_rows=400, rounds=60))
    got = predict_languages(docs, "doc_id", "text", model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id")))
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97 and model.languages == ("de", "en", "es", "fr")


def test_odd_texts(clashing, odd_rows, spark):
    model = train_language_model(clashing, "doc_id", "text", "lang", LanguageRules(rounds=10))
    got = predict_languages(clashing, "doc_id", "text", model, with_row=True)
    rows = got.select("lang_pred", "score", F.col("row.text").alias("text")).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert model.languages == ("en", "fr")
    none = train_language_model(clashing.where("false"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in predict_languages(clashing, "doc_id", "text", none).collect()} == {"und"}
    assert predict_languages(clashing.where("false"), "doc_id", "text", model).count() == 0
