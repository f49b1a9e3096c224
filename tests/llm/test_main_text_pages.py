"""Pages whose markup is left open keep their article, work is linear in the page, and extract() on every defined case."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import main_text

ARTICLE = ("<article><h1>A title</h1><p>One long sentence, with several words in it.</p>"
           "<p>Another one follows here, with an end.</p></article>")
WANT = ["A title", "One long sentence, with several words in it.", "Another one follows here, with an end."]
PAGES = {
    "head without end": "<html><head><title>T</title><meta charset=x><body>" + ARTICLE,
    "head without end or body": "<html><head><title>T</title>" + ARTICLE,
    "head that ends after the body begins": "<html><head><title>T</title><body>" + ARTICLE + "</head>",
    "svg closes itself": "<body><svg width=1 />" + ARTICLE,
    "nested svg": "<body><svg><svg><text>x</text></svg><text>y</text></svg>" + ARTICLE,
    "svg around one that closes itself": "<body><svg><svg /><text>x</text></svg>" + ARTICLE,
    "iframe closes itself": "<body><iframe src=x />" + ARTICLE,
    "iframe without end": "<body><iframe src=x>" + ARTICLE,
    "button without end": "<body><nav><button>Menu</nav>" + ARTICLE,
    "button without end, another later": "<body><button>Menu" + ARTICLE + "<button>x</button>",
    "options without end": "<body><datalist><option>a<option>b</datalist>" + ARTICLE,
    "select": "<body><form><select><option>a<option>b</select></form>" + ARTICLE,
    "title without end": "<title>T<body>" + ARTICLE,
    "noscript": "<body><noscript><p>Enable it now please.</p></noscript>" + ARTICLE,
    "script with tags": "<body><script>var a = '</p><article>';</script>" + ARTICLE,
    "upper case": "<BODY><BUTTON>Go</BUTTON>" + ARTICLE.upper().replace("A TITLE", "A title").replace(
        "ONE LONG SENTENCE, WITH SEVERAL WORDS IN IT", "One long sentence, with several words in it").replace(
        "ANOTHER ONE FOLLOWS HERE, WITH AN END", "Another one follows here, with an end"),
}


@pytest.fixture(scope="module")
def field():
    return main_text.fit(main_text.training_set())


@pytest.mark.parametrize("name", PAGES)
def test_open_markup_keeps_the_article(field, name):
    assert main_text.main_blocks(PAGES[name], field) == WANT


def test_short_pages(field):
    wrong = total = 0
    for seed in range(5000, 5100):
        page, labels = main_text.short_page(seed)
        got = field.decode([main_text.describe(*b) for b in main_text.blocks(page)])
        wrong, total = wrong + sum(a != b for a, b in zip(got, labels)), total + len(labels)
    assert wrong <= 0.07 * total
    assert main_text.main_blocks("<body><article><p>Only one sentence stands here, and no more.</p></article>", field) \
        == ["Only one sentence stands here, and no more."]


@pytest.mark.parametrize("piece", ["<div>a", '<a "', "<button>a<li>b", "<title>a</b>", "<a '\"x", "<svg>", "</p><li>"])
def test_work_is_linear(piece):
    start = time.process_time()
    main_text.blocks(piece * 20_000)
    assert time.process_time() - start < 5


def test_extract_defined_cases(spark, field):
    page = f"<body>{ARTICLE}"
    rows = [(None, None, page), (1, "u", None), (2, "u", ""), (3, "u", page), (3, "u", page), (4, None, "<p>" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    got = sorted(((r["page_id"] or 0, r["url"], r["text"]) for r in main_text.extract(df, field).collect()), key=repr)
    text = "\n".join(WANT)
    assert got == sorted([(0, None, text), (1, "u", ""), (2, "u", ""), (3, "u", text), (3, "u", text), (4, None, "")], key=repr)
    assert main_text.extract(df.limit(0), field).count() == 0
