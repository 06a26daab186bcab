import random
import re
import time

import duckdb
import pytest

from tidemark.llm import html_text
from tidemark.llm.html_text import extract, main_text

LONG = "the cat is on the mat and it was in the house of the king. " * 5


def test_marked_article_without_its_boilerplate():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="nav-open"><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="ad">Buy the best of the things that are in the shop.</div><header>Site</header><article><header><h1>Head &amp; line</h1></header><p><b>Bold<br><p>A  b
    &eacute;&#x41;</p><p>x</p><aside>See also</aside><div class="share">Share</div><script>var a = "</p>";</script><form><p>Name</p></form></article>
    <section id="comments"><article><p>{LONG}</p></article></section><footer>&copy; me</footer></body></html>"""
    assert extract(page) == "Head & line\nBold\nA b éA\nx"


def test_unmarked_page_goes_by_block_rules():
    page = f'<body><div class="menu"><a href="x">Home</a></div><h1>Title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p><ul><li><a href="1">one link</a></li><li><a href="2">two</a></li></ul><p>&copy; 2024</p></body>'
    assert extract(page).split("\n") == ["Title", LONG.strip(), "Short one.", LONG.strip()]


OTHER = [
    "Кошка сидела на ковре в доме короля, и никто не знал, откуда она пришла и зачем осталась там до самого утра. " * 3,
    "Kot siedział na dywanie w domu króla i nikt nie wiedział, skąd przyszedł ani dlaczego został tam aż do rana. " * 3,
    "Katten satt på mattan hos kungen, och ingen visste varifrån den kom eller varför den stannade kvar hela natten. " * 3,
    "Kedi kralın evindeki halının üzerinde oturuyordu ve kimse nereden geldiğini ya da neden kaldığını bilmiyordu. " * 3,
    "猫坐在国王家的地毯上，没有人知道它从哪里来，也没有人知道它为什么一直留到天亮才肯离开这座房子。" * 2,
]


@pytest.mark.parametrize("text", OTHER)
def test_pages_in_languages_without_stop_words(text):
    menu = '<div><a href="1">' + text[:80] + '</a> <a href="2">' + text[80:160] + "</a></div>"
    page = f'<body><div class="menu">{text}</div>{menu}<h1>{text[:20]}</h1><p>{text}</p><p>{text[:30]}</p><p>{text}</p><p>&copy; {text}</p></body>'
    assert extract(page).split("\n") == [text[:20].strip(), text.strip(), text[:30].strip(), text.strip()]


def test_one_english_paragraph_does_not_judge_another_language():
    for text in OTHER[:2]:
        page = f"<body><p>{text}</p><p>{LONG}</p><p>{text}</p><p>{text}</p><p>{text}</p></body>"
        assert extract(page).split("\n") == [text.strip(), LONG.strip(), *[text.strip()] * 3]


def test_keywords_are_bad_where_the_language_has_a_list():
    assert extract(f"<body><p>{LONG}</p><p>{'shoes hats coats socks gloves ' * 10}</p><p>{LONG}</p></body>").split("\n") == [LONG.strip()] * 2


def test_text_beside_teaser_articles_is_kept():
    page = f"<body><div><h1>Head</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><section><article><h3>Teaser</h3><p>A short teaser.</p></article></section></body>"
    assert extract(page).split("\n") == ["Head", LONG.strip(), "Short one.", LONG.strip(), "Teaser", "A short teaser."]


def test_long_text_beside_an_article_is_judged_too():
    page = f"<body><div>Site name</div><article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article><div>{LONG}</div><div>Write to us at the office of the house.</div></body>"
    assert extract(page).split("\n") == ["Head", LONG.strip(), LONG.strip(), LONG.strip()]


def test_inside_an_article_both_passes_decide():
    words = "shoes hats coats socks gloves " * 10
    links = '<ul><li><a href="1">one thing</a></li></ul>'
    page = f"<article><h1>Head</h1><p>{LONG}</p><p>{words}</p><p>Short.</p><p>{LONG}</p>{links}<p>More offers</p>{links}</article>"
    assert extract(page).split("\n") == ["Head", LONG.strip(), words.strip(), "Short.", LONG.strip()]


KEYWORDS = "shoes hats coats socks gloves " * 10


@pytest.mark.parametrize("seed", range(30))
def test_second_pass_equals_plain_search_for_neighbours(seed):
    rng = random.Random(seed)
    kinds = [rng.choice("gbs") for _ in range(rng.randint(1, 12))]
    text = {"g": LONG.strip(), "b": KEYWORDS.strip(), "s": "Short one."}
    page = "<body>" + "".join(f"<p>{text[k]}</p>" for k in kinds) + "</body>"
    listed = kinds.count("g") * len(LONG) >= 0.25 * (kinds.count("g") * len(LONG) + kinds.count("b") * len(KEYWORDS))
    decided = ["" if k == "s" else "good" if k == "g" or not listed else "bad" for k in kinds]
    want = []
    for i, d in enumerate(decided):
        near = {next((x for x in decided[i + 1 :] if x), ""), next((x for x in decided[:i][::-1] if x), "")} - {""}
        if d == "good" or not d and near in (set(), {"good"}):
            want.append(text[kinds[i]])
    assert extract(page) == "\n".join(want)


def test_both_passes_matter(monkeypatch):
    page = f"<body><p>{LONG}</p><p>Short one.</p><p>{LONG}</p><p>{KEYWORDS}</p><p>Offers</p><p>{KEYWORDS}</p></body>"
    assert extract(page).split("\n") == [LONG.strip(), "Short one.", LONG.strip()]
    monkeypatch.setattr(html_text, "stop_density", lambda t: 0.5)
    assert len(extract(page).split("\n")) == 6


def test_a_page_of_short_blocks_has_text():
    assert extract('<body><div class="menu">Home</div><h1>Head</h1><p>Short.</p><div class="ad">more</div></body>') == "Head\nShort."


def test_articles_are_found_without_their_marks():
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    same = sum(extract(h) == extract(re.sub(r"<(/?)(article|main)\b", r"<\1div", h)) for (h,) in rows)
    assert same >= 0.95 * len(rows)


@pytest.mark.parametrize("part", ["<p>x</p>", "<option>x", "<button>a", "<div>", "</ul>", "<p ", "<a '", "<!--", "<li><b>x ", "&amp;", "word "])
def test_time_grows_with_the_length(part):
    def took(n):
        began = time.process_time()
        extract("<div>" * 2000 + part * (n // len(part)))
        return time.process_time() - began

    assert took(400_000) < 12 * max(took(100_000), 0.05)


def test_broken_and_empty_markup():
    assert extract(None) == extract("") == extract("<p>") == "" and extract("<") == "<"
    assert extract("<article><p>a<p>b <i>c</i></article") == "a\nb c"
    assert extract("<article><p>1 < 2 & 3</p><!-- no <p>x</p> --><p>y") == "1 < 2 & 3\ny"
    assert extract("<article><script>never closed <p>x") == ""
    assert extract("<article><p title='a>b'>t</p></article>") == "t"


def test_table(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>é x</p></article>", "z"), (None, None, None, "z"), (1, "u", "<article><p>é x</p></article>", "z")], "page_id long, url string, html string, text string")
    assert sorted((tuple(r) for r in main_text(df).collect()), key=str) == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0)], key=str)
    assert main_text(df.where("false")).count() == 0


def test_all_articles_of_the_table(spark, sf_dir):
    import html

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.DOTALL)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in re.split(r"</?(?:p|h1)>", inner))
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)
