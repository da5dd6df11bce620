import html as html_module
import re
import time

import pytest
from conftest_llm import DATA, needs_data, sentence

from wattweave.llm import html_text


def page(*blocks, **around):
    head = "<html><head><title>T x</title><style>p{}</style></head><body class='no-sidebar'>"
    return head + around.get("before", "") + "<article>" + "".join(blocks) + "</article>" + around.get("after", "") + "</body></html>"


BEFORE = (
    "<header><p>Head words that are many and long enough to look like text</p></header>"
    "<nav><ul><li><a href='/'>Home</a><li>News</ul></nav><!-- a note --><div class='ad'>Buy this thing now, it is very good</div>"
)
AFTER = (
    "<aside>Side</aside><div id='comments'><p>A reader says a lot of things here, one after the other</p></div>"
    "<div class='cookieNotice'>We use cookies on this page</div><form><label>Name</label></form><script>var a='<p>x</p>'</script><footer>&copy; us</footer>"
)


def test_article_without_furniture(rng):
    long = [sentence(rng, 40) for _ in range(4)]
    blocks = ["<h1>A &amp; B</h1>", f"<p>{long[0]}</p>", "<p>Ou.</p>", f"<p><b>{long[1]}<br><p>{long[2]}", f"<ul><li>{long[3]}<li>end</ul>"]
    expected = "\n\n".join(["A & B", long[0], "Ou.", long[1], long[2], long[3], "end"])
    assert html_text.main_text(page(*blocks, before=BEFORE, after=AFTER)) == expected


def test_short_article_beside_long_furniture(rng):
    text = html_text.main_text(page("<p>Brief &#233;t&eacute;.</p>", before=BEFORE, after=f"<footer>{sentence(rng, 300)}</footer>"))
    assert text == "Brief été."


def test_page_without_article_element(rng):
    long = [sentence(rng, 30) for _ in range(3)]
    body = f"<body>{BEFORE}<div class='content'><h2>Title</h2><p>{long[0]}</p><p>{long[1]}</p><p>x</p></div>{AFTER}</body>"
    assert html_text.main_text(body) == "\n\n".join(["Title", long[0], long[1], "x"])


@pytest.mark.parametrize("around", [("", ""), (BEFORE, AFTER)])
@pytest.mark.parametrize("last", [1, 3])
@pytest.mark.parametrize(
    "form",
    [
        "<div id=content><div>{}</div><div>{}</div></div>",
        "<div><section>{}</section></div><div><section>{}</section></div>",
        "<main><article>{}</article><article>{}</article></main>",
        "<article>{}</article><section>{}</section>",
        "<article>{}</article><div class='ad'>Buy now</div><article>{}</article>",
        "<main>{}</main><div>{}</div>",
        "<table><tr><td>{}<td>{}</table>",
    ],
)
def test_no_part_of_a_split_article_is_lost(rng, form, last, around):
    parts = [[sentence(rng, rng.choice([20, 40, 80])) for _ in range(n)] for n in (7, last)]
    html = around[0] + form.format(*["".join(f"<p>{t}</p>" for t in part) for part in parts]) + around[1]
    assert html_text.main_text(f"<body>{html}</body>") == "\n\n".join(parts[0] + parts[1])


def test_short_lines_outside_the_article_stay_out(rng):
    long = [sentence(rng, 40) for _ in range(4)]
    blocks = "".join(f"<p>{t}</p>" for t in long)
    for form in ("<article>{}</article>", "<main>{}</main>", "<div><p>x</p>{}</div>"):
        text = html_text.main_text(f"<body><div>Top</div>{form.format(blocks)}<div>Next</div></body>")
        assert text.removeprefix("x\n\n") == "\n\n".join(long)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a\n\t b&nbsp;&nbsp;c<br/>d</p>", "a b c d"),
        ("<p>one<p>two</div></p></article>", "one\n\ntwo"),
        ("<p>cut off <a href='x", "cut off"),
        ("<p>a &am", "a &am"),
        ("<p>1 < 2 &lt; 3</p>", "1 < 2 < 3"),
        ("<script>only script</script>", ""),
        ("<p hidden>no</p><p>yes</p>", "yes"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ],
)
def test_small_pages(html, text):
    assert html_text.main_text(html) == text


@needs_data("pages")
def test_every_article_of_the_table(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    found = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [html_module.unescape(re.sub("<[^>]*>", " ", b)) for b in re.split("</?(?:p|h1)>", inner)]
        expected = "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert found[r["page_id"]]["text"] == expected and found[r["page_id"]]["n_chars"] == len(expected)


def test_rows_columns_and_empty_table(spark, rng):
    long = page(*[f"<p>{sentence(rng, 200)}</p>" for _ in range(300)])
    rows = [(1, "u", None, "x", 5), (None, None, page("<p>hi 😀</p>"), "y", 5), (2, "u", long, "z", 5), (2, "u", long, "z", 5)]
    schema = "page_id long, url string, html string, text string, n_chars long"
    found = html_text.extract(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    assert by_id[1] == [("", 0)] and by_id[None] == [("hi 😀", 4)] and len(by_id[2]) == 2 and by_id[2][0][1] > 200_000
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("section", ["<![foo[x]]>", "<![ foo", "<![if !IE]>", "<![endif]-->", "<![CDATA[x]]>", "<![", "<!x y>", "<![]>"])
def test_unknown_declarations_do_not_end_the_job(rng, section):
    words = sentence(rng, 40)
    assert words in html_text.main_text(page(f"<p>{words}</p>") + section)
    after = html_text.main_text(f"<body><p>{words}</p>{section}</p><p>{words}</p></body>")
    assert after.startswith(words)


@pytest.mark.parametrize(
    "html",
    [
        "<div>a" * 100_000,
        "<div>a" * 50_000 + "</div>" * 50_000,
        "<p><div>" + "<i>" * 50_000 + "<hr>x" * 50_000,
        "text " + "<a" * 200_000,
        "<p>x" * 100_000,
        "<article>" * 50_000 + "<p>x</p>" * 50_000,
    ],
)
def test_time_grows_with_the_length(html):
    begun = time.process_time()
    html_text.main_text(html)
    assert time.process_time() - begun < 6


def test_cut_off_tags_are_no_text():
    assert html_text.main_text("<p>a < b > c</p><p>end <a href='x") == "a < b > c\n\nend"
    assert html_text.main_text("words <!-- open") == "words"
