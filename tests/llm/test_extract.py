import itertools
import random
import time

from monthgrid.llm import extract as X

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">x</a></li></ul></nav>'
        '<!-- ad --><div class="ad">buy</div><article><h1>A &amp; B</h1><p><b>one  \n two<br><p>th<i>re</i>e &lt;4&gt; &am<aside>no</aside><div class="comments"><p>me too</p></div>'
        '<p>shadow <span class="shadow">box</span></p></article><div class="notice">n</div><footer>&copy; f</footer>')


def text(html, other=None):
    return X.main_text(X.blocks(html), other and X.blocks(other))


def test_article_without_its_surroundings():
    assert text(PAGE) == "A & B\none two\nthree <4> &am\nshadow box"
    assert text(None) == text("") == text("<p></p>") == text("<nav>a") == ""
    assert text("<article><p>a</div></p></section>b</article>c") == "a\nb"
    assert text("<article>x<form><input>y</form>z</article>") == "x\nz"


def test_generated_ids_and_topic_classes_keep_article_text():
    for name in ("discussion", "related-work", "search-algorithms", "market-share", "article-header", "social-policy", "comments", "ad"):
        assert text(f'<article><h2 id="{name}">H</h2><section id="{name}"><p>t</section></article>') == "H\nt"
    for name in ("discussion", "related-work", "search-algorithms", "market-share", "article-header", "social-policy", "side notice"):
        assert text(f'<main><h2 class="{name}">H</h2><div class="{name}"><p>t</div></main>') == "H\nt"
    assert text('<article><p>t<div class="x Ad">a</div><ul class="share-buttons"><li>s</ul><section class="comments">c</section></article>') == "t"
    assert text('<div id="discussion">c</div><p>t') == "t"


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in "ab")
        got = sorted(X.common_lines(a, b))
        assert len(got) == lcs(a, b)
        it = iter(b)
        assert all(any(x == a[i] for x in it) for i in got)


def test_shared_lines_go_where_no_article_is_marked(spark):
    page = "<div>site name</div><p>{}</p><p>imprint</p>"
    rows = [(1, "http://h.org/a/1", page.format("first"), "z"), (2, "http://h.org/a/1?x", page.format("first"), "z"), (3, "http://H.org/a/2", page.format("second"), "z"),
            (4, "http://other.org/a/2", page.format("second"), None), (5, None, None, None), (6, "http://h.org/b", "<article><p>imprint</p></article>", "z"), (None, "x", "<p>t", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["page_id"]: (r["text"], r["n_chars"]) for r in X.main_texts(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {1: ("first", 5), 2: ("first", 5), 3: ("second", 6), 4: ("site name\nsecond\nimprint", 24), 5: ("", 0), 6: ("imprint", 7), None: ("t", 1)}


def test_empty_table(spark):
    assert X.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_template_lines_inside_articles_go_and_quoted_passages_stay(spark):
    """Every page has an article, of which only comparison can tell the unmarked first and last line."""
    page = "<article><p>share this page</p>{}<p>written by the staff</p></article>"
    body = {i: [f"line {i} {k}" for k in range(4)] for i in range(12)}
    body[3][1] = body[4][2] = "a quoted passage"
    body[7][1] = body[8][1] = body[9][1] = "another quoted passage"
    rows = [(i, f"http://h.org/{i:02}", page.format("".join(f"<p>{x}</p>" for x in lines))) for i, lines in body.items()]
    rows += [(100 + i, "http://h.org/05", rows[5][2]) for i in range(3)]  # copies
    rows += [(200 + i, f"http://copies.org/{i}", page.format("".join(f"<p>c{k}</p>" for k in range(8)) + f"<p>edited {i}</p>")) for i in range(8)]  # near copies
    rows += [(300, "http://one.org/", page.format("<p>t</p>")), (301, "http://one.org/x", page.format("<p>u</p>"))]  # too few to tell
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["page_id"]: r["text"].split("\n") for r in X.main_texts(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(rows) and all(got[i] == lines for i, lines in body.items())
    assert all(got[100 + i] == body[5] for i in range(3))
    assert all(got[200 + i] == ["share this page", *(f"c{k}" for k in range(8)), f"edited {i}", "written by the staff"] for i in range(8))
    assert got[300] == ["share this page", "t", "written by the staff"]


def test_many_equal_lines_are_compared_by_rows_of_bits(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(X, "PAIRS", -1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in "ab")
        got = sorted(X.common_lines(a, b))
        assert len(got) == lcs(a, b)
        it = iter(b)
        assert all(any(x == a[i] for x in it) for i in got)
    monkeypatch.undo()
    lines = [rng.choice("01") for _ in range(6000)]
    begin = time.process_time()
    assert len(X.common_lines(lines, lines[7:])) >= 5993
    assert time.process_time() - begin < 5
