"""Main text of pages: zones, alignment, nearest neighbours."""

import random

from landfall.llm import html_extract as module
from landfall.llm.html_extract import html_extract, main_text, page_lines, shared_lines

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use <div>cookies</div> here</div><nav><ul><li>menu</ul></nav><main><article>
<header><h1>Head &amp; x</h1><p>by me</p></header><p>One  <i>tw</i>o&nbsp;three<br>four<p>Five <a title="a>b">l</a>
<ul><li>li1<li>li2</ul><div id="comments"><p>bad</p></div><form>f</form><aside>s</aside><script>"</p>"</script>tail
</article><aside>z</aside></main><!-- x --><footer>f</footer></body></html>"""


def text_of(page, neighbour=None):
    return main_text(page_lines(page), neighbour and page_lines(neighbour))


def test_the_article_and_nothing_else():
    assert text_of(PAGE) == "Head & x\nOne two three four\nFive l\nli1\nli2\ntail"


def test_odd_markup():
    assert text_of("") == ""
    assert text_of("plain text") == "plain text"
    assert text_of("<article>a < b &lt; c<p>d") == "a < b < c\nd"
    assert text_of("<article>a<script>never closed") == "a"
    assert text_of("<article>a<!-- never closed") == "a"
    assert text_of("<article><p class='ad'>x<p>y</article>") == "y"
    assert text_of("<article><td>1</td><td>2</td> </article>") == "1\n2"
    assert text_of("<article " + "x='" * 3000 + ">a</article>") is not None


def test_names_of_wrappers_do_not_take_the_article():
    body = "<p>one</p><section class='social-policy'><p>two</p></section><div class=ad>x</div><p>three</p>"
    for wrapper in ("<article class='post has-sidebar'>%s</article>", "<article class='sidebar'>%s</article>",
                    "<main class='content no-sidebar'>%s</main>", "<main id=search><article>%s</article></main>",
                    "<div id='article-with-comments'><article>%s</article></div>",
                    "<div class='sidebar'><nav>n</nav><div class='menu'><main>%s</main></div></div>",
                    "<section><div class='ad'>never closed</section><article>%s</article>",
                    "<article><div class='layout withSidebar'>%s</div></article>"):
        assert text_of(wrapper % body) == "one\ntwo\nthree", wrapper
    for name in ("site-nav", "mainMenu", "cookie-notice", "post comment-list comments", "SIDEBAR", "comment-17"):
        assert text_of(f"<article><p>one<div class='{name}'><p>x</div><p>two</article>") == "one\ntwo", name


def test_wrappers_in_wrappers_take_no_longer_than_their_tags():
    deep = "<div class=sidebar>" * 50_000 + "<article>a</article>" + "<div class=menu><article>b</article></div>" * 9
    assert text_of(deep) == "\n".join("a" + "b" * 9)


def test_unmarked_pages_lose_what_a_neighbour_shares():
    one = "<body><div>Top of site</div><div><p>Text a</p><p>quote</p></div><div>Copyright</div></body>"
    two = one.replace("Text a", "Text b").replace("<p>quote</p>", "")
    assert text_of(one, two) == "Text a\nquote"
    assert text_of(one) == "Top of site\nText a\nquote\nCopyright"
    marked = "<article><p>same</p></article>"
    assert text_of(marked, marked) == "same"


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(2000):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 9))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 9))]
        found = [a[i] for i in sorted(shared_lines(a, b))]
        rest = iter(b)
        assert len(found) == longest(a, b) and all(x in rest for x in found)


def test_neighbours_are_the_nearest_paths_of_the_host(spark):
    def page(top, body):
        return f"<body><div>{top}</div><p>{body}</p></body>"

    rows = [
        (1, "http://a.com/x/1", page("X site", "one")), (2, "http://a.com/x/2", page("X site", "two")),
        (3, "http://a.com/y/1", page("Y site", "three")), (4, "http://a.com/y/2", page("Y site", "four")),
        (5, "http://b.com/y/2", page("X site", "alone")), (6, None, None), (7, "http://c.com/", ""),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in html_extract(df).collect()}
    assert {i: got[i] for i in (5, 6, 7)} == {5: "X site\nalone", 6: "", 7: ""}
    assert {got[i] for i in (1, 2, 3, 4)} == {"one", "two", "three", "four"}
    assert all(r.n_chars == len(r.text) for r in html_extract(df).collect())


def nearest_texts(rows):
    """By plain Python: each page differenced with the nearer one beside it."""
    def split(row):
        return tuple(row[1].split("://")[1].split("/", 1))

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    rows, out = sorted(rows, key=lambda row: (*split(row), row[1], row[0])), {}
    for i, row in enumerate(rows):
        beside = [r for r in rows[max(i - 1, 0):i] + rows[i + 1:i + 2] if split(r)[0] == split(row)[0]]
        near = max(beside, key=lambda r: common("/" + split(r)[1], "/" + split(row)[1]), default=None)
        out[row[0]] = text_of(row[2], near and near[2])
    return out


def test_pairs_do_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE_ROWS", 1)
    rng = random.Random(4)
    rows = []
    for i in range(90):
        host, part = rng.choice(["a.com", "b.com", f"two{i // 9}.com"]), rng.choice("xyz")
        rows.append((i, f"http://{host}/{part}/{rng.randint(1, 99)}",
                     f"<body><div>Menu of {host}</div><div>Part {part}</div><p>text {i}</p><div>End</div></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    ties = spark.createDataFrame(
        [(1, "http://t.com/1", f"<p>top</p><p>{i % 3}</p><p>{i}</p>") for i in range(12)] + [(None, None, "<p>n</p>")] * 3,
        df.schema)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(name) for name in names]
    seen = []
    try:
        for width, coalesce in ((1, "true"), (5, "false"), (40, "false"), (40, "true")):
            spark.conf.set(names[0], width)
            spark.conf.set(names[1], coalesce)
            assert {r.page_id: r.text for r in html_extract(df).collect()} == nearest_texts(rows), width
            seen.append(sorted(map(repr, html_extract(df.union(ties)).collect())))
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert len(seen[0]) == 105 and all(one == seen[0] for one in seen)
