from __future__ import annotations

import random

import pytest

from quipu.llm import html_extract


def kept(page: str) -> list[str]:
    return [line for line, place in html_extract.text_lines(page) if place != html_extract.SKIPPED]


@pytest.mark.parametrize(
    "page",
    [
        "<body><form id=aspnetForm><div><label>L</label><article>text</article><button>b</button></div></form>",
        "<body><form><p>text</p><select><option>o</select><label>L</label></form>",
        "<body><form action=q><input><article>text</article>",
        "<head><title>t</title><body><article>text</article>",
        "<html><head><meta charset=u><p>text",
        "<body class='post right-sidebar'><p>text</p></body>",
        "<div id='main-with-sidebar'><article>text</article></div>",
        "<div class='page right-sidebar'><article>text</article></div><div class=related><article>t</article></div>",
        "<div class='page sidebar'><main>text</main></div>",
        "<div class='page sidebar'><h1>text</h1></div><div class=sidebar>s</div>",
        "<article class='post comments-open'>text</article>",
        "<p title='a hidden gem' data-role='x nav'>text</p><p HIDDEN>h</p><p style='x:y; Display : none'>d</p>",
    ],
)
def test_no_ancestor_takes_the_main_text(page):
    assert kept(page) == ["text"]


def main(page: str, other: str = "") -> list[str]:
    lines, places = zip(*html_extract.text_lines(page), strict=True)
    near = html_extract.prints_of([line for line, _ in html_extract.text_lines(other)])
    return html_extract.main_lines(lines, places, html_extract.shared_lines(html_extract.prints_of(lines), near))


def test_marked_parts_stay_together():
    assert main("<main><h1>T</h1><p>lead</p><article>part</article><p>more</p></main>") == ["T", "lead", "part", "more"]
    assert main("<main>real text</main><aside><article>teaser</article></aside>") == ["real text"]
    assert main("<nav>x<article>y") == ["y"]
    assert main("<article>a</article><p>menu</p><article>b</article>", "<p>menu</p>") == ["a", "b"]


def test_differencing_decides_between_marked_and_loose_lines():
    text = "<div>A long text without marks.</div>"
    page = f"<div>menu of the site</div>{text}<article>card</article>"
    assert main(page, "<div>menu of the site</div><p>other</p><article>card</article>") == ["A long text without marks."]
    assert main(f"<div>menu of the site</div><article>short {text}</article>", "<div>menu of the site</div>") == ["short", "A long text without marks."]
    around = "<main><p>All news</p><article>own</article><p>Back to the list</p></main>"
    assert main(around, "<main><p>All news</p><article>x</article><p>Back to the list</p></main>") == ["own"]


# --- pairing -------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}


@pytest.mark.parametrize("url", ["http://h.example.com/?p={0}", "http://h.example.com/index.php?id={0}", "page {0}", None])
def test_pages_of_one_path_are_paired(spark, url):
    rows = [(i, url and url.format(i), f"<p>menu</p><p>own text {i}</p>") for i in range(12)]
    assert texts(spark, rows + rows[:5]) == {i: f"own text {i}" for i in range(12)}


def test_other_paths_come_before_pages_of_the_same_path(spark):
    rows = [(i, f"http://h.example.com/a?v={i}", f"<p>menu</p><p>passage</p><p>own {i}</p>") for i in range(6)]
    rows.append((6, "http://h.example.com/b", "<p>menu</p><p>other</p>"))
    got = texts(spark, rows)
    assert all(got[i] == f"passage own {i}" for i in range(6)) and got[6] == "other"


def by_hand(rows):
    """The neighbour of every version, by a walk from each."""
    out = {}
    for i, own in enumerate(rows):
        sides = []
        for step in (-1, 1):
            side = []
            for level in range(html_extract.LEVELS):
                at = i
                while 0 <= at + step < len(rows) and rows[at + step]["host"] == own["host"]:
                    at += step
                    if html_extract.apart(rows[at], rows[at - step])[level]:
                        side.append(rows[at])
                        break
                else:
                    side.append(None)
            sides.append(side)
        out[own["host"], own["digest"]] = html_extract.choose(own, *sides)
    return out


def test_pairing_against_a_walk_from_every_page(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        host = rng.choice(["one", "some", "some", "many", "many"]) if i else "alone"
        path = {"one": "x", "some": f"{rng.randint(0, 2)}", "many": f"{rng.randint(0, 40)}", "alone": ""}[host]
        own = f"<p>{rng.randint(0, 150)} {'text ' * rng.randint(1, 30)}</p>"
        rows.append((i, f"http://{host}.example/{path}?q={rng.randint(0, 3)}", f"<p>menu {rng.randint(0, 2)}</p>{own}"))
    pages = spark.createDataFrame(rows, PAGES)
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    seen = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for n in ("1", "7", "90"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = html_extract.nearest_prints(pages).collect()
            seen.append({(r.host, r.digest): r.near for r in got})
            assert len(got) == len(seen[-1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    kinds = pages.select("url", html_extract.page_prints(pages["html"]).alias("p")).select("url", "p.*").collect()
    first = {}
    for r in kinds:
        rest = r.url.split("://")[1]
        host, path = rest.split("?")[0].split("/")
        key = {"host": host, "path": "/" + path, "query": rest.split("?")[1], "digest": r.digest, "prints": r.prints}
        best = first.setdefault((host, r.digest), key)
        if (key["path"], key["query"]) < (best["path"], best["query"]):
            first[host, r.digest] = key
    want = by_hand(sorted(first.values(), key=lambda k: (k["host"], k["path"], k["query"], k["digest"])))
    assert seen[0] == want and seen[1] == want and seen[2] == want
    assert want[next(k for k in want if k[0] == "alone.example")] is None


@pytest.mark.parametrize("edited", ["", "<p>one more line {0}</p>"])
def test_copies_do_not_take_the_whole_text(spark, edited):
    own = "".join(f"<p>A long paragraph with number {{0}}.{i} of the main text, which stands on this page.</p>" for i in range(40))
    menu = "<div>menu of the site</div>"
    rows = []
    for i in range(5):
        rows.append((3 * i, f"http://h.example.com/{i}", menu + own.format(i)))
        rows += [(3 * i + k, f"http://h.example.com/{i}/print{k}", menu + (own + edited * k).format(i)) for k in (1, 2)]
    rows += [(100, "http://two.example/a", menu + own.format(9)), (101, "http://two.example/b", menu + (own + edited).format(9))]
    got = texts(spark, rows)
    want = [" ".join(line for line, _ in html_extract.text_lines(own.format(i))) for i in range(10)]
    for i in range(5):
        assert [got[3 * i + k] for k in range(3)] == [want[i] + f" one more line {i}" * (k if edited else 0) for k in range(3)]
    assert got[100] == "menu of the site " + want[9] and got[101].startswith(got[100])


def test_furniture_does_not_make_pages_almost_equal():
    nav = "<nav>" + "<p>a long menu line of the site</p>" * 300 + "</nav>"
    pages = [html_extract.text_lines(f"{nav}<div>Imprint</div><p>own text {i}</p>") for i in range(2)]
    prints = [html_extract.weighted(html_extract.prints_of([line for line, _ in p]), p) for p in pages]
    assert not html_extract.almost_equal(*prints) and html_extract.almost_equal(prints[0], list(prints[0]))


OWN = [
    '<p class="share price">The share price rose.</p>',
    '<div class="search results">Twelve boats were found.</div>',
    '<section id="related-work"><h2>Related work</h2><p>Others measured this before.</p></section>',
    '<div class="alert">Do not open the valve under pressure.</div>',
]


@pytest.mark.parametrize("block", OWN)
def test_names_of_an_articles_own_blocks_only_raise_a_doubt(spark, block):
    page = f"<body><nav>Menu</nav><article><h1>Title</h1><p>First part of it.</p>{block}<p>Last part of it.</p></article></body>"
    other = "<body><nav>Menu</nav><article><h1>Else</h1><p>Quite another text.</p><div class='share'>Share this page</div></article></body>"
    shared = page.replace("<h1>Title", "<div class='share'>Share this page</div><h1>Title")
    rows = [(1, "http://h.org/a/1", page), (2, "http://h.org/a/2", other), (3, "http://g.org/a/1", shared), (4, "http://g.org/a/2", other)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = " ".join(line for line, _ in html_extract.text_lines(block))
    assert got[1] == got[3] == f"Title First part of it. {text} Last part of it."
    assert got[4] == "Else Quite another text."  # what the neighbour repeats is furniture


@pytest.mark.parametrize("names", ['id="disqus_thread"', 'class="commentlist"', 'class="comments-area"', 'id="comments"'])
def test_reader_comments_go(names):
    page = f"<article><h1>T</h1><p>Body.</p><ol {names}><li>First!</li><li class='share'>Me too</li></ol></article>"
    assert [line for line, place in html_extract.text_lines(page) if place != html_extract.SKIPPED] == ["T", "Body."]


def test_a_teaser_article_inside_a_doubtful_block_is_doubtful():
    page = "<article><p>Body.</p><div class='related'><article><h2>Teaser</h2></article></div></article>"
    assert html_extract.text_lines(page) == [("Body.", html_extract.ARTICLE), ("Teaser", html_extract.DOUBTFUL)]
