import math
import random

from clientele.llm import site_tree
from clientele.llm.site_tree import Importance, branch_importance, extract, parse, parse_blocks
from tests.llm.data import CLASHES

SCHEMA = "page_id bigint, url string, html string, " + ", ".join(f"{c} string" for c in CLASHES)


def texts_of(page):
    blocks, _ = parse(page)
    best = max((scope for _, scope, _ in blocks), default=0)
    return [text for text, scope, _ in blocks if scope == best]


def pages(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], SCHEMA)


def test_blocks_of_awkward_markup():
    page = """<!DOCTYPE html><head><title>No</title><script>if (a < b) "</p>"</script></head><body>
    <header><h1>Site</h1></header><nav><a>menu</a></nav><div class="cookie-notice">We use</div>
    <div role="main"><p>One &lt;two&gt;&nbsp;three<br>four <a href="x>y">li<b>n</b>k</a>
    <ul><li>a<li>b &amp;amp; c</ul><!-- not <p>this --><table><tr><td>1<td>2</table>
    <p hidden>No</p><div class=comments><p>No</div><form>f</form><div style="display: none">No</div>
    last</div><aside>s</aside><footer>z"""
    assert texts_of(page) == ["One <two> three four link", "a", "b &amp; c", "1 2", "last"]


def test_article_before_main_before_all():
    article = "<main><p>outside</p><article><header><h1>Title</h1></header><p>in <i>it</i></article></main>"
    assert texts_of(article) == ["Title", "in it"]
    assert texts_of("<p>no</p><main><p>main</main>") == ["main"]
    assert texts_of("just text") == ["just text"]
    assert texts_of("<article><p>a</p><article class='comment'><p>no</article></article>") == ["a"]


def test_broken_pages():
    assert texts_of("") == [] and texts_of("<p") == [] and texts_of("<!-- open") == []
    assert texts_of("<p>cut &am") == ["cut &am"]
    assert texts_of("</div></p>a</b>b<div>c</span>d") == ["ab", "cd"]
    assert texts_of("<b>" * 3000 + "deep" + "<div>" * 3000 + "est") == ["deep", "est"]


def site(n, host="a.example"):
    """A site whose template has an unnamed box with the same words on each page."""
    out = []
    for i in range(n):
        body = f"<p>Story {i} tells of {i * 7}.</p><p>It ends with {i * 13}.</p>"
        out.append((i, f"https://{host}/p/{i}", f"<body><div><span>Welcome to our site</span></div><div class=b{i}>{body}</div></body>"))
    return out


def test_branches_that_are_the_same_on_all_pages_go(spark):
    rows = site(30)
    found = {r["page_id"]: r["text"] for r in extract(pages(spark, rows)).collect()}
    assert found == {i: f"Story {i} tells of {i * 7}.\nIt ends with {i * 13}." for i in range(30)}


def test_a_few_pages_are_no_evidence(spark):
    found = extract(pages(spark, site(5))).collect()
    assert all(r["text"].startswith("Welcome to our site\nStory") for r in found)


def test_copies_and_pages_of_template_alone_stay(spark):
    copies = [(100 + i, "https://b.example/x", "<article><p>The same article.</p></article>") for i in range(40)]
    bare = [(200, "https://a.example/bare", "<body><div><span>Welcome to our site</span></div></body>")]
    found = {r["page_id"]: r["text"] for r in extract(pages(spark, site(30) + copies + bare)).collect()}
    assert all(found[100 + i] == "The same article." for i in range(40))
    assert found[200] == "Welcome to our site"


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (None, "nonsense", None), (2, "//h.example", ""), (3, "x", "<p>𝒹é " + "w " * 200_000)]
    found = sorted(extract(pages(spark, rows)).collect(), key=str)
    assert [(r["page_id"], r["n_chars"]) for r in found] == [(1, 1), (1, 1), (2, 0), (3, 400_002), (None, 0)]
    assert extract(pages(spark, [])).collect() == []


def main_text(spark, page):
    return extract(pages(spark, [(1, "https://one.example/", page)])).first()["text"]


def test_pages_keep_all_of_their_text(spark):
    story = "The main text of the page goes on and on. " * 5
    cases = {
        f"<article class='card'><p>Teaser</p></article><div class='story'>{story}</div>": "Teaser\n" + story.strip(),
        "<main><article>First</article><p>Second part</p></main>": "First\nSecond part",
        f"<div class='notice-board'>{story}</div><p>More</p>": story.strip() + "\nMore",
        f"<div class='article-header'><h1>Title</h1></div><p>{story}</p>": "Title\n" + story.strip(),
        f"<article><p>{story}</p><div class='related-work'>Others did more.</div></article>": story.strip() + "\nOthers did more.",
        f"<div class='ad-slot'>Buy</div><div id='site-header'>Site</div><p>{story}</p><section class=comments>{story * 30}</section>": story.strip(),
        f"<div class='widget'><p>{story}</p></div><p>by</p>": story.strip() + "\nby",
        f"<nav>{story * 9}</nav><form>{story * 9}</form><p>Short</p>": "Short",
    }
    for page, text in cases.items():
        assert main_text(spark, page) == text, page


def test_menus_without_telling_tags_go_by_the_tree(spark):
    menu = "<div class=x1><span>Home</span> <span>World</span></div><div class=x1>Sport</div>"
    rows = [(i, f"https://m.example/{i}", f"<body>{menu}<nav>Menu</nav><div class=y>Story {i} of {i * 31}</div><p class=z>All rights</p></body>") for i in range(40)]
    for r in extract(pages(spark, rows)).collect():
        assert r["text"] == f"Story {r['page_id']} of {r['page_id'] * 31}"
        # The menu in nav is the same on all pages, too, and goes by the tree before its tag.
        assert (r["by_tree"], r["by_tag"], r["by_word"]) == (4, 0, 0)


def test_importance_by_brute_force(spark):
    rng = random.Random(3)
    limits = Importance(pages=5)
    rows = []
    for i in range(60):
        body = "".join(f"<{t} class=c{rng.randrange(3)}>{rng.choice(['same', f'own {i}', rng.choice('abcd')])}</{t}>" for t in rng.choices(["p", "div", "h2"], k=rng.randrange(1, 6)))
        rows.append((i, f"https://h{i % 2}.example/{i}", f"<body><div id=x>menu {i % 3}</div>{body}<footer>foot</footer></body>"))
    chosen = pages(spark, rows).select("page_id", "url", "html")
    parsed = chosen.mapInArrow(site_tree._parse_rows, site_tree._PARSED_SQL)
    found = {r["path"]: (r["m"], r["importance"]) for r in branch_importance(parsed, limits).collect()}
    shown, said, seen = {}, {}, set()
    for _, url, page in rows:
        blocks, nodes = parse_blocks(page, url.split("/")[2])
        key = url.split("/")[2], "\n".join(b.text for b in blocks if b.noise == 0)
        for path, style in nodes.items():
            shown.setdefault(path, {}).setdefault(style, set()).add(key[1])
        for b in blocks:
            for path in b.paths:
                said.setdefault(path, {}).setdefault((b.paths[-1], b.text), set()).add(key[1])
    expected = {}
    for path, styles in shown.items():
        m = sum(map(len, styles.values()))
        if m < limits.pages or path not in said:
            continue
        presentation = -sum(len(x) / m * math.log(len(x) / m, m) for x in styles.values())
        content = 1 - min(1, sum(math.log(len(x), m) for x in said[path].values()) / len(said[path]))
        fade = limits.fade ** len(styles)
        expected[path] = m, (1 - fade) * presentation + fade * content
    assert set(found) == set(expected) and len(found) > 10
    for path, (m, value) in expected.items():
        assert found[path][0] == m and abs(found[path][1] - value) < 1e-9
