import random
import re
import time
from html import unescape

from conftest import SMALL
from tickloom.llm import html_text
from tickloom.llm.html_text import align, blocks, fold, parse, slot_of

PAGES = "page_id bigint, url string, html string, text string"


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    found = html_text.extract(df).collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return [(r.page_id, r.text) for r in sorted(found, key=lambda r: (r.page_id is None, r.page_id or 0))]


def test_parsing_is_lenient():
    html = "<p><b>One <i>two</i>&amp;&nbsp;three<br>four<p>five</b></p></div>six<script>var t='</p>';</script><li>7<li>8"
    assert blocks(parse(html)) == ["One two& three four", "five", "six", "7", "8"]
    assert blocks(parse("a<!-- <p>x</p> -->b<p title='>'>c")) == ["ab", "c"]
    assert blocks(parse("")) == [] and blocks(parse("<p")) == ["<p"]


def test_trees_fold_and_match():
    a = fold(parse("<body><div><h1>t</h1><p>1<p>2<p>3</div><ul><li>x</ul></body>"))
    b = fold(parse("<body><div class=intro>new</div><div><h1>u</h1><p>9</div></body>"))
    assert [f.label for f in a] == ["html", "body.", "div.", "h1.", "p.", "ul.", "li."]
    pairs = {}
    align(a[0], b[0], pairs, {})
    assert {n: m.label for n, m in pairs.items()} == {0: "html", 1: "body.", 2: "div.", 3: "h1.", 4: "p."}
    assert a[slot_of(a, [0, 0, 0, 1, 30, 0, 1])].label == "div."


def test_template_and_noise_go_content_stays(spark):
    def page(i, title):
        return (f"<html><body><div><span>Site name</span></div><nav>menu {i}</nav><div class='top-ad'>buy {i}</div>"
                f"<div><h1>{title} {i}</h1><p>Body &lt;{i}&gt; text here.</p><p>More of page {i}.</p>"
                f"<form>mail {i}</form></div><p>Terms apply.</p><section class='comments'><p>first! {i}</p></section>"
                "<footer>f</footer></body></html>")

    found = texts(spark, [(i, f"http://a.b/{i}", page(i, "Title")) for i in range(8)])
    assert found == [(i, f"Title {i}\nBody <{i}> text here.\nMore of page {i}.") for i in range(8)]


def test_odd_pages(spark):
    one = "<article><h1>T</h1><p>Only page.</p></article>"
    rows = [(1, None, None), (2, None, ""), (3, "http://x/", one), (3, "http://x/", one), (None, "http://x/", "<p>bare"),
            (5, "http://y/", "plain text  only"), (6, "http://z/", "<nav>x</nav>"), (7, "http://w/", "<p>" + "long " * 50_000)]
    found = texts(spark, rows)
    assert found[:4] == [(1, ""), (2, ""), (3, "T\nOnly page."), (3, "T\nOnly page.")]
    assert found[4:6] == [(5, "plain text only"), (6, "")] and len(found[6][1]) == 249_999
    assert found[7] == (None, "bare")
    assert texts(spark, []) == []


def test_whole_table_against_its_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        parts = (" ".join(unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split())
                 for x in re.split("</?(?:p|h1)>", article))
        assert found[page.page_id] == "\n".join(x for x in parts if x)


def test_many_kinds_of_noise(spark):
    def page(i):
        return f"""<html><body class="has-sidebar page-{i}"><header><h1>Site</h1></header><nav>n{i}</nav>
        <div class='cookie-notice'>We use {i} cookies</div><div id="topnav">t{i}</div>
        <main class="with-sidebar"><article class="post"><header><h1>Head {i}</h1></header><p>One&nbsp;{i} &copy; x</p>
        <div class="ad-slot">Buy {i}</div><ul><li>a {i}</li><li>b</li></ul><blockquote>Q<p>inner {i}</p></blockquote>
        <table><tr><td>c1</td><td>c2</td></tr></table><!-- c --><pre>p
        q</pre><form><label>Mail</label><input></form></article>
        <aside>side {i}</aside><section id="comments"><article class="comment"><p>nice {i}</p></article></section></main>
        <div class="newsletter-box"><p>join {i}</p></div><footer>foot {i}</footer></body></html>"""

    found = texts(spark, [(i, f"http://h/{i}", page(i)) for i in range(7)])
    assert found == [
        (i, f"Head {i}\nOne {i} © x\na {i}\nb\nQ\ninner {i}\nc1\nc2\np q") for i in range(7)]


def test_words_do_not_make_an_article_noise(spark):
    marks = ["class='post tag-social'", "class='category-search'", "id=notice-12", "class=promo"]
    shapes = [f"<{tag} {mark}><h1>Head {{i}}</h1><p>Long body text of page {{i}} here.</p></{tag}>"
              for mark in marks for tag in ("article", "div")]
    shapes.append("<div class=post-related><h1>Head {i}</h1><p>Long body text of page {i} here.</p></div>")
    for n, shape in enumerate(shapes):
        page = "<html><body><nav>menu</nav>" + shape + "<div class=social>like {i}</div></body></html>"
        found = texts(spark, [(i, f"http://h{n}/{i}", page.replace("{i}", str(i))) for i in range(2)])
        assert found == [(i, f"Head {i}\nLong body text of page {i} here.") for i in range(2)], shape


def test_long_comments_stay_noise():
    page = "<body><article><h1>H</h1><p>Short.</p></article><section id=comments><p>" + "words " * 50 + "</section></body>"
    assert blocks(parse(page)) == ["H", "Short."]
    assert blocks(parse(page.replace("<article>", "<div>").replace("</article>", "</div>"))) == ["H", "Short."]


def hosts(spark, body, n=7):
    page = "<html><body><div><span>Site name</span></div>" + body + "<p>Terms apply.</p></body></html>"
    return [t for _, t in texts(spark, [(i, f"http://h/{i}", page.replace("{i}", str(i))) for i in range(n)])]


def test_titles_intros_and_uneven_sections_stay(spark):
    long, items = "<p>" + "Long {i} body. " * 30 + "</p>", "<ul>" + "<li>Item {i} of a long list.</li>" * 30 + "</ul>"
    for body in ("<article><h1>T {i}</h1><div class=body>" + long + "</div></article>",
                 "<div class=post><h1>T {i}</h1><div class=body>" + long + "</div></div>",
                 "<h1>T {i}</h1><section><h2>Summary</h2><p>Short {i}.</p></section><section>" + long + "</section>",
                 "<article><p>Intro {i}.</p>" + items + "</article>", "<p>Intro {i}.</p><div>" + items + "</div>"):
        want = blocks(parse(body))
        for n in (7, 1):
            found = hosts(spark, body, n)
            kept = [] if n == 7 else ["Site name"]
            end = [] if n == 7 else ["Terms apply."]
            assert found == ["\n".join([*kept, *want, *end]).replace("{i}", str(i)) for i in range(n)], body


def test_near_copies_and_shared_headings_stay(spark):
    body = "<article><h1>Same</h1><h2>Summary</h2><p>The same long body of an article.</p></article>"
    for tag in ("article", "div"):
        want = blocks(parse(body))
        found = hosts(spark, "<nav>menu {i}</nav><div>Advert {i}</div>" + body.replace("article>", tag + ">"))
        assert all("\n".join(want) in text for text in found)
    mixed = [body] * 7 + [body.replace("ame", f"ome {i}") for i in range(8)]
    pages = [(i, f"http://h/{i}", f"<body><div>Site</div>{x}<footer>{i}</footer></body>") for i, x in enumerate(mixed)]
    assert texts(spark, pages) == [(i, "\n".join(blocks(parse(x)))) for i, x in enumerate(mixed)]


def test_words_and_ids_decide_nothing_inside_an_article(spark):
    """Headings, sections and other parts of an article whose marks say something else."""
    parts = ["<h2 id='related-work'>Related work</h2>", "<h2 id=search class=search>Search {i}</h2>",
             "<section id=discussion><h2>Discussion</h2><p>We discuss {i}.</p></section>", "<p class=notice>Note {i}.</p>",
             "<blockquote class=social>Quote {i}.</blockquote>", "<div class=feedback><p>Feedback loops of {i}.</p></div>",
             "<ul class=menu><li>Soup {i}</li><li>Fish</li></ul>", "<p id=comments>Comments on {i} from me.</p>",
             "<div id=advertisement><p>How ads {i} work.</p></div>"]
    for tag in ("article", "article class=post", "div"):
        own = parts if tag != "div" else parts[:3] + parts[7:]
        body = f"<{tag}><h1>T {{i}}</h1><p>Intro {{i}}.</p>" + "".join(own) + f"<p>End {{i}}.</p></{tag.split()[0]}>"
        want = ["T {i}", "Intro {i}."] + [
            t for p in own for t in re.sub("<[^>]*>", "\n", p).split("\n") if t] + ["End {i}."]
        for n in (1, 8):
            found = hosts(spark, "<nav>n</nav>" + body, n)
            for i in range(n):
                assert [t for t in found[i].split("\n") if t not in ("Site name", "Terms apply.")] == [
                    t.replace("{i}", str(i)) for t in want], (tag, n)


def test_parts_of_an_article_that_words_and_structure_call_noise(spark):
    gone = ["<div class=share><a href=x>Tweet {i}</a> <a href=y>Mail</a></div>", "<div class=ad><p>Buy {i}</p></div>",
            "<div class='newsletter'><p>Join {i}</p><form><input name=m></form></div>",
            "<section class=discussion><div class=comment>a {i}</div><div class=comment>b</div></section>",
            "<div class=comments><p>nice {i}</p></div>"]
    body = "<article><h1>T {i}</h1><p>Text {i}.</p>" + "".join(gone) + "</article>"
    assert hosts(spark, body) == [f"T {i}\nText {i}." for i in range(7)]
    # The same on every page of the host, and named so.
    body = "<article><h1>T {i}</h1><div class=notice><p>We moved.</p></div><div><p>Not named.</p></div><p>Long text {i} here.</p></article>"
    assert hosts(spark, body) == [f"T {i}\nNot named.\nLong text {i} here." for i in range(7)]
    assert hosts(spark, body, 1) == ["Site name\nT 0\nWe moved.\nNot named.\nLong text 0 here.\nTerms apply."]


def quickly(function, *args):
    start = time.process_time()
    found = function(*args)
    assert time.process_time() - start < (10 if function is pair_up else 4)
    return found


def pair_up(a, b):
    shapes, pairs = {}, {}
    x, y = fold(parse(a), shapes), fold(parse(b), shapes)
    align(x[0], y[0], pairs, {})
    return len(pairs), len(x), len(y)


def test_deep_wide_and_broken_pages_take_linear_time():
    deep = "<div>" * 50_000 + "text" + "</div>" * 50_000
    assert quickly(blocks, quickly(parse, deep)) == ["text"]
    assert quickly(pair_up, deep, deep.replace("text", "<p>more</p>"))[0] == 50_001
    assert quickly(blocks, quickly(parse, "<div class=ad>" * 50_000 + "text")) == []
    row = "<div class=post><div class=head><h2>{0}</h2></div><p>{0}</p>{1}</div>"
    wide = "".join(row.format(i, "<ul><li>x</ul>" * (i % 3)) for i in range(10_000))
    other = "".join(row.format(i, "<ul><li>x</ul>" * (i % 2)) for i in range(9_000))
    assert len(quickly(blocks, quickly(parse, wide))) == 30_000 - 1
    quickly(fold, parse(wide))
    assert quickly(pair_up, wide, wide)[0] == 10_000 * 3 + 10_000 + 9_999 + 1
    matched, n, m = quickly(pair_up, wide, other)
    assert matched > 0.9 * min(n, m)
    mixed = "".join(f"<div class=c{i % 97}><p>x</div>" for i in range(10_000))
    quickly(pair_up, mixed, "<div class=z></div>" + mixed[:200_000])
    for page in ('<a "' * 25_000, "<a '" * 25_000 + '">', '<a "' * 25_000 + '">end', "<!x" * 30_000, "<" * 100_000,
                 "</div>" * 20_000, "<p>" + "</b>" * 30_000, "<!--" * 30_000, "<div>" * 10_000 + "</section>" * 10_000):
        quickly(blocks, parse(page))


def test_matching_against_the_textbook():
    """Weights of random trees against the plain recursion."""
    rng = random.Random(4)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else ""
        return f"<div class={rng.choice('abc')}>{inner}</div>"

    def weight(a, b):
        if a.label != b.label:
            return 0
        best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children, 1):
            for j, y in enumerate(b.children, 1):
                best[i][j] = max(best[i - 1][j - 1] + weight(x, y), best[i - 1][j], best[i][j - 1])
        return 1 + best[-1][-1]

    for _ in range(300):
        shapes, pairs = {}, {}
        a, b = (fold(parse("".join(tree(3) for _ in range(4))), shapes) for _ in range(2))
        align(a[0], b[0], pairs, {})
        assert len(pairs) == weight(a[0], b[0])
        at = {id(f): f.parent for f in b}
        for number, match in pairs.items():
            assert a[number].label == match.label
            if a[number].parent is not None:
                assert pairs[a[number].parent.number] is at[id(match)]


def test_long_child_lists_match_as_short_ones_do():
    """The greatest weight by the plain recursion, for child lists shorter and longer than any block of rows."""
    rng = random.Random(5)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randrange(3))) if depth else ""
        return f"<div class={rng.choice('abc')}>{inner}</div>"

    def weight(a, b, known):
        if a.label != b.label:
            return 0
        if (a.shape, b.shape) not in known:
            above = [0] * (len(b.children) + 1)
            for x in a.children:
                row = [0]
                for j, y in enumerate(b.children, 1):
                    row.append(max(above[j - 1] + weight(x, y, known), above[j], row[-1]))
                above = row
            known[a.shape, b.shape] = 1 + above[-1]
        return known[a.shape, b.shape]

    for n, m in ((20, 200), (200, 20), (63, 64), (65, 66), (150, 130), (300, 280)):
        shapes, pairs = {}, {}
        a, b = (fold(parse("".join(tree(2) for _ in range(k))), shapes) for k in (n, m))
        align(a[0], b[0], pairs, {})
        assert len(pairs) == weight(a[0], b[0], {}), (n, m)
        matches = [pairs[c.number].number for c in a[0].children if c.number in pairs]
        assert matches == sorted(matches)


def test_a_long_list_of_parts_keeps_its_template_and_text(spark):
    """Varying parts between constant ones: what goes and stays does not depend on how many there are."""
    def page(i, n):
        parts = "".join(f"<div class=c{(k * 7 + i * k) % 5}><p>Part {k} of {i}.</p></div>" for k in range(n))
        return f"<body><div class=top><p>Site</p></div>{parts}<div class=end><p>Terms</p></div></body>"

    for n in (20, 120):
        found = texts(spark, [(i, f"http://h/{i}", page(i, n)) for i in range(8)])
        assert found == [(i, "\n".join(f"Part {k} of {i}." for k in range(n))) for i in range(8)]
