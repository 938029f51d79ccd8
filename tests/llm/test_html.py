import math
import random

import pytest

from orderloom.llm import html

P = "The quick brown fox jumps over the lazy dog and runs on through the wide green field until the evening comes at last. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_article_among_menus_adverts_and_footer():
    got = html.main_text(
        page(
            '<nav><a href="/a">Menu</a></nav><!-- c --><div class="ad">Buy this</div><article><h1>Head &amp; line</h1>'
            f"<p><b>First<br>\n line.<br><p>{P}</p><p>Is &lt;b&gt; &eacute;</article><footer>&copy; us</footer>"
        )
    )
    assert got == f"Head & line\n\nFirst line.\n\n{P.strip()}\n\nIs <b> é"


def test_density_finds_the_content_without_names():
    links = "".join(f'<li><a href="/{k}">Topic number {k} of many</a></li>' for k in range(20))
    got = html.main_text(
        page(f"<div><ul>{links}</ul></div><div><div><h2>About the fox</h2><p>{P}</p><p>{P}{P}</p></div></div><div>short line</div>")
    )
    assert got.startswith("About the fox\n\n") and "Topic" not in got and got.count("\n\n") == 2


def test_sidebars_comments_forms_and_notices_go():
    got = html.main_text(
        page(
            f'<header><h1>Site</h1></header><main><article><header><h1>Story</h1></header><p>{P}</p>'
            f'<form><label>Mail</label><input></form><ul><li>one<li>two</ul></article></main>'
            f'<section id="comments"><p>{P}</p></section><div class="site-sidebar"><p>{P}</p></div><div role="alert">Cookies</div>'
        )
    )
    assert got == f"Story\n\n{P.strip()}\n\none\n\ntwo"


def test_articles_keep_title_lighter_sections_and_direct_text():
    many = f"<section>{f'<p>{P * 3}</p>' * 5}</section>"
    items = "<ul>" + "".join(f"<li>item {k}" for k in range(6)) + "</ul>"
    rest = f"<section><h2>Parts</h2>{items}</section><section><h2>More</h2><p>{P}</p><p>{P}</p></section>"
    for wrap in ("<article>{}</article>", "<main><div>{}</div></main>", "<div>{}</div>"):
        got = html.main_text(page(wrap.format(f"<h1>The title</h1>direct text{many}{rest}")))
        assert got.startswith("The title\n\ndirect text\n\nThe quick") and "Parts\n\nitem 0" in got and got.count("fox") == 17
    got = html.main_text(page(f"<h1>The title</h1>{many}{rest}"))
    assert got.startswith("The title") and "item 5" in got and got.count("fox") == 17


def test_wrappers_with_telling_names_keep_the_content():
    side = f'<div class="sidebar"><p>{P}</p></div>'
    for name in ('div class="has-sidebar"', 'div class="content no-sidebar"', 'div id="post" class="post comments-open"', 'form action="/"'):
        tag = name.split()[0]
        for body in (f"<article><h1>Title</h1><p>{P * 3}</p></article>", f"<h1>Title</h1><p>{P * 3}</p>", f"<p>{P * 3}</p>"):
            got = html.main_text(page(f"<{name}>{body}{side}</{tag}>"))
            assert got.count("fox") == 3 and ("Title" in got) == ("h1" in body)
    got = html.main_text(page(f'<article><p>{P}</p><section id="social-impact"><h1>Impact</h1><p>{P}</p></section></article>'))
    assert got.count("fox") == 2
    comments = f'<section id="comments"><ol>{f"""<li><article class="comment-body"><p>{P * 9}</p></article>""" * 3}</ol></section>'
    assert html.main_text(page(f"<article><p>{P}</p></article>{comments}")) == P.strip()


def test_comments_adverts_and_notices_go_wherever_they_stand():
    story = f"<h1>Story</h1><p>{P * 2}</p>"
    long = f"<h1>Loud head</h1><p>{P * 3}</p>"
    kept = f"Story\n\n{(P * 2).strip()}"
    comment = f'<article class="comment"><p>{P}</p></article>'
    for rest in (
        f'<section id="comments"><article><p>{P * 3}</p></article></section>',
        f'<ol class="comment-list"><li>{comment}</li><li>{comment}</li></ol>',
        f'<div class="newsletter">{long}</div>', f'<div class="ad-slot-2">{long}</div>', f'<div class="cookie-notice">{long}</div>',
        f'<div id="newsletter-signup">{long}</div>', '<p class="copyright">Copyright 2024 by nobody at all, all rights are reserved here</p>',
    ):
        assert html.main_text(page(f"<article>{story}</article>{rest}")) == kept, rest
        assert html.main_text(page(f"<article>{story}{rest}</article>")) == kept, rest
        assert html.main_text(page(f"<main>{story}{rest}</main>")) == kept, rest
    assert html.main_text(page(f"<main>{story}{comment}</main>")) == kept
    assert html.main_text(page(f"<article>{story}{comment}{comment}</article>")) == kept
    assert html.main_text(page(f"<div>{story}</div><div id='disqus_thread'><p>{P * 9}</p></div>")) == kept
    assert html.main_text(page(f"<article>{story}</article><p>A line beside it that is no part of it</p>")) == kept


def naive(tree):
    """Density and sums of every node from nested dictionaries, by the definition."""
    def build(k):
        return {
            "k": k, "tag": tree.tag[k], "text": "".join(i for i in tree.items[k] if isinstance(i, str)),
            "children": [build(i) for i in tree.items[k] if not isinstance(i, str) and not tree.dropped[i]],
        }

    def walk(node):
        yield node
        for c in node["children"]:
            yield from walk(c)

    def letters(node, linked=False, only_links=False):
        linked = linked or node["tag"] == "a"
        own = len("".join(node["text"].replace("\xa0", " ").split())) if linked or not only_links else 0
        return own + sum(letters(c, linked, only_links) for c in node["children"])

    def within_link(k):
        return k > 0 and (tree.tag[k] == "a" or within_link(tree.parent[k]))

    root = build(0)
    body = next((n for n in walk(root) if n["tag"] == "body" and letters(n)), root)
    share = letters(body, only_links=True) / max(1, letters(body))
    density, sums = {}, {}
    for node in walk(root):
        c, lc = letters(node), letters(node, within_link(node["k"]), True)
        below = [x for x in walk(node) if x is not node]
        t = max(1, sum(x["tag"] not in html.INLINE for x in below))
        lt = max(1, sum(x["tag"] == "a" for x in below))
        found = 0.0
        if c and node["tag"] not in html.INLINE:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            ratio = c / max(1, lc) * t / lt
            found = c / t * max(0.0, math.log(ratio) / math.log(base) if base > 1 and ratio > 0 else 0.0 if base > 1 else math.log(max(c, 2)))
        density[node["k"]] = found
    for node in walk(root):
        sums[node["k"]] = sum(density[c["k"]] for c in node["children"])
    inside = [x["k"] for x in walk(body)]
    return density, sums, body["k"], max(sorted(inside), key=lambda k: (sums[k], -k))


def test_densities_and_their_sums_equal_a_naive_count():
    rnd = random.Random(12)

    def some(depth):
        tag = rnd.choice(["div", "p", "section", "a", "span", "ul", "li", "b", "nav", "article"])
        inner = "".join(some(depth - 1) for _ in range(rnd.randrange(4))) if depth else ""
        words = " ".join("word" * rnd.randrange(1, 3) for _ in range(rnd.randrange(9)))
        return f'<{tag} class="{rnd.choice(["", "", "x", "ad", "sidebar"])}">{words}{inner}</{tag}>{rnd.choice(["", " tail"])}'

    for _ in range(150):
        tree = html.Tree(page("".join(some(4) for _ in range(4))))
        _, _, dense, total, body, best = html.scores(tree)
        density, sums, naive_body, naive_best = naive(tree)
        assert body == naive_body and best == naive_best
        for k, v in density.items():
            assert dense[k] == pytest.approx(v) and total[k] == pytest.approx(sums[k])


def test_odd_pages():
    assert html.main_text("") == ""
    assert html.main_text("<html><body></body></html>") == ""
    assert html.main_text("just text &amp; more\n here") == "just text & more here"
    assert html.main_text("<p>a<p>b") == "a\n\nb"
    assert html.main_text("<div>" * 5000 + P + "</div>" * 5000) == P.strip()
    assert html.main_text("<p>" + P * 3000 + "</p>").count("fox") == 3000
    assert html.main_text("</div></p><b>x</i>") == "x"
    assert html.main_text("<table><tr><td>a<td>b<tr><td>c</table>") == "a b\n\nc"


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>x</p>"), (3, "u", "<p>x</p>"), (None, "u", "<p>y")]
    pages = spark.createDataFrame([(*r, "own", "own") for r in rows], "page_id long, url string, html string, n_chars string, tag string")
    got = html.extract(pages).select("page_id", "url", "text", "n_chars", "tag").collect()
    assert [tuple(r) for r in got] == [
        (1, "u", "", 0, "own"), (2, None, "", 0, "own"), (3, "u", "x", 1, "own"), (3, "u", "x", 1, "own"), (None, "u", "y", 1, "own")
    ]
    assert html.extract(pages.where("false")).collect() == []
