"""Main text: markup roles, repeated substrings against brute force."""

import random

import pytest

from personweave.llm.extract import blocks, host_of, main_text
from tests.llm.common import clashing

SCHEMA = "page_id long, url string, html string"
NOTE = "subscribe to our weekly letter to read all that is new on this site"


def texts(spark, pages, **settings):
    return {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, SCHEMA), **settings).collect()}


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>Title</title>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>Head</h1><p>One &amp; two&nbsp;<b>bold</b>.<p>Three<br>four &lt;x&gt; &#233;</article>"
MAIN = "Head\n\nOne & two bold.\n\nThree four <x> é"
NOISE = [
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<header>Site name</header>", "<footer>&copy; 2020</footer>", "<aside>Side</aside>",
    "<div class='ad banner'>Buy</div>", "<div id=\"cookie-notice\">We use cookies</div>", "<form><label>Name</label><input><button>Go</button></form>",
    "<script>var t='</p>';</script>", "<style>p{}</style>", "<!-- comment <p>x</p> -->", "<section class='comments'><p>First!</p></section>",
    "<div class=sidebar><p>Links</p></div>", "<noscript>Turn on</noscript>", "<div role=navigation>Menu</div>", "<div hidden>Secret</div>"]


@pytest.mark.parametrize("noise", NOISE)
@pytest.mark.parametrize("where", ["before", "after", "within"])
def test_boilerplate_goes(spark, noise, where):
    if where == "within" and "header" in noise:
        return  # the header of an article holds its title
    body = {"before": noise + ARTICLE, "after": ARTICLE + noise, "within": ARTICLE.replace("<p>Three", noise + "<p>Three")}[where]
    found = "\n\n".join(t for t, aside, article in blocks(page(body)) if article and not aside)
    assert found == MAIN


@pytest.mark.parametrize("html,want", [
    ("", []), ("   ", []), ("plain text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("<p>a &am", ["a &am"]), ("<p>x &amp", ["x &"]),
    ("<p>a <i>b</i>c</p>d", ["a bc", "d"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<p>cut <b", ["cut"]), ("<p>a\n\t b c", ["a b c"]),
    ("<ul><li>a<li>b</ul>", ["a", "b"]), ("<table><tr><td>a<td>b</table>", ["a", "b"]), ("</p></div>x", ["x"]), ("<p>5 < 6 & 7</p>", ["5 < 6 & 7"])])
def test_blocks(html, want):
    assert [t for t, _, _ in blocks(html)] == want


def test_hosts():
    assert host_of("https://User@A.Example.com:80/x?y") == "a.example.com"
    assert host_of(None) == host_of("nothing") == host_of("") == ""


def test_repeats_of_a_host_go_and_unique_runs_stay(spark):
    common = "all rights reserved by the people who own this site and nobody else"
    pages = [(i, f"http://h.example/{i}", page(f"<div><p>unique words number {i} of this page stand here</p></div><div>{common}</div>")) for i in range(4)]
    pages += [(10 + i, f"http://other{i}.example/", pages[0][2]) for i in range(3)]
    out = texts(spark, pages)
    assert all(out[i] == f"unique words number {i} of this page stand here" for i in range(4))
    assert all(out[10 + i].endswith(common) for i in range(3))


def test_mirrored_articles_stay(spark):
    pages = [(i, "http://h.example/", page(f"<article><p>{'the very same article text again and again ' * 3}</p></article>")) for i in range(5)]
    assert all(out.startswith("the very same") for out in texts(spark, pages).values())


def brute_force(pages, depth, least, cover):
    """Main text by comparing every run of tokens with every other."""
    found = {i: (host_of(u), blocks(h)) for i, u, h in pages}
    stream = {i: [w for t, _, article in b if not article for w in t.lower().split()] for i, (_, b) in found.items()}
    seen = {}
    for i, (host, b) in found.items():
        for k in range(len(stream[i]) - depth + 1):
            seen.setdefault((host, tuple(stream[i][k:k + depth])), set()).add("\n".join(t for t, _, _ in b))
    out = {}
    for i, (host, b) in found.items():
        runs = [k for k in range(len(stream[i]) - depth + 1) if len(seen[host, tuple(stream[i][k:k + depth])]) >= least]
        anywhere, place, kept = {x for k in runs for x in range(k, k + depth)}, 0, []
        for text, aside, article in b:
            if article:
                kept += [] if aside else [text]
                continue
            words, start = text.split(), place
            place += len(words)
            own = {x for k in runs if start <= k and k + depth <= place for x in range(k, k + depth)}
            if aside or anywhere >= set(range(start, place)):
                continue
            if cover is None and own:
                text = " ".join(w for x, w in enumerate(words, start) if x not in own)
            elif own and len(own) >= cover * len(words):
                continue
            kept.append(text)
        out[i] = "\n\n".join(kept)
    return out


@pytest.mark.parametrize("cover", [None, 0.8])
def test_repeats_against_brute_force(spark, cover):
    rng = random.Random(4)
    runs = [[rng.choice("abcdefgh") for _ in range(rng.randrange(3, 12))] for _ in range(8)]

    def part(n):
        return " ".join(" ".join(rng.choice(runs) if rng.random() < 0.6 else [rng.choice("abcdefgh") for _ in range(n)]) for _ in range(rng.randrange(1, 5)))
    shapes = ["<p>{}</p>", "<article><h2>{}</h2><p>{}</p></article>", "<nav>{}</nav>", "<ul><li>{}<li>{}</ul>", "<article><p>{}</p><div class=ad>{}</div></article>"]
    pages = []
    for i in range(60):
        chosen = [rng.choice(shapes) for _ in range(4)]
        pages.append((i, f"http://h{i % 3}.example/", "".join(x.format(part(9), part(2)) for x in chosen)))
    pages += [(100 + i, *pages[i][1:]) for i in range(5)]
    assert texts(spark, pages, depth=5, least_pages=3, cover=cover) == brute_force(pages, 5, 3, cover)


def test_registered_setting_against_brute_force(spark):
    rng = random.Random(8)
    menu = "".join(f"<li>{w}</li>" for w in "Home News Sports Arts Travel Weather Contact About Shop".split())
    pages = []
    for i in range(40):
        own = " ".join(rng.choice(["stone", "river", "cloud", "harbour", "winter", "north"]) for _ in range(60))
        note = f"<div>{NOTE}</div>" if i % 2 else f"<div>{NOTE} and so on {i}</div>"
        body = f"<article><h1>Weekly report on the state of the northern harbour works</h1><p>The harbour {own}</p><p>{NOTE}</p></article>"
        pages.append((i, f"http://h{i % 2}.example/{i}", f"<ul>{menu}</ul>{body if i % 4 else f'<p>{own}</p>'}{note}"))
    found = texts(spark, pages)
    assert found == brute_force(pages, 8, 3, None)
    assert all(found[i].startswith("Weekly report on the state of the northern harbour works\n\nThe harbour") for i in range(40) if i % 4)
    assert not any("Sports" in t for t in found.values())


def test_odd_rows(spark):
    pages = [(1, None, None), (2, "http://a/", ""), (None, "http://a/", "<p>x"), (3, None, ARTICLE), (3, None, ARTICLE), (4, "http://a/", "<p>long " + "word " * 200_000)]
    out = main_text(clashing(spark.createDataFrame(pages, SCHEMA))).collect()
    rows = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in out if r.page_id in (1, 2, 3)), key=str)
    assert rows == [(1, None, "", 0), (2, "http://a/", "", 0), (3, None, MAIN, len(MAIN)), (3, None, MAIN, len(MAIN))]
    assert len(out) == 6 and max(r.n_chars for r in out) == 5 + 5 * 200_000 - 1


def test_empty_table(spark):
    assert texts(spark, []) == {}


@pytest.mark.parametrize("head", [
    "<script>if(a.indexOf(\"<!--\")>0)x();</script>", "<script><!-- x();</script>", "<style><!-- p{}</style>", "<textarea><!-- </textarea>",
    "<a title='<!--'></a>", "<textarea><!--</textarea><!-- c -->"])
def test_comment_marks_that_open_no_comment(head):
    assert [t for t, _, _ in blocks(head + "<article><p>Main text</p></article>")] == ["Main text"]


def test_unclosed_comment_ends_the_page():
    assert [t for t, _, _ in blocks("<p>a</p><!-- b <p>c</p>")] == ["a"]
    assert [t for t, _, _ in blocks("<p>a</p><!-- b --><p>c</p><!-- d")] == ["a", "c"]


@pytest.mark.parametrize("wrapper", [
    "form id='aspnetForm'", "div class='layout with-sidebar'", "div class='no-sidebar'", "div class='has-comments'", "div class='menu-open'",
    "div class='content-widget'", "div class='overlay'", "aside", "section class='sidebar'"])
@pytest.mark.parametrize("inner", ["article", "main", "div role=main"])
def test_articles_in_wrappers_stay(wrapper, inner):
    tag = wrapper.split()[0]
    found = blocks(page(f"<{wrapper}><nav>Menu</nav><{inner}><p>Main text</p><div class=ad>Buy</div></{inner.split()[0]}><p>Out</p></{tag}>"))
    assert [t for t, aside, article in found if article and not aside] == ["Main text"]


@pytest.mark.parametrize("name", ["with-sidebar", "no-sidebar", "has-comments", "menu-open"])
def test_names_of_states_are_no_boilerplate(name):
    assert blocks(f"<div class='{name}'><p>Text</p></div>") == [("Text", False, False)]


@pytest.mark.parametrize("name", ["site-footer", "left-sidebar", "comment-list", "related-links", "ad-300", "cookie_notice", "nav2"])
def test_compound_names_of_boilerplate(name):
    assert [b[1] for b in blocks(f"<div class='{name}'><p>Text</p></div>")] == [True]


def test_boilerplate_in_articles_and_comments_stays_out():
    html = "<article><p>Main</p><aside><article>Teaser</article></aside></article><div class=comments><article class=comment>First!</article></div>"
    assert [t for t, aside, _ in blocks(html) if not aside] == ["Main"]




def test_articles_stay_whole(spark):
    """Headings and lines that many articles share stay; the same line outside articles goes."""
    bodies = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(4)]
    head = "Weekly report on the state of the northern harbour works"
    pages = [(i, "http://h.example/", page(f"<article><h1>{head}</h1><p>The harbour {b}</p><p>{NOTE}</p></article><div>{NOTE}</div>")) for i, b in enumerate(bodies)]
    assert texts(spark, pages) == {i: f"{head}\n\nThe harbour {b}\n\n{NOTE}" for i, b in enumerate(bodies)}


def test_marks_end_at_block_edges(spark):
    """A repeated heading and the equal first words of unique blocks make a long run, but the unique blocks keep them."""
    pages = [(i, "http://h.example/", f"<p>{NOTE}</p><p>The harbour {' '.join(f'u{i}x{k}' for k in range(9))}</p>") for i in range(5)]
    assert texts(spark, pages) == {i: f"The harbour {' '.join(f'u{i}x{k}' for k in range(9))}" for i in range(5)}


def test_given_articles_are_main_text(spark):
    """Nothing is lost of what markup puts into articles and does not name boilerplate."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in main_text(table).collect()}
    want = {r.page_id: "\n\n".join(t for t, aside, article in blocks(r.html or "") if article and not aside) for r in table.collect()}
    assert found == want


def test_copies_count_once_and_near_copies_stay(spark):
    body = " ".join(f"word{k}" for k in range(40))
    copies = [(i, "http://h.example/", f"<div><p>{body} {NOTE}</p></div>") for i in range(5)]
    near = [(10 + i, "http://h.example/", f"<article><p>{body} changed{i} {body[::-1]}</p></article>") for i in range(4)]
    assert texts(spark, copies, cover=None) == {i: f"{body} {NOTE}" for i in range(5)}
    assert texts(spark, near, cover=None) == {10 + i: f"{body} changed{i} {body[::-1]}" for i in range(4)}


def test_unique_runs_of_covered_blocks_stay(spark):
    pages = [(i, "http://h.example/", f"<div><p>{NOTE} only{i} here{i}</p></div><p>{' '.join(f'u{i}x{k}' for k in range(30))} {NOTE}</p>") for i in range(4)]
    assert texts(spark, pages, cover=None) == {i: f"only{i} here{i}\n\n" + " ".join(f"u{i}x{k}" for k in range(30)) for i in range(4)}
