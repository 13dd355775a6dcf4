import pytest

from trackmill.llm.html_text import extract_main_text, main_text, marked, nodes_of, path_scores

LONG = "This is a sentence of the article, which goes on for a while. And another one follows it, as they do."


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, expected", [
    (f"<nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Head</h1><p>{LONG}</p><p>Hm.</p></article><footer>&copy; x</footer>",
     f"Head\n{LONG}\nHm."),
    (f"<article><p><b>{LONG}<br><p>Two &amp; three &lt;x&gt; &#233;\n  and</p></article>", f"{LONG}\nTwo & three <x> é and"),
    (f"<header>Site</header><main><header>By me</header><p>{LONG}<script>var t='</p>';</script> on</p></main><aside>Else</aside>",
     f"By me\n{LONG} on"),
    (f"<div class='cookie-notice'>We use cookies, {LONG}</div><article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><div class=comments><article class=comment><p>I say: {LONG}</p></article></div></article>", LONG),
    (f"<article><form><p>Mail: <input></p></form><p>{LONG}</p><!-- <p>gone</p> --></article>", LONG),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{LONG}", f"one\ntwo\na\nb\n{LONG}"),
    (f"<div id=content><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a href=/>x</a> <a href=/>y</a></div>",
     f"{LONG}\nShort.\n{LONG}"),
    (f"<div role=navigation>{LONG}</div><article>{LONG}<em>in</em>line<a href=/>link</a></article>", f"{LONG}inlinelink"),
    ("<nav>only</nav><footer>these</footer>", ""),
])
def test_pages(body, expected):
    assert main_text(page(body)) == expected


@pytest.mark.parametrize("body, expected", [
    # Without article or main: links within paragraphs, headings and short blocks at the ends.
    (f"<div><p>He saw <a href='/x'>Paris</a> in May. {LONG}</p><p>{LONG}</p></div>", f"He saw Paris in May. {LONG}\n{LONG}"),
    (f"<div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><h2>End</h2><ul><li>x</ul></div>", f"Head\n{LONG}\n{LONG}\nEnd\nx"),
    (f"<div><h1>Head</h1><p>{LONG}</p></div>", f"Head\n{LONG}"),
    (f"<div><p>{LONG}</p><ul><li><a href='/x'>one</a><li><a href='/x'>two</a></ul><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    # Words of boilerplate in the class of a wrapper.
    (f"<main class='content has-sidebar'><p>{LONG}</p><div class=sidebar>Else</div></main>", LONG),
    (f"<div class=with-sidebar><article><p>{LONG}</p></article><div class=sidebar>Else</div></div>", LONG),
    (f"<div id=page-social><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p></article><div class=comments><article class=comment>{LONG[:60]}</article>"
     f"<article class=comment>{LONG[:60]}</article></div>", LONG),
])
def test_pages_without_marks_and_wrappers(body, expected):
    assert main_text(page(body)) == expected


@pytest.mark.parametrize("text", ["", " ", "<", "<!--", "<p", "</p>", "<script>x", "<p>" * 2000, "&am", "<article>", "<a href='x", "\x00<b>"])
def test_damaged_pages(text):
    assert isinstance(main_text(text), str)
    assert main_text(f"<article><p>{LONG}</p></article>{text}").startswith(LONG)


def test_bare_text_is_content():
    assert main_text(LONG) == LONG


def test_hints():
    assert marked(' class="post-body" id=main')[0] is False
    assert marked(' class="sidebarWidget"')[0] is True
    assert marked(" hidden")[0] is True
    assert marked(' role="search"')[0] is True


def test_paths_with_text_and_marks_score_higher():
    nodes, _ = nodes_of(page(f"<div><p>{LONG}</p><p>{LONG}</p></div><ul><li>one<li>two<li>three</ul>"))
    scores = path_scores(nodes)
    told = {node.text.strip(): scores[node.path] for node in nodes}
    assert told[LONG] > 3 * told["one"] and told["one"] == told["three"]


def test_table(spark):
    rows = [(1, "u", page(f"<article>{LONG}</article>"), "a", "b"), (1, "u", page(f"<article>{LONG}</article>"), "a", "b"),
            (2, None, None, None, None), (None, "v", "", "a", "b"), (3, "w", page("<article>" + "<p>x, y.</p>" * 5000), "a", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    found = sorted(((r["id"], r["url"], r["n_chars"]) for r in extract_main_text(pages).collect()), key=str)
    assert found == sorted([(1, "u", len(LONG)), (1, "u", len(LONG)), (2, None, 0), (None, "v", 0), (3, "w", 5000 * 6 - 1)], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html, text", [
    ("<p title=it's>One", "One"), ('<a href="x>bad', ""), ('<p>Go on, <a href="x>bad', "Go on, bad"),
    ('<article><p>Long text, here it is, with marks.<div class="share-price"><p>The share price rose, again.</div></article>',
     "Long text, here it is, with marks.\nThe share price rose, again."),
    ('<article><p>Long text, here it is, with marks.<div class="share"><p>The share price rose, again.</div></article>',
     "Long text, here it is, with marks."),
    ('<article><p>Long text, here it is, with marks.<div class="share-price"><p><a>More on it</a> <a>And more</a></div></article>',
     "Long text, here it is, with marks."),
    ("<article><p>Same text, here.</p></article><article><p>Same text, here.</p></article>", "Same text, here.\nSame text, here."),
    ('<article><p>Long text, here it is, with marks.<div class="user-comments"><p>I do not think so, no.</div></article>',
     "Long text, here it is, with marks."),
    ("<script>if (a<b && c>'x) {</script><article><p>Hi, there.", "Hi, there."),
    ("<article><p>Hi, <b title='a>b'>you</b><!-- > ' -- > --> there.<? x ><!y>", "Hi, you there."),
])
def test_markup_and_names(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("html", [
    "<div>" * 100_000 + "text, here." + "</x>" * 100_000, "<p a='>" * 50_000 + "x", '<p a=">' * 50_001, "<li><b>" * 50_000 + "x",
    "<a b=' c=\" >" * 30_000, "<" * 200_000, "<!--" * 50_000, "<script>" * 50_000,
])
def test_time_grows_with_the_page_alone(html):
    import time

    began = time.process_time()
    main_text(html)
    assert time.process_time() - began < 20


def grown(choose, depth, lines, inline):
    """A random tree within an article as HTML; its blocks of text go to ``lines``."""
    out = []
    for _ in range(choose.randint(1, 4)):
        kind = choose.choice(["text", "inline", "block", "drop", "break"])
        if kind == "text":
            word = choose.choice(["One, two.", "three &amp; four", "fünf;", "a &lt; b"])
            out.append(f" {word} ")
            inline.append({"three &amp; four": "three & four", "a &lt; b": "a < b"}.get(word, word))
        elif kind == "inline" and depth:
            out.append(choose.choice(["<b>{}</b>", "<i class='x'>{}</i>", '<span title="a > b">{}</span>']).format(" so, "))
            inline.append("so,")
        elif kind == "block" and depth:
            lines.append(inline[:])
            inline.clear()
            out.append(f"<div data-x=it's>{grown(choose, depth - 1, lines, inline)}</div>")
            lines.append(inline[:])
            inline.clear()
        elif kind == "drop":
            lines.append(inline[:])
            inline.clear()
            out.append(choose.choice(["<nav>Menu, here.</nav>", "<aside><p>Aside, too.</aside>", "<form>Name, please.</form>"]))
        elif kind == "break":
            out.append(choose.choice(["<br>", " \n\t ", "<!-- no, -->", "<script>var x = '<p>';</script>"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(60))
def test_random_articles_against_their_trees(seed):
    import random

    choose, lines, inline = random.Random(seed), [], []
    body = grown(choose, 4, lines, inline)
    lines.append(inline)
    expected = "\n".join([LONG, *[" ".join(line) for line in lines if line]])
    assert main_text(f"<html><body><nav>Home</nav><article><p>{LONG}</p>{body}</article><footer>End, of it.</footer>") == expected
