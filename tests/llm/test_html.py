from wareline.llm import html_blocks as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<header><a href="/">Home of all</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use them for all that you can think of, and a little more than that.</div>
<article><header><h1>A&nbsp;title</h1></header><p>First <a href=x>linked</a>
  words.<p>Second &lt;b&gt; &copy; &am</p><div class="ad">Buy this &amp; that</div><!-- <p>no</p> -->
<aside>More on it</aside><p>Last</p></article>
<section id="comments"><p>I liked it a lot, and so did all the others that were there.</p></section>
<form><label>Mail</label><input></form><footer>&copy; us</footer></body></html>"""

TEXT = "A title\nFirst linked words.\nSecond <b> © &am\nLast"


def test_article_without_furniture():
    assert H.main_text(PAGE, H.trained_tree()) == TEXT


def test_broken_markup():
    tree = H.trained_tree()
    assert H.main_text("", tree) == ""
    assert H.main_text("<article><p>a b<p>c<", tree) == "a b\nc<"
    assert H.main_text("<article><p>kept</p><!-- open <p>gone", tree) == "kept"
    assert H.main_text("<article><p title='a>b'>x</p><script>if(a<b)", tree) == "x"
    assert H.main_text("<nav>" * 3000 + "x", tree) == ""
    assert H.main_text("<article>" + "<p>word</p>" * 5000, tree) == "\n".join(["word"] * 5000)


def test_end_tags_left_out():
    tree = H.trained_tree()
    article = "<article><p>All of it</article><p>bye"
    for tag, inner in (
        ("aside", "<table>" + "<tr><td>x" * 40), ("nav", "<dl>" + "<dt>a<dd>b" * 40),
        ("form", "<select>" + "<optgroup><option>a" * 40), ("aside", "<ul>" + "<li><p>x" * 40),
        ("nav", "<div>" * 100), ("aside", "<p class=ad>x"),
    ):
        assert H.main_text(f"<{tag}>{inner}</{tag}>{article}", tree) == "All of it", inner
    # A mark ends with its element: cells, terms and paragraphs on each other.
    for marked in ("<table><tr><td class=ad>x<th>", "<table><tr class=ad><td><p>x<tr><td>",
                   "<dl><dt class=ad>x<dd>", "<p class=ad>x<div>"):
        assert H.main_text(f"<article>{marked}kept", tree) == "kept", marked
    # A nested table or list stays in its cell or item.
    assert H.main_text("<article><table><tr><td class=ad><table><tr><td>x<td>y</table>z<td>kept", tree) == "kept"
    assert H.main_text("<article><ul><li class=ad><ul><li>x<li>y</ul>z<li>kept", tree) == "kept"
    for start in ("<body>", "", "<div>", "<b>"):
        page = f"<html><head><title>T</title><meta a=b>\n{start}<article>kept"
        assert H.main_text(page, tree) == "kept", start
    assert H.main_text("<head><title>T</title><noscript>x</noscript>" + "a word " * 40, tree)
    assert H.main_text("<article>" + "<div>" * 30000 + "</b></i></p></td>" * 30000 + "x", tree) == "x"


WORDS = "one of the many lines that a page may hold, long enough to be a part of its text"


def test_marks_that_name_more_than_one_thing():
    tree = H.trained_tree()
    article = f"<article><p>All of it</p><p>{WORDS}</p></article>"
    whole = f"All of it\n{WORDS}"
    for beside in ("<section class='article-comments'>{}</section>", "<div class=story-related>{}</div>",
                   "<article class=comment>{}</article>", "<main id=replies>{}</main>",
                   "<form class=search>{}</form>", "<form><p>{}</form>",
                   "<form class=comments><article>{}</article></form>",
                   "<form><aside><article>{}</article></aside></form>"):
        assert H.main_text(article + beside.format(f"<p>{WORDS}</p>"), tree) == whole, beside
    for around in ("<div class='layout with-sidebar'>{}</div>", "<form>{}</form>",
                   "<form><div>{}</div></form>", "<div class='post has-comments'>{}</div>",
                   "<form><div class=ad>x</div><div>{}</div></form>", "<div class=theme-header>{}</div>"):
        assert H.main_text(around.format(article), tree) == whole, around
    results = f"<div class='page-search-results has-sidebar'><p>{WORDS}</p><p>{WORDS}</p></div>"
    assert H.main_text(results, tree) == f"{WORDS}\n{WORDS}"


def test_links_go_on_over_blocks():
    tree = H.trained_tree()
    cards = f"<a href=/x><div><h3>A card of it</h3><p>{WORDS}</p></div></a>" * 3
    assert {b.linked / b.words for b in H.blocks_of(cards)} == {1.0}
    text = f"<p>{WORDS} {WORDS} {WORDS}</p>" * 2
    plain = "\n".join([f"{WORDS} {WORDS} {WORDS}"] * 2)
    assert H.main_text(text + cards, tree) == plain
    assert H.main_text(text + "<p>Copyright of the owners, all rights are kept, ask before any use</p>",
                       tree) == plain
    # A link ends with its element, at the next link and at its end tag; a name is no link.
    for page in ("<p><a href=x>a</p><p>b", "<p><a href=x>a<a name=y></p><p>b", "<a name=top><p>a</p><p>b",
                 "<p><a href=x>a</a></p><p>b"):
        assert [b.linked for b in H.blocks_of(page)][1:] == [0], page


def test_extract_keeps_rows(spark):
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (2, None, None, "y", 2), (None, "v", "", "z", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = H.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in got) == [
        (0, 0, 0), (1, len(TEXT), len(TEXT)), (1, len(TEXT), len(TEXT)), (2, 0, 0)]
    assert H.extract(pages.limit(0)).count() == 0
