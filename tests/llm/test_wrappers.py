"""Wrapper inference and extraction."""

import random
import time

import pytest

from mercata.llm import wrappers

SCHEMA = "page_id long, url string, html string, host string, article string, mark int, text string"


def made(i, seed=0, comments=True):
    rng = random.Random(i * 31 + seed)
    say = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    paragraphs = [say(rng.randrange(5, 30)) for _ in range(rng.randrange(1, 6))]
    items = [say(2) for _ in range(rng.randrange(0, 4))]
    body = "".join(f"<p>{p} &amp; <b>bold</b>{'</p>' if rng.random() < 0.7 else ''}" for p in paragraphs)
    listing = "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>" if items else ""
    aside = f"<div class='promo box'>{say(4)}</div>" if rng.random() < 0.5 else ""
    talk = "<section id='comments'>" + "".join(f"<p>{say(6)}</p>" for _ in range(rng.randrange(4))) + "</section>" if comments else ""
    html = (
        f"<!DOCTYPE html><html><head><title>{say(3)}</title><style>p{{a}}</style></head><body><header><h1>Site</h1></header>"
        f"<nav><ul>{''.join(f'<li><a href=x>{say(1)}</a></li>' for _ in range(rng.randrange(2, 6)))}</ul></nav>"
        f"<div class='cookie-notice'>We use cookies and many more words than you would think</div><div id=main-col><div class=post>"
        f"<h2>Title {i}</h2>{aside}{body}<script>var x='<p>no</p>'</script>{listing}<form>Sign <input> up</form></div>{talk}</div>"
        f"<aside>{say(9)}</aside><footer>&copy; {say(3)}</footer></body></html>"
    )
    return html, "\n\n".join([f"Title {i}", *(f"{p} & bold" for p in paragraphs), *items])


def test_templates_without_article_elements(spark, frame):
    pages = [(i, f"https://Host{i % 2}.example:80/p/{i}", made(i)[0], "h", "a", 1, "t") for i in range(40)]
    got = {r.page_id: r for r in wrappers.extract(frame(pages, SCHEMA)).collect()}
    for i in range(40):
        assert got[i].text == made(i)[1], made(i)[0]
        assert got[i].n_chars == len(got[i].text)


def site(i, articles=40, tag="div"):
    """A page of a host whose template has no article element and no telling class names."""
    rng = random.Random(i)
    say = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    lead, body = say(8), [say(rng.randrange(20, 60)) for _ in range(rng.randrange(2, 6))]
    links = "".join(f"<li><a href=x>{say(3)}</a> new" for _ in range(8))
    box = "<div class=zz>Join our mailing club for weekly letters</div>" if i % 4 else ""
    html = (
        f"<body><div class=q1>The Daily Example</div><{tag} class=q2><h1>Story {i}</h1><p class=q5>{lead}</p><div class=body>"
        f"<p>{body[0]}</p>{box}{''.join(f'<p>{p}</p>' for p in body[1:])}</div></{tag}><ul class=q3>{links}</ul><div class=q4>All rights kept by us</div></body>"
    )
    return html, "\n\n".join([f"Story {i}", lead, *body])


@pytest.mark.parametrize("tag", ["div", "article"])
def test_the_wrapper_tells_template_from_text(spark, frame, tag):
    """Fixed texts, optional boxes inside the article and lists of links go because the host repeats them: the pages
    alone don't tell."""
    pages = [(i, f"http://site.example/{i}", site(i, tag=tag)[0], "h", "a", 1, "t") for i in range(40)]
    got = {r.page_id: r.text for r in wrappers.extract(frame(pages, SCHEMA)).collect()}
    for i in range(40):
        assert got[i] == site(i)[1]
        assert wrappers.text_of(pages[i][2]) != site(i)[1] or tag == "article" and not i % 4


def test_copies_of_an_article_are_no_template(spark, frame):
    """Near copies share a text because it is the article, however many there are."""
    story = [" ".join(f"s{j}x{k}" for k in range(30 + j)) for j in range(5)]
    def copy(i):
        return f"<body><div class=q2><h1>Story</h1>{''.join(f'<p>{p}</p>' for p in story)}<p>seen {i} times</p></div></body>"
    pages = [(i, f"http://site.example/{i}", copy(i), "h", "a", 1, "t") for i in range(20)]
    pages += [(100 + i, f"http://site.example/{100 + i}", f"<body><div class=q2><h1>Other {i}</h1><p>{'o%d ' % i * 50}</p></div></body>", "h", "a", 1, "t") for i in range(3)]
    got = {r.page_id: r.text for r in wrappers.extract(frame(pages, SCHEMA)).collect()}
    for i in range(20):
        assert got[i] == "\n\n".join(["Story", *story, f"seen {i} times"])


def test_every_page_shapes_its_hosts_wrapper(frame):
    """All different pages count, each once, near copies of a page together, other hosts' pages not at all."""
    pages = [(i, "http://a.example/x", site(i % 30)[0], "h", "a", 1, "t") for i in range(60)]
    pages += [(100 + i, "http://b.example/y", site(500 + i)[0].replace("All rights", "No rights"), "h", "a", 1, "t") for i in range(2)]
    rows = {r.host: r for r in wrappers.host_wrappers(frame(pages, SCHEMA)).collect()}
    assert rows["a.example"].articles == 30 and rows["b.example"].articles == 2
    texts = lambda host: {f.text for f in rows[host].fixed}
    assert wrappers.digest("All rights kept by us") in texts("a.example") - texts("b.example")
    assert wrappers.digest("Join our mailing club for weekly letters") in texts("a.example")  # optional: on 22 of 30
    assert wrappers.digest("No rights kept by us") in texts("b.example") and len(rows["a.example"].fixed) == 3
    assert len(rows["a.example"].lists) == 1


@pytest.mark.parametrize("page, text", [
    ("<div class='content has-sidebar'><article><p>one two</p></article></div><div class=sidebar>x y z</div>", "one two"),
    ("<div class='layout with-sidebar'><article>one two</article></div>", "one two"),
    ("<div class=side-by-side><article>one two</article></div>", "one two"),
    ("<div class='post share-enabled'><article>one two</article></div>", "one two"),
    ("<div class=widget><article>one two</article></div><div class=widget>three</div>", "one two"),
    ("<ul>" + "".join(f"<li><a href=x>link number {i}</a>" for i in range(60)) + "</ul><div class=body><p>" + "word " * 40 + "</p></div>", "word " * 39 + "word"),
    ("<div><h1>Title</h1><p class=lead>Lead text</p><div class=body><p>Body text</p></div></div>", "Title\n\nLead text\n\nBody text"),
    ("<form id=aspnetForm><h1>Title</h1><p>Text in a form around all</p></form>", "Title\n\nText in a form around all"),
    ("<div class=post><h1>T</h1><p>short</p></div><ol class=comment-list><li><article>a much longer comment than the text</article></ol>", "T\n\nshort"),
    ("<article><header class=entry-header><h1>T</h1></header><p>x</p><aside>no</aside><section id=comments><article>no</article></section></article>", "T\n\nx"),
    ("<div class=cookie-bar>no</div><div class=related-posts>no</div><div role=search>no</div><p hidden>no</p><p>yes<button>no</button>", "yes"),
    ("<div class=notice>all that there is</div>", "all that there is"),
])
def test_furniture_by_name_is_weak_evidence(page, text):
    assert wrappers.text_of(f"<body>{page}</body>") == text


def test_blocks_references_and_space():
    html = "<body><article><h1>A&nbsp;&lt;b&gt;</h1>loose <i>te</i>xt<br>more<p>one\n\t two<p>three&#233;<table><tr><td>x<td>y</table></article>out"
    assert wrappers.text_of(html) == "A <b>\n\nloose text more\n\none two\n\nthreeé\n\nx\n\ny"


def test_long_irregular_pages_take_linear_time(spark, frame):
    rng = random.Random(1)
    body = "".join(f"<{rng.choice(['div', 'p', 'h3'])} class=c{'abcdefg'[rng.randrange(7)] * rng.randrange(1, 9)}>block {i}" for i in range(20_000))
    start = time.time()
    got = wrappers.extract(frame([(i, "http://x.example", f"<body>{body}{i}</body>", "h", "a", 1, "t") for i in range(2)], SCHEMA)).collect()
    assert time.time() - start < 30 and all(r.text.count("block") == 20_000 for r in got)


def test_pages_without_words_or_markup(spark, frame):
    rows = [(1, None, None), (2, "", ""), (3, "http://x.example", "<html><nav>menu</nav></html>"), (4, "not a url", "plain words only")]
    rows += [(5, "http://x.example", "<article>" + "long word " * 60_000 + "</article>")] * 2 + [(None, "http://x.example", "<p>a < b <!-- c")]
    got = wrappers.extract(frame([(*r, "h", "a", 1, "t") for r in rows], SCHEMA)).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 7 and texts[1] == texts[2] == texts[3] == "" and len(texts[5]) == 600_000 - 1
    assert wrappers.extract(frame([], SCHEMA)).collect() == []


def test_broken_markup_does_not_hang():
    for html in ("<a href=\"" * 2000, "<" * 50_000, "<p " * 20_000, "<!--" * 20_000, "<script>" * 3000, "<div>" * 3000 + "x", "&" * 50_000):
        wrappers.text_of(html)
