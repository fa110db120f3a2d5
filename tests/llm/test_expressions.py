"""Union-free expressions of pages: inference, matching, and extraction by them."""

import random
import re

import pytest

from mercata.llm import wrappers
from mercata.llm.expressions import EDGE, Wrapper, content

SCHEMA = "page_id long, url string, html string"


def steps_of(words):
    return [(a, b, 1) for word in words for a, b in zip([EDGE, *word], [*word, EDGE])]


def pattern(chain):
    """The chain as a pattern over letters; a group is never empty."""
    out = ""
    for members, optional, repeated in chain:
        letters = "".join(chr(part) for part, _ in members)
        inner = "".join(chr(part) + "?" * (skipped and len(members) > 1) for part, skipped in members)
        out += f"(?:(?=[{letters}])(?:{inner})" + ("+)" if repeated else ")") + ("?" if optional else "")
    return out


def wrapper_of(chain):
    factors = [
        {"members": [{"part": p, "optional": o} for p, o in members], "optional": optional, "repeated": repeated}
        for members, optional, repeated in chain
    ]
    return Wrapper([{"path": 0, "prose": False, "texts": 0, "content": factors}], set(), [])


@pytest.mark.parametrize("words, expected", [
    (["ab", "ab"], "ab"),
    (["ab", "acb"], "ac?b"),                # an element that some pages lack
    (["ab", "abbb"], "ab+"),                # one that stands several times
    (["a", "abb"], "ab*"),
    (["xabab", "xab", "xababab"], "x(ab)+"),  # parts that come in turns
    (["hfphp", "hphphfp"], "(hf?p)+"),
    (["", "dtdt"], "(dt)*"),
])
def test_contents(words, expected):
    chain = content(steps_of([list(map(ord, word)) for word in words]))
    shown = ""
    for members, optional, repeated in chain:
        inner = "".join(chr(p) + "?" * (skipped and len(members) > 1) for p, skipped in members)
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[optional, repeated]
        shown += (f"({inner})" if len(members) > 1 else inner) + mark
    assert shown == expected


def test_every_page_matches_and_matching_is_the_expression():
    """Words that gave an expression match it; any word's steps are allowed just where a plain pattern matches it.  The order of words
    makes no difference."""
    rng = random.Random(3)
    for _ in range(300):
        letters = [ord(c) for c in "abcdef"[:rng.randrange(1, 7)]]
        words = [[rng.choice(letters) for _ in range(rng.randrange(6))] for _ in range(rng.randrange(1, 5))]
        if rng.random() < 0.5:
            words = [sorted(word) for word in words]
        chain = content(steps_of(words))
        assert chain == content(rng.sample(steps_of(words), len(steps_of(words))))
        wrapper, plain = wrapper_of(chain), re.compile(pattern(chain))
        matches = lambda word: all(wrapper.allows(0, a, b) for a, b in zip([EDGE, *word], [*word, EDGE]))
        assert all(map(matches, words))
        known = sorted({c for word in words for c in word})
        for _ in range(40 if known else 0):
            word = [rng.choice(known) for _ in range(rng.randrange(7))]
            assert matches(word) == bool(plain.fullmatch("".join(map(chr, word)))), (words, chain, word)


def say(rng, n):
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


def page(i):
    rng = random.Random(i)
    promo = f"<div class=promo>{say(rng, 3)}</div>" if i % 3 else ""
    terms = "".join(f"<dt>{say(rng, 2)}<dd>{say(rng, 9)}" for _ in range(rng.randrange(2, 5)))
    told = "".join(f"<h3>{say(rng, 2)}</h3>{'<figure><img></figure>' * (k % 2)}<p>{say(rng, 20)}</p>" for k in range(4))
    return f"<body><nav>{say(rng, 3)}</nav><div class=top>The Daily Example</div>{promo}<dl>{terms}</dl><section>{told}</section></body>"


def made(frame, pages):
    rows = wrappers.host_wrappers(frame(pages, SCHEMA)).collect()
    found = {}
    for row in (r.asDict(recursive=True) for r in rows):
        symbols = {s["after"]: s["symbol"] for s in row["symbols"]}
        found[row["host"]] = wrappers.unpacked(row["packed"]), symbols
    return found


def test_a_hosts_expression(spark, frame):
    """Optional and repeated parts, turns, slots and fixed texts, from all pages of the host and no other's."""
    pages = [(i, f"http://a.example/{i}", page(i)) for i in range(12)] + [(i, f"http://b.example/{i}", "<p>one<hr>two") for i in range(2)]
    found = made(frame, pages)
    wrapper, symbols = found["a.example"]
    assert wrapper.written(symbols) == (
        f'body(nav div.top("{wrappers.digest("The Daily Example")}") div.promo(#)? dl((dt(#) dd(#))+) section((h3(#) figure? p(#))+))'
    )
    for _, _, html in pages[:12]:
        assert all(b.bound for b in wrappers.blocks(html, wrapper))
    assert not any(b.bound for b in wrappers.blocks(pages[0][2], found["b.example"][0]))


def test_text_that_does_not_match_is_kept(spark, frame):
    """A fixed text is the template's where the expression has its part, not where a page puts it elsewhere."""
    rng = random.Random(5)
    pages = [(i, "http://a.example", f"<body><div class=zz>Fixed words here</div><h1>{say(rng, 4)}</h1><p>{say(rng, 30)}</p>") for i in range(6)]
    wrapper, symbols = made(frame, pages)["a.example"]
    assert wrapper.written(symbols) == f'body(div.zz("{wrappers.digest("Fixed words here")}") h1(#) p(#))'
    assert wrappers.text_of("<body><div class=zz>Fixed words here</div><h1>T</h1><p>some text</p>", wrapper) == "T\n\nsome text"
    assert wrappers.text_of("<body><h1>T</h1><p>some text</p><div class=zz>Fixed words here</div>", wrapper) == "T\n\nsome text\n\nFixed words here"
    assert wrappers.text_of("<body><hr><div class=zz>Fixed words here</div><h1>T</h1>", wrapper) == "T"  # what follows an unknown part may


def test_repeated_lists_of_links_go_whole(spark, frame):
    """Dates beside the links of a repeated part are no text; a repeated part that holds prose on any page is no list."""
    def site(i, teaser):
        rng = random.Random(i)
        items = "".join(f"<div class=item><a href=x>{say(rng, 6)}</a><p>{teaser(rng, k)}</p></div>" for k in range(5))
        body = [say(rng, 30) for _ in range(3)]
        return f"<body><h1>Story {i}</h1>{''.join(f'<p>{p}</p>' for p in body)}<section>{items}</section></body>", [f"Story {i}", *body]

    dates = [site(i, lambda rng, k: f"{rng.randrange(1, 29)} May") for i in range(10)]
    told = [site(100 + i, lambda rng, k: say(rng, 40 if k else 2)) for i in range(10)]
    pages = [(i, "http://a.example", dates[i][0]) for i in range(10)] + [(100 + i, "http://b.example", told[i][0]) for i in range(10)]
    got = {r.page_id: r.text.split("\n\n") for r in wrappers.extract(frame(pages, SCHEMA)).collect()}
    for i in range(10):
        assert got[i] == dates[i][1]
        assert got[100 + i][:4] == told[i][1] and len(got[100 + i]) == 9
