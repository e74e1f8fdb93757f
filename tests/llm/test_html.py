"""Pages whose content classes and ids, lists of links or missing articles make hard to tell."""

import numpy as np
import pytest

from countloom.llm import html

L = "The first paragraph of this piece is long enough to count as running text of its own, with several clauses and a full stop."
M = "A second paragraph goes on about the same matter at much the same length, so that both of them together form a cluster of lines."
N = "A third one closes the piece, again with a good number of words, so that nobody would take it for a menu or for a caption."


@pytest.mark.parametrize("page", [
    f"<div class='post comments-open'><p>{L}</p><p>{M}</p></div>", f"<div class='page widget-area-right'><p>{L}</p><p>{M}</p></div>", f"<body class='no-sidebar has-comments sidebar-right'><p>{L}</p><p>{M}</p></body>",
    f"<div class='comments-open'><p>{L}</p></div><div class='sidebar'><p>Short</p></div><p>{M}</p>",
    f"<article><p class='navigation-history'>{L}</p><p class='alert'>{M}</p></article>",
    f"<div class='menu-top'><a href=1>Home</a></div><div><p>{L}</p><p>{M}</p></div><ol class='commentlist'><li>{N}</li></ol>",
    f"<p>{L}</p><p>{M}</p><section id='respond'>Leave a reply</section>", f"<div class='cookiebar'>{N}</div><p>{L}</p><p>{M}</p>",
    f"<ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul><p>{L}</p><p>{M}</p>", f"<p>{L}</p><p>{M}</p><p>Copyright 2020 The Paper</p>", f"<p>{L}</p><p>{M}</p><div>&copy; 2020</div>",
    f"<article><p>{L}</p><p>{M}</p><div class='comment-list'><p>{N}</p></div></article>", f"<article><p>{L}</p><div class='ad-slot'>{N}</div><p>{M}</p></article>", f"<article><p>{L}</p><p class='advert'>{N}</p><p>{M}</p></article>",
])
def test_content_alone(page):
    assert html.main_text(page) == f"{L} {M}"


@pytest.mark.parametrize("page, text", [
    (f"<article><h2 class='modal-verbs'>Can and may</h2><p>{L}</p></article>", f"Can and may {L}"),
    (f"<article><p>{L}</p><div class='notice-board'>{N}</div><p>{M}</p></article>", f"{L} {N} {M}"),
    (f"<p>{L}</p><ul><li><a href=1>One source</a></li><li><a href=2>Two sources</a></li><li><a href=3>Three sources</a></li></ul><p>{M}</p>", f"{L} One source Two sources Three sources {M}"),
    (f"<p>{L}</p><p>Copyright law is the matter.</p><p>{M}</p>", f"{L} Copyright law is the matter. {M}"),
])
def test_content_with_such_names(page, text):
    assert html.main_text(page) == text


def test_pages_with_known_text():
    """Pages made of known content between menus, notices and footers, without an article element."""
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in "klmnprst" for b in "aeiou" for c in ("n", "st", "ra", "lle")]
    say = lambda n: " ".join(rng.choice(words, n)).capitalize() + "."
    for i in range(150):
        body = [say(int(rng.integers(20, 90))) for _ in range(rng.integers(2, 7))]
        middle = [say(int(rng.integers(3, 9))) for _ in range(rng.integers(0, 3))]
        content = body[:1] + middle + body[1:]
        links = "".join(f"<li><a href=/{k}>{say(1)}</a></li>" for k in range(rng.integers(2, 8)))
        menu = [f"<ul>{links}</ul>", f"<nav>{links}</nav>", f"<div class='main-menu'><ul>{links}</ul></div>", ""][i % 4]
        notice = ["", f"<div id='cookie-notice'>{say(30)}</div>", f"<div class='newsletter box'><form>{say(8)}<input></form></div>"][i % 3]
        foot = [f"<footer>{say(12)}</footer>", f"<div class='footer-inner'>{say(12)}</div>", f"<ul>{links}</ul><p>&copy; {say(3)}</p>"][i % 3]
        inner = "".join(f"<p>{x}</p>" for x in content)
        page = f"<html><body class='single has-sidebar'>{menu}{notice}<div class='entry-content'>{inner}</div><div class='comments-area'><p>{say(40)}</p></div>{foot}</body></html>"
        assert html.main_text(page) == " ".join(content), (i, page)
