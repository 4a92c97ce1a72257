"""Inputs that once took a parser or a finder too long, or that a length limit cut short."""

import random
import time

import pytest

from foldmark.llm import pii
from foldmark.llm.html import main_text, mark, parse


def text_of(html):
    nodes = parse(html)
    mark(nodes)
    return main_text(nodes, set())


@pytest.mark.parametrize(
    "html",
    [
        "<a" * 10**6, "<" + "a" * 10**6, "<!" * 10**6, "<div>" * 1000 + "</x1>" * 10**6, "<div>" * 1000 + "</p>" * 10**6, "<b>" * 10_000 + "<div></div>" * 50_000,
        "<li><ul>" + "<div><li></li>" * 50_000, "<a '\">" * 100_000, "<p><foo>" + "<b>" * 50_000 + "<div></div>" * 50_000, "<script>" + "<" * 10**6,
    ],
)
def test_unclosed_and_stray_tags_take_linear_time(html):
    began = time.time()
    parse(html)
    assert time.time() - began < 20


def test_text_is_kept_where_no_tag_ends():
    assert text_of("<p>one</p> two <b three") == "one two <b three"
    assert text_of("<p>one</p><!-- two") == "one" and text_of("a < b <i>c</i>") == "a < b c"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<p>real</p><section id="reader-comments"><p>c</p></section>', "real"),
        ('<p>real</p><div class="user-comments"><p>c</p></div>', "real"),
        ('<article><p>A</p><ul><li class="comment">hi there</li></ul></article>', "A"),
        ('<article><p>A</p><div class="in-article-promo">x</div><div class="related-stories"><a>x y z</a></div><p class="notice">N</p></article>', "A"),
        ('<div class="notice"><article>A</article></div><article>B</article>', "A B"),
        ('<div class="user-comments"><article>A</article></div><article>B</article>', "B"),
        ('<aside><article>A</article></aside><article>B</article>', "B"),
        ('<div class="article-body"><p class="lead">A</p></div>', "A"),
    ],
)
def test_readers_words_and_boxes(html, want):
    assert text_of(html) == want


@pytest.fixture(scope="module")
def fitted():
    rng = random.Random(7)
    return pii.fit([(k % 4 == 0, e) for k in range(pii.GENERATED) for e in pii.generated(rng)])


@pytest.mark.parametrize("n", [2, 4, 5, 12, 13, 30, 1000])
def test_every_number_of_a_list_is_found(fitted, n):
    for number, between in ((lambda k: f"212-555-{1000 + k}", " "), (lambda k: f"{200 + k % 800} 555 1234", " "), (lambda k: f"0{200 + k % 800}/5551234", ", ")):
        text, want = "call ", []
        for k in range(n):
            want.append((len(text), len(text) + len(number(k)), "phone"))
            text += number(k) + between
        assert pii.find(text, fitted)[1] == want


def test_addresses_of_any_length_are_candidates_whole():
    text = "x" * 70 + " [at] example [dot] org"
    assert ("email", 0, len(text)) in pii.candidates(text)
    text = "b at " + ".".join("abcdefghij") + ".com"
    assert ("email", 0, len(text)) in pii.candidates(text)
    text = "b at " + "y" * 100 + ".com"
    assert ("email", 0, len(text)) in pii.candidates(text)
