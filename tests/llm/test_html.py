"""Which text of a page is its article: what names, lists and several regions must not take away."""

import time

import pytest

pytest.importorskip("airshed.llm")

from airshed.llm import html_extract  # noqa: E402

LONG = "A sentence of the article with quite a good many words in it, so that it counts as running text. "
HEAD = '<body><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav><header>Site name</header>'
FOOT = '<section id="comments"><div class="comment"><p>No, dear author, I think that all of this is wrong from the first word to the last.</p></div></section><footer>Imprint</footer>'


def text(body, sigma=html_extract.SIGMA):
    return html_extract.main_text(f"<html>{HEAD}{body}{FOOT}", sigma)


@pytest.mark.parametrize(
    ("inner", "says"),
    [
        ('<section id="discussion"><h2>Discussion</h2><p>Our results say otherwise.</p></section>', "Discussion Our results say otherwise."),
        ('<section id="related-work"><p>Others found the same.</p></section>', "Others found the same."),
        ('<p class="related">It is related.</p>', "It is related."),
        ('<p id="legal-basis">The law says so.</p>', "The law says so."),
        ('<div class="share-price">It rose to 12.</div>', "It rose to 12."),
        ('<h2 id="search-algorithms">Search algorithms</h2>', "Search algorithms"),
        ('<ul><li><a href=x>First source</a></li><li><a href=y>Second source</a></li></ul>', "First source Second source"),
        ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>", "So x=2 holds."),
        ("<p>Set <label>this</label> first.</p>", "Set this first."),
    ],
)
def test_parts_of_an_article_stay(inner, says):
    assert text(f"<article><p>{LONG * 3}</p>{inner}<p>{LONG * 2}</p></article>") == f"{(LONG * 3).strip()} {says} {(LONG * 2).strip()}"


@pytest.mark.parametrize(
    "inner",
    [
        '<section id="discussion"><div class="comment"><p>No.</p></div><form>Reply</form></section>',
        '<div class="related"><a href=x>No, this other story</a><a href=y>No, that one</a></div>',
        '<div class="ad-box">No buy this</div>',
        '<p class="cookie-notice">No cookies</p>',
        '<div class="newsletter-signup"><p>No, subscribe to our letter</p></div>',
        '<ul class="share"><li><a href=x>No tweet</a></ul>',
        '<aside>No aside</aside>',
        '<form><label>No name</label></form>',
        '<div style="display: none">No</div>',
        '<div class="sidebar-widget-area">No</div>',
    ],
)
def test_what_is_no_article_goes(inner):
    assert text(f"<article><p>{LONG * 3}</p>{inner}<p>{LONG * 2}</p></article>") == f"{(LONG * 3).strip()} {(LONG * 2).strip()}"


def test_several_regions():
    two = f"<article><p>{LONG * 3}</p></article><article><p>{LONG * 2}</p></article>"
    assert text(two) == " ".join([LONG.strip()] * 5)
    cards = two + "".join(f'<article class="teaser"><a href={k}>No {k}</a></article><article><a href={k}>No title {k}</a><p>No.</p></article>' for k in range(3))
    assert text(cards) == " ".join([LONG.strip()] * 5)
    divs = f"<div><p>{LONG * 6}</p><p>Short.</p></div><div><p>{LONG * 3}</p></div>"
    assert text(divs) == f"{(LONG * 6).strip()} Short. {(LONG * 3).strip()}"


def test_smoothing_and_threshold_decide_without_an_article():
    """Short lines amid long ones lie in the cluster; unmarked boxes before and after the text do not."""
    menu = "<div><div><a href=a>No one</a></div><div><a href=b>No two</a></div><div>No <b>x</b> <i>y</i></div></div>"
    body = "".join(f"<p>{LONG * 2}</p><p>Yes.</p>" for _ in range(6))
    page = f"<html><body>{menu}<div>{body}</div><div><div>No</div><div><a href=c>No imprint</a></div></div>"
    want = " ".join([f"{(LONG * 2).strip()} Yes."] * 6)
    assert html_extract.main_text(page) == want
    # Two stretches of even weight, one broken up by tags: only smoothed ratios make one cluster of it.
    broken = "".join(f"<p>{LONG}</p><p><b>a</b><b>b</b><b>c</b></p>" for _ in range(8))
    flat = f"<html><body><div>{broken}</div><div>{''.join(f'<p><i>{k}</i><b>no</b></p>' for k in range(40))}</div>"
    smooth = html_extract.smoothed
    lines = html_extract.lines_of(flat)
    ratio = html_extract.np.array([len(t) / max(n, 1) for t, n, *_ in lines.lines])
    even = smooth(ratio)
    assert ((even >= even.std()) != (ratio >= ratio.std())).sum() >= 5
    assert html_extract.main_text(flat) == " ".join([f"{LONG.strip()} abc"] * 8)


@pytest.mark.parametrize("unit", ["<p><font>x", "<p><a href=q>x", "<div>x</p>", "<span class=ad>x", "<b><i>x</u>", "<ul><li><b>x", "<table><tr><td><i>x"])
def test_time_is_linear_in_unclosed_tags(unit):
    def seconds(n):
        began = time.perf_counter()
        html_extract.main_text(unit * n)
        return time.perf_counter() - began

    seconds(100)
    assert seconds(16_000) < 10 * max(min(seconds(4_000) for _ in range(2)), 0.05)
