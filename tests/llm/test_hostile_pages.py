"""Page text, title and links: equal to the plain patterns, and linear on malformed pages."""

import html
import random
import re
import time

import pytest

from medallion_ops.llm.warc_derivatives import page_links, page_text, page_title, without_hidden

TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"""<(a|img|link|script|iframe)\b[^>]*?\b(?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
HEAD = re.compile(r"(?:\s+|<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
                  r"|<(title|noscript|template)(?=[\s/>])[^>]*>.*?</\2\s*>"
                  r"|</?(?:meta|link|base|basefont|bgsound|title|noscript|template)(?=[\s/>])[^>]*>)*(?:</head\s*>)?", re.S | re.I)
HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|head)(?=[\s/>])[^>]*>", re.I)
PIECES = ["<a ", "<A", "<img ", "<title>", "</title>", "</TITLE >", "<title", ">", "href=", 'src="x>y"', "href='", "'", '"', "b", " ", "\n",
          "src = z", "<head>", "</head>", "<script>", "</script >", "<style ", "</style>", "<noscript>", "</noscript>", "<template>",
          "<meta c>", "<!--", "-->", "<p>", "</div>", "<link href=q>", "text", "&amp;", "data-src=1"]


def _plain_hidden(page):
    out, at = [], 0
    while begin := HIDDEN.search(page, at):
        name = begin[1].lower() if begin[1] else None
        if name == "head":
            end = HEAD.match(page, begin.end()).end()
        else:
            close = re.compile("-->" if name is None else rf"</{name}\s*>", re.I).search(page, begin.end())
            end = close.end() if close else begin.end() if name in ("noscript", "template") else len(page)
        out += page[at:begin.start()], " "
        at = end
    return "".join([*out, page[at:]])


def test_pages_are_read_as_the_plain_patterns_read_them():
    rnd = random.Random(4)
    for _ in range(6000):
        page = "".join(rnd.choices(PIECES, k=rnd.randint(0, 14)))
        title = TITLE.search(page)
        assert page_title(page) == (title[1] if title else None), page
        assert list(page_links(page)) == [(m[1], m[2] or m[3] or m[4] or "") for m in LINK.finditer(page)], page
        assert without_hidden(page) == _plain_hidden(page), page


@pytest.mark.parametrize("piece", ["<a ", "<title>", "<title ", "<script ", "<head><title>", "<head><noscript ", "<!--", "<a href=\"", "<p ", "<a>",
                                   "<img src", "</title ", "<noscript>", "<", "&", "\n"])
def test_a_megabyte_of_one_thing_takes_seconds(piece):
    page = piece * (1_000_000 // len(piece))
    t = time.process_time()
    page_text(page)
    page_title(page)
    sum(1 for _ in page_links(page))
    assert time.process_time() - t < 15


def test_white_space_is_evened_out():
    """Runs of white space within a line become a space, empty lines go, lines are trimmed; any kind of white space."""
    rnd = random.Random(3)
    for _ in range(500):
        page = "".join(rnd.choice(["a", "b\u00e9", " ", "  ", "\t", "\n", "\r", "\r\n", "\u00a0", "\u2028", "\x1c", "\x85", "\u3000", "&nbsp;", "<br>"])
                       for _ in range(rnd.randrange(30)))
        plain = html.unescape(page.replace("<br>", "\n")).replace("\r", "\n")
        assert page_text(page) == re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[^\S\n]+", " ", plain)).strip()


def test_plain_words_cost_little_more_than_splitting_them():
    page = "words in a row " * 200_000
    def least(f):
        took = []
        for _ in range(5):
            t = time.process_time()
            f(page)
            took.append(time.process_time() - t)
        return min(took)
    assert least(page_text) < 4 * least(lambda x: " ".join(x.split()))
