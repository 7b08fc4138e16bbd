"""Class words mark a part of a page; wrappers that hold the article stay."""

import pytest

from ledgerlake.llm.webtext import main_text

TEXT = "word " * 60
PARAGRAPHS = f"<p>{TEXT}</p>" * 3


@pytest.mark.parametrize(
    "name",
    ["class='content has-sidebar'", "id='page' class='site no-sidebar'", "class='post comment-enabled'", "class='sidebar-layout'", "class='page with-menu'"],
)
def test_wrappers_stay(name):
    page = f"<body><div {name}>{PARAGRAPHS}<div class='sidebar'><p>beside</p></div></div><div class='comments'><p>first!</p></div></body>"
    assert main_text(page) == "\n".join([TEXT.strip()] * 3)


def test_wrapper_of_a_short_article_stays():
    assert main_text("<body><div class='banner-wrap'><article><p>short text</p></article></div><div class='widget'><p>no</p></div></body>") == "short text"


def test_long_threads_and_teasers_go():
    long = f"<p>{TEXT}</p>" * 20
    assert main_text(f"<body><div class='post'>{PARAGRAPHS}</div><div class='comments'>{long}</div></body>") == "\n".join([TEXT.strip()] * 3)
    page = f"<body><article>{PARAGRAPHS}</article><div class='related'><article>{long}</article></div></body>"
    assert main_text(page) == "\n".join([TEXT.strip()] * 3)
