"""All blocks of an article come out, whatever their density beside the densest one."""

import pytest

from ledgerlake.llm.webtext import main_text


def p(size, c="x"):
    return f"<p>{c * size}</p>"


def test_title_lead_and_inner_div():
    page = f"<body><article><h1>{'t' * 30}</h1><p class=lead>{'l' * 150}</p><div>{p(300) * 10}</div></article></body>"
    assert main_text(page).split("\n") == ["t" * 30, "l" * 150, *["x" * 300] * 10]


@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><main>{}</main></body>", "<body><div class='entry-content'>{}</div></body>"])
def test_several_sections(around):
    page = around.format(f"<section>{p(400) * 8}</section><section>{p(100, 'y') * 3}</section>")
    assert main_text(page).split("\n") == ["x" * 400] * 8 + ["y" * 100] * 3


def test_text_directly_in_an_ancestor():
    page = f"<body><article>Loose words<div>{p(300) * 3}</div>at the end</article></body>"
    assert main_text(page).split("\n") == ["Loose words", *["x" * 300] * 3, "at the end"]


def test_cut_parts_and_link_lists_stay_out():
    page = f"<body><div class='links'><a href=1>one</a> <a href=2>two</a></div><article><h1>T</h1><div>{p(300) * 3}</div><aside>no</aside></article></body>"
    assert main_text(page).split("\n") == ["T", *["x" * 300] * 3]
