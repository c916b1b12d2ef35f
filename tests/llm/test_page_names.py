"""Names of wrappers and marks of small parts do not shut the main text out."""

from __future__ import annotations

import pytest

from delayflow.llm import pages
from tests.llm.test_text_operators import LONG, PAGE

TEXT = LONG.strip()


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "with-ads", "comments-open", "nav-fixed", "modal"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_names_of_wrappers(name, inner):
    page = f"<body><div class='page {name}'><{inner}><p>{LONG}</p></{inner}></div></body>"
    if (name, inner) != ("modal", "div"):
        assert pages.main_text(page) == TEXT
    assert pages.main_text(f"<div id=a><span class='{name}'><main><p>{LONG}</p></main></span></div>") == TEXT


def test_small_parts_do_not_outvote_the_text():
    card = "<article class='card'><p>Read this too, it is one of the best that we had in all of the days.</p></article>"
    page = f"<div class='content'><p>{LONG}</p><p>{LONG}</p></div>{card}"
    assert pages.main_text(page).startswith(f"{TEXT}\n{TEXT}")
    assert pages.main_text(f"<article><p>{LONG}</p><p>{LONG}</p></article><div><p>{LONG}</p></div>") == f"{TEXT}\n{TEXT}"


def test_named_parts_stay_out():
    for name in ("sidebar", "sidebar-left", "related-posts", "comment-list", "site-footer"):
        part = f"<div class='{name}'><p>{LONG}</p></div>"
        assert pages.main_text(f"<article><p>{LONG}{LONG}</p></article>{part}") == f"{TEXT} {TEXT}"
        assert pages.main_text(f"<div><p>{LONG}</p></div>{part}") == TEXT
    related = f"<div class='related'><article><p>{LONG}{LONG}</p></article></div>"
    assert pages.main_text(f"<article><p>{LONG}</p></article>{related}") == TEXT
    assert pages.main_text(f"<aside><article><p>{LONG}</p></article></aside><p>{LONG}</p>") == TEXT
    assert "cookies" not in pages.main_text(PAGE)
    inside = f"<div class='has-sidebar'><article><p>{LONG}</p><div class='share-buttons'><p>{LONG[:100]}</p></div></article></div>"
    assert pages.main_text(inside) == TEXT
    nested = f"<div class='has-sidebar'><div class='sidebar-left'><p>{LONG}</p></div><div><p>{LONG}{LONG}</p></div></div>"
    assert pages.main_text(nested) == f"{TEXT} {TEXT}"
    assert pages.main_text(f"<article class='post comments-open'><p>{LONG}</p></article>") == TEXT
    assert pages.main_text(f"<div class='search-results'><p>{LONG}</p></div>") == TEXT
    assert pages.main_text("<div class='has-sidebar'><p>Only this</p></div>") == "Only this"
