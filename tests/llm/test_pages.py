"""Pages whose class names hold words of parts that are not the article."""

import pytest

from tests.llm.conftest import prose
from tests.llm.test_text_models import PAGE
from tillscope.llm.page_parts import Weights, learn, main_text

WRAPS = (
    "class='content no-sidebar'", "class=has-sidebar", "class='article-with-comments'", "class='legal-news'",
    "id='main-form'", "class='sidebar'",
)


@pytest.mark.parametrize("wrap", WRAPS)
def test_names_around_the_article(wrap):
    weights = learn([PAGE] * 3)
    wanted = "A title First & bold line. Second é Third"
    assert main_text(PAGE.replace("<article>", f"<div {wrap}><article>").replace("</article>", "</article></div>"), weights) == wanted
    plain = prose(1, 60)
    page = f"<body><div class='cookie-notice'>We use cookies</div><div {wrap}><p>{plain}</p></div></body>"
    assert main_text(page, weights) == plain == main_text(page, Weights({}, {}, 0.1))


def test_comments_stay_out_though_they_are_longer():
    story, talk = prose(2, 30), prose(3, 200)
    page = f"<article><p>{story}</p></article><div class=comments><p>{talk}</p></div>"
    assert main_text(page, learn([page])) == story
    small = f"<div><p>{story}</p></div><div class='sidebar-left'><p>{prose(4, 20)}</p></div>"
    assert main_text(small, Weights({}, {}, 0.1)) == story


TALK = (
    "section class=comments", "div class='sidebar'", "article class=comment", "div class='comment-body'",
    "div class='user-comments'", "div class='ad-slot'", "div class=adbox", "div id='comment-1204'",
)


@pytest.mark.parametrize("part", TALK)
def test_longer_parts_of_others_stay_out(part):
    """Comments, adverts and sidebars longer than the article: in it, after it, and beside an unmarked one."""
    story, talk, name = prose(7, 50), prose(8, 400), part.split()[0]
    other = f"<{part}><p>{talk}</p></{name}>"
    for weights in (Weights({}, {}, 0.1), learn([PAGE] * 3)):
        assert main_text(f"<body><article><p>{story}</p>{other}</article></body>", weights) == story
        assert main_text(f"<body><article><p>{story}</p></article>{other}</body>", weights) == story
        assert main_text(f"<body><div class=post><p>{story}</p></div>{other}</body>", weights) == story


def test_region_runs_over_barred_parts():
    links = "".join(f"<li><a href='/{k}'>two words</a></li>" for k in range(30))
    body = prose(5, 80)
    for nav in (f"<nav><ul>{links}</ul></nav>", f"<div class=menu><ul>{links}</ul></div>"):
        page = f"<article><h1>{prose(6, 8)}</h1>{nav}<p>{body}</p></article>"
        assert main_text(page, learn([page])) == f"{prose(6, 8)} {body}"
