"""Cases in which an operator did less than its whole job."""

import random
import string

import pytest

from aerolytics.llm import html_extract, line_dedup, secrets
from aerolytics.llm import queries as Q
from tests.llm.llm_data import documents

LETTERS, BASE62 = string.ascii_letters, string.ascii_letters + string.digits


# 1 ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("before, alphabet, n, after", [
    ("", LETTERS, 32, ""), ("", BASE62, 32, ""), ("session_authorization=", BASE62, 32, ""),
    ("services/webhooks/incoming/", BASE62, 32, ""), ("\u5bc6", BASE62, 32, "\u94a5"), ("", BASE62, 32, "-token=abcdefgh")])
def test_op1_random_strings_behind_names_and_beside_patterns(before, alphabet, n, after):
    counter = secrets.TokenCounter.get(Q.vocabulary("byte_bpe_50k.tiktoken"), Q.split_pattern())
    rnd = random.Random(3)
    for _ in range(100):
        key = "".join(rnd.choice(alphabet) for _ in range(n))
        text = f"use {before}{key}{after} x"
        found = secrets.random_spans(text, secrets.base_spans(text), counter, 1.9, frozenset())
        at = text.index(key)
        assert any(s <= at and at + n <= e for s, _, e in found)


def test_op1_names_paths_and_identifiers_stay():
    counter = secrets.TokenCounter.get(Q.vocabulary("byte_bpe_50k.tiktoken"), Q.split_pattern())
    for text in ("getElementsByTagNameAndClassNameList", "a/b/c/d/e/f/g/h/i/j/k/l", "VeryLongJavaClassNameFactoryBeanImpl2",
                 "usr/local/share/python3/site-packages/numpy", "https-www-example-com/en/2020/01/02/index"):
        assert secrets.random_spans(text, [], counter, 1.9, frozenset()) == []


# 4 ----------------------------------------------------------------------------------------
def test_op4_shared_words_in_lists_of_both_kinds(spark, monkeypatch):
    """Pairs whose shared prefix words are partly in short and partly in long lists."""
    monkeypatch.setattr(line_dedup, "LONG", 4)
    rows, want = [], []
    for i, (n, more, short) in enumerate([(25, 6, 1), (50, 11, 2), (100, 20, 4)]):
        words = [f"a{i}x{k}" for k in range(n)]
        rows.append(" ".join(words))
        for k in range(short, n):                        # the next rare words lead other lines
            for j in range(7 if k < short + 10 else 20):
                rows.append(f"{words[k]} f{j} g{(j * 7 + k) % 23}")
        rows.append(" ".join(words + [f"b{i}x{k}" for k in range(more)]))
        want.append(len(rows))
    d = documents(spark, [(i, t, "en", "a") for i, t in enumerate(rows, 1)])
    gone = line_dedup.find_duplicate_lines(line_dedup.row_keys(d, "doc_id")).collect()
    assert sorted(r["doc_id"] for r in gone) == want


# 5 ----------------------------------------------------------------------------------------
PARTS = ["A heading of the page", "A first paragraph that is long enough to be read as text of the article.",
         "A second paragraph that is long enough to be read as text of the article."]
BODY = "<h1>%s</h1><p>%s</p><p>%s</p>" % tuple(PARTS)


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article>%s</article></div>", "<div class='post no-comments'>%s</div>",
    "<div class='sidebar-layout'><article>%s</article></div>", "<form id=whole><div><main>%s</main></div></form>",
    "<div class='sidebar-layout'>%s</div>", "<article class='post social-story'>%s</article>"])
def test_op5_wrappers_do_not_drop_the_article(page):
    html = ("<body><nav><a href=/>Home</a></nav>" + page % BODY
            + "<div class=comments><p>I liked it.</p></div><footer>Site</footer></body>")
    assert html_extract.main_text(html) == "\n\n".join(PARTS)


@pytest.mark.parametrize("attr", ['title="A hidden valley"', 'data-hidden="false"', 'data-overflow="hidden"',
                                  'data-class="sidebar"', 'alt="style=display:none"'])
def test_op5_attributes_by_their_own_names(attr):
    assert html_extract.main_text(f"<body><article {attr}>{BODY}</article></body>") == "\n\n".join(PARTS)
    assert html_extract.main_text(f"<body><article {attr} hidden>{BODY}</article></body>") == ""


def test_op5_signs_beside_and_inside_the_article_stay_out():
    html = (f"<body><article>{BODY}<div class=related><p>{PARTS[1]}</p></div></article><aside class=related>"
            f"<article><p>{PARTS[2]}</p></article></aside><section id=comments><article><p>{PARTS[1]}</p></article></section>")
    assert html_extract.main_text(html) == "\n\n".join(PARTS)
