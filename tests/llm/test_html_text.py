from __future__ import annotations

import re

import pytest

from tallyline.llm.html_text import extract, main_text

LONG = (
    "The river had been rising for two days when they came to the bridge, and it was not clear to any of them that the"
    " old planks would hold for another hour, so they waited on the bank and looked at the water as it went by in the dark."
)
MORE = (
    "It was then that one of the men said he would go first, with a rope about him, and that the others should follow if"
    " he got to the far side; nobody had a better idea, and in the end this is what they did, slowly, one after the other."
)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_article_without_furniture():
    html = page(
        f"""<header><a href=/>Home</a> The site of the day</header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
        <div class="cookie-notice">{LONG}</div><div id="sidebar"><p>{LONG}</p></div>
        <article><h1>The bridge</h1><p>{LONG}</p><p>Short one.</p><script>var x = "<p>{LONG}</p>";</script>
        <p>{MORE.replace("men", "<b>men</b>")}<br>  and &amp;  so&nbsp;on</p><form><p>{LONG}</p></form><!-- <p>{LONG}</p> --></article>
        <section class="comments"><p>{MORE}</p></section><aside>{LONG}</aside><footer>&copy; 2020 {LONG}</footer>"""
    )
    assert main_text(html) == "\n\n".join(["The bridge", LONG, "Short one.", MORE + " and & so on"])


def test_blocks_alone_decide_where_no_article_is_marked():
    links = " ".join(f"<a href=/{i}>the link of the day number {i}</a>" for i in range(9))
    html = page(f"<div>Menu</div><div>{links}</div><div><h2>The way</h2><p>{LONG}</p><p>Yes.</p><p>{MORE}</p></div><div>Imprint</div>")
    assert main_text(html) == "\n\n".join(["The way", LONG, "Yes.", MORE])


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<", ""),
        (f"<p>{LONG}", LONG),
        (f"<article><p><b>{LONG}<br><p>{MORE}</article", f"{LONG}\n\n{MORE}"),
        (f"<nav><a href=x>go</a><article><p>{LONG}</p></article>", LONG),
        (f"</div></p><article><p>{LONG}</p></div></article><p>Bye", LONG),
        (f'<article><p title="a > b">{LONG}</p><p class="x>{MORE}</p></article>', f"{LONG}\n\n{MORE}"),
        ("<article><h1>A day</h1><p>Short and all there is.</p></article>", "A day\n\nShort and all there is."),
        (f"<div style='display:none'>{LONG}</div><article><p>{MORE}</p></article>", MORE),
        ("<nav><a href=a>b</a></nav><footer>c</footer>", ""),
    ],
)
def test_defined_results(html, text):
    assert main_text(html) == text


def test_long_pages_are_whole():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(3000))
    got = main_text(page(f"<article>{body}</article>"))
    assert got.count("\n\n") == 2999 and got.endswith(" 2999")
    assert len(main_text("<a b='" * 20000)) < 10


def test_frame(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</p></article>"), "x"), (1, "u", None, "x"), (None, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    got = extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, LONG, len(LONG))]
    assert extract(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "start, end",
    [
        ('<div style="overflow:hidden">', "</div>"),
        ('<section class="overflow-hidden">', "</section>"),
        ('<div aria-hidden="false">', "</div>"),
        ('<div hidden="until-found">', "</div>"),
        ('<div title="hidden display:none">', "</div>"),
        ('<div class="layout has-sidebar">', "</div>"),
        ('<div id="search-result">', "</div>"),
        ('<div class="widget"><div>', "</div></div>"),
        ("<head><title>T</title><meta charset=utf-8>", ""),
        ("<head><title>T</title><body>", ""),
    ],
)
@pytest.mark.parametrize("subject", ["article", "main"])
def test_containers_keep_their_article(start, end, subject):
    assert main_text(f"{start}<{subject}><p>{LONG}</p><p>&copy; {MORE}</p></{subject}>{end}") == f"{LONG}\n\n© {MORE}"


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN=''", 'class=x style="color:red; display: none"', "aria-hidden=true"])
def test_hidden_containers_stay_out(attrs):
    assert main_text(f"<div {attrs}><article><p>{LONG}</p></article></div><article><p>{MORE}</p></article>") == MORE


def test_comments_inside_an_article_stay_out():
    html = f"<article><p>{LONG}</p><section class='comment-list comments'><article><p>{MORE}</p></article></section></article><p>&copy; {MORE}</p>"
    assert main_text(html) == LONG


RUSSIAN = "Река поднималась уже два дня, когда они пришли к мосту, и никто не знал, выдержат ли старые доски ещё один час. " * 3
ITALIAN = "Il fiume cresceva ormai da due giorni quando arrivarono al ponte, e nessuno sapeva se le vecchie assi avrebbero retto. " * 3
CHINESE = "他们来到桥边的时候，河水已经上涨了两天，谁也不知道那些旧木板还能不能再撑一个小时。于是他们在岸边等着，看着黑暗中流过的河水。" * 4


@pytest.mark.parametrize("text", [RUSSIAN.strip(), ITALIAN.strip(), CHINESE])
def test_pages_in_languages_without_stop_words(text):
    links = "".join(f"<div><a href=/{i}>{text[:60]}</a></div>" for i in range(9))
    other = " ".join(text[::2].split()) + "."
    body = f"<div><p>{text}</p><p>{other}</p></div>"
    assert main_text(page(f"<div>{text[:20]}</div>{links}{body}<div>&copy; {text}</div>")) == f"{text}\n\n{other}"
    assert main_text(page(f"{body}<p>{text[:20].strip()}</p>{body}")).count("\n\n") == 4


@pytest.mark.parametrize(
    "block",
    [
        "See <a href=x>the other bridge</a>.",
        "<a href=x>The other bridge</a>",
        f"<a href=x>{MORE}</a>",
        f"{LONG} <a href=x>{MORE}</a>",
    ],
)
def test_links_in_an_article_are_text(block):
    text = re.sub("<[^>]*>", "", block)
    assert main_text(page(f"<article><p>{LONG}</p><p>{block}</p><p>{MORE}</p></article>")) == "\n\n".join([LONG, text, MORE])


def test_rows_of_links_in_an_article_are_a_menu():
    menu = "".join(f"<li><a href=/{i}>Part {i}</a></li>" for i in range(4))
    assert main_text(page(f"<article><p>{LONG}</p><ul>{menu}</ul><p>{MORE}</p></article>")) == f"{LONG}\n\n{MORE}"
