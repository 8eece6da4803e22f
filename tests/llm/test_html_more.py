"""Pages whose attributes look like those of hidden or other parts."""

from __future__ import annotations

import pytest

from seriesmill.llm.html_text import main_text

LONG = "This is the text of the article and it has many of the small words that are in all texts. " * 3
TEXT = " ".join(LONG.split())


@pytest.mark.parametrize(
    "attributes",
    [
        'class="overflow-hidden"',
        'style="overflow:hidden"',
        'data-hidden="false"',
        'title="the hidden valley"',
        'aria-hidden="false"',
        'class="hidden md:block"',
        'data-id="share"',
        'class="content-sidebar-wrap"',
        'class="sidebar-layout"',
    ],
)
def test_shown(attributes):
    assert main_text(f"<div {attributes}><p>{LONG}</p></div>") == TEXT
    assert main_text(f"<article {attributes}><p>{LONG}</p></article>") == TEXT
    assert main_text(f"<article><div {attributes}><p>{LONG}</p></div></article>") == TEXT


@pytest.mark.parametrize(
    "attributes",
    ["hidden", 'hidden=""', "HIDDEN=hidden", 'class="a hidden"', "style='color:red; display : none !important'", "style=visibility:hidden", "aria-hidden=true"],
)
def test_hidden(attributes):
    assert main_text(f"<div {attributes}><article><p>{LONG}</p></article></div><p>{LONG}</p>") == TEXT


def test_names_around_the_article():
    bar = f"<div class='sidebar'><p>{LONG}</p></div>"
    for inner in ("article", "main"):
        assert main_text(f"<div class='page-widget'>{bar}<{inner}><p>{LONG}</p></{inner}>{bar}</div>") == TEXT
    teasers = "<div class='related'><article>Another story in a few words</article></div>"
    assert main_text(f"<article><p>{LONG}</p></article>{teasers}") == TEXT
    assert main_text(f"<div class='page-widget'><article><p>{LONG}</p></article>{teasers}</div>") == TEXT
    comments = f"<section id=comments><article class=comment><p>{LONG}</p></article></section>"
    assert main_text(f"<div><p>{LONG}</p></div>{comments}") == TEXT


WRITTEN = {
    "ru": "Вчера вечером в городе открылась новая библиотека, и на праздник пришли не только дети, но и взрослые, которые давно ждали этого дня. ",
    "pl": "Wczoraj wieczorem w mieście otwarto nową bibliotekę i na uroczystość przyszły nie tylko dzieci, ale także dorośli, którzy czekali na to od lat. ",
    "tr": "Dün akşam şehirde yeni bir kütüphane açıldı ve bu kutlama için çok sayıda çocuk ile uzun zamandır bekleyen yetişkinler de geldi. ",
    "ar": "افتتحت أمس في المدينة مكتبة جديدة وقد جاء إلى الحفل عدد كبير من الأطفال مع الكبار الذين كانوا في انتظار هذا اليوم منذ سنوات. ",
    "zh": "昨天晚上，城里新开了一座图书馆，前来庆祝的不仅有孩子，还有许多等待这一天已久的成年人。馆内藏书十万册，免费向所有市民开放。" * 2,
    "th": "เมื่อวานนี้ห้องสมุดแห่งใหม่เปิดให้บริการในเมืองและมีผู้คนจำนวนมากมาร่วมงานเฉลิมฉลองทั้งเด็กและผู้ใหญ่ที่รอคอยวันนี้มานานหลายปีแล้ว",
    "hi": "कल शाम शहर में एक नया पुस्तकालय खुला और इस उत्सव में बच्चों के साथ वे लोग भी आए जो कई वर्षों से इस दिन की प्रतीक्षा कर रहे थे। ",
    "sw": "Jana jioni maktaba mpya ilifunguliwa mjini, watoto wengi pamoja na watu wazima walikuja kusherehekea siku hiyo waliyoisubiri miaka mingi. ",
}


@pytest.mark.parametrize("lang", WRITTEN)
def test_languages(lang):
    text = (WRITTEN[lang] * 3).strip()
    page = f"<body><div><a href=x>{text}</a></div><p>{text}</p><p>{text}</p><nav>{text}</nav>"
    assert main_text(page) == f"{text}\n\n{text}"


def test_code_and_tables():
    code = "for (int i = 0; i < size; ++i) { sum += values[i] * weights[i]; count++; } return sum / count; " * 3
    code = code.replace("<", "&lt;")
    plain = " ".join(code.replace("&lt;", "<").split())
    assert main_text(f"<p>{LONG}</p><pre>{code}</pre><p>{LONG}</p>") == f"{TEXT}\n\n{plain}\n\n{TEXT}"
    assert main_text(f"<pre>{code}</pre>") == plain
    row = "Nitrogen 78.084, oxygen 20.946, argon 0.934, carbon dioxide 0.042, neon 0.0018"
    assert main_text(f"<p>{LONG}</p><table><tr><td>{row}</td></tr></table><p>{LONG}</p>") == f"{TEXT}\n\n{row}\n\n{TEXT}"
