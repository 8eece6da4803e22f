"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags.  The first pass judges each block
by its length, the share of its characters inside links and the share of stop
words; short blocks stay undecided, and so do longer ones with few stop words.  Scripts
and pages without any known stop words are judged by length and links alone.  The second pass gives an undecided
block the label of its nearest decided neighbours: good between two good ones, else
bad, save for a heading before good text.  Blocks inside elements
that are never the article (menus, headers of the page, footers, forms, adverts, notices,
comments, by element or by the words of class and id) are bad from the start, and so are hidden
ones.  A name does not count for an element that holds a main element or the longest article.  Inside an
``article`` or ``main`` element a block is taken to belong unless links fill it.

Edge cases: null, empty and text-free pages give an empty text.  Text outside any
tag is a block.  Unclosed elements end where the element around them ends;
an end tag without a start is ignored.  Repeated rows are read each for itself.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from seriesmill.llm.common import map_texts

# Names of elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "title")
NEVER_TAGS = frozenset("nav footer aside form button select menu dialog fieldset option label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted cookie cookies consent gdpr notice"
    " popup modal overlay newsletter subscribe subscription signup login sidebar side aside rail widget widgets menu nav navbar"
    " navigation breadcrumb breadcrumbs topbar toolbar footer foot masthead comment comments disqus reply replies respond share"
    " sharing social related recommended recommendations trending pagination pager tags search skip copyright".split()
)

COMMENT_WORDS = frozenset("comment comments reply replies disqus".split())
# "has-sidebar" names a page with a side bar, not the bar
WITH_WORDS = frozenset("has with no without".split())
# "sidebar-layout" and "content-sidebar-wrap" name what holds text and bar together
BAR_WORDS = frozenset("sidebar side aside rail".split())
WRAP_WORDS = frozenset("wrap wrapper container grid row".split())

# Frequent small words of English, German, French and Spanish, then Italian, Portuguese, Dutch, Swedish, Danish, Norwegian,
# Finnish, Polish, Czech, Hungarian, Romanian, Turkish, Indonesian, Vietnamese, Russian, Ukrainian, Bulgarian, Greek, Arabic, Persian, Hebrew, Hindi.
STOP_WORDS = frozenset(
    "a about all an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on"
    " one or our out she so that the their them there they this to up was we were what when which who will with would you your"
    " aber als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist"
    " kann mit nach nicht noch nur oder sein sich sie sind so um und von vor war wie wird zu zum zur über nicht"
    " au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour qui"
    " que sa se ses son sont sur un une vous"
    " al como con de del el en es esta este ha la las lo los más me mi muy no o para pero por que se ser si sin sobre su sus"
    " también un una y ya"
    " ai al alla alle anche che chi ci col da dal dalla degli dei del della delle di e ed era gli ha hanno i il io la le lo ma nel nella non o per"
    " perché più quando questa questo se si sono stato su sua sul sulla suo tra un una uno è"
    " ao aos as até com como da das do dos ela ele em entre era essa esse eu foi há isso já mais mas na nas nos não num o os ou para pela pelo"
    " por quando que quem se sem ser seu sua são também tem um uma à é"
    " aan al als bij dan dat de der deze die dit door een en er had heb heeft het hij hoe ik in is je kan maar met mijn na naar niet nog of om"
    " onder ook op over te tot uit van veel voor was wat we werd wordt zich zij zijn zo zou"
    " alla att av blev de dem den denna det detta där efter ej eller en ett från för ha hade han har hon i inte jag kan man med men mot när och"
    " om på sig sin ska som så till under upp ut var vi vid är"
    " af at blev blir ble da dem den der deres det dette din eller en er et etter efter for fra få han har havde hadde hun hvis hvor i ikke jeg"
    " kan man med men mit mot når nu og også om over på seg sig ser sin skal som så til ud ut var ved vi vil være å"
    " ei ettei että hän ja jo joka jos kanssa kuin kun me minä mitä mutta mukaan myös niin nyt oli olla on ovat se sekä sen siitä tai tämä vain voi"
    " aby albo ale bardzo bez by był była było być co czy dla do gdy go i ich jak jako jego jej jest jeszcze już ma może na nad nie niż o od oraz po"
    " pod przez przy się są ta tak także tego tej ten to tych tym tylko w we więc wszystko z za ze że"
    " aby ale ani až bude by byl byla bylo být co další do i jak jako je jeho jejich jen ještě již jsem jsou k kde kdy která které který má na nebo"
    " než o od po pod pro při s se si tak také to tím u v ve však z za že"
    " a az azt csak de egy el és ez ezt fel ha hogy is itt ki kell le lehet majd meg még mert mi mint minden már nagyon nem nincs olyan pedig s szerint"
    " van vagy volt"
    " a acest această al ale am ar au că care ce cel cu de din dintre este fi fost în și la lui mai nu o pe pentru prin sa sau se sunt un unei"
    " unui"
    " ama bir bu böyle çok da daha de değil diye en gibi hem her için ile ise kadar ki mi mu ne o olan olarak oldu olduğu sonra şey şu tüm var ve"
    " veya ya yok"
    " ada adalah akan atau bagi bahwa bisa dalam dan dapat dari dengan di ia ini itu juga karena ke lebih mereka oleh pada para saat saya sebagai"
    " sudah tahun telah tidak untuk yang"
    " bị các cho chúng có còn cũng của là làm lại một mà này những như nhiều không khi để đã đó được đến sẽ tại thì trong trên tôi từ và vào về"
    " với vì ra người"
    " а без бы был была были было быть в вам вас весь во вот все всё вы где да для до его ее её если есть еще ещё же за и из или им их к как"
    " когда которые который ли мне может мы на не него нет но о об он она они от по под при с со так также то только том ты у уже что чтобы"
    " это этот я"
    " або але був була були в від він вона вони все для до є з за і із й його її їх як який які коли ми на не ні о по при про та так також те"
    " тільки то у це цей ця чи що щоб я"
    " а без бе беше в във все го да до е за и из или им като към ли ми на не ни но около от по през при с са се си след със съм те то това той"
    " тя че ще"
    " από αυτή αυτό για δεν ένα ένας έχει η ήταν θα και κατά με μετά μια μπορεί να ο οι όπως ότι που πως σας σε στα στη στην στις στο στον τα της"
    " τη την τις το τον του τους των ως είναι"
    " أن أو إلى إن التي الذي الى ان او بعد به بها بين تم ثم حتى ذلك عن على عند غير في قبل قد كان كانت كل كما لا لم له لها ما مع من منذ هذا هذه هو"
    " هي و وقد ولا يا"
    " آن از است این با باید بر برای بود به تا تواند چه خود در دارد را شد شده شود که کرد کرده کند می ما نیز هر هم های و یا یک"
    " אבל או אחד אך אל אם אני את בין גם הוא היא היה הם זה זו יותר יש כי כל כמו לא לו מה מי מן על עד עם רק של"
    " आप इस इसके उस उसके एक और कर करने कि किया की कुछ के को गया जा जो तक तो था थी थे नहीं पर ने बहुत भी में यह या ये लिए वह वे से हम ही है हैं हो".split()
)
# Scripts written without spaces between words or without small words here: Hangul, Han, Kana, Thai, Lao, Burmese, Khmer and others
_NO_WORDS = re.compile(r"[\u0530-\u058F\u0980-\u109F\u10A0-\u11FF\u1200-\u139F\u1780-\u18AF\u2D00-\u2D2F\u2E80-\u9FFF\uA960-\uA97F\uAC00-\uD7FF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF]")
# of these, a character counts as two
_DENSE = re.compile(r"[\u1100-\u11FF\u2E80-\u9FFF\uAC00-\uD7FF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF]")

LINK_SHARE = 0.2  # above it a block is bad
ARTICLE_LINK_SHARE = 0.6  # inside the article element
SHORT = 70  # characters under which a block cannot be judged by itself
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
HEADING_REACH = 200  # characters of undecided text between a heading and the text it heads

# read from left to right, so that neither hides the other
_SKIP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+>?|<\?[^>]*+>?"
    r"|<(" + "|".join(RAW_TAGS) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)",
    re.S | re.I,
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^<>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?+")
# "hidden md:block": hidden on small screens only
_SHOWN = re.compile(r"[a-z0-9-]+:(?:block|flex|grid|contents|flow-root|table|inline(?:-[a-z]+)?|visible|not-hidden)")
# marks of the Devanagari vowels are no letters
_WORD = re.compile(r"(?:[^\W\d_]|[\u0900-\u0903\u093A-\u094F\u0962\u0963])+")


class Mark:
    """An element that names or hides what it holds, and the marked element around it."""

    __slots__ = ("around", "bad", "freed", "named")

    def __init__(self, around: Mark | None, named: bool):
        self.around, self.named = around, named
        self.freed = False  # holds the article, so its name does not count
        self.bad = True


class Block:
    __slots__ = ("article", "heading", "linked", "mark", "never", "parts")

    def __init__(self, mark: Mark | None, article: bool, heading: bool):
        self.parts: list[str] = []
        self.linked = 0
        self.never = False
        self.mark, self.article, self.heading = mark, article, heading


def _attributes(written: str) -> dict[str, str]:
    """Values by lower-case name; of repeated names the first counts, a bare name has an empty value."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(written):
        found.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    """Whether an element is not shown: by its attributes, its style or the exact class."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    classes = attributes.get("class", "").lower().split()
    if "hidden" in classes and not any(_SHOWN.fullmatch(c) for c in classes):
        return True
    for rule in attributes.get("style", "").lower().split(";"):
        name, _, value = rule.partition(":")
        if (name.strip(), value.replace("!important", "").strip()) in (("display", "none"), ("visibility", "hidden")):
            return True
    return False


def _holds_both(parts: list[str]) -> bool:
    """Whether a name is that of a wrapper around text and bar."""
    if BAR_WORDS.isdisjoint(parts):
        return False
    return "layout" in parts or (not {"content", "main"}.isdisjoint(parts) and not WRAP_WORDS.isdisjoint(parts))


def _named_never(name: str, attributes: dict[str, str]) -> bool:
    """Whether the words of class, id and role say that an element is not the article."""
    words = COMMENT_WORDS if name == "article" else NEVER_WORDS
    for key in ("class", "id", "role"):
        for value in attributes.get(key, "").lower().split():
            parts = re.split(r"[^a-z]+", value)
            if not words.isdisjoint(parts) and WITH_WORDS.isdisjoint(parts) and not _holds_both(parts):
                return True
    return False


def _free(marks: list[Mark], articles: list[tuple[Mark | None, int | None]]) -> None:
    """Names do not condemn what holds a main element, or an article of at least half the text of the longest one.

    Shorter articles (teasers of other pages) leave the names around them as they are.
    """
    longest = max((n for _, n in articles if n is not None), default=0)
    for mark, n in articles:
        if n is not None and (2 * n < longest or not n):
            continue
        while mark is not None and not mark.freed:
            mark.freed = True
            mark = mark.around
    for mark in marks:  # outer ones first
        mark.bad = not (mark.named and mark.freed) or (mark.around is not None and mark.around.bad)


def blocks(html: str) -> list[tuple[str, Block]]:
    """Blocks with text, in page order: (text, block)."""
    html = _SKIP.sub(lambda m: " " if m.group(1) else "", html)
    # name, the marks around it, of an article or main element its place in articles
    open_tags: list[tuple[str, Mark | None, int]] = []
    mark: Mark | None = None
    article = links = heading = 0
    held = 0  # characters outside links so far
    made: list[Block] = []
    marks: list[Mark] = []
    articles: list[tuple[Mark | None, int | None]] = []  # the marks around it, its characters (none: a main element)
    current: Block | None = None
    at = 0

    def close(upto: int) -> None:
        nonlocal mark, article, links, heading
        while len(open_tags) > upto:
            name, mark, place = open_tags.pop()
            if name == "article" and place >= 0:
                articles[place] = (articles[place][0], articles[place][1] + held)
            article -= name in ("article", "main")
            links -= name == "a"
            heading -= name in HEADINGS

    def take(text: str) -> None:
        nonlocal current, held
        if not text:
            return
        if current is None:
            if text.isspace():
                return
            current = Block(mark, article > 0, heading > 0)
            made.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())
        else:
            held += len(text.strip())

    for m in _TAG.finditer(html):
        take(html[at : m.start()])
        at = m.end()
        name = m.group(2).lower()
        if name in BLOCK_TAGS:
            current = None
        if m.group(1):
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    close(i)
                    break
            continue
        if name == "br":
            # one break is white space, a second one parts blocks
            if current is not None and current.parts and current.parts[-1] == "\n":
                current = None
            else:
                take("\n")
            continue
        if name in VOID_TAGS:
            continue
        if name in BLOCK_TAGS:
            # a paragraph ends where the next block starts
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == "p" or (open_tags[i][0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option")):
                    close(i)
                    break
                if open_tags[i][0] in BLOCK_TAGS:
                    break
        inside = article > 0
        bad = name in NEVER_TAGS or (name == "header" and not inside)
        named = False
        if not bad and m.group(3) and name not in ("html", "body", "main"):
            attributes = _attributes(m.group(3))
            bad = _hidden(attributes)
            named = not bad and _named_never(name, attributes)
        place = -1
        if not (bad or named) and name in ("article", "main"):
            place = len(articles)
            articles.append((mark, None if name == "main" else -held))
        open_tags.append((name, mark, place))
        if bad or named:
            mark = Mark(mark, named)
            marks.append(mark)
        article += name in ("article", "main")
        links += name == "a"
        heading += name in HEADINGS
    take(html[at:])
    close(0)
    _free(marks, articles)
    for b in made:
        b.never = b.mark is not None and b.mark.bad
    texts = [(" ".join(unescape("".join(b.parts)).split()), b) for b in made]
    return [(t, b) for t, b in texts if t]


def size(text: str) -> int:
    """Length of a text, as it would be in an alphabet."""
    return len(text) if text.isascii() else len(text) + len(_DENSE.findall(text))


def stop_share(text: str) -> float | None:
    """Share of the small words; none where the script has no known ones."""
    if not text.isascii() and 2 * len(_NO_WORDS.findall(text)) > sum(map(str.isalpha, text)):
        return None
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(text: str, block: Block) -> str:
    """good, bad, odd (of few small words), or one of the undecided: near (a longer one) and short."""
    if block.never:
        return "bad"
    share = block.linked / len(text)
    if block.article:
        return "bad" if share > ARTICLE_LINK_SHARE else "good"
    if share > LINK_SHARE or text.startswith("©"):
        return "bad"
    long = size(text)
    if long < SHORT:
        return "short"
    stops = stop_share(text)
    if stops is None or stops >= STOP_HIGH:
        return "good" if long > LONG else "near"
    return "near" if stops >= STOP_LOW else "odd"


def settled(labels: list[str], found: list[tuple[str, Block]]) -> list[str]:
    """Odd blocks are judged by the page.

    Beside an article or main element they are bad.  Where no block has the small words of a known language,
    these cannot tell: long blocks are good.  Else long ones (code, tables, lists, another language) go with the text
    beside them, others with the text around them.
    """
    if any(label == "good" and b.article for label, (_, b) in zip(labels, found)):
        return ["bad" if label == "odd" else label for label in labels]
    known = any(label in ("good", "near") and stop_share(t) is not None for label, (t, _) in zip(labels, found))
    made = []
    for label, (text, _) in zip(labels, found):
        if label == "odd":
            long = size(text) > LONG
            label = ("near" if long else "short") if known else ("good" if long else "near")
        made.append(label)
    return made


def second_pass(labels: list[str], found: list[tuple[str, Block]]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided block on either side."""
    n = len(labels)
    before, after = ["bad"] * n, ["bad"] * n
    seen = "bad"
    for i in range(n):
        before[i] = seen
        seen = labels[i] if labels[i] in ("good", "bad") else seen
    seen, gap = "bad", 0
    heads = [False] * n
    for i in range(n - 1, -1, -1):
        after[i] = seen
        heads[i] = seen == "good" and gap <= HEADING_REACH
        if labels[i] in ("good", "bad"):
            seen, gap = labels[i], 0
        else:
            gap += len(found[i][0])
    keep = []
    for i, label in enumerate(labels):
        sides = (before[i], after[i])
        if label == "near":
            keep.append("good" in sides)
        elif label == "short":
            keep.append(sides == ("good", "good") or (found[i][1].heading and heads[i]))
        else:
            keep.append(label == "good")
    return keep


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    keep = second_pass(settled([first_pass(t, b) for t, b in found], found), found)
    return "\n\n".join(t for (t, _), k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def made(pages: list) -> dict:
        texts = [main_text(h) for h in pages]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_texts(pages, ["page_id", "url"], "html", "text string, n_chars long", made)
