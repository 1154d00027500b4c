"""Main text of web pages by their line-block distribution."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 3  # lines of a line block
SURGE = 80  # characters that a line block must hold for the text to begin
MARKED = 2  # what a character in a marked article weighs
SHARE = 0.5  # of the heaviest article's weight, or of that outside articles, that another needs to be text too

# Elements without text of the page, elements that end a line, elements and roles of the
# frame around an article, words of class and id names that tell the frame.
RAW = "script style noscript template textarea select option iframe object svg math canvas video audio"
HEAD = "title base link meta style script noscript template"
LINE = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul"
)
FRAME = "nav footer aside form menu dialog button label input"
ROLES = "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form"
NAMES = (
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar "
    "header masthead topbar footer bottombar copyright sidebar aside rail widget widgets "
    "comment comments commentlist disqus replies respond reply "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer "
    "newsletter subscribe subscription signup login share sharing social related recommended "
    "teaser form search skip"
)
# Words that say nothing at the end of a name, names that tell the frame only alone, and those of threads,
# which may be longer than the article.
VAGUE = "wrapper wrap container inner outer section box list area block slot unit bar links buttons posts left right top bottom"
ALONE, THREADS = frozenset(("widget", "widgets")), frozenset("comment comments commentlist disqus replies".split())
RAW_TAGS, LINE_TAGS, FRAME_TAGS = (frozenset(x.split()) for x in (RAW, LINE, FRAME))
HEAD_TAGS, VAGUE_WORDS = frozenset(HEAD.split()), frozenset(VAGUE.split())
FRAME_ROLES, FRAME_NAMES = frozenset(ROLES.split()), frozenset(NAMES.split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# The tags that one may leave open, and what closes them.
OPEN_ENDED = {"p": LINE_TAGS - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"])}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")
RAW_END = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in RAW_TAGS}
RAW_END["option"] = re.compile(r"</option\s*>|(?=</?[a-z])|\Z", re.I)  # its end tag may be left out, and it holds text only
TITLE_END = re.compile(r"</title\s*>|(?=</head\b|<body\b)|\Z", re.I)


@dataclass
class Line:
    """Text between two line ends. weight: its characters outside links, or in an article all; 0 in the frame."""

    text: str
    weight: int
    frame: bool
    article: int  # number of the article or main element around it, 0 if none


def frame_word(name: str) -> str:
    """The word of a class or id name that tells the frame: its last one, without those that say nothing."""
    words = WORD.findall(name)
    if words and words[0] == "is" or not {"has", "with", "no", "js", "without"}.isdisjoint(words[:-1]):
        return ""
    while len(words) > 1 and words[-1] in VAGUE_WORDS and words[-1] not in FRAME_NAMES:
        words.pop()
    last = words[-1] if words else ""
    return last if last in FRAME_NAMES and not (last in ALONE and name != last) else ""


def is_frame(tag: str, attributes: str, in_article: bool) -> str:
    """What makes an element frame: "tag", "role", or the word of its class or id; "" if nothing does."""
    if tag in FRAME_TAGS or (tag == "header" and not in_article):
        return "tag"
    if not attributes or tag in ("html", "body", "main"):
        return ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            if value.strip() in FRAME_ROLES:
                return "role"
            continue
        for word in map(frame_word, value.split()):
            if word and not (in_article and word == "header"):
                return word
    return ""


def page_lines(page: str) -> list[Line]:
    """Strip markup: the lines of a page, in order.

    An element is not frame by its name alone if it holds most of the page's weight and no article stands
    outside the frame; threads of comments are frame at any length.
    """
    lines: list[Line] = []
    named: list[tuple[int, ...]] = []  # of each line, the elements around it that are frame by name
    stack: list[tuple[str, bool, bool, int, tuple[int, ...]]] = []  # tag, frame, link, article, names
    frame, link, article, articles = False, False, 0, 0
    names: tuple[int, ...] = ()
    head = False
    pieces: list[str] = []
    weight, at = 0, 0

    def put(raw: str) -> None:
        nonlocal weight
        pieces.append(raw)
        if not frame and (article or not link):
            weight += len(raw.strip())

    def end_line() -> None:
        nonlocal weight
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                lines.append(Line(text, weight, frame, article))
                named.append(names)
            pieces.clear()
        weight = 0

    while found := TOKEN.search(page, at):
        head = head and not page[at : found.start()].strip()
        if found.start() > at:
            put(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        head = head and tag in HEAD_TAGS
        if head and tag == "title" and not closing:
            at = TITLE_END.search(page, at).end()
            continue
        if tag == "head":
            head = not closing
            continue
        if tag in LINE_TAGS:
            end_line()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    end_line() if tag in LINE_TAGS or stack[depth][1] else None
                    _, frame, link, article, names = stack[depth]
                    del stack[depth:]
                    break
            continue
        if tag in RAW_TAGS:
            at = RAW_END[tag].search(page, at).end()
            continue
        if tag in VOID or found[3].endswith("/"):
            continue
        while stack and tag in OPEN_ENDED.get(stack[-1][0], ()):
            _, frame, link, article, names = stack.pop()
        stack.append((tag, frame, link, article, names))
        if tag in ("article", "main") and not frame:
            articles += 1
            article = article or articles
        why = "" if frame else is_frame(tag, found[3], article > 0)
        if why:
            end_line()
            if why in ("tag", "role") or why in THREADS:
                frame = True
            else:
                names += (found.start(),)
        link = link or tag == "a"
    if at < len(page):
        put(page[at:])
    end_line()
    mass: dict[int, int] = {}
    for line, inside in zip(lines, named, strict=True):
        for element in inside:
            mass[element] = mass.get(element, 0) + line.weight
    half = sum(x.weight for x in lines) / 2
    outside = any(x.article and x.weight and not n for x, n in zip(lines, named, strict=True))
    small = {element for element, m in mass.items() if outside or m <= half}
    for line, inside in zip(lines, named, strict=True):
        if not small.isdisjoint(inside):
            line.frame, line.weight = True, 0
    return lines


def _runs(weights: list[int], begin: int, end: int) -> list[tuple[int, int, int]]:
    """(first line, line after the last, highest block) of the runs between surge and dive in a stretch of lines."""
    blocks = [sum(weights[i : min(i + WINDOW, end)]) for i in range(begin, end)]
    runs, start = [], None
    for i in range(begin, end + 1):
        flat = i == end or blocks[i - begin] == 0
        if start is None and not flat:
            start = i
        elif start is not None and flat:
            heavy = [k for k in range(start, i) if weights[k]]
            runs.append((heavy[0], heavy[-1] + 1, max(blocks[start - begin : i - begin])))
            start = None
    return runs


def main_text(page: str | None) -> str:
    """The text between surge and dive points of the line-block distribution.

    The block at a line sums the weights of it and the next ``WINDOW`` - 1 lines. Text runs from
    a surge, where blocks come to hold ``SURGE`` characters, to a dive, where a block holds none;
    lines that lead up to a surge without a dive belong to it, and so do runs with only frame lines
    between them and it. Where nothing surges, the heaviest such runs are the text.

    Marked articles are evidence, not the answer. Their lines weigh ``MARKED`` times their characters, those of links
    too, and no block reaches over an article's end. The runs of one article count together, and so do those outside
    articles; of these sums the largest wins, and others that reach ``SHARE`` of it stay as well. So a teaser beside
    the body goes, and a body outside articles stays. Frame lines (menus, adverts, comments and the like) weigh
    nothing and are left out wherever they stand.
    """
    lines = page_lines(page or "")
    weights = [0 if x.frame else x.weight * (MARKED if x.article else 1) for x in lines]
    groups: list[list[tuple[int, int, int]]] = []  # runs with only frame lines between
    begin = 0
    for end in range(1, len(lines) + 1):
        if end < len(lines) and lines[end].article == lines[begin].article:
            continue
        fresh = True
        for run in _runs(weights, begin, end):
            if not fresh and all(x.frame for x in lines[groups[-1][-1][1] : run[0]]):
                groups[-1].append(run)
            else:
                groups.append([run])
            fresh = False
        begin = end
    mass = [sum(weights[group[0][0] : group[-1][1]]) for group in groups]
    surging = [k for k, group in enumerate(groups) if any(r[2] >= SURGE for r in group)]
    surging = surging or sorted(range(len(groups)), key=lambda k: -mass[k])[:1]
    sums: dict[int, int] = {}
    for k in surging:
        article = lines[groups[k][0][0]].article
        sums[article] = sums.get(article, 0) + mass[k]
    least = SHARE * max(sums.values(), default=0)
    kept = []
    for k in surging:
        first, last = groups[k][0][0], groups[k][-1][1]
        if sums[lines[first].article] >= least:
            kept += [x.text for x in lines[first:last] if not x.frame]
    return " ".join(kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` plus ``text``, the main text of the whole page ("" if none), and ``n_chars``.

    A null or empty page has no text. Columns named text or n_chars are replaced, others stay. Each row is
    read by itself, so repeated rows give equal results; of equally heavy runs that do not surge the first is the text.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            kept = [n for n in batch.schema.names if n not in ("text", "n_chars")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    kept = pages.drop(*[c for c in ("text", "n_chars") if c != html])
    schema = [f for f in kept.schema if f.name not in ("text", "n_chars")]
    out = T.StructType([*schema, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return kept.mapInArrow(run, out)


def page_report(pages: DataFrame) -> DataFrame:
    """Per page: id, address, main text and its length."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
