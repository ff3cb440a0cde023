"""Flat text blocks of an HTML page, and what a classifier sees of them and their neighbours."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Comments, declarations, or a tag: its slash, name and attributes. A quote opens a value only after "=".
TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")

#: Elements whose content is no text of the page.
RAW = set("script style noscript template textarea title iframe noframes noembed object svg math select datalist canvas audio video xmp".split())
#: Elements that don't end a block.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SPACE = {"br", "img", "input"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that the next of their kind, or any block in the case of p, ends.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

#: What surrounds an article, by element, role and parts of class and id names.
CHROME_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "fieldset", "header"}
CHROME_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
CHROME_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos promotion banner banners teaser teasers "
    "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs toolbar topbar masthead header footer foot copyright legal "
    "sidebar side aside rail widget widgets related recommended recommendations trending popular more newsletter subscribe subscription signup login signin "
    "adbox adslot adunit adspace adcontainer adwrapper adlabel adsbygoogle share sharing social follow cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay "
    "comment comments commentlist respond replies reply disqus discussion form search pagination pager paging tags tagcloud skip hidden".split()
)
#: Comments stay comments inside any element.
REMARKS = set("comment comments commentlist respond replies reply disqus discussion".split())
BODY_WORDS = set("article articlebody story storybody post postbody entry content main maincontent text prose".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Words before a part of a class name by which it tells about a layout, not about the element.
LAYOUT = {"has", "with", "no", "without", "is", "overflow"}
#: In an article they hold its headline.
HEADS = {"header", "masthead", "banner"}


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    chrome: int  # elements around the article that hold it
    region: int  # 2 in article or main, 1 in an element named like one, 0 in none
    heading: bool
    item: bool


def name_parts(value: str) -> set[str]:
    parts = [p.lower() for p in NAME_PARTS.findall(value)]
    return {p for before, p in zip(["", *parts], parts, strict=False) if before not in LAYOUT}


class Element:
    """An open element: how many elements around the article it stands in, and in which region.

    Of these, fixed are such that main doesn't take back (a class name may tell about a whole layout,
    an element can't), and forms such that an article doesn't either (some sites put the page in one).
    """

    __slots__ = ("tag", "chrome", "region", "fixed", "forms")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None):
        self.tag = tag
        self.chrome, self.region, self.fixed, self.forms = (parent.chrome, parent.region, parent.fixed, parent.forms) if parent else (0, 0, 0, 0)
        if tag in ("html", "body"):
            return
        names = name_parts(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        role = attributes.get("role", "").lower()
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        if self.region == 2:
            names -= HEADS
        heads = tag == "header" and self.region == 2
        if tag == "main" or role == "main":
            self.chrome, self.region, self.forms = self.fixed, 2, 0
        elif tag == "article" or role == "article" or attributes.get("itemprop") == "articleBody":
            self.chrome, self.region, self.forms = self.chrome - self.forms, 2, 0
        elif not self.region and names & BODY_WORDS:
            self.region = 1
        if tag == "form":
            self.chrome, self.forms = self.chrome + 1, self.forms + 1
        elif (tag in CHROME_TAGS and not heads) or hidden or names & REMARKS:
            self.chrome, self.fixed = self.chrome + 1, self.fixed + 1
        elif (role in CHROME_ROLES or names & CHROME_WORDS) and tag not in ("main", "h1") and not heads:
            self.chrome += 1


def page_blocks(page: str | None) -> list[Block]:
    """The blocks in page order: runs of text between block elements, references decoded, white space folded."""
    page = page or ""
    found: list[Block] = []
    stack: list[Element] = [Element("", {}, None)]
    texts: list[str] = []
    linked: list[str] = []
    in_link = False
    pos, end = 0, len(page)

    def close() -> None:
        text = " ".join("".join(texts).split())
        if text:
            top = stack[-1]
            tags = {e.tag for e in stack[-4:]}
            found.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), top.chrome, top.region, bool(tags & HEADINGS), "li" in tags))
        texts.clear()
        linked.clear()

    def put(text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        texts.append(text)
        if in_link:
            linked.append(text)

    while pos < end:
        at = page.find("<", pos)
        if at < 0:
            put(page[pos:])
            break
        if at > pos:
            put(page[pos:at])
        match = TAG.match(page, at)
        if not match:
            put("<")
            pos = at + 1
            continue
        pos = match.end()
        slash, tag, rest = match.groups()
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not slash and not rest.endswith("/"):
                ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, pos)
                pos = ended.start() if ended else end
            continue
        if tag in INLINE or tag in SPACE:
            if tag == "a":
                in_link = not slash
                linked.append(" ")
            elif tag in SPACE:
                texts.append(" ")
            continue
        close()
        if slash:
            if any(e.tag == tag for e in stack):
                in_link = False
                while stack.pop().tag != tag:
                    pass
        elif tag not in VOID:
            if stack[-1].tag == "p" or (stack[-1].tag in HEADINGS and tag in HEADINGS):
                stack.pop()
            enders = ENDED_BY.get(tag)
            if enders and stack[-1].tag in enders:
                stack.pop()
            attributes = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(rest)} if rest.strip(" \t\r\n/") else {}
            stack.append(Element(tag, attributes, stack[-1]))
    close()
    return found


FEATURES = ["words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "chrome", "region", "heading", "item", "sentence"]


def block_features(blocks: list[Block]) -> list[list[float]]:
    """FEATURES of each block; none beside the first and the last count as empty blocks.

    region is -1 outside of the article on a page that marks one by its element, and 0 if none is marked.
    """
    marked = max((b.region for b in blocks if not b.chrome), default=0)
    sizes = [(float(b.words), b.link_words / b.words) for b in blocks]
    out = []
    for k, b in enumerate(blocks):
        before, after = sizes[k - 1] if k else (0.0, 0.0), sizes[k + 1] if k + 1 < len(sizes) else (0.0, 0.0)
        region = b.region if b.region == marked else -1 if marked else 0
        out.append([*sizes[k], *before, *after, float(min(b.chrome, 2)), float(region), float(b.heading), float(b.item), float(b.text[-1] in ".!?:;…\"”»)")])
    return out
