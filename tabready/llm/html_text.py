"""Main text of web pages by tree scoring.

A page becomes a tree; scripts, forms, navigation, notices, adverts and reader
comments leave it by element, role and class words.  Every paragraph passes
points for its length and its commas to its ancestors, fewer with each level,
and a container's sum is discounted by its link density.  The best container,
or the article around it, is kept, with those siblings that score or read like
text.  Blocks are joined in page order.

Forms and boxes that only their class words drop are looked into.  One that
holds an article or main stays (a form without its controls).  If hardly any
text is left without them, and none in an article or main, the one that holds
most of the page's unlinked text comes back, or else all of them; boxes of
reader comments only come back if nothing at all is left.  Class words are read
out of camelCase and of compounds that begin with a telling stem.  Comments
without such a name are known by their shape: siblings of one kind that each
hold a link or button to reply.

Defined results: null, empty or text-free html gives an empty text; broken,
unclosed or cut-off markup is read as far as it goes; texts of any depth and
length are read whole and without recursion, in time that grows with their
length; of containers with equal scores the first is best; repeated rows get equal
results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
ITEM_OF = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
DROPPED = frozenset("nav aside footer button select input svg math canvas object audio video map dialog "
                    "menu head".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                          "toolbar".split())
DROPPED_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs "
                          "comment comments commentlist disqus respond cookie cookies consent gdpr footer header masthead menu nav navbar "
                          "navigation newsletter subscribe subscription notice notices notification alert pager pagination popup "
                          "modal overlay promo promoted promotion related recommended recommendations share sharing social "
                          "sidebar sponsor sponsored toolbar widget widgets login signup signin copyright outbrain taboola "
                          "replies responses reviews discussion discussions guestbook paywall bio".split())
READER_WORDS = frozenset("comment comments commentlist disqus respond replies responses reviews discussion discussions guestbook".split())
# Beginnings of compounds, words that begin so and mean something else, and what a link to reply says.
DROPPED_STEMS = ("comment", "cookie", "advert", "newsletter", "subscrib", "breadcrumb", "sidebar", "paywall", "popup", "sponsor")
OTHER_WORDS = ("commentar", "advertise-with")
REPLIES = frozenset(("reply", "replies", "reply to this", "antworten", "répondre", "responder", "rispondi", "beantwoorden", "ответить", "返信", "回复"))
COMMAS = re.compile("[,\u060c\u3001\uff0c]")
KEPT_WORDS = frozenset("has with no without".split())
NEVER_DROPPED = frozenset("html body article main".split())
#: Hardly any text: less than these characters and than this share of the page's.
FEW_CHARS, FEW_SHARE = 200, 0.1
TEXT_LIKE = frozenset("p pre h1 h2 h3 h4 h5 h6 ul ol dl blockquote figure table".split())
BOXES = frozenset("div section article main body td blockquote".split())

ATTRIBUTE = re.compile(r"[\s/]*([^\s>/][^\s=>/]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
COMMENT_END = re.compile(r"--!?>")
TAG_END = re.compile(r"[\s/]*>")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """The tree in page order: a parent always stands before its children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out, self.link = ["#root"], [-1], [False], [False]
        self.named_out = [False]  # by its class or id words only
        self.form, self.readers = [False], [False]
        self.runs: list[tuple[int, str]] = []  # node and text; a block boundary is a space
        self._open = [0]
        # places in the stack of open elements: of each name, and of those that are no inline ones
        self._at: dict[str, list[int]] = {}
        self._blocks, self._seen = [0], {"#root"}
        self._read(source)

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._text(s[at:lt])
                at = lt
                continue
            if s.startswith("<!--", at):
                empty = next((x for x in ("<!-->", "<!--->") if s.startswith(x, at)), None)
                end = COMMENT_END.search(s, at + 4)
                at = at + len(empty) if empty else end.end() if end else n
            elif s.startswith(("<!", "<?"), at):
                end = s.find(">", at)
                at = n if end < 0 else end + 1
            elif m := NAME.match(s, at + 2 if s.startswith("</", at) else at + 1):
                closing, name, at = s[at + 1] == "/", m[0].lower(), m.end()
                attributes: dict[str, str] = {}
                while not (end := TAG_END.match(s, at)):
                    a = ATTRIBUTE.match(s, at)
                    if not a:
                        return  # the page ends inside a tag
                    attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
                    at = a.end()
                at = end.end()
                if closing:
                    self._close(name)
                else:
                    self._start(name, attributes)
                    if name in RAW:
                        end = re.compile(rf"</{name}[\s/>]", re.I).search(s, at)
                        at = end.start() if end else n
            else:
                self._text("<")
                at += 1

    def _text(self, raw: str) -> None:
        self.runs.append((self._open[-1], entities.unescape(raw) if "&" in raw else raw))

    def _break(self) -> None:
        self.runs.append((self._open[-1], " "))

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name in ("html", "body") and name in self._seen:
            return
        self._seen.add(name)
        if name in CLOSES_P:
            self._close_up_to({"p"}, BOXES | {"button", "li"} - {"p"})
        if name in ITEM_OF:
            self._close_up_to(*ITEM_OF[name])
        if name not in INLINE:
            self._break()
        node, parent = len(self.tag), self._open[-1]
        self.tag.append(name)
        self.parent.append(parent)
        self.out.append(self._dropped(name, attributes))
        self.named_out.append(self._named_dropped(name, attributes))
        self.form.append(name == "form" or name not in ("html", "body", "main") and attributes.get("role", "").lower() == "form")
        self.readers.append(self.named_out[-1] and any(w in READER_WORDS or w.startswith("comment") for w in self._name_words(attributes)))
        self.link.append(self.link[parent] or name == "a")
        if name not in VOID:
            self._at.setdefault(name, []).append(len(self._open))
            if name not in INLINE:
                self._blocks.append(len(self._open))
            self._open.append(node)

    def _innermost(self, names: set[str] | frozenset[str]) -> int:
        """The place of the last opened element of these names, 0 if none is open."""
        return max((self._at[x][-1] for x in names if self._at.get(x)), default=0)

    def _cut(self, place: int) -> None:
        """Close the element at this place and all opened after it."""
        for k in range(len(self._open) - 1, place - 1, -1):
            self._at[self.tag[self._open[k]]].pop()
            if self._blocks[-1] == k:
                self._blocks.pop()
        del self._open[place:]

    def _close_up_to(self, names: set[str], stop: set[str] | frozenset[str]) -> None:
        place = self._innermost(names)
        if place > self._innermost(stop - names):
            self._cut(place)

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._break()
        if name in ("html", "body"):
            return
        place = self._innermost({name})
        # an inline element ends within its block only
        if place and (name not in INLINE or place > self._blocks[-1]):
            self._cut(place)
        if name not in INLINE:
            self._break()

    @staticmethod
    def _dropped(name: str, attributes: dict[str, str]) -> bool:
        if name in NEVER_DROPPED and name != "article":
            return False
        if name in DROPPED or "hidden" in attributes or attributes.get("role", "").lower() in DROPPED_ROLES:
            return True
        return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I))

    @staticmethod
    def _name_words(attributes: dict[str, str]) -> list[str]:
        return [w.lower() for w in WORDS.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")]

    @classmethod
    def _named_dropped(cls, name: str, attributes: dict[str, str]) -> bool:
        if name in NEVER_DROPPED and name != "article" or not ("class" in attributes or "id" in attributes):
            return False
        words = cls._name_words(attributes)
        told = any(w in DROPPED_WORDS or w.startswith(DROPPED_STEMS) and not w.startswith(OTHER_WORDS) for w in words)
        return told and not any(w in KEPT_WORDS for w in words)

    def _mark_replies(self) -> None:
        """Siblings of one name that each hold a link or button to reply are
        reader comments, whatever their class."""
        holds: set[int] = set()
        said: dict[int, str] = {}
        for node, text in self.runs:
            place = node
            while self.tag[place] in INLINE and self.tag[place] != "a" and place:
                place = self.parent[place]
            if self.tag[place] in ("a", "button"):
                said[place] = said.get(place, "") + text
        for node, text in said.items():
            if " ".join(text.split()).casefold() in REPLIES:
                for _ in range(6):
                    holds.add(node)
                    node = self.parent[node]
                    if node <= 0 or self.tag[node] in NEVER_DROPPED and self.tag[node] != "article":
                        break
        kinds: dict[tuple[int, str], list[int]] = {}
        for node in holds:
            if self.tag[node] not in INLINE and self.tag[node] != "button":
                kinds.setdefault((self.parent[node], self.tag[node]), []).append(node)
        for nodes in kinds.values():
            if len(nodes) > 1:
                for node in nodes:
                    self.named_out[node] = self.readers[node] = True

    def _bring_back(self, box: list[bool], out: list[bool]) -> None:
        """Take the mark from boxes that hold the page's text.  ``box`` marks
        what its form or class words drop, ``out`` what goes in any case."""
        tag, parent, n = self.tag, self.parent, len(self.tag)
        around, main = [0] * n, [False] * n  # the nearest box, and whether an article or main is around
        for i in range(1, n):
            out[i] = out[i] or out[parent[i]]
            around[i] = i if box[i] else around[parent[i]]
            main[i] = main[parent[i]] or tag[i] in ("article", "main")
        own, in_main = [0] * n, [False] * n  # unlinked text of a box, without the boxes in it
        for node, text in self.runs:
            if not out[node] and not self.link[node] and (size := len(text.strip())):
                own[around[node]] += size
                in_main[around[node]] |= main[node]
        whole, inner = own[:], {0: []}
        for i in range(n - 1, 0, -1):
            if box[i] and whole[i]:
                whole[around[parent[i]]] += whole[i]
                inner.setdefault(around[parent[i]], []).append(i)
        left, said = own[0], in_main[0]
        plain, readers = [], []

        def see(into: int) -> None:
            for i in inner.get(into, ()):
                heapq.heappush(readers if self.readers[i] else plain, (-whole[i], i))

        see(0)
        while (plain or readers and not left) and not (left and said) and left < min(FEW_CHARS, FEW_SHARE * whole[0]):
            queue = plain if left or not readers or plain and plain[0] <= readers[0] else readers
            most = -2 * queue[0][0] > whole[0]
            for _ in range(1 if most else len(queue)):
                i = heapq.heappop(queue)[1]
                box[i] = False
                left, said = left + own[i], said or in_main[i]
                see(i)

    def main_text(self) -> str:
        tag, parent, out = self.tag, self.parent, self.out
        n = len(tag)
        self._mark_replies()
        if "article" not in tag and "main" not in tag:
            header = [t == "header" for t in tag]
        else:  # a header inside the article is the article's own
            inside = [False] * n
            for i in range(1, n):
                inside[i] = inside[parent[i]] or tag[i] in ("article", "main")
            header = [t == "header" and not inside[i] for i, t in enumerate(tag)]
        holds_main = [False] * n  # a wrapper of the article stays, whatever its class says
        for i in range(n - 1, 0, -1):
            if holds_main[i] or tag[i] in ("article", "main") and not self.named_out[i]:
                holds_main[parent[i]] = True
        box = [(self.named_out[i] or self.form[i]) and not holds_main[i] for i in range(n)]
        for i in range(1, n):
            out[i] = out[i] or header[i]
        self._bring_back(box, out)
        for i in range(1, n):
            out[i] = out[i] or box[i] or out[parent[i]]
        chars, commas, linked, direct = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.runs:
            if not out[node] and (size := len(text.strip())):
                chars[node] += size
                commas[node] += len(COMMAS.findall(text))
                linked[node] += size * self.link[node]
                direct[node] += size
        for i in range(n - 1, 0, -1):
            chars[parent[i]] += chars[i]
            commas[parent[i]] += commas[i]
            linked[parent[i]] += linked[i]
            if tag[i] in INLINE:
                direct[parent[i]] += direct[i]
        if not chars[0]:
            return ""
        score = [0.0] * n
        for i in range(1, n):
            if out[i] or not chars[i] or not (tag[i] in ("p", "pre", "td", "blockquote") or tag[i] in BOXES and direct[i] > 0):
                continue
            points = (1 + commas[i] + min(chars[i] / 100, 3.0)) * (1 - linked[i] / chars[i])
            holder, level = (parent[i] if tag[i] in ("p", "pre") else i), 0
            while holder > 0 and level < 6:
                score[holder] += points / (1, 2, 6, 9, 12, 15)[level]
                holder, level = parent[holder], level + 1
        final = [score[i] * (1 - linked[i] / chars[i]) if chars[i] else 0.0 for i in range(n)]
        best = max(range(n), key=lambda i: (final[i], -i))
        if final[best] <= 0:
            best = next((i for i in range(n) if tag[i] in ("article", "main") and chars[i] and not out[i]), 0)
        holder = best
        while holder > 0:  # the outermost article or main around the best container
            if tag[holder] in ("article", "main"):
                best = holder
            holder = parent[holder]
        keep = [False] * n
        keep[best] = True
        if tag[best] not in ("#root", "html", "body", "article", "main"):
            for i in range(1, n):
                if i != best and parent[i] == parent[best] and chars[i] and not out[i]:
                    density = linked[i] / chars[i]
                    keep[i] = final[i] >= max(10.0, 0.2 * final[best]) or tag[i] in TEXT_LIKE and density < 0.3
        for i in range(1, n):
            keep[i] = (keep[i] or keep[parent[i]]) and not out[i]
        if best == 0:
            keep = [not x for x in out]
        # boundaries count everywhere: text kept on both sides of one stays apart
        return " ".join("".join(t if keep[node] else " " for node, t in self.runs if t == " " or keep[node] or out[node]).split())


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return Page(source).main_text() if source else ""


def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(x) for x in batch], dtype="object")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``, one row per input row."""
    text = F.pandas_udf(releasing(_main_text), "string")(F.col(html_col))
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
