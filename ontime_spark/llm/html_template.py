"""Main text of web pages by templates that equivalence classes of tokens deduce.

A page is read as tokens: places (an element's path of names and classes) and texts at places. A
token's occurrence vector says how often each page of its host has it; vectors are compared through
a sum of hashes over pages, so no vector is ever held. Tokens of one host with equal vectors are an
equivalence class. From the classes of most pages down, a class is dealt to the slots of those before it,
and is valid in a slot where enough of its tokens are, on enough pages. Texts of valid classes are the
host's template, unless they are all that the slot's pages have: then the pages are copies. What the
template doesn't hold is in its slots. Main slots are the deepest containers that, over all pages of the host
which have them, hold most of those pages' other text, with what is beside them up to the next container
that mixes template and other text; so each layout has its own. An article or main element of a page stands for its slot unless it holds
much less.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.llm.common import keep, with_arrow

# Names of HTML elements and usual names of classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BREAKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section summary table tbody td tfoot th thead title tr ul caption".split()
)
HOLDERS = BREAKS | frozenset("button select textarea noscript template iframe svg object canvas audio video label math".split())
ASIDE = frozenset(
    "nav aside footer button select option textarea script style noscript template iframe svg object canvas"
    " audio video head title dialog menu label fieldset".split()
)
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar navigation"
    " breadcrumb breadcrumbs masthead footer sidebar widget widgets related recommended recommendations share sharing"
    " social cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe"
    " subscription signup login register search comment comments disqus replies responses pagination pager toolbar"
    " topbar skip".split()
)
# Names that set an element inside a line aside, and those that mean it only where most of the text is links.
LINE_NAMES = frozenset("ad ads advert advertisement sponsored promo share sharing social newsletter subscribe".split())
LINK_NAMES = frozenset("menu related recommended recommendations search register".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
MAIN = frozenset(("article", "main"))
CONTAINERS = frozenset("html body div section article main center td form".split())

ORDERED = frozenset(("div", "section"))  # without class and id these are told apart by their order
FRAMES = frozenset("nav aside footer header menu dialog fieldset".split())  # they divide a page as containers do

NAMED_SHARE = 0.9  # of a page's text that a named element holds which is taken for its article
NAMED_LENGTH = 200
LINK_SHARE = 0.5  # of the text of a list that is links and not prose
LEAST_SHARE = 0.3  # of a host's pages that a class must occur in
LEAST_PAGES = 3
LEAST_SIZE = 3  # tokens of a class in one slot
LEAST_DATA = 0.2  # of what a slot's pages have in it that a class in it must leave
BESIDE_SHARE = 0.5  # of the pages with a place that a slot of its own beside the main one is on
BESIDE_SIZE = 0.25  # of the main slot's text that such a slot may have
MAIN_SHARE = 2 / 3  # of its pages' text outside the template that a main slot holds

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|(!--|!|\?|/))")
_OPEN_END = re.compile(r"<[!?/]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NUMBER = re.compile(r"[-_\d]+$")


class Element:
    """An open element: its name and path, whether it is set aside for certain, in the article, and in which.

    named has the numbers of the elements around it, itself included, that their names may set aside.
    """

    __slots__ = ("name", "place", "aside", "named", "main", "holders", "plain")

    def __init__(self, name: str, place: str, aside: bool, named: tuple[int, ...], main: bool, holders: tuple[int, int]):
        self.name, self.place, self.aside, self.named, self.main, self.holders = name, place, aside, named, main, holders
        self.plain = 0  # children that only their order tells apart

    def outside(self) -> tuple:
        return self.aside, self.named


def _aside_words(name: str, value: str) -> set[str]:
    """The whole words of a class or id, but for numbers at their end, that are usual names of what is no article."""
    if name in ("html", "body"):
        return set()
    return {_NUMBER.sub("", w) for w in value.split()} & (ASIDE_NAMES if name in HOLDERS else LINE_NAMES)


def _freed(raw: list[tuple], holders: tuple[list, list], unsure: set[int]) -> set[int]:
    """The numbers of named elements that their names don't set aside, for what they hold.

    Those in ``unsure`` are set aside only where most of their text is links.

    These hold the page's chief article or main element, the one with most text beside what is named in it
    (articles in articles don't count, nor one shorter than the main element's text); or, in a page without
    them, nearly all of the page's text.
    """
    freed: set[int] = set()
    longest = -1
    for kind in (1, 0):
        sizes = [0] * len(holders[kind])
        for _, words, aside, named, _, inside, _ in raw:
            if not aside and inside[kind] >= 0 and named == holders[kind][inside[kind]]:
                sizes[inside[kind]] += len(words)
        if sizes and max(sizes) >= longest:
            longest = max(sizes)
            freed.update(holders[kind][sizes.index(longest)])
    if longest < 0:
        by_named: dict[tuple[int, ...], int] = {}
        for _, words, aside, named, *_ in raw:
            if not aside:
                by_named[named] = by_named.get(named, 0) + len(words)
        if by_named:
            outer: dict[int, int] = {}
            for named, length in by_named.items():
                if named:
                    outer[named[0]] = outer.get(named[0], 0) + length
            top = max(outer, key=outer.get, default=None)
            if top is not None and outer[top] >= max(NAMED_LENGTH, NAMED_SHARE * sum(by_named.values())):
                inside = {k: v for k, v in by_named.items() if k and k[0] == top}
                freed.update(max(inside, key=inside.get))
    linked = dict.fromkeys(unsure, 0.0)
    for _, words, _, named, _, _, links in raw if unsure else ():
        for n in unsure.intersection(named):
            linked[n] += links - LINK_SHARE * len(words)
    freed.update(n for n, more in linked.items() if more < 0)
    return freed


def blocks(
    page: str, slots: frozenset[int] = frozenset()
) -> tuple[list[tuple[str, str, bool, bool]], dict[str, int], dict[str, tuple[str, str]]]:
    """(blocks, places, around): each block's place, text, whether it is set aside and whether it is in the article.

    Blocks end where an element that breaks lines begins or ends. Comments, declarations and the
    contents of scripts and styles are no text. An end tag closes the last element of its name and
    what is open inside it; without one it means nothing. places counts each place's elements;
    around has its parent place and name. A name sets an element aside unless it holds the page's article or one
    of the ``slots``.
    """
    raw: list[tuple] = []
    places: dict[str, int] = {}
    around: dict[str, tuple[str, str]] = {}
    opened: dict[str, tuple[int, ...]] = {}
    holders: tuple[list, list] = ([], [])  # named elements around each outer article, and each outer main element
    names = 0
    unsure: set[int] = set()
    stack = [Element("", "", False, (), False, (-1, -1))]
    inline: dict[str, int] = {}  # open elements of a line, by name
    text: list[str] = []
    links, in_link = 0, False  # of the text since the last block's end, how much is in links
    at, size, last = 0, len(page), page.rfind(">")

    def say(words: str) -> None:
        nonlocal links
        text.append(words)
        if in_link:
            links += len(words)

    def close_to(i: int) -> None:
        for element in stack[i:]:
            if element.name not in BREAKS:
                inline[element.name] -= 1
        del stack[i:]

    def flush() -> None:
        nonlocal links
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                top = stack[-1]
                raw.append((top.place, words, top.aside, top.named, top.main, top.holders, min(links, len(words))))
            links = 0

    def push(element: Element) -> None:
        stack.append(element)
        if element.name not in BREAKS:
            inline[element.name] = inline.get(element.name, 0) + 1

    def open_element(name: str, attributes: str) -> None:
        nonlocal names
        top = stack[-1]
        aside, main, label = top.aside or name in ASIDE, top.main or name in MAIN, name
        article, middle, words = name == "article", name == "main", set()
        if name == "header" and not top.main:
            aside = True
        for key, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
            value = (a or b or c).lower()
            key = key.lower()
            if key == "role":
                aside = aside or value in ASIDE_ROLES
                article, middle = article or value == "article", middle or value == "main"
                main = main or article or middle
            else:
                label += "." + re.sub(r"\d+", "#", value)
                words |= _aside_words(name, value)
        if label == name and name in ORDERED:
            top.plain += 1
            label = f"{name}[{top.plain}]"
        place = f"{top.place}/{label}"
        if len(place) > 400:  # deep pages: the path's digest stands for its beginning
            place = hashlib.blake2b(place.encode(), digest_size=8).hexdigest()
        places[place] = places.get(place, 0) + 1
        numbers, inside = top.named, list(top.holders)
        if words or name == "form":
            names += 1
            numbers += (names,)
            if top.main and name != "form" and words <= LINK_NAMES:
                unsure.add(names)
        around.setdefault(place, (top.place, name))
        opened.setdefault(place, numbers)
        for kind, here in enumerate((article, middle)):
            if here and inside[kind] < 0:
                inside[kind] = len(holders[kind])
                holders[kind].append(numbers)
        push(Element(name, place, aside, numbers, main, tuple(inside)))

    no_comment_end = False
    while at < size:
        if at > last:  # no tag ends after this
            open_end = _OPEN_END.search(page, at)
            say(page[at : open_end.start()] if open_end else page[at:])
            break
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[7]:
            if m[7] == "!--":
                end = -1 if no_comment_end else page.find("-->", at)
                no_comment_end = end < 0
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", at)
                at = size if end < 0 else end + 1
            continue
        name = (m[2] or m[5]).lower()
        attributes = m[3] if m[2] else m[6]
        if name == "a":
            in_link = not (m[1] or m[4])
        if m[1] or m[4]:
            if name in BREAKS:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    if name not in BREAKS and stack[i].outside() != stack[i - 1].outside():
                        flush()
                    close_to(i)
                    break
            continue
        if name in BREAKS:
            flush()
            if stack[-1].name == "p" or (name == "li" and stack[-1].name == "li"):
                close_to(len(stack) - 1)
        elif name == "br":
            say(" ")
        if name in VOID:
            continue
        if name in HOLDERS or _ATTRIBUTE.search(attributes):
            was = stack[-1].outside()
            open_element(name, attributes)
            if stack[-1].outside() != was and name not in BREAKS:
                top = stack.pop()
                flush()
                stack.append(top)
        elif inline.get(name) and name not in VOID:  # its end must not close one around it
            top = stack[-1]
            push(Element(name, top.place, top.aside, top.named, top.main, top.holders))
        if name in RAW:
            low = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            inside = page[at : low.start()] if low else page[at:]
            at = low.start() if low else size
            if name in ("title", "textarea"):
                say(inside)
    flush()
    freed = _freed(raw, holders, unsure)
    for place in opened if slots else ():
        if opened[place] and _number(place) in slots:
            freed.update(opened[place])
    return [(p, w, aside or not freed.issuperset(named), main) for p, w, aside, named, main, *_ in raw], places, around


def _number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode(), digest_size=8).digest(), "little", signed=True)


FIELDS = ("token", "times", "parent", "kind", "length", "total")


def page_tokens(page: str) -> list[tuple[int, int, int, int, int, int]]:
    """(token, times, parent token, kind, length, total) of a page: kind 0 is a place, 1 a text at a place,
    2 a place that is a container, 3 a chief heading's, 4 another one that divides a page.

    A length counts text that is not set aside: a place's all in and under it, a text's all its times; total
    is the page's.
    """
    found, places, around = blocks(page)
    lengths: dict[str, int] = {}
    texts: dict[tuple[str, str], list[int]] = {}
    for place, words, aside, _ in found:
        firm = 0 if aside else len(words)
        seen = texts.setdefault((place, words), [0, 0])
        seen[0] += 1
        seen[1] += firm
        lengths[place] = lengths.get(place, 0) + firm
    total = sum(lengths.values())
    # A place stands in ``around`` after its parent.
    for p in reversed(around):
        lengths[around[p][0]] = lengths.get(around[p][0], 0) + lengths.get(p, 0)
    number = {p: _number(p) for p in places} | {"": 0}
    kind = lambda name: 2 if name in CONTAINERS else 3 if name == "h1" else 4 if name in FRAMES else 0
    out = [(number[p], n, number[around[p][0]], kind(around[p][1]), lengths.get(p, 0), total) for p, n in places.items()]
    out += [(_number(p, w), n, number[p], 1, length, total) for (p, w), (n, length) in texts.items()]
    return out


class Template:
    """What a host's frequent tokens deduce: its template's texts and main slots.

    tokens are rows of the fields of FIELDS, summed over pages (parent and kind alike on all), with pages
    and vector.
    """

    def __init__(self, tokens: list[dict]):
        self.at = {t["token"]: t for t in tokens}
        self.texts: list[int] = []
        self.framed: dict[int, float] = {}  # valid tokens: their pages' template text in the classes around them
        classes: dict[tuple, list[dict]] = {}
        for t in tokens:
            classes.setdefault((t["pages"], t["vector"]), []).append(t)
        for key in sorted(classes, key=lambda c: (-c[0], classes[c][0]["times"], c[1])):
            self._nest(classes[key])

    def slot(self, token: dict) -> int:
        """The valid place around a token: one of an earlier class, as its own is not valid yet; 0 at the root."""
        p = token["parent"]
        while p in self.at and p not in self.framed:
            p = self.at[p]["parent"]
        return p if p in self.framed else 0

    def _nest(self, members: list[dict]) -> None:
        parts: dict[int, list[dict]] = {}
        for t in members:
            parts.setdefault(self.slot(t), []).append(t)
        valid = [(around, part) for around, part in parts.items() if len(part) >= LEAST_SIZE]
        if not valid:
            return
        pages = members[0]["pages"]
        before = max(self.framed.get(around, 0.0) for around, _ in valid)
        own = sum(t["length"] for t in members if t["kind"] == 1) / pages
        data = members[0]["total"] / pages - before
        copies = own > 0 and data - own < LEAST_DATA * data
        for around, part in valid:
            if not copies:
                self.texts += [t["token"] for t in part if t["kind"] == 1]
            for t in part:
                self.framed[t["token"]] = before + (0 if copies else own)

    def _recurs(self, beside: int, around: int, text: float) -> bool:
        """Whether a place is on most pages that have the one around it, with much less than ``text`` on each."""
        m = self.at[beside]
        return m["pages"] >= BESIDE_SHARE * self.at[around]["pages"] and m["length"] < BESIDE_SIZE * text * m["pages"]

    def slots(self) -> list[int]:
        """The main slots: of those that a page has, the ones around no other are its own."""
        held: dict[int, float] = {}  # the template's text in and under each place
        marked: dict[int, set[int]] = {}  # children that hold a text of the template
        titled: set[int] = set()  # places around chief headings
        for text in map(self.at.get, self.texts):
            below, p = None, text["parent"]
            while p in self.at:
                held[p] = held.get(p, 0) + text["length"]
                marked.setdefault(p, set())
                if below is not None:
                    marked[p].add(below)
                below, p = p, self.at[p]["parent"]
        for p in (t["token"] for t in self.at.values() if t["kind"] == 3 and t["length"] > held.get(t["token"], 0)):
            while p in self.at:
                titled.add(p)
                p = self.at[p]["parent"]
        frames: dict[int, list[int]] = {}  # what divides each place
        for t, v in self.at.items():
            if v["kind"] in (2, 4):
                frames.setdefault(v["parent"], []).append(t)
        single = {t: v for t, v in self.at.items() if v["kind"] == 2 and v["times"] == v["pages"]}
        found = set()
        for token, place in single.items():
            valid = token if token in self.framed else self.slot(place)
            data = place["length"] - held.get(token, 0)
            if data <= 0 or data < MAIN_SHARE * (place["total"] - place["pages"] * self.framed.get(valid, 0)):
                continue
            # What is beside it belongs to it, unless something there is a slot of its own: it has text beside
            # the template's and no chief heading, and either some of the template, too, or it is on most of the
            # pages and holds much less.
            below, top, p = token, token, place["parent"]
            while p in self.at:
                beside = [m for m in frames.get(p, ()) if m != below and m not in titled and self.at[m]["length"] > held.get(m, 0)]
                if any((m in marked.get(p, ()) and self.at[m]["kind"] == 2) or self._recurs(m, p, data / place["pages"]) for m in beside):
                    break
                if p in single:
                    top = p
                below, p = p, self.at[p]["parent"]
            found.add(top)
        return sorted(found)


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def templates(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(host, texts, slots): each host's template and main slots, from all its pages.

    Token rows are summed before the shuffle, so a host with a third of all pages costs one row per
    token and task. Only tokens of at least 30 % of a host's pages meet, which bounds a host's row by a few
    pages' tokens.
    """
    token = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in FIELDS]))

    def make():
        def one(column):
            return [[[dict(zip(FIELDS, t)) for t in page_tokens(v.as_py() or "")] for v in column]]

        return one

    html = F.col(f"`{html_col}`")
    source = pages.select(host_of(url_col).alias("host"), F.xxhash64(F.col(f"`{id_col}`"), html).alias("page"), html.alias("html"))
    read = with_arrow(source, ["html"], [T.StructField("tokens", token)], make, ["host", "page"])
    rows = read.select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    vectors = rows.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("times").alias("times"),
        F.sum(F.pmod(F.xxhash64("page", "times"), F.lit(1 << 40))).alias("vector"),
        F.min("parent").alias("parent"),
        F.min("kind").alias("kind"),
        F.sum("length").alias("length"),
        F.sum("total").alias("total"),
    )
    sizes = pages.select(host_of(url_col).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    enough = F.greatest(F.col("all_pages") * LEAST_SHARE, F.lit(LEAST_PAGES))
    often = vectors.filter(F.col("pages") >= LEAST_PAGES).join(sizes, "host").filter(F.col("pages") >= enough)
    hosts = often.groupBy("host").agg(F.collect_list(F.struct("pages", "vector", *FIELDS)).alias("tokens"))

    def deduce():
        def one(column):
            found = [Template(tokens.as_py()) for tokens in column]
            return [[t.texts for t in found], [t.slots() for t in found]]

        return one

    numbers = T.ArrayType(T.LongType())
    return keep(with_arrow(hosts, ["tokens"], [T.StructField("texts", numbers), T.StructField("slots", numbers)], deduce, ["host"]), "templates")


def main_text(page: str, texts: frozenset[int], slots: frozenset[int] | None) -> str:
    """The page's main blocks, one a line, without the template's texts.

    Its main slot are the blocks in or under the host's for its layout, or those in article or main elements if they have at
    least half as much text. If the template leaves nothing of it, or the page has none, all that the template
    doesn't hold is taken.
    """
    found, places, around = blocks(page, slots or frozenset())
    firm = [(p, w, article, not texts or _number(p, w) not in texts) for p, w, aside, article in found if not aside]
    own = [p for p in places if _number(p) in slots] if slots else []
    outer = {q for p in own for q in _ancestors(p, around)[1:]}
    inside = [[b for b in firm if p in _ancestors(b[0], around)] for p in own if p not in outer]
    slot = max(inside, key=lambda found: sum(len(b[1]) for b in found), default=[])
    article = [b for b in firm if b[2]]
    if sum(len(b[1]) for b in article) * 2 >= sum(len(b[1]) for b in slot):
        slot = article or slot
    left = [w for _, w, _, data in slot if data]
    return "\n".join(left or [w for _, w, _, data in firm if data])


def _ancestors(place: str, around: dict[str, tuple[str, str]]) -> list[str]:
    """A place and those around it."""
    out = []
    while place:
        out.append(place)
        place = around[place][0]
    return out


def extract(
    pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id",
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """``pages`` with main_text: white space is one blank, character references are decoded.

    Null, empty and textless pages give the empty text. Pages without a readable host form a host of
    their own. Repeated pages and ids count each time. Whole pages are read. A column named main_text
    is replaced.
    """
    found = templates(pages, html_col, url_col, id_col)
    # The written table's size decides whether Spark sends it to all tasks or joins by host, splitting a hot one.
    joined = pages.withColumn("__host", host_of(url_col)).join(found.withColumnRenamed("host", "__host"), "__host", "left")

    def make():
        def one(column, texts, slots):
            out = []
            for v, t, s in zip(column, texts, slots):
                t, s = (frozenset(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else frozenset() for x in (t, s))
                out.append(main_text(v.as_py() or "", t, s))
            return [pa.array(out, pa.string())]

        return one

    kept = pages.columns if keep_columns is None else keep_columns
    return with_arrow(joined, [html_col, "texts", "slots"], [T.StructField("main_text", T.StringType())], make, kept)
