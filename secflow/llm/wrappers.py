"""HTML main text by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and text slots. Runs of siblings of one shape fold into a repeated group,
so that long pages have short skeletons. Spark counts the skeletons of each host; the different ones
are aligned in rounds, two by two, into a wrapper: what does not match becomes optional, repeated
parts become groups, texts become slots. Pages of a host whose texts stand in article or main elements,
those that only name such a part, and those with neither are templates of their own, each with its
wrapper. One is divided by a hash of the skeleton while it has many, so that no task holds more than a few.

A wrapper's slot is a place: the chain of tags and classes above the text. Places under menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments are furniture,
and so is a place outside the article or main part of wrappers that have one. A page gives the texts
of its other places, block by block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import stored

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math title head".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var wbr".split())
FURNITURE_TAGS = frozenset(
    "nav header footer aside form button select option input label dialog menu menuitem object canvas audio video".split()) | RAW
#: Words of class, id or role that name furniture, matched as whole parts between other characters.
FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer sidebar aside related widget "
    "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login search "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion share sharing social "
    "comment comments reply replies respond disqus pagination pager toolbar copyright complementary contentinfo "
    "legal disclaimer skip".split())
MAIN_TAGS = ("article", "main")
MAIN_NAMES = frozenset("article main content post entry story body".split())
_CLOSES = {  # an opening tag ends these open elements
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}}
_BLOCKS_CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<", re.S)
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPACE = re.compile(r"\s+")

Event = tuple[str, str, str]  # kind (open, close, text), element label, text


def events(page: str) -> Iterator[Event]:
    """Tags and texts of a page; raw elements lose their content, comments go."""
    at, end = 0, len(page)
    while at < end:
        match = _TOKEN.match(page, at)
        token, at = match.group(), match.end()
        if token[0] != "<" or token == "<":
            yield "text", "", token
            continue
        if token[1] in "!?":
            continue
        name = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            yield "close", name, ""
            continue
        marks = [m.group(2).strip("\"'") for m in _ATTRIBUTE.finditer(token)]
        label = " ".join([name, *_SPACE.split(" ".join(marks).lower().strip())]).strip()
        if name in RAW and name != "head" and not token.endswith("/>"):
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        yield "open", label, ""
        if name in VOID or token.endswith("/>"):
            yield "close", name, ""


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """(place, text) of each block of text: the labels of the open block elements and furniture, outermost first."""
    stack: list[str] = []
    held: list[str] = []
    place: tuple[str, ...] = ()

    def flush() -> tuple[tuple[str, ...], str] | None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        return (place, text) if text else None

    def drop_to(names: set | frozenset) -> None:
        while stack and stack[-1].split(" ", 1)[0] in names | INLINE and any(s.split(" ", 1)[0] in names for s in stack):
            last = stack.pop().split(" ", 1)[0]
            if last in names:
                break

    for kind, label, text in events(page):
        name = label.split(" ", 1)[0]
        if kind == "text":
            if not held:
                place = tuple(s for s in stack if s.split(" ", 1)[0] not in INLINE or furniture(s))
            held.append(text)
        elif kind == "open":
            odd = name in INLINE and furniture(label)
            if name not in INLINE or odd:
                if (found := flush()) is not None:
                    yield found
                drop_to(_CLOSES.get(name, set()) | ({"p"} if name in _BLOCKS_CLOSE_P else set()))
            stack.append(label)
        else:
            names = [s.split(" ", 1)[0] for s in stack]
            if name in names:
                last = len(names) - 1 - names[::-1].index(name)
                if name not in INLINE or furniture(stack[last]):
                    if (found := flush()) is not None:
                        yield found
                    del stack[last:]
                elif all(n in INLINE for n in names[last:]):
                    del stack[last]
    if (found := flush()) is not None:
        yield found


def furniture(label: str) -> bool:
    name, *marks = label.split(" ")
    if name in FURNITURE_TAGS:
        return True
    if name in ("body", "html", *MAIN_TAGS):
        return False
    return any(part in FURNITURE_NAMES for mark in marks for part in re.split(r"[^a-z]+", mark))


def main_part(label: str) -> bool:
    name, *marks = label.split(" ")
    return name in MAIN_TAGS or (name in ("div", "section", "td") and any(
        part in MAIN_NAMES for mark in marks for part in re.split(r"[^a-z]+", mark)))


def skeleton(page: str) -> str:
    """Places of a page's texts in order, repeats folded: ``a>b`` once, ``a>b+`` for a run."""
    out: list[str] = []
    for place, _ in blocks(page):
        name = ">".join(place)
        if out and out[-1].rstrip("+") == name:
            out[-1] = name + "+"
        else:
            out.append(name)
    return "\n".join(_fold(out))


def _fold(items: list[str], longest: int = 4) -> list[str]:
    """Runs of a sequence of up to ``longest`` items become one group each: (a|b)+ as marked items."""
    for width in range(2, longest + 1):
        at, out = 0, []
        while at < len(items):
            unit, n = items[at:at + width], 1
            while len(unit) == width and items[at + n * width:at + (n + 1) * width] == unit:
                n += 1
            out += [u if u.endswith("+") else u + "+" for u in unit] if n > 1 else items[at:at + 1]
            at += n * width if n > 1 else 1
        items = out
    return items


def align(one: list[str], two: list[str]) -> list[str]:
    """Union-free generalisation of two wrappers: common items stay, others become optional, in order.

    An item is a place with + (repeated) and ? (optional) behind it.
    """
    def bare(x: str) -> str:
        return x.rstrip("+?")

    n, m = len(one), len(two)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if bare(one[i]) == bare(two[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and bare(one[i]) == bare(two[j]):
            marks = set(one[i][len(bare(one[i])):]) | set(two[j][len(bare(two[j])):])
            out.append(bare(one[i]) + "".join(c for c in "+?" if c in marks))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(one[i] if one[i].endswith("?") else one[i] + "?")
            i += 1
        else:
            out.append(two[j] if two[j].endswith("?") else two[j] + "?")
            j += 1
    return _merge(out)


def _merge(items: list[str]) -> list[str]:
    """Neighbours of one place are one repeated slot."""
    out: list[str] = []
    for item in items:
        bare = item.rstrip("+?")
        if out and out[-1].rstrip("+?") == bare:
            marks = set(out[-1][len(bare):]) | {"+"}
            out[-1] = bare + "".join(c for c in "+?" if c in marks)
        else:
            out.append(item)
    return out


def template(places: list[str]) -> str:
    """What marks the main part of a page with these places: tagged elements, named blocks, or nothing."""
    chains = [c for c in (p.split(">") if p else [] for p in places) if not any(furniture(x) for x in c)]
    if any(x.split(" ", 1)[0] in MAIN_TAGS for c in chains for x in c):
        return "tagged"
    return "named" if any(main_part(x) for c in chains for x in c) else "clear"


def article_places(wrapper: list[str]) -> list[str]:
    """Slots of a wrapper that hold the article.

    Furniture goes. If what is left has a main part, that alone counts: article or main elements
    first, else blocks named as such; without one, all that is left.
    """
    places = list(dict.fromkeys(w.rstrip("+?") for w in wrapper))
    chains = {p: p.split(">") if p else [] for p in places}
    clear = [p for p in places if not any(furniture(x) for x in chains[p])]
    tagged = [p for p in clear if any(x.split(" ", 1)[0] in MAIN_TAGS for x in chains[p])]
    named = [p for p in clear if any(main_part(x) for x in chains[p])]
    return tagged or named or clear


def extract(page: str, places: set[str]) -> str:
    return "\n".join(text for place, text in blocks(page) if ">".join(place) in places)


#: Skeletons that one task aligns at a time; a host with more is divided.
ALIGN_AT_ONCE = 64


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, wrapper): one wrapper for each template of a host over all its skeletons.

    Skeletons are counted by Spark first. While a template has more than ``ALIGN_AT_ONCE``, hash parts of
    them are aligned apart, and the parts' wrappers go on.
    """

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values(["n", "skeleton"], ascending=[False, True])
        wrapper: list[str] | None = None
        for text in order["skeleton"]:
            items = text.split("\n") if text else []
            wrapper = items if wrapper is None else align(wrapper, items)
        return pd.DataFrame({
            "host": [pdf["host"].iloc[0]], "template": [pdf["template"].iloc[0]], "skeleton": ["\n".join(wrapper or [])], "n": [int(pdf["n"].sum())]})

    rows = stored(pages.groupBy("host", "template", "skeleton").agg(F.count("*").alias("n")), "skeletons")
    while True:
        most = rows.groupBy("host", "template").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        parts = -(-most // ALIGN_AT_ONCE)
        part = F.pmod(F.xxhash64("skeleton"), F.lit(max(parts, 1)))
        cut = rows.withColumn("part", part).groupBy("host", "template", "part")
        rows = stored(cut.applyInPandas(join, "host string, template string, skeleton string, n long"), "wrappers")
        if parts <= 1:
            return rows.select("host", "template", F.col("skeleton").alias("wrapper"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    A null or empty page, or one without main text, gives the empty text. Hosts come from the url; rows
    without one share a wrapper. Equal rows give equal results.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host")

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [skeleton(x or "") for x in batch.column(1).to_pylist()]
            kind_of = {s: template([x.rstrip("+") for x in s.split("\n")]) for s in set(shapes)}
            kinds = [kind_of[s] for s in shapes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kinds, pa.string()), pa.array(shapes, pa.string())],
                names=["host", "template", "skeleton"])

    outlines = pages.select(host, F.col("html").cast("string").alias("html")).mapInArrow(
        outline, "host string, template string, skeleton string")
    found = wrappers(outlines).groupBy("host").agg(
        F.map_from_entries(F.collect_list(F.struct("template", "wrapper"))).alias("wrapper"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[str]] = {}
        for batch in batches:
            texts, kind_of = [], {}
            for page, of_host in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                parts = [(">".join(place), text) for place, text in blocks(page or "")]
                places = tuple(dict.fromkeys(p for p, _ in parts))
                if places not in kind_of:
                    kind_of[places] = template(list(places))
                wrapper = dict(of_host or []).get(kind_of[places])
                if wrapper not in held:
                    if len(held) > 10_000:
                        held.clear()
                    held[wrapper] = set(article_places((wrapper or "").split("\n")))
                texts.append("\n".join(text for place, text in parts if place in held[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host)
    joined = rows.join(found.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left")
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(
        cut, "page_id long, url string, text string, n_chars long")
