"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block element, and elements that never hold an
article's text (menus, forms, scripts, adverts, reader comments, ...) leave empty lines
where they stood. A line weighs as much as its text outside links, or nothing outside the
page's article element if it has one. The weights of ``WINDOW`` lines in a row are summed
at every line; the sums surge where running text begins and dive to zero where it ends, and
the lines between a surge and its dive are kept when they hold a share of the page's
largest sum or belong to the same article as that.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
# A surge needs this many characters, or a third of the page's largest sum if that is less.
SURGE = 86

# Element names of HTML.
_SKIP = frozenset("script style noscript template head title nav footer aside form button select option textarea iframe svg "
                  "math canvas audio video object embed map dialog menu fieldset label datalist".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img".split())
_SCOPE = frozenset(("article", "main"))

# Names of classes and ids that mark what is not the article.
_NOT_TEXT = re.compile(
    r"^(?:(?:site|page|global|top|bottom|left|right|post|article|blog|user|reader|side|main|cookie|in|inline)[-_])?"
    r"(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|alerts?|"
    r"newsletters?|subscribe|subscription|signup|popups?|modals?|overlay|comments?|commentlist|commentform|respond|disqus|"
    r"replies|sidebars?|widgets?|related|recommended|recommendations?|shares?|sharing|social|breadcrumbs?|menus?|nav|navbar|navigation|"
    r"footers?|headers?|masthead|topbar|toolbar|pagination|pager|login|search|skip|teasers?)"
    r"(?:[-_](?:[a-z]+|[0-9]+))*$")
_IS_TEXT = re.compile(r"^(?:(?:main|page|post|article|entry|story)[-_])?(?:article|content|story|articlebody|entry|post)(?:[-_](?:body|content|text))?$")

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!?(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes say it is no article text, or that it is."""
    no = yes = False
    for name, value in _ATTRIBUTE.findall(" " + attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            no = True
        elif name == "style":
            no = no or "display:none" in value.replace(" ", "")
        elif name == "role":
            no = no or value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu")
            yes = yes or value in ("main", "article")
        else:
            names = value.split()
            no = no or any(map(_NOT_TEXT.match, names))
            yes = yes or any(map(_IS_TEXT.match, names))
    return no, yes


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """Lines of a page: text, characters within links, number of the article element it is
    in (0: none). A skipped element leaves an empty line, an article's edge ``WINDOW``."""
    lines: list[tuple[str, int, int]] = []
    text: list[str] = []
    linked = 0
    open_: list[tuple[str, bool, int]] = []  # containers: name, skipped, article
    scopes = links = skipping = scope = at = 0
    raw_end = None

    def close_line(gap: int = 0) -> None:
        nonlocal linked
        t = " ".join(html.unescape("".join(text)).split())
        if t:
            lines.append((t, linked, scope))
        text.clear()
        linked = 0
        lines.extend([("", 0, 0)] * gap)

    def pop() -> None:
        nonlocal skipping, scope
        name, skipped, outer = open_.pop()
        if skipped or outer != scope:
            close_line(WINDOW if outer != scope else 1)
        skipping -= skipped
        scope = outer

    while True:
        m = _TAG.search(page, at)
        piece = page[at:m.start() if m else len(page)]
        if piece and not skipping:
            text.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        closing, name, attributes = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not name:
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name in _INLINE and not (skipping or attributes):
            continue
        if closing:
            if name not in _INLINE:
                close_line()
            if any(x[0] == name for x in open_):
                while open_[-1][0] != name:
                    pop()
                pop()
            continue
        if name in _VOID:
            if name in ("br", "hr"):
                text.append(" ")
            continue
        no, yes = _marks(attributes) if attributes.strip() else (False, False)
        if name in ("html", "body"):
            no = False
        elif name in _SCOPE and not no:
            while skipping:  # an unclosed menu doesn't hold the article
                pop()
        block = name not in _INLINE
        if block:
            close_line()
            links = 0
            if open_ and open_[-1][0] == "p" and name != "p" or open_ and open_[-1][0] == name == "p":
                pop()
        skip = no and not (yes and name in _SCOPE) or name in _SKIP or name == "header" and not scope
        if skip and block:
            close_line(0 if skipping else 1)
        elif skip:
            text.append(" ")
        inner = scope
        if not skip and not skipping and not scope and (name in _SCOPE or yes):
            close_line(WINDOW)
            scopes += 1
            inner = scopes
        if block or skip:
            open_.append((name, skip, scope))
            skipping += skip
        scope = inner
        if name in _RAW and not attributes.rstrip().endswith("/"):
            raw_end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = raw_end.start() if raw_end else len(page)
    close_line()
    return lines


def main_text(page: str) -> str:
    """The article's text: blocks in page order, joined by one space."""
    lines = lines_of(page)
    scoped = any(s and t for t, _, s in lines)
    weight = [0 if scoped and not s else len(t) if scoped else max(0, len(t) - 2 * k) for t, k, s in lines]
    n = len(lines)
    sums = [sum(weight[i:i + WINDOW]) for i in range(n)]
    top = max(sums, default=0)
    if not top:
        return ""
    surge, found, i = min(SURGE, top / 3), [], 0
    while i < n:
        if sums[i] < surge and not (scoped and sums[i]):
            i += 1
            continue
        j = i
        while j < n and sums[j]:
            j += 1
        first = i
        while first < j and not weight[first]:
            first += 1
        found.append((first, j, max(sums[i:j])))
        i = j
    best = max(found, key=lambda r: r[2])
    home = {lines[k][2] for k in range(best[0], best[1])}
    kept = []
    for a, b, peak in found:
        same = scoped and any(lines[k][2] in home for k in range(a, b) if weight[k])
        if same or peak * 3 >= top:
            kept += [lines[k][0] for k in range(a, b) if lines[k][0] and (weight[k] or not scoped)]
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: ``id_col``, the columns in ``keep``, ``text`` and ``n_chars``.

    Null and empty pages, and pages without text, give an empty text. Broken markup is read
    on: unclosed elements end with the page, a tag cut off by its end is dropped. Repeated
    rows and null ids stay rows of their own; an empty table gives no rows; other columns
    are neither read nor returned. A page is read whole, in one pass.
    """
    cols = [id_col, *keep]
    p = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)], F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names[:-1], "text", "n_chars"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in p.schema.fields[:-1])
    out = p.mapInArrow(run, f"{schema}, text string, n_chars bigint")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)], "text", "n_chars")
