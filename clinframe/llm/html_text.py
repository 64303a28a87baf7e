"""Main text of HTML pages by two-pass block rules."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Common function words of English, German, French and Spanish (fixed values).
STOP_WORDS = frozenset("""
a an the and or but of to in on at by for from with as is are was were be been it its this that these those not have has had he she they we you i
der die das und oder aber von zu im in den dem des ein eine einer eines einem einen ist sind war mit auf für an bei nach aus um nicht auch sich es er sie wir ihr
le la les un une des de du et ou mais à au aux en dans par pour sur avec est sont était ce cette ces que qui ne pas il elle nous vous ils on se plus
el la los las un una unos unas y o pero de del al en por para con es son era que se no lo su sus como más este esta estos estas
""".split())

SKIPPED = frozenset("head script style noscript template iframe object embed svg canvas select button textarea nav footer aside form menu dialog".split())
CONTAINERS = frozenset("body div section article main header ul ol dl table tbody tr figure blockquote details center fieldset".split()) | SKIPPED
BLOCKS = frozenset("p li dt dd td th h1 h2 h3 h4 h5 h6 pre hr figcaption caption address summary option legend title html".split()) | CONTAINERS
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("br hr img input meta link source wbr area base col embed param track".split())
# Words of class, id and role values that mark what is not the article (fixed values).
MARKED = re.compile(r"(?:^|[\s_-])(ads?|advert\w*|advertisement|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|"
                    r"comments?|replies|disqus|sidebar|side|menu|nav\w*|breadcrumbs?|footer|masthead|toolbar|share|sharing|social|related|recommended|widget|"
                    r"pagination|pager|login|signup|search|complementary|contentinfo)(?=$|[\s_-])", re.I)
# The same names as a whole token, alone or with a word for a kind of part (fixed values): what counts on the article's own
# headings, paragraphs and sections, whose slugs may hold any word.
PART = re.compile(r"(?:ads?|advert|advertisement|sponsored|promo|banner|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|comments?|replies|"
                  r"disqus|sidebar|menu|nav|navigation|breadcrumbs?|footer|masthead|toolbar|share|sharing|social|related|recommended|widget|pagination|pager|"
                  r"login|signup|search|complementary|contentinfo)(?:[_-](?:area|articles|bar|block|box|buttons?|container|content|form|inner|items|links|list|"
                  r"panel|posts|section|stories|widget|wrap|wrapper))?", re.I)
# Ids of a section that holds the readers' comments, inside the article too (fixed values).
COMMENTS = re.compile(r"(?:(?:reader|user)[_-])?comments(?:[_-](?:area|container|list|section|wrap|wrapper))?|disqus[_-]thread", re.I)
STATE = re.compile(r"(?:has|have|no|not|with|without)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled)", re.I)  # of the page, not of its parts
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"""
                   r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^<>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>""", re.S | re.I)
WORD = re.compile(r"\w+")

#: Block thresholds: characters and shares.
SHORT, LONG, MAX_LINKS, STOP_LOW, STOP_HIGH = 70, 200, 0.33, 0.06, 0.12


def blocks(page: str):
    """(text, characters inside links, region, marked, heading) of each block in page order.

    ``region`` numbers the article or main element that holds the block, 0 outside.
    Names never mark body, main, an article that is in no other article, or an
    element that holds main; nor one that holds articles, unless the page has
    an article outside such elements.
    """
    found, lost = _blocks(page, False)
    yield from _blocks(page, True)[0] if lost else found


def _blocks(page: str, lift: bool):
    """The blocks, and whether all articles are inside named elements; with ``lift`` the names of those don't count."""
    out: list[tuple[str, int, int, bool, bool]] = []
    stack: list[list] = []  # open containers: tag, marked by tag or hidden, marked by name, region
    articles = [0, 0]  # outside and inside elements marked by name
    parts: list[str] = []
    link_chars = links = regions = 0
    block_marked = heading = False

    def flush():
        nonlocal parts, link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, link_chars, stack[-1][3] if stack else 0,
                            block_marked or bool(stack) and (stack[-1][1] or any(x[2] for x in stack)), heading))
            parts, link_chars = [], 0

    def words(raw):
        nonlocal link_chars
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            link_chars += len(text.strip())

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            words(page[at:m.start()])
        at = m.end()
        tag = m.group(3) or m.group(6)
        if not tag:
            continue  # comment, declaration or raw-text element: no text
        tag, closing, attributes = tag.lower(), bool(m.group(2) or m.group(5)), m.group(4) or m.group(7) or ""
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        block_marked, links = False, 0
        heading = tag in HEADINGS and not closing
        if tag in CONTAINERS:
            if closing:
                if any(x[0] == tag for x in stack):
                    while stack.pop()[0] != tag:
                        pass
                continue
            if tag in VOID or attributes.rstrip().endswith("/"):
                continue
            if tag in ("article", "main"):  # an unclosed menu or header ends here
                while stack and stack[-1][0] in ("nav", "header", "ul", "ol", "head") and not (len(stack) > 1 and (stack[-2][1] or stack[-2][2])):
                    stack.pop()
            marked, region = (stack[-1][1], stack[-1][3]) if stack else (False, 0)
            hidden, named = _marks(attributes, tag == "section" and region > 0, tag == "section")
            if tag in ("body", "main") or tag == "article" and all(x[0] != "article" for x in stack):
                named = False
                if tag == "main" or tag == "article" and lift:
                    for x in stack:
                        x[2] = False
                inside = any(x[2] for x in stack)
                if tag == "article" and not marked and not hidden:
                    articles[inside] += 1
                if tag != "body" and not marked and not inside and not region:
                    regions += 1
                    region = regions
            stack.append([tag, marked or hidden or tag in SKIPPED or (tag == "header" and not region), named, region])
        elif not closing:
            block_marked = any(_marks(attributes, tag in HEADINGS or bool(stack and stack[-1][3])))
    if at < len(page):
        words(page[at:])
    flush()
    return out, bool(articles[1] and not articles[0])


def _marks(attributes: str, own: bool = False, section: bool = False) -> tuple[bool, bool]:
    """Whether a tag hides its element, and whether class, id, role or label name something that is not the article.

    On the article's ``own`` parts ids and labels name their subject, so only
    classes and roles count there, and only as whole tokens (PART).  A ``section``
    counts its id too where that is one of COMMENTS.
    """
    hidden = named = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "aria-label"):
            if not own:
                named = named or any(MARKED.search(t) and not STATE.fullmatch(t) for t in value.split())
            elif name in ("class", "role"):
                named = named or any(PART.fullmatch(t) for t in value.split())
            elif name == "id" and section:
                named = named or bool(COMMENTS.fullmatch(value.strip()))
        else:
            hidden = (hidden or name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true"
                      or name == "style" and bool(NO_DISPLAY.search(value)))
    return hidden, named


def stop_density(text: str) -> float:
    """Share of the words that are function words of a listed language."""
    found = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in found) / max(1, len(found))


def first_pass(text: str, link_chars: int, region: int, marked: bool, heading: bool, listed: bool = True) -> str:
    """good, bad, near (probably good) or short, from the block alone.

    ``listed``: the page is in a language whose function words are known;
    otherwise length and links decide.
    """
    if marked:
        return "bad"
    size = len(text)
    if link_chars > MAX_LINKS * size:
        return "bad"
    if not region and "©" in text and (size < SHORT or text.startswith("©")):
        return "bad"  # a copyright line, not prose that has the sign
    if size < SHORT or heading:
        return "short"
    if not listed:
        return "good" if size >= LONG else "near"
    density = stop_density(text)
    if density >= STOP_HIGH:
        return "good" if size >= LONG else "near"
    if density >= STOP_LOW:
        return "near"
    return "short" if region else "bad"


def second_pass(labels: list[str], regions: list[int], headings: list[bool] | None = None, texts: list[str] | None = None) -> list[bool]:
    """Undecided blocks take the label of their nearest decided neighbour.

    Neighbours are sought within the same article or main element.  Both good:
    good.  Both bad: bad.  Otherwise a ``near`` block and any block inside an
    article are good; outside, a heading goes with what it heads, the next
    decided block, and another block with the nearer one; between two equally
    near ones it is good if it ends like a sentence.  With none decided a short
    block is good inside an article and bad outside.
    """
    keep: list[bool | None] = [{"good": True, "bad": False}.get(x) for x in labels]
    decided, n = list(keep), len(keep)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    for out, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last, place = None, None
        for i in order:
            if regions[i] != place:
                last, place = None, regions[i]
            out[i] = last
            if decided[i] is not None:
                last = i
    for i in range(n):
        if decided[i] is not None:
            continue
        a, b = before[i], after[i]
        if a is not None and b is not None and decided[a] == decided[b]:
            keep[i] = decided[a]
        elif labels[i] == "near" or regions[i]:
            keep[i] = True
        elif a is None and b is None:
            keep[i] = False
        elif headings and headings[i]:
            keep[i] = b is not None and decided[b]
        elif a is None or b is None or i - a != b - i:
            keep[i] = decided[a if b is None or a is not None and i - a < b - i else b]
        else:
            keep[i] = bool(texts) and texts[i].endswith((".", "!", "?", "…"))
    return [bool(k) for k in keep]


def main_text(page: str | None) -> str:
    """The article's blocks joined by blank lines; empty for null, empty or text-free pages."""
    found = list(blocks(page or ""))
    regions = {r for _, _, r, marked, _ in found if r and not marked}
    if regions:  # where the page says which part is the article, the rest is decided
        found = [b if b[2] in regions else (*b[:3], True, b[4]) for b in found]
    listed = any(stop_density(b[0]) >= STOP_LOW for b in found if len(b[0]) >= SHORT and not b[3])
    keep = second_pass([first_pass(*b, listed) for b in found], [b[2] for b in found], [b[4] for b in found], [b[0] for b in found])
    return "\n\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (main text) and ``n_chars`` (its code points) in place of the HTML.

    Pages are cut into blocks at block-level tags.  Pass one labels each block
    by link density, length and stop-word density, or as bad inside menus,
    forms, footers and elements whose class says so; pass two lets undecided
    blocks inherit from their nearest decided neighbours.  Character references
    are decoded and white space becomes one space.

    Row by row, nothing is shuffled.  Null or empty pages give an empty text;
    repeated rows each give theirs; columns called text or n_chars are replaced.
    """
    small_batches(pages.sparkSession, 500)
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    src = pages.select(*names, F.col(html_col).alias("text"), F.lit(0).cast("long").alias("n_chars"))

    def run(it):
        for batch in it:
            texts = [main_text(t) for t in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return src.mapInArrow(run, src.schema)
