"""Wrappers of web pages: union-free regular expressions inferred by aligning pages of one host.

A page is read as a tree. The children of an element, and of the page, are a sequence of items:
elements and text slots. Runs of equal items become repeated ones, longer tandem repeats become
repeated groups. Two such expressions are aligned item by item: what only one of them has becomes
optional, equal elements are merged inside, and texts that differ become variable slots. Merging is
cheap and its result no larger than the templates of a host, so pages are merged in any number.
"""

from __future__ import annotations

import html
import re
from difflib import SequenceMatcher

import xxhash

# Elements by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6"
                      " header hr main menu nav ol p pre section table ul").split())
BLOCKS = CLOSES_P | frozenset("body br caption dd dt figcaption head html li option tbody td tfoot th thead tr title".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table select div section article main body html".split())
CONTAINERS = frozenset("html body div section article main table tbody tr td center form font".split())
NO_CONTENT = frozenset(("script style noscript template head title nav header footer aside form button select textarea iframe svg"
                        " object canvas dialog menu").split())
NO_CONTENT_WORDS = frozenset((
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header menu"
    " modal nav navbar navigation newsletter notice notices pagination popup promo promoted related reply replies respond share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar widget").split())

MAX_DEPTH = 200  # deeper elements are read as part of the one at this depth
LONGEST_GROUP = 8
ENOUGH_PAGES = 3
NEARLY_ALL = 0.9
WHOLE = frozenset(("article", "main"))
PAGE_LEVEL = frozenset(("html", "body"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""[^<]++|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)"""
                    r"""((?:"[^"]*+"|'[^']*+'|[^>"']++)*+>|[^>]*(?:>|\Z))|<""", re.S)
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}


class Element:
    """An element of a page; ``kids`` are elements and texts."""

    __slots__ = ("tag", "sig", "kids")

    def __init__(self, tag: str, sig: str):
        self.tag, self.sig, self.kids = tag, sig, []


def _signature(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    marks = sorted({word for m in _MARK.finditer(attributes) if m[1].lower() != "role"
                    for word in re.sub(r"\d+", "0", (m[2] or m[3] or m[4] or "").lower()).split()})
    return ".".join([tag, *marks])


def parse(page: str) -> list:
    """The top items of a page. Unclosed and misplaced tags are tolerated; entities are decoded."""
    root = Element("", "")
    stack, at = [root], 0
    while found := _TOKEN.match(page, at):
        at, tag = found.end(), (found[2] or "").lower()
        token = found[0]
        if not tag:
            if not token.startswith(("<!", "<?")):
                kids = stack[-1].kids
                text = html.unescape(token)
                if kids and isinstance(kids[-1], str):
                    kids[-1] += text
                else:
                    kids.append(text)
            continue
        if found[1]:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                del stack[depth:]
            continue
        if tag in CLOSES_P:
            _close(stack, ("p",))
        _close(stack, SIBLINGS.get(tag, ()))
        element = Element(tag, _signature(tag, found[3]))
        stack[-1].kids.append(element)
        if tag in _RAW_END:  # what is inside is not markup
            end = _RAW_END[tag].search(page, at)
            if tag == "title":
                element.kids.append(html.unescape(page[at:end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[3].endswith("/>") and len(stack) < MAX_DEPTH:
            stack.append(element)
    return root.kids


def _close(stack: list[Element], tags: tuple[str, ...]) -> None:
    while tags:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                break
            if stack[k].tag in SCOPES and stack[k].tag not in tags:
                return
        else:
            return
        if tags == ("p",):
            return


# Items of an expression are lists, so that they turn into JSON and back as they are:
#   ["e", signature, repeated, optional, pages, items]   an element
#   ["g", key, repeated, optional, pages, items]          a group
#   ["t", hash or None, repeated, optional, pages, characters]   a text slot; the hash is that of a constant text
# The pages are the distinct ones that have it: copies of a page, and repeats on a page, count once.
KIND, NAME, REPEATED, OPTIONAL, PAGES, INSIDE = range(6)


def _key(item: list) -> str:
    return "#text" if item[KIND] == "t" else item[NAME]


def _alike(a: list, b: list) -> bool:
    return a[KIND] == b[KIND] and (a[KIND] == "t" or a[NAME] == b[NAME])


def page_id(kids: list) -> int:
    """A hash of the texts of a page that may be content, so that copies of a page have one id."""
    digest = xxhash.xxh64()

    def visit(kids: list) -> None:
        for kid in kids:
            if not isinstance(kid, str):
                if _is_content(kid.sig):
                    visit(kid.kids)
            elif text := " ".join(kid.split()):
                digest.update(text + "\n")

    visit(kids)
    return digest.intdigest() - (1 << 63)


def infer(kids: list) -> list:
    """The expression of one page's items."""
    items = []
    for kid in kids:
        if isinstance(kid, str):
            text = kid.strip()
            if text:
                items.append(["t", xxhash.xxh64_hexdigest(text), False, False, 1, len(text)])
        else:
            items.append(["e", kid.sig, False, False, 1, infer(kid.kids)])
    return fold(items)


def fold(items: list) -> list:
    """Tandem repeats become repeated items and groups, the shortest first."""
    for size in range(1, LONGEST_GROUP + 1):
        if len(items) < 2 * size:
            break
        out, k = [], 0
        keys = [_key(x) for x in items]
        while k < len(items):
            part, n = items[k:k + size], k + size
            while len(part) == size and keys[n:n + size] == keys[k:k + size] and keys[k] != "#text" * (size == 1):
                part = [_united(a, b, True) for a, b in zip(part, items[n:n + size], strict=True)]
                n += size
            if n == k + size or len(part) < size:
                out.append(items[k])
                k += 1
            elif size == 1:
                part[0][REPEATED] = True
                out += part
                k = n
            else:
                out.append(["g", "|".join(keys[k:k + size]), True, False, 1, part])
                k = n
        items = out
    return items


def _united(a: list, b: list, one_page: bool) -> list:
    """Two items of one key as one, on one page and its copies or on different pages."""
    pages = max(a[PAGES], b[PAGES]) if one_page else a[PAGES] + b[PAGES]
    both = [a[KIND], a[NAME], a[REPEATED] or b[REPEATED], a[OPTIONAL] or b[OPTIONAL], pages]
    if a[KIND] == "t":
        return [a[KIND], a[NAME] if a[NAME] == b[NAME] else None, *both[2:], a[INSIDE] + b[INSIDE]]
    return [*both, merge(a[INSIDE], b[INSIDE], one_page)]


def _grouped(items: list, others: list) -> list:
    """``items`` with what is a single turn of a group of ``others`` as that group."""
    for group in (x for x in others if x[KIND] == "g"):
        size = len(group[INSIDE])
        for k in range(len(items) - size + 1):
            if "|".join(_key(x) for x in items[k:k + size]) == group[NAME]:
                items = [*items[:k], ["g", group[NAME], False, False, 1, items[k:k + size]], *items[k + size:]]
                break
    return items


def merge(a: list, b: list, one_page: bool = False) -> list:
    """The expression that covers two: those of copies of ``one_page``, or of pages of which none is in both."""
    if len(a) == len(b) and all(map(_alike, a, b)):
        return [_united(p, q, one_page) for p, q in zip(a, b, strict=True)]
    a, b = _grouped(a, b), _grouped(b, a)
    out = []
    optional = lambda items: [[*x[:OPTIONAL], True, *x[OPTIONAL + 1:]] for x in items]
    i = j = 0
    for x, y, n in SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False).get_matching_blocks():
        out += optional(a[i:x]) + optional(b[j:y])
        out += [_united(p, q, one_page) for p, q in zip(a[x:x + n], b[y:y + n], strict=True)]
        i, j = x + n, y + n
    return out


def _is_content(sig: str) -> bool:
    tag, *marks = sig.split(".")
    words = {word for mark in marks for word in re.split(r"[-_0]+", mark)}
    return tag not in NO_CONTENT and not (words & NO_CONTENT_WORDS and tag not in ("html", "body", "article", "main"))


def rules(items: list, pages: int) -> list:
    """The expression with the verdict on each text: items become [signature or None, keep, items].

    ``pages`` is the number of the host's distinct pages. Texts under an element that holds no
    content by its name are out. Of the rest, a text that is the same on nearly all distinct pages
    of a host is constant; such texts and links alone do not make an element a carrier of content.
    Containers are entered, and each carrier in them followed, so that pages of any shape keep
    theirs. An article or main element, or a container with carriers that cannot be entered, stays
    whole, what is constant in it too. Headings, and what lies at the level of the page, stay alone.
    """
    def constant(item: list) -> bool:
        return pages >= ENOUGH_PAGES and item[NAME] is not None and not item[REPEATED] and item[PAGES] >= NEARLY_ALL * pages

    def mass(item: list, varying: bool = True) -> int:
        if item[KIND] == "t":
            return 0 if varying and constant(item) else item[INSIDE]
        if item[KIND] == "e" and (not _is_content(item[NAME]) or item[NAME].split(".")[0] == "a"):
            return 0
        return sum(mass(x, varying) for x in item[INSIDE])

    varying = sum(map(mass, items)) > 0
    mains: list[list] = []

    def follow(items: list, parent: list | None) -> None:
        flat = [y for x in items for y in (x[INSIDE] if x[KIND] == "g" and not x[REPEATED] else [x])]
        carriers = [x for x in flat if mass(x, varying)]
        tags = [x[NAME].split(".")[0] if x[KIND] == "e" else "" for x in carriers]
        enter = [tag in CONTAINERS and not x[REPEATED] for x, tag in zip(carriers, tags, strict=True)]
        page_level = parent is None or parent[NAME].split(".")[0] in PAGE_LEVEL
        if not page_level and not all(e or tag in HEADINGS and not x[REPEATED] for e, tag, x in zip(enter, tags, carriers, strict=True)):
            mains.append(parent)
            return
        for x, tag, inside in zip(carriers, tags, enter, strict=True):
            if inside and tag not in WHOLE:
                follow(x[INSIDE], x)
            else:
                mains.append(x)

    follow(items, None)
    whole = {id(x) for x in mains}
    no_mains = not mains

    def verdicts(items: list, inside: bool, content: bool) -> list:
        out = []
        for item in items:
            here = inside or id(item) in whole
            if item[KIND] == "g":
                out += verdicts(item[INSIDE], here, content)
            elif item[KIND] == "t":
                out.append([None, here and content, []])
            else:
                good = content and _is_content(item[NAME])
                out.append([item[NAME], here and good, verdicts(item[INSIDE], here, good)])
        return out

    return verdicts(items, no_mains, True)


def extract(kids: list, verdicts: list) -> str:
    """The main text of a page that a host's rules cover: its blocks, a line each."""
    lines, held = [], []

    def flush() -> None:
        line = " ".join("".join(held).split())
        if line:
            lines.append(line)
        held.clear()

    def visit(kids: list, verdicts: list, default: bool) -> None:
        at = 0
        for kid in kids:
            is_text = isinstance(kid, str)
            key = None if is_text else kid.sig
            if is_text and not kid.strip():
                if default:
                    held.append(kid)
                continue
            # The next item of this key; behind the last one, the loop of a group begins anew.
            found = next((k for k in [*range(at, len(verdicts)), *range(at)] if verdicts[k][0] == key), None)
            if found is not None:
                at = found
            keep = default if found is None else verdicts[found][1]
            if is_text:
                if keep:
                    held.append(kid)
                continue
            if kid.tag in BLOCKS:
                flush()
            if found is not None:
                visit(kid.kids, verdicts[found][2], keep)
            elif _is_content(kid.sig):
                visit(kid.kids, [], default)
            if kid.tag in BLOCKS:
                flush()

    visit(kids, verdicts, not any(v[0] is not None for v in verdicts))
    flush()
    return "\n".join(lines)
