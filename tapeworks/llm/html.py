"""Main text of web pages through wrappers inferred per host.

A page is read into a tree of block elements (implied ends are filled in, so a page cut short
reads like a whole one); inline markup belongs to the text. A wrapper is a union-free regular
expression over such trees: a part is an element with a sequence of parts and a text slot, may be
optional, and may be repeated, alone or as a group. Pages of one host are aligned one after
another: where they differ, equal neighbouring parts, or groups of parts, become repetitions; parts
that one side lacks become optional; elements of one tag whose marks (class, id, role) only partly agree keep the
common ones; texts become slots. A sequence of over ``WIDTH`` parts becomes one repeated group of
optional parts, elements below ``DEEP`` levels belong to the text of the one there, and a wrapper of over
``NODES`` parts loses its lowest levels, so its size is bounded whatever the pages are, and no text is lost.
Aligning is closed over wrappers, so tasks align their own pages first and only wrappers (one
per host and task) are shuffled and aligned further, in two levels; a host with a third of all pages
sends no more than any other.

Every slot of the finished wrapper carries what the host's pages have in it: characters,
characters in links, pages, and (by counters that can be merged) how many pages repeat one text. A slot
with one text on most of its pages is template, and no main text. Containers are ranked: the wrapper's
article and main elements, then those that hold most changing, unlinked text. Menus, forms and
the like go by their tags, parts of a container whose every mark names such a role go too, unless they hold
most of it. Then each page is aligned with the wrapper of its host: every text of it gets its
slot, which is a place in the wrapper and not a path, and the first container that the page
has any text in gives the text. A page that no container of its wrapper fits is its own wrapper.

Defined results: a null or empty page, or one without main text, gives the empty string; pages
whose url is null or odd have no host and are each their own wrapper; repeated rows are extracted
each; an empty table gives an empty result; other columns are ignored; depth and length of a
page are not limited.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, table

#: Wrappers are broadcast up to so many characters in all (counted first), else joined by host.
BROADCAST_CHARS = 50_000_000
#: Partial wrappers of a host are first aligned in so many groups.
GROUPS = 64
#: Bounds of a wrapper: parts of one sequence, levels, and parts in all.
WIDTH, DEEP, NODES = 48, 24, 4000
#: Texts counted per slot; a text on over 1 / (TEXTS + 1) of the pages is surely among them.
TEXTS = 4
#: A slot is template if one text fills it on this share of its pages, and these are so many at least.
SAME, SEEN = 0.6, 4
#: Containers of a wrapper that pages are tried with before they are taken alone.
RANKS = 8
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s>/]*+(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|</?[a-zA-Z][^>]*+(?:>|\Z)", re.S
)
_NAME = re.compile(r"</?([a-zA-Z][^\s>/]*)")
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes object canvas".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
_PEERS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_ASIDE_TAGS = frozenset("head nav footer aside form button select dialog menu".split())
#: Words that name the role of a part that is no main text, and words that say nothing of a role.
_ROLES = frozenset("ad ads advert advertisement banner sidebar comment comments cookie cookies consent notice promo sponsor sponsored share sharing social related breadcrumb breadcrumbs menu nav navigation footer masthead newsletter pagination complementary contentinfo".split())
_NO_ROLE = frozenset("area bar block box container item items list links panel section slot widget wrapper".split())
_MAIN_TAGS = frozenset(["article", "main"])


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """('open', name, marks), ('close', name, '') and ('text', raw, '') in page order."""
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            yield "text", html[at:], ""
            return
        if m.start() > at:
            yield "text", html[at : m.start()], ""
        at, tag = m.end(), m[0]
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            yield "close", name, ""
            continue
        if name in _RAW:
            if not tag.endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else n
            continue
        # marks with digits are numbers of a post or a build, and no part of a template
        marks = " ".join(sorted({w for v in _MARK.findall(tag) for w in v.strip("\"'").lower().split() if w.isascii() and not any(c.isdigit() for c in w)})) if len(tag) > len(name) + 2 else ""
        yield "open", name, marks


class Part:
    """A part of a wrapper, or of a page: an element (its sign is tag and marks) or a group (no sign)."""

    __slots__ = ("sign", "many", "maybe", "kids", "pages", "chars", "linked", "texts", "members")

    def __init__(self, sign: str, kids: list[Part] | None = None, many: bool = False) -> None:
        self.sign, self.kids, self.many, self.maybe = sign, kids or [], many, False
        #: Of the slot: pages that have it, characters, characters in links, pages by text.
        self.pages, self.chars, self.linked, self.texts = 1, 0, 0, {}
        #: Numbers of a page's elements that were folded into this part.
        self.members: list[int] = []

    @property
    def key(self) -> str:
        return self.sign or "(" + "|".join(k.key for k in self.kids) + ")"

    @property
    def tag(self) -> str:
        return self.sign.partition(".")[0]

    @property
    def bag(self) -> bool:
        """A group in which each part is optional: any sequence of them."""
        return not self.sign and self.many and all(k.maybe for k in self.kids)

    def dump(self) -> list:
        return [self.sign, self.many, self.maybe, self.pages, self.chars, self.linked, [list(t) for t in self.texts.items()], [k.dump() for k in self.kids]]

    @classmethod
    def load(cls, data: list) -> Part:
        part = cls(data[0], [cls.load(k) for k in data[7]], data[1])
        part.maybe, part.pages, part.chars, part.linked, part.texts = data[2], data[3], data[4], data[5], {t: n for t, n in data[6]}
        return part


def _mix(*numbers: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"".join(n.to_bytes(8, "little") for n in numbers)) >> 1


def _counted(a: dict[int, int], b: dict[int, int]) -> dict[int, int]:
    """Counters of two summaries: of more than TEXTS texts, all lose the count of the first beyond."""
    both = dict(a)
    for text, n in b.items():
        both[text] = both.get(text, 0) + n
    if len(both) > TEXTS:
        beyond = sorted(both.values(), reverse=True)[TEXTS]
        both = {text: n - beyond for text, n in both.items() if n > beyond}
    return both


def fuse(a: Part, b: Part, fold: bool) -> Part:
    """``a`` with ``b`` in it: two pages' parts, or (``fold``) neighbours within the same pages."""
    if a.sign != b.sign:
        common = sorted(set(a.sign.partition(".")[2].split()) & set(b.sign.partition(".")[2].split()))
        a.sign = f"{a.tag}.{' '.join(common)}" if common else a.tag
    if not fold:
        a.texts = _counted(a.texts, b.texts)
        a.pages += b.pages
    else:
        if a.pages == b.pages == 1:
            a.texts = {_mix(*a.texts, *b.texts): 1} if a.texts or b.texts else {}
        else:
            a.texts = _counted(a.texts, b.texts)
        a.pages = max(a.pages, b.pages)
    a.chars += b.chars
    a.linked += b.linked
    a.members += b.members
    a.many |= b.many
    a.maybe |= b.maybe
    a.kids = align(a.kids, b.kids, fold)
    return a


def _absent(part: Part) -> Part:
    part.maybe = True
    return part


def _runs(parts: list[Part]) -> list[list[Part]]:
    """Neighbours of one key together."""
    out: list[list[Part]] = []
    for part in parts:
        if out and out[-1][0].key == part.key:
            out[-1].append(part)
        else:
            out.append([part])
    return out


def _inner(part: Part) -> tuple[str, ...]:
    return tuple(dict.fromkeys(k.key for k in part.kids))


def _pairs_of_run(xs: list[Part], ys: list[Part]) -> Iterator[tuple[list[Part], list[Part]]]:
    """Of two runs of one key: as many parts on both sides keep their places; else parts that differ
    in what is in them do, and those that don't are one repeated part."""
    if len(xs) == len(ys):
        yield from (([x], [y]) for x, y in zip(xs, ys, strict=True))
        return
    inner_x, inner_y = [_inner(x) for x in xs], [_inner(y) for y in ys]
    if any(p.many for p in (*xs, *ys)) or min(len(set(inner_x)), len(set(inner_y))) < 2:
        yield xs, ys
        return
    for _, i, j, k, m in SequenceMatcher(None, inner_x, inner_y, autojunk=False).get_opcodes():
        for n in range(max(j - i, m - k)):
            yield xs[i + n : j][:1], ys[k + n : m][:1]


def pairs(a: list[Part], b: list[Part]) -> list[tuple[list[Part], list[Part]]]:
    """Both sequences in one order: parts that are the same part of a template stand side by side, several
    of them where it is a repeated one; what the other side lacks stands alone."""
    if [p.key for p in a] == [p.key for p in b]:
        return [([x], [y]) for x, y in zip(a, b, strict=True)]
    runs_a, runs_b = _runs(a), _runs(b)
    out: list[tuple[list[Part], list[Part]]] = []
    for what, i, j, k, m in SequenceMatcher(None, [r[0].key for r in runs_a], [r[0].key for r in runs_b], autojunk=False).get_opcodes():
        if what == "equal":
            for xs, ys in zip(runs_a[i:j], runs_b[k:m], strict=True):
                out += _pairs_of_run(xs, ys)
            continue
        # elements of one tag are the same part if some of their marks are
        left = runs_b[k:m]
        for xs in runs_a[i:j]:
            marks = set(xs[0].sign.partition(".")[2].split())
            at = next((n for n, ys in enumerate(left) if marks and xs[0].tag == ys[0].tag and marks & set(ys[0].sign.partition(".")[2].split())), None)
            if at is not None:
                out += [([], ys) for ys in left[:at]]
                out += _pairs_of_run(xs, left[at])
                left = left[at + 1 :]
            else:
                out.append((xs, []))
        out += [([], ys) for ys in left]
    return out


def _one(parts: list[Part]) -> Part:
    """Several neighbours as one repeated part."""
    first = parts[0]
    for other in parts[1:]:
        fuse(first, other, True)
    first.many |= len(parts) > 1
    return first


def align(a: list[Part], b: list[Part], fold: bool = False) -> list[Part]:
    """The least sequence of parts that both are cases of. Repetitions are only sought where the
    sequences differ: what all pages have as often keeps its places."""
    if any(p.bag for p in (*a, *b)):
        return bagged([*a, *b], fold)
    if [p.key for p in a] != [p.key for p in b]:
        groups = {tuple(k.key for k in p.kids) for p in (*a, *b) if not p.sign}
        a, b = grouped(a, groups), grouped(b, groups)
        if more := {tuple(k.key for k in p.kids) for p in (*a, *b) if not p.sign} - groups:
            a, b = grouped(a, more), grouped(b, more)
    out = []
    for xs, ys in pairs(a, b):
        if xs and ys:
            out.append(fuse(_one(xs), _one(ys), fold))
        else:
            maybe = _one(xs or ys)
            out.append(_absent(maybe))
    if len(out) > WIDTH:
        out = [_one(run) for run in _runs(out)]
    return bagged(out, True) if len(out) > WIDTH else out


def grouped(parts: list[Part], known: set[tuple[str, ...]] = frozenset()) -> list[Part]:
    """Neighbouring equal groups of two to four different parts as one repeated group; of ``known``
    groups even one alone."""
    for size in (2, 3, 4):
        if len(parts) < size:
            break
        out: list[Part] = []
        keys: list[str] = []
        for part in parts:
            out.append(part)
            keys.append(part.key)
            last = tuple(keys[-size:])
            if len(set(last)) < 2 or len(last) < size or not all(p.sign for p in out[-size:]):
                continue
            group = out[-size - 1] if len(out) > size and not out[-size - 1].sign else None
            if group is not None and tuple(k.key for k in group.kids) == last:
                for x, y in zip(group.kids, out[-size:], strict=True):
                    fuse(x, y, True)
                group.many = True
                del out[-size:], keys[-size:]
            elif last in known or tuple(keys[-2 * size : -size]) == last and not any(p.maybe for p in out[-2 * size :]):
                times = 1 if last in known else 2
                kids = out[-size:] if times == 1 else [fuse(x, y, True) for x, y in zip(out[-2 * size : -size], out[-size:], strict=True)]
                group = Part("", kids, times == 2)
                group.pages = max(k.pages for k in kids)
                out[-times * size :], keys[-times * size :] = [group], [group.key]
        parts = out
    return parts


def bagged(parts: list[Part], fold: bool) -> list[Part]:
    """One repeated group of optional parts: one for each sign, or for each tag, or for all."""
    flat, todo = [], list(reversed(parts))
    while todo:
        part = todo.pop()
        if part.sign:
            flat.append(part)
        else:
            todo += reversed(part.kids)
    for name in (lambda p: p.sign, lambda p: p.tag, lambda _: "any"):
        if len({name(p) for p in flat}) <= WIDTH:
            break
    of: dict[str, Part] = {}
    for part in flat:
        sign = name(part)
        if sign in of:
            fuse(of[sign], part, fold).sign = sign
        else:
            part.sign, of[sign] = sign, part
    group = Part("", [_absent(p) for p in of.values()], True)
    group.pages = max((p.pages for p in of.values()), default=1)
    return [group]


def tree(html: str) -> tuple[list[Part], list[tuple[int, str]]]:
    """(the page as parts, its texts in page order with the number of the element each is in)."""
    import xxhash

    top = Part("page")
    top.members = [0]
    stack, texts, raw, marks = [top], [], [], {}
    number = 0

    def flush() -> None:
        nonlocal raw
        if raw:
            node = stack[-1]
            text = " ".join(unescape("".join(r for r, _ in raw)).split())
            if text:
                texts.append((node.members[0], text))
                node.chars += len(text)
                node.linked += sum(len(r) for r, linked in raw if linked) * len(text) // max(1, sum(len(r) for r, _ in raw))
                marks.setdefault(node.members[0], xxhash.xxh64()).update(text.encode("utf-8", "surrogatepass"))
            raw = []

    def close() -> None:
        node = stack.pop()
        if mark := marks.pop(node.members[0], None):
            node.texts = {mark.intdigest() >> 1: 1}
        if len(node.kids) > WIDTH:
            node.kids = [_one(run) for run in _runs(grouped(node.kids))]
        if len(node.kids) > WIDTH:
            node.kids = bagged(node.kids, True)

    for kind, sign, text, linked in walk(html):
        if kind == "text":
            raw.append((text, linked))
            continue
        flush()
        if kind == "in":
            number += 1
            node = Part(sign)
            node.members = [number]
            stack[-1].kids.append(node)
            stack.append(node)
        else:
            close()
    flush()
    close()
    return [top], texts


def walk(html: str) -> Iterator[tuple[str, str, str, bool]]:
    """('in' | 'out' | 'text', sign, raw text, in a link): blocks nest properly, ends are implied.
    Blocks below DEEP levels come as ends of a text: they have no part of their own."""
    names: list[str] = []
    count: dict[str, int] = {}
    linked = False

    def leave(to: int) -> Iterator[tuple[str, str, str, bool]]:
        while len(names) > to:
            name = names.pop()
            count[name] -= 1
            yield ("out" if len(names) < DEEP else "text"), name, " ", False

    def last(name: str) -> int:
        at = len(names) - 1
        while names[at] != name:
            at -= 1
        return at

    for kind, name, marks in tokens(html):
        if kind == "text":
            yield "text", "", name, linked
        elif name in _INLINE:
            if name == "a":
                linked = kind == "open"
            elif name == "br":
                yield "text", "", " ", linked
        elif name in _VOID:
            yield "text", "", " ", False
        elif kind == "close":
            if count.get(name):
                yield from leave(last(name))
                linked = False
        else:
            if name in _CLOSES_P and names and names[-1] == "p":
                yield from leave(len(names) - 1)
            elif name in _ITSELF and any(count.get(x) for x in _PEERS.get(name, (name,))):
                at = max(last(x) for x in _PEERS.get(name, (name,)) if count.get(x))
                if not any(x in _ITSELF[name] for x in names[at:]):
                    yield from leave(at)
            elif name == "body" and names and names[-1] == "head":
                yield from leave(len(names) - 1)
            linked = False
            names.append(name)
            count[name] = count.get(name, 0) + 1
            yield ("in" if len(names) <= DEEP else "text"), (f"{name}.{marks}" if marks else name), " ", False
    yield from leave(0)


def _size(parts: list[Part]) -> int:
    return sum(1 + _size(p.kids) for p in parts)


def _cut_below(parts: list[Part], levels: int) -> None:
    """Parts below so many levels become text of the one there."""
    for part in parts:
        if levels > 1:
            _cut_below(part.kids, levels - 1)
        elif part.sign:
            below, part.kids = list(part.kids), []
            while below:
                kid = below.pop()
                below += kid.kids
                part.chars, part.linked, part.texts = part.chars + kid.chars, part.linked + kid.linked, {}
                part.members += kid.members
        else:
            _cut_below(part.kids, 1)


def learn(wrapper: list[Part] | None, page: list[Part]) -> list[Part]:
    """The wrapper of what it was inferred from and one more page, or wrapper."""
    wrapper = page if wrapper is None else align(wrapper, page)
    levels = DEEP
    while _size(wrapper) > NODES:
        levels = levels // 2
        _cut_below(wrapper, max(2, levels))
        if levels <= 2:
            break
    return wrapper


# --- which parts are main text


def _names_role(sign: str) -> bool:
    """Whether some mark consists of words for roles of what is no main text."""
    for mark in sign.partition(".")[2].split():
        words = set(re.split(r"[^a-z]+", mark)) - {""}
        if words & _ROLES and words <= _ROLES | _NO_ROLE:
            return True
    return False


class _Seen:
    """A wrapper's parts in preorder, with what containers are ranked by."""

    def __init__(self, wrapper: list[Part]) -> None:
        self.parts: list[Part] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        todo: list[tuple[Part, int]] = [(p, -1) for p in reversed(wrapper)]
        while todo:
            part, up = todo.pop()
            self.parts.append(part)
            self.parent.append(up)
            me = len(self.parts) - 1
            todo += [(k, me) for k in reversed(part.kids)]
        n = len(self.parts)
        self.end = list(range(1, n + 1))
        for i in range(n - 1, 0, -1):
            if self.parent[i] >= 0:
                self.end[self.parent[i]] = max(self.end[self.parent[i]], self.end[i])
        in_main, self.aside = [False] * n, [False] * n
        for i, part in enumerate(self.parts):
            up = self.parent[i]
            in_main[i] = part.tag in _MAIN_TAGS or up >= 0 and in_main[up]
            self.aside[i] = up >= 0 and self.aside[up] or part.tag in _ASIDE_TAGS or part.tag == "header" and not (up >= 0 and in_main[up])
        self.template = [p.pages >= SEEN and max(p.texts.values(), default=0) >= SAME * p.pages for p in self.parts]
        self.role = [False] * n

    def sums(self, value: list[int]) -> list[int]:
        """Of every part and all below it."""
        total = list(value)
        for i in range(len(total) - 1, -1, -1):
            if self.parent[i] >= 0:
                total[self.parent[i]] += total[i]
        return total

    def chars(self) -> list[int]:
        return [0 if a else p.chars for p, a in zip(self.parts, self.aside, strict=True)]

    def inside(self, top: int) -> list[int]:
        """Parts of a container that are main text: no asides, no parts named after another role and
        no template (an article may repeat itself), unless that is most of it."""
        span = range(top, self.end[top])
        open_chars = self.chars()
        total = self.sums(open_chars)
        out: set[int] = set()
        for i in span:
            if i > top and (self.parent[i] in out or _names_role(self.parts[i].sign) and 2 * total[i] < total[top]):
                out.add(i)
        kept = [i for i in span if i not in out and not self.aside[i]]
        same = [] if self.parts[top].tag == "article" else [i for i in kept if self.template[i]]
        if 2 * sum(open_chars[i] for i in same) < sum(open_chars[i] for i in kept):
            gone = set(same)
            kept = [i for i in kept if i not in gone]
        return kept


def containers(wrapper: list[Part]) -> list[list[int]]:
    """Ranked containers, each as numbers (in preorder) of its parts that are main text."""
    seen = _Seen(wrapper)
    n, parts = len(seen.parts), seen.parts
    chars = seen.chars()
    total = seen.sums(chars)
    main = [i for i in range(n) if parts[i].tag in _MAIN_TAGS and not seen.aside[i] and total[i]]
    # of nested ones the inner, if it holds half of the outer's text
    main.sort(key=lambda i: (-total[i], i))
    first: list[int] = []
    for i in main:
        at = len(first)
        for j, outer in enumerate(first):
            if outer < i < seen.end[outer] and 2 * total[i] >= total[outer]:
                at = j
                break
        first.insert(at, i)

    def ranked(use_roles: bool) -> list[int]:
        shut = [False] * n
        for i in range(n):
            up = seen.parent[i]
            shut[i] = up >= 0 and shut[up] or use_roles and _names_role(parts[i].sign)
        own = [0 if shut[i] or seen.template[i] or 2 * parts[i].linked > parts[i].chars else c - min(c, parts[i].linked) for i, c in enumerate(chars)]
        whole, mass = seen.sums(own), list(own)
        for i in range(n):
            up = seen.parent[i]
            while up >= 0 and not parts[up].sign:
                up = seen.parent[up]
            if up >= 0 and parts[i].sign:
                mass[up] += own[i]
        order = sorted((i for i in range(n) if parts[i].sign and mass[i]), key=lambda i: (-mass[i], i))
        out = []
        for i in order:
            # an element around it that it holds most of is the container, but never the whole page
            up = seen.parent[i]
            while up >= 0 and parts[up].tag not in ("body", "html", "page") and whole[up] < 2 * whole[i]:
                i, up = up if parts[up].sign else i, seen.parent[up]
            if i not in out:
                out.append(i)
        return out

    rest = ranked(True) or ranked(False)
    found = [seen.inside(i) for i in dict.fromkeys([*first, *rest])]
    return [f for f in found if f][:RANKS]


def _slots(wrapper: list[Part], page: list[Part], number: dict[int, int], up: int, slots: dict[int, int]) -> None:
    """Slots of a page's elements: number (by id) of the wrapper's part that each is a case of, or that
    the element around it is."""

    def below(part: Part, mine: int) -> None:
        todo = [part]
        while todo:
            one = todo.pop()
            slots.update(dict.fromkeys(one.members, mine))
            todo += one.kids

    if any(p.bag for p in wrapper):
        known = {k.sign: k for p in wrapper for k in (p.kids if not p.sign else [p])}
        flat = [p for p in page if p.sign] + [k for p in page if not p.sign for k in p.kids]
        matched = [(known.get(p.sign) or known.get(p.tag) or known.get("any"), p) for p in flat]
    else:
        groups = {tuple(k.key for k in p.kids) for p in wrapper if not p.sign}
        matched = [(xs[min(n, len(xs) - 1)] if xs else None, y) for xs, ys in pairs(wrapper, grouped(page, groups) if groups else page) for n, y in enumerate(ys)]
    for x, y in matched:
        if x is None:
            below(y, up)
            continue
        mine = number[id(x)]
        slots.update(dict.fromkeys(y.members, mine))
        if x.kids:
            _slots(x.kids, y.kids, number, mine, slots)
        else:
            for kid in y.kids:
                below(kid, mine)


class Wrapper:
    """A finished wrapper: its parts, numbered, and its containers."""

    def __init__(self, parts: list[Part], ranked: list[list[int]]) -> None:
        self.parts, self.ranked = parts, [set(r) for r in ranked]
        self.number = {id(p): i for i, p in enumerate(_Seen(parts).parts)}

    @classmethod
    def of(cls, parts: list[Part]) -> Wrapper:
        return cls(parts, containers(parts))

    def extract(self, page: list[Part], texts: list[tuple[int, str]]) -> str | None:
        slots: dict[int, int] = {}
        _slots(self.parts, page, self.number, 0, slots)
        for main in self.ranked:
            if found := [text for element, text in texts if slots.get(element) in main]:
                return " ".join(found)
        return None


def extract(html: str | None, wrapper: Wrapper | None) -> str:
    """The main text of a page, block by block."""
    if not html:
        return ""
    page, texts = tree(html)
    found = wrapper.extract(page, texts) if wrapper else None
    if found is None and texts:
        found = Wrapper.of(page).extract(page, texts)
    return found or ""


def _bare(part: Part) -> list:
    return [part.sign, part.many, part.maybe, [_bare(k) for k in part.kids]]


def _from_bare(data: list) -> Part:
    part = Part(data[0], [_from_bare(k) for k in data[3]], data[1])
    part.maybe = data[2]
    return part


_STATE = "host string, part int, wrapper string"


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper): each host's wrapper and its containers, as JSON; pages(host, html)."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state: dict[str, list[Part]] = {}
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html and html.strip():
                    page = tree(html)[0]
                    _forget(page)
                    state[host] = learn(state.get(host), page)
        part = TaskContext.get().partitionId() % GROUPS
        dumped = [json.dumps([p.dump() for p in w]) for w in state.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(state), pa.string()), pa.array([part] * len(state), pa.int32()), pa.array(dumped, pa.string())], names=["host", "part", "wrapper"])

    def together(group: pa.Table) -> list[Part]:
        wrapper = None
        for dumped in sorted(group["wrapper"].to_pylist()):
            wrapper = learn(wrapper, [Part.load(p) for p in json.loads(dumped)])
        return wrapper

    def one_row(group: pa.Table, wrapper: str, **more) -> pa.Table:
        return pa.table({"host": pa.array([group["host"][0].as_py()], pa.string()), **more, "wrapper": pa.array([wrapper], pa.string())})

    def half(group: pa.Table) -> pa.Table:
        return one_row(group, json.dumps([p.dump() for p in together(group)]), part=pa.array([0], pa.int32()))

    def whole(group: pa.Table) -> pa.Table:
        wrapper = together(group)
        return one_row(group, json.dumps([[_bare(p) for p in wrapper], containers(wrapper)]))

    partial = pages.mapInArrow(local, _STATE).groupBy("host", "part").applyInArrow(half, _STATE)
    return partial.groupBy("host").applyInArrow(whole, "host string, wrapper string")


def _forget(parts: list[Part]) -> None:
    """Elements' numbers mean nothing beyond their page."""
    todo = list(parts)
    while todo:
        part = todo.pop()
        part.members = []
        todo += part.kids


def main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    host = F.lower(F.nullif(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), "url", "html", host.alias("host"))
    wrappers = cut(infer(rows.where(F.col("host").isNotNull()).select("host", "html")), "wrappers")
    chars = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(wrappers) if chars <= BROADCAST_CHARS else wrappers, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, dumped in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if dumped and dumped not in known:
                    if len(known) >= 256:
                        known.clear()
                    parts, ranked = json.loads(dumped)
                    known[dumped] = Wrapper([_from_bare(p) for p in parts], ranked)
                texts.append(extract(html, known.get(dumped)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
