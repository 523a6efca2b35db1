"""Main-text extraction with wrappers inferred per host.

A page is a stream of structural tags and text blocks. A host's wrapper is a union-free
regular expression over such streams: pages are aligned with it one after the other;
adjacent equal stretches become repeated groups, a stretch that only one side has becomes
optional, and a text that differs becomes a slot. Every page takes part: each task folds
the pages it reads into one wrapper per host, and those partial wrappers (one per host
and task) are then aligned with each other, so a hot host is never gathered.

Besides, the pages that have a text at a path are counted for every host, path and text
(all pages, whatever the wrapper's size), and so is the unlinked text of each path. A text is
template if at least two pages and half of the host's have it, these pages are not copies of
each other, and the wrapper has it as a fixed element of that many pages. In a repeated group the texts of one page
differ among themselves, as a menu's do, so there the count decides if ``SURE_PAGES`` pages share the text. A text in any
other slot differs between pages: it is data (an author, a section) and stays, however many pages share it. The main
element is the deepest that holds ``MAIN_SHARE`` of the host's variable (not template), unlinked text.

Extraction keeps a page's blocks inside article or main elements if it has them. There a
template text that ``SURE_PAGES`` pages share goes only with a second sign: it is links for the
most part, or it stands at the end, in an element with a class or id that holds no other text
on the page (headings, list items and lines that a site's articles have in common stay; a page that
would lose most of its main text that way is a near copy and stays whole). Else it keeps what is no template
text, without blocks outside the main element that are links for the most part. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments go, told by
tag, role, and whole class and id names; if such names cover nearly all of a host's text, its
main element is read all the same. Headings and lines (br) are blocks of their own.

Null and empty html give empty text. Broken markup is read as browsers do roughly: unknown
closing tags are ignored, paragraphs and list items end where the next begins. Pages
without a host form the host ''. Elements nested deeper than ``MAX_DEPTH`` are read as children of
the one at that depth, as browsers do. Alignment is near linear in the streams' lengths,
and a wrapper keeps every element of every page of its host, however few pages have it: its
length follows the different paths of the host, not the pages."""

from __future__ import annotations

import html as htmllib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import broadcast_if_small, materialize, ship_code

HELD_TOKENS = 400_000  # wrapper elements a task holds before it hands them on
MERGE = 16  # partial wrappers of a host that one task aligns
MAX_DEPTH = 512  # fixed value: nesting that common browsers build
MAIN_SHARE = 0.7  # of a host's variable text that its main element must hold; text outside stays, links don't
SURE_PAGES = 3  # pages of a host that share a text of a repeated group before it is template; any template text before it goes from article and main
NAMED_SHARE = 0.1  # below it, elements called boilerplate hold a host's text and are read

# fixed values: HTML element classes
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title")
BLOCK = set(("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul").split())
HOLDS = set("article aside blockquote body dd details dialog div dl dt fieldset figure footer form header html li main nav ol section table tbody td tfoot th thead tr ul".split())
DROP_TAGS = set("aside audio button canvas datalist footer head iframe input label map menu nav noscript object option script select style svg template textarea title video".split())
DROP_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
DROP_NAMES = set(("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr "
                  "login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted "
                  "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget").split())

# elements of these may also be the frame around a page
FRAME_TAGS = set("dialog form header".split())
COMMENT_NAMES = set("comment comments replies reply respond".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[^a-z]+")


SURE, BY_NAME = 2, 1


class Page:
    """blocks: (path, text, kind, linked characters), kind 'm' in article or main, 'b' boilerplate,
    '' else. An article or main inside elements that only their class, id, role or FRAME_TAGS
    call boilerplate is kind 'b' if the page has main text elsewhere ('m'), '' if not; tokens: (key, text or None) of the stream that wrappers align."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[str, str, str, int]] = []
        self._marked: list[tuple[str, str, str | None]] = []
        # tag, path, dropped (SURE: no text is read; BY_NAME), main, main inside BY_NAME
        # and inside a link
        self._stack: list[tuple[str, str, int, bool, bool, bool]] = [("", "", 0, False, False, False)]
        self._open_tags: dict[str, int] = {}
        self._paths: dict[tuple[str, str], str] = {}  # one string for all elements of a path
        self._depth: dict[str, int] = {"": 0}
        self._text: list[str] = []
        self._linked = 0
        self._read(source or "")
        other = "b" if any(b[2] == "m" for b in self.blocks) else ""
        self.blocks = [(p, t, other if k == "s" else k, n) for p, t, k, n in self.blocks]
        self.tokens = [(f"#{p}" if k[0] == "s" else k, t) for p, k, t in self._marked if k[0] != "s" or not other]

    def _flush(self) -> None:
        if self._text:
            text = _SPACE.sub(" ", htmllib.unescape("".join(self._text))).strip()
            if text:
                _, path, drop, main, inner, _ = self._stack[-1]
                self.blocks.append((path, text, "b" if drop else "s" if inner else "m" if main else "", min(self._linked, len(text))))
                if not drop:
                    self._marked.append((path, "s" if inner else f"#{path}", text))
            self._text, self._linked = [], 0

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            m = _TOKEN.search(s, at)
            end = m.start() if m else n
            if end > at:
                self._say(s[at:end])
            if not m:
                break
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self._close(tag)
                else:
                    self._open(tag, m[3])
                    if tag in RAW:
                        stop = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(s, at)
                        at = stop.end()
                        self._close(tag)
        self._flush()

    def _say(self, raw: str) -> None:
        if self._stack[-1][2] != SURE:
            self._text.append(raw)
            if self._stack[-1][5]:
                self._linked += len(raw)

    def _open(self, tag: str, attrs: str) -> None:
        block = tag in BLOCK
        if block:
            self._flush()
            if tag == "body":
                self._pop_to("head")
            if tag not in ("br", "hr"):
                self._pop_to("p")
            if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                self._pop_to(tag)
        if tag in VOID:
            return
        _, path, drop, main, inner, link = self._stack[-1]
        names: list[str] = []
        whole: set[str] = set()
        role = ""
        if attrs and drop != SURE:
            for a in _ATTR.finditer(attrs):
                key, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
                if key in ("class", "id"):
                    names += [x for x in _NAME.split(value) if x]
                    whole.update(value.split())
                elif key == "role":
                    role = value.strip()
                elif key == "style" and "display:none" in value.replace(" ", ""):
                    drop = SURE
                elif key == "aria-hidden" and value == "true":
                    drop = SURE
            if _HIDDEN.search(_ATTR.sub("", attrs).lower()):
                drop = SURE
        holder = tag in ("article", "main") or role == "main"
        if holder:
            by_name = role in DROP_ROLES or not whole.isdisjoint(COMMENT_NAMES)
        elif tag in ("html", "body"):
            by_name = role in DROP_ROLES
        else:
            drop = SURE if tag in DROP_TAGS else drop
            by_name = role in DROP_ROLES or not whole.isdisjoint(DROP_NAMES) or (tag in FRAME_TAGS and not (main and tag == "header")) or (not main and "header" in whole)
        if by_name:
            drop = drop or BY_NAME
        elif holder and drop == BY_NAME:
            drop, inner = 0, True
        main = main or holder
        if block:
            path = self._child(path, tag, names)
            if not drop and tag in HOLDS:
                self._marked.append((path, f"<{path}", None))
        self._stack.append((tag, path, drop, main, inner, link or tag == "a"))
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1

    def _child(self, path: str, tag: str, names: list[str]) -> str:
        """Path of an element below ``path``; the same string for the same path."""
        if self._depth[path] >= MAX_DEPTH:
            return path
        named = ".".join(sorted(set(names)))
        if len(named) > 80:
            named = blake2b(named.encode("utf-8", "replace"), digest_size=8).hexdigest()
        step = f"{tag}.{named}" if named else tag
        full = self._paths.get((path, step))
        if full is None:
            full = self._paths[path, step] = f"{path}/{step}"
            self._depth[full] = self._depth[path] + 1
        return full

    def _cut(self, i: int) -> None:
        """Ends the open elements from the i-th on."""
        for x in self._stack[i:]:
            self._open_tags[x[0]] -= 1
        del self._stack[i:]

    def _pop_to(self, tag: str) -> None:
        """Ends an open element of that tag, if one is open in the same container."""
        if not self._open_tags.get(tag):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][0] == tag:
                self._cut(i)
                return
            if self._stack[i][0] in HOLDS:
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if not self._open_tags.get(tag):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            here = self._stack[i][0]
            if here == tag:
                self._cut(i)
                return
            if here in HOLDS and tag not in HOLDS:
                return


# -- wrappers ------------------------------------------------------------------
# an element is [key, text (None: a tag or a slot), pages, characters of text, linked characters, flags]
# flags: 1 optional, 2 repeated, 4 slot

OPTIONAL, REPEATED, SLOT = 1, 2, 4


def _join(a: list, b: list) -> list:
    """Two aligned elements as one."""
    slot = (a[5] | b[5]) & SLOT or (SLOT if a[1] != b[1] else 0)
    return [a[0], None if slot else a[1], a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] | b[5] | slot]


_PRIME, _BASE = (1 << 61) - 1, 1_000_003
NEAR = 4  # next places of a token that are tried as the start of a repetition


def fold_repeats(w: list[list]) -> list[list]:
    """Adjacent equal stretches of any length become one repeated group. Stretches are
    compared by prefix hashes, and only where a token comes again."""
    ids: dict[str, int] = {}
    keys = [ids.setdefault(e[0], len(ids) + 1) for e in w]
    n = len(keys)
    total, power, nxt, last = [0] * (n + 1), [1] * (n + 1), [n] * n, {}
    for i, k in enumerate(keys):
        total[i + 1] = (total[i] * _BASE + k) % _PRIME
        power[i + 1] = power[i] * _BASE % _PRIME
    for i in range(n - 1, -1, -1):
        nxt[i] = last.get(keys[i], n)
        last[keys[i]] = i

    def same(a: int, b: int, p: int) -> bool:
        return b + p <= n and (total[a + p] - total[a] * power[p] - total[b + p] + total[b] * power[p]) % _PRIME == 0

    out, i = [], 0
    while i < n:
        at, found = nxt[i], 0
        for _ in range(NEAR):
            if 2 * at - i > n:
                break
            if same(i, at, at - i):
                found = at - i
                break
            at = nxt[at]
        if not found:
            out.append(w[i])
            i += 1
            continue
        unit, j = [list(e) for e in w[i:i + found]], i + found
        while same(i, j, found):
            for k in range(found):
                pages = max(unit[k][2], w[j + k][2])
                unit[k] = _join(unit[k], w[j + k])
                unit[k][2] = pages
            j += found
        for e in unit:
            e[5] |= REPEATED
        out.extend(unit)
        i = j
    return out


def fold_nested(w: list[list]) -> list[list]:
    """``fold_repeats`` to its end: folding the repetitions inside two stretches may make
    these equal, so that lists of lists of any lengths are one group, too."""
    while len(folded := fold_repeats(w)) < len(w):
        w = folded
    return folded


def page_wrapper(page: Page) -> list[list]:
    linked = {(f"#{p}", t): n for p, t, _, n in page.blocks}
    return fold_nested([[k, t, 1, len(t or ""), linked.get((k, t), 0), 0] for k, t in page.tokens])


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of pairs (sorted by the first) whose second rises, too."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        x = bisect_left(ends, j)
        ends[x:x + 1], at[x:x + 1] = [j], [k]
        before[k] = at[x - 1] if x else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal tokens in both streams, in order. Equal ends first; then tokens that
    either side has once are the fixed points, and the stretches between them are aligned on
    their own; where no token is single, the kth of a side goes with the kth of the other."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b), 0)]
    while work:
        a0, a1, b0, b1, level = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        where: tuple[dict, dict] = ({}, {})
        for found, side, lo, hi in ((where[0], a, a0, a1), (where[1], b, b0, b1)):
            for i in range(lo, hi):
                found.setdefault(side[i], []).append(i)
        single = [(x[0], y[0]) for k, x in where[0].items() if len(x) == 1 and len(y := where[1].get(k, ())) == 1]
        if single and level < 4:
            chain = _rising(sorted(single))
            out += chain
            for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)], strict=True):
                work.append((i + 1, i2, j + 1, j2, level + 1))
        else:
            out += _rising(sorted((i, j) for k, x in where[0].items() for i, j in zip(x, where[1].get(k, ()), strict=False)))
    return sorted(out)


def align(w: list[list], other: list[list]) -> list[list]:
    """The union-free expression that covers both."""
    keys, theirs = [e[0] for e in w], [e[0] for e in other]
    if keys == theirs:
        return [_join(a, b) for a, b in zip(w, other, strict=True)]
    out, i, j = [], 0, 0
    for x, y in [*_common(keys, theirs), (len(w), len(other))]:
        out += [[*e[:5], e[5] | OPTIONAL] for e in w[i:x]]
        out += [[*e[:5], e[5] | OPTIONAL] for e in other[j:y]]
        if x < len(w):
            out.append(_join(w[x], other[y]))
        i, j = x + 1, y + 1
    return fold_nested(out)


def _mark(path: str, text: str) -> str:
    return blake2b(f"{path}\n{text}".encode("utf-8", "replace"), digest_size=8).hexdigest()


def structure(w: list[list], pages: int) -> tuple[list[str], list[str], list[str]]:
    """Of a wrapper: marks of the texts that are fixed elements of two pages and half of the host's (a
    text may be one in several places), the paths of all its texts, and of those in repeated groups."""
    texts = [e for e in w if e[0][0] == "#"]
    places: dict[tuple[str, str], int] = {}
    for e in texts:
        if e[1] is not None:
            places[e[0], e[1]] = places.get((e[0], e[1]), 0) + e[2]
    fixed = {_mark(k[1:], t) for (k, t), n in places.items() if n >= 2 and 2 * n >= pages}
    return sorted(fixed), sorted({e[0][1:] for e in texts}), sorted({e[0][1:] for e in texts if e[5] & REPEATED})


def template_texts(fixed, paths, groups, common) -> tuple[list[str], list[str]]:
    """Marks of a host's template texts, and of those that go from article and main, too. The wrapper
    decides: of the ``common`` texts (path, mark, pages) its fixed elements, those of its repeated groups that enough pages share,
    and those whose path it does not know; no slots."""
    fixed, paths, groups = set(fixed), set(paths), set(groups)
    found = [x for x in common if x["mark"] in fixed or x["path"] not in paths or (x["path"] in groups and x["pages"] >= SURE_PAGES)]
    return sorted({x["mark"] for x in found}), sorted({x["mark"] for x in found if x["pages"] >= SURE_PAGES})


def rules(found, sure, main: str | None, named: bool | None) -> dict:
    """What extraction needs of a host: marks of template texts (``sure``: those that go from
    article and main too), path of the main element, whether that is called boilerplate."""
    return {"main": main or "", "named": bool(named), "fixed": list(found), "sure": list(sure)}


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_texts(page: Page) -> tuple[dict, int]:
    """(path, mark, named) -> [characters, linked characters] of a page's texts, and a hash of
    its unnamed texts: copies of a page share it."""
    found: dict[tuple, list] = {}
    whole = blake2b(digest_size=8)
    for path, text, kind, linked in page.blocks:
        mark = _mark(path, text)
        x = found.setdefault((path, mark, kind == "b"), [0, 0])
        x[0], x[1] = x[0] + len(text), x[1] + linked
        if kind != "b":
            whole.update(mark.encode())
    return found, int.from_bytes(whole.digest(), "big", signed=True)


PARTS = "host string, path string, mark string, named boolean, pages long, chars long, linked long, low long, high long, wrapper string"
SHAPES = "host string, pages long, wrapper string"


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, rules): what extraction needs of every host, as JSON of ``rules``."""
    names = [x.split()[0] for x in PARTS.split(", ")]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list] = {}
        count: dict[str, int] = {}
        marks: dict[tuple, list] = {}
        held = 0

        def out() -> pd.DataFrame:
            rows = [(*k, *v, None) for k, v in marks.items()]
            rows += [(h, None, None, None, count[h], None, None, None, None, json.dumps(w)) for h, w in known.items()]
            f = pd.DataFrame(rows, columns=names)
            return f.astype({c: "Int64" for c in ("pages", "chars", "linked", "low", "high")} | {"named": "boolean"})

        for f in frames:
            for host, source in zip(f["host"], f["html"], strict=True):
                page = Page(source)
                w = page_wrapper(page)
                held -= len(known.get(host, ()))
                known[host] = align(known[host], w) if host in known else w
                held += len(known[host])
                count[host] = count.get(host, 0) + 1
                texts, copy = page_texts(page)
                for (path, mark, named), (chars, linked) in texts.items():
                    x = marks.setdefault((host, path, mark, named), [0, 0, 0, copy, copy])
                    x[:] = x[0] + 1, x[1] + chars, x[2] + linked, min(x[3], copy), max(x[4], copy)
                if len(marks) > 50_000 or held > HELD_TOKENS:  # bounded memory, more partial rows
                    yield out()
                    marks.clear(), known.clear(), count.clear()
                    held = 0
        yield out()

    def merged(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("wrapper")
        w = None
        for x in f["wrapper"]:
            w = json.loads(x) if w is None else align(w, json.loads(x))
        return pd.DataFrame([(f["host"].iloc[0], int(f["pages"].sum()), json.dumps(w))], columns=["host", "pages", "wrapper"])

    @F.pandas_udf("struct<fixed:array<string>,paths:array<string>,groups:array<string>>")
    def shape(wrapper: pd.Series, pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([structure(json.loads(x), int(n)) for x, n in zip(wrapper, pages, strict=True)], columns=["fixed", "paths", "groups"])

    @F.pandas_udf("struct<found:array<string>,sure:array<string>>")
    def template_of(fixed: pd.Series, paths: pd.Series, groups: pd.Series, common: pd.Series) -> pd.DataFrame:
        rows = zip(fixed, paths, groups, common, strict=True)
        return pd.DataFrame([template_texts(f, p, g, [] if c is None else c) for f, p, g, c in rows], columns=["found", "sure"])

    @F.pandas_udf("string")
    def as_json(found: pd.Series, sure: pd.Series, main: pd.Series, named: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(rules(f, s, m, n)) for f, s, m, n in zip(found, sure, main, named, strict=True)], dtype=object)

    ship_code(pages.sparkSession)
    parts = materialize(pages.select(host_of(F.col("url")).alias("host"), "html").mapInPandas(partial, PARTS), "wrapper_parts")
    # partial wrappers of a host are aligned a few at a time, until each host has one
    shapes = parts.where("wrapper is not null").select("host", "pages", "wrapper")
    while True:
        most = shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        groups = -(-most // MERGE)
        slot = F.pmod(F.xxhash64("wrapper", "pages"), F.lit(groups)).alias("slot") if groups > 1 else F.lit(0).alias("slot")
        shapes = materialize(shapes.groupBy("host", slot).applyInPandas(merged, SHAPES), "wrapper_merged")
    shapes = shapes.withColumn("s", shape("wrapper", "pages")).select("host", "s.fixed", "s.paths", "s.groups")
    total = parts.where("wrapper is not null").groupBy("host").agg(F.sum("pages").alias("total"))
    marks = parts.where("wrapper is null").groupBy("host", "path", "mark", "named").agg(
        *[F.sum(c).alias(c) for c in ("pages", "chars", "linked")], F.min("low").alias("low"), F.max("high").alias("high"))
    marks = marks.join(broadcast_if_small(total, 20_000), "host")
    # copies of one page make no template: the pages of a template text differ elsewhere
    template = (F.col("pages") >= 2) & (2 * F.col("pages") >= F.col("total")) & (F.col("low") < F.col("high"))
    common = marks.where(template & ~F.col("named")).groupBy("host").agg(F.collect_list(F.struct("path", "mark", "pages")).alias("common"))
    known = shapes.join(common, "host", "left").withColumn("t", template_of("fixed", "paths", "groups", "common"))
    known = materialize(known.select("host", "t.found", "t.sure"), "wrapper_templates")
    # variable is what the wrapper does not call template; of names it knows nothing
    gone = known.select("host", F.explode("found").alias("mark"), F.lit(False).alias("named"))
    variable = marks.where(~(template & F.col("named"))).join(broadcast_if_small(gone), ["host", "mark", "named"], "left_anti")
    paths = variable.groupBy("host", "path", "named").agg(F.greatest(F.sum("chars") - 2 * F.sum("linked"), F.lit(0)).alias("v"))
    steps = F.split("path", "/")
    above = F.when(F.size(steps) >= 2, F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/")))
    above = paths.where("v > 0").select("host", "named", "v", F.explode(above).alias("p")).groupBy("host", "p").agg(
        F.sum(F.when(~F.col("named"), F.col("v")).otherwise(0)).alias("free"), F.sum("v").alias("every"))
    most = above.groupBy("host").agg(F.max("free").alias("most_free"), F.max("every").alias("most"))
    above = above.join(broadcast_if_small(most, 20_000), "host").withColumn("is_named", F.col("most_free") < NAMED_SHARE * F.col("most"))
    v, top = F.when(F.col("is_named"), F.col("every")).otherwise(F.col("free")), F.when(F.col("is_named"), F.col("most")).otherwise(F.col("most_free"))
    last = F.split(F.element_at(F.split("p", "/"), -1), "[.]")[0]
    main = above.where((v >= MAIN_SHARE * top) & (v > 0) & last.isin(*sorted(HOLDS))).groupBy("host").agg(
        F.max(F.struct(F.size(F.split("p", "/")).alias("deep"), "p")).alias("x"), F.max("is_named").alias("is_named"))

    one = known.join(main.select("host", F.col("x.p").alias("main"), "is_named"), "host", "left")
    return one.select("host", as_json("found", "sure", F.coalesce("main", F.lit("")), F.coalesce("is_named", F.lit(False))).alias("rules"))


def _own_end(kept: list[tuple[str, str, int, bool]]) -> set[int]:
    """Template blocks at the end of an article that stand in a named element without any other
    text: (path, text, linked characters, template) of the blocks -> their indexes."""
    if not kept[-1][3]:
        return set()
    mine = [p for p, _, _, shared in kept if not shared]
    used = {p[:i] for p in set(mine) for i in [*[m.start() for m in re.finditer("/", p)], len(p)]}
    out: set[int] = set()
    for i in range(len(kept) - 1, -1, -1):
        path, _, _, shared = kept[i]
        if not shared:
            break
        ends = [*[m.start() for m in re.finditer("/", path)][1:], len(path)]
        if any("." in path[path.rfind("/", 0, e) + 1:e] and path[:e] not in used for e in ends):
            out.add(i)
    return out


def main_text(source: str | None, rule: dict) -> str:
    blocks = Page(source).blocks
    fixed, main, sure = rule["fixed"], rule["main"], rule["sure"]
    kept = [(p, t, n, _mark(p, t) in sure) for p, t, kind, n in blocks if kind == "m"]
    if kept:
        end = _own_end(kept)
        goes = [x and (2 * n >= len(t) or i in end) for i, (_, t, n, x) in enumerate(kept)]
        # a page of which most would go is a near copy of others
        copy = 2 * sum(len(k[1]) for k, g in zip(kept, goes, strict=True) if g) > sum(len(k[1]) for k in kept)
        return "\n".join(k[1] for k, g in zip(kept, goes, strict=True) if copy or not g)
    inside = lambda p: main and (p == main or p.startswith(main + "/"))
    free = [(p, t, 2 * n >= len(t)) for p, t, kind, n in blocks
            if (kind == "" or rule["named"] and inside(p)) and _mark(p, t) not in fixed]
    # outside the main element only link lists go: headlines and intros may stand beside it
    return "\n".join([t for p, t, link in free if not link or inside(p)] or [t for _, t, _ in free])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and ``text``, the main text, of every row of ``pages`` (page_id, url, html)."""
    @F.pandas_udf("string")
    def text(html: pd.Series, rule: pd.Series) -> pd.Series:
        read: dict[str, dict] = {}
        out = []
        for h, r in zip(html, rule, strict=True):
            if r not in read:
                x = json.loads(r) if r else {"main": "", "named": False, "fixed": [], "sure": []}
                read[r] = x | {"fixed": set(x["fixed"]), "sure": set(x["sure"])}
            out.append(main_text(h, read[r]))
        return pd.Series(out, dtype=object)

    known = broadcast_if_small(materialize(wrappers(pages), "wrappers"), 20_000)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(known, "host", "left")
    return rows.select("page_id", "url", text("html", "rules").alias("text"))
