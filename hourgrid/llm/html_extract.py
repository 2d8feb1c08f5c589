"""Main-text extraction by equivalence-class template deduction.

A page is a sequence of tokens: its elements, told apart by their place in the
page, and the text runs between them.  Tokens of a host that have the same
occurrence vector (the same count on every page) form an equivalence class.
Classes whose tokens occur once on their pages are layouts: the innermost element
of such a class that holds most of its text is the layout's article slot.  Inside
the slot, text that occurs with its element on the layout's pages is template
text, and a class of named elements that repeats behind the slot's own text is a
list of records (reader comments, teasers).  What is left in the slot, outside
menus, notices and other furniture, is the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from .common import materialise, read_table

SUPPORT = 0.5  # share of a host's pages that its main layout must cover
LAYOUT_SUPPORT = 0.05  # share of a host's pages that any other class must cover, ...
LEAST_PAGES = 3  # ... and pages, as for template text and records
REPEATED = 0.9  # share of an element's pages on which a text in it is template text
HOLDS = 0.8  # share of a layout's text that its article slot holds

#: HTML's elements by how they take part in the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr""".split())
FURNITURE = frozenset("""nav header footer aside form script style noscript iframe template svg math object button select option
textarea input dialog menu head title canvas audio video map figcaption""".split()) - {"figcaption"}
#: Class names, ids and roles that mark furniture, ...
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar
navigation menu menubar breadcrumb breadcrumbs header masthead footer contentinfo sidebar aside complementary cookie cookies consent
notice notices alert disclaimer popup modal overlay newsletter subscribe signup login form search share sharing social comment comments
disqus respond replies related recommended widget toolbar pagination pager skip hidden""".split())
#: ... and the words that they may be compounded with ("site-header", "nav-links").
COMPOUND_WORDS = frozenset("""site page top bottom left right main primary secondary inner outer area box bar list item items block section wrap
wrapper container button buttons link links post posts entry article articles global mobile desktop js slot unit group panel row col icon
icons toggle text title policy message msg thread reply form us our your author email mail""".split())
#: ... that mark furniture in any compound ("notice-x"), unless the name is one of something without or around it.
STRONG_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored sidebar cookie cookies notice notices disclaimer
newsletter breadcrumb breadcrumbs comment comments disqus navbar masthead pagination""".split())
AROUND_WORDS = frozenset("no non not without with has have hide page site body layout".split())
NEVER_FURNITURE = frozenset(("html", "body", "main", "article"))
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav
ol p pre section table ul""".split())
CLOSES_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
               "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
SCOPES = frozenset(("html", "body", "table", "ul", "ol", "dl", "div", "article", "section", "main", "td", "th", "blockquote"))

_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]+)")


def _names_furniture(name: str) -> bool:
    """Whether a class name, id or role is a furniture word or a compound of such
    words; "no-sidebar" and "page-with-comments" name something else."""
    parts = [w for w in re.split(r"[_-]+", name) if w]
    if any(w in STRONG_WORDS for w in parts) and not any(w in AROUND_WORDS for w in parts):
        return True
    return any(w in FURNITURE_WORDS for w in parts) and all(w in FURNITURE_WORDS or w in COMPOUND_WORDS or w[0].isdigit() for w in parts)


def _is_hidden(attributes: dict[str, str]) -> bool:
    style = [[x.strip() for x in d.split(":", 1)] for d in attributes.get("style", "").lower().split(";")]
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or any(d[0] == "display" and len(d) == 2 and d[1].split("!")[0].strip() == "none" for d in style))


@lru_cache(maxsize=65536)
def _element(name: str, text: str) -> tuple[str, str, int]:
    """(name, label, mark) of a start tag.  Mark 2: furniture with all it holds, by
    its element or hidden; 1: furniture by its names (or a form), which may also be
    those of a wrapper around the article; 0: none."""
    name = name.lower()
    attributes: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(text):
        attributes.setdefault(key.lower(), html.unescape(a or b or c))
    names = [w for key in ("class", "id", "role") for w in attributes.get(key, "").lower().split()]
    words = [w for m in names for w in re.split(r"[_-]+", m) if w]
    free = name in NEVER_FURNITURE
    mark = 2 if name in FURNITURE and name != "form" or not free and _is_hidden(attributes) else int(
        name == "form" or not free and any(map(_names_furniture, names)))
    label = name + "".join("." + re.sub(r"\d+", "#", w) for w in sorted(set(words))[:4])
    return name, label, mark


def blocks_of(page: str) -> list[tuple[str, bool, str]]:
    """(path, furniture, text) of each text block in page order; the path of an
    element is that of its parent and its own label.  Elements without text come
    with an empty text, once per start tag.

    A wrapper with furniture's names does not hide the page's article: where
    ``main``, or an ``article`` with at least half of the text, lies inside marked
    wrappers only, the marks around it do not count for what it holds."""
    marked = list(_marked_blocks(page))
    plain = sum(len(text) for _, marks, _, text in marked if not marks)
    inside: Counter[tuple[str, int]] = Counter()
    for _, marks, holder, text in marked:
        if holder and marks == holder[1]:
            inside[holder] += len(text)
    shown = {n for (name, n), chars in inside.items() if chars and n < _HARD and (n == 0 or name == "main" or chars >= plain)}
    level = min(shown, default=0)
    return [(path, bool(marks) and not (marks == level and holder is not None and holder[1] == level), text) for path, marks, holder, text in marked]


_HARD = 1 << 30  # marks that no article undoes


def _marked_blocks(page: str) -> Iterator[tuple[str, int, tuple[str, int] | None, str]]:
    """(path, marks, holder, text) of each block: the number of furniture marks on
    it and above, and the name and marks of the ``article`` or ``main`` around it."""
    stack: list[tuple[str, str, int, tuple[str, int] | None]] = [("", "", 0, None)]  # name, path, marks, holder
    parts: list[str] = []
    at = 0

    def flush() -> Iterator[tuple[str, int, tuple[str, int] | None, str]]:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            yield *stack[-1][1:], text

    def close(names: tuple[str, ...]) -> None:
        for n in range(len(stack) - 1, 0, -1):
            if stack[n][0] in names:
                del stack[n:]
                return
            if stack[n][0] in SCOPES:
                return

    while at < len(page):
        tag = _TAG.search(page, at)
        if not tag:
            parts.append(page[at:])
            break
        parts.append(page[at : tag.start()])
        at = tag.end()
        ending, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name, label, mark = _element(name, attributes or "")
        if name in INLINE and not mark:
            if name == "br":
                parts.append(" ")
            continue
        if ending:
            if any(entry[0] == name for entry in stack):
                yield from flush()
                while stack[-1][0] != name:
                    stack.pop()
                stack.pop()
            elif name not in INLINE:
                yield from flush()
            continue
        yield from flush()
        if name in CLOSES_P:
            close(("p",))
        if name in CLOSES_SELF:
            close(CLOSES_SELF[name])
        path = f"{stack[-1][1]}>{label}"
        marks = stack[-1][2] + (0, 1, _HARD)[mark]
        holder = (name, marks) if name in ("article", "main") and not (stack[-1][3] and stack[-1][3][1] == marks) else stack[-1][3]
        yield path, marks, holder, ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not (attributes or "").endswith("/"):
            stack.append((name, path, marks, holder))
    yield from flush()


def _last_label(path: str) -> str:
    return path.rsplit(">", 1)[-1].split(".")[0]


def _within(path: str, region: str) -> bool:
    return path == region or path.startswith(region + ">")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _text_token(path: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path}\0{text}".encode("utf-8", "replace")) >> 1


def _is_named(path: str) -> bool:
    return "." in path.rsplit(">", 1)[-1]


def trailing_elements(blocks: list[tuple[str, bool, str]]) -> set[str]:
    """Paths of the named elements behind the text of their parent: no text in an
    element without names, and none of the parent itself, follows their first one."""
    first: dict[str, int] = {}
    last_plain: dict[str, int] = {}
    shown = [(n, path) for n, (path, furniture, text) in enumerate(blocks) if text and not furniture]
    for n, path in shown:
        while path and path not in first:
            first[path] = n
            path = path.rpartition(">")[0]
    seen: set[str] = set()
    for n, path in reversed(shown):
        last_plain.setdefault(path, n)
        while path and path not in seen:
            seen.add(path)
            parent = path.rpartition(">")[0]
            if not _is_named(path):
                last_plain.setdefault(parent, n)
            path = parent
    return {path for path, n in first.items() if _is_named(path) and last_plain.get(path.rpartition(">")[0], -1) < n}


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, path, text, n_pages, single, vector_a, vector_b, chars, trailing):
    occurrence vectors of the tokens of (url, html) rows, summed per batch.  A
    vector is kept as two sums of a hash of (page, count): equal vectors have equal
    sums.  ``single`` counts the pages that have the token once, ``trailing`` those
    where the element stands behind its parent's text.  Furniture has no tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str, int], list[int]] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                host, key = host_of(url), xxhash.xxh3_64_intdigest((url or "").encode("utf-8", "replace"))
                seen: Counter[tuple[str, int]] = Counter({("", 0): 1})
                chars: Counter[str] = Counter()
                blocks = blocks_of(page or "")
                trailing = trailing_elements(blocks)
                for path, furniture, text in blocks:
                    if furniture:
                        continue
                    if text:
                        chars[path] += len(text)
                        seen[path, _text_token(path, text)] += 1
                    else:
                        seen[path, 0] += 1
                for (path, text), n in seen.items():
                    h = xxhash.xxh3_64_intdigest(b"%d:%d" % (key, n))
                    row = sums.setdefault((host, path, text), [0] * 6)
                    for i, x in enumerate((1, n == 1, h & 0x7FFFFFFF, h >> 33, 0 if text else chars[path], not text and path in trailing)):
                        row[i] += x
            columns = list(zip(*[(*k, *v) for k, v in sums.items()], strict=True)) or [()] * 9
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 7]
            names = ["host", "path", "text", "n_pages", "single", "vector_a", "vector_b", "chars", "trailing"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = pages.select("url", "html").mapInArrow(
        count, "host string, path string, text long, n_pages long, single long, vector_a long, vector_b long, chars long, trailing long")
    return rows.groupBy("host", "path", "text").agg(*[F.sum(c).alias(c) for c in ("n_pages", "single", "vector_a", "vector_b", "chars", "trailing")])


def article_path(elements: list[tuple[str, int, int, int]], n_pages: int) -> str | None:
    """The template element whose slot holds the article.

    ``elements`` are (path, class number, pages, chars) of the valid classes.  An
    element stays in the template if its parent does (classes nest).  Among those
    the outermost ``article``, else ``main``, else the innermost element that
    holds most of the slots' text is the one; None without any text."""
    tree = {"": 0}
    for path, number, _, chars in sorted(elements):
        if path and path.rsplit(">", 1)[0] in tree:
            tree[path] = chars
    for wanted in ("article", "main"):
        named = [p for p in tree if _last_label(p) == wanted]
        if named:
            return min(named, key=lambda p: (p.count(">"), -sum(c for q, c in tree.items() if _within(q, p)), p))
    total = sum(tree.values())
    if not total:
        return None
    holding = [p for p in tree if p and sum(c for q, c in tree.items() if _within(q, p)) >= 0.8 * total and _last_label(p) not in ("p", "li")]
    return max(holding, key=lambda p: (p.count(">"), p), default=None)


def layout_slots(elements: list[dict], n_pages: int, support: float = SUPPORT) -> list[str]:
    """The article slots of a host's layouts, that of most pages first.

    ``elements`` have path, class, n_pages, single and chars.  The main layout's slot
    is ``article_path`` of what at least ``support`` of the pages have.  Every other
    class whose elements occur once on each of its pages is a layout of its own: its
    slot is the innermost of its elements that holds most of the text below its
    outermost one."""
    main = [(e["path"], e["class"], e["n_pages"], e["chars"]) for e in elements if e["n_pages"] >= support * n_pages]
    first = article_path(main, n_pages)
    slots = [first] if first else []
    layouts: dict[int, list[dict]] = {}
    for e in elements:
        if e["path"] and e["n_pages"] == e["single"] and e["n_pages"] < n_pages:
            layouts.setdefault(e["class"], []).append(e)
    for own in sorted(layouts.values(), key=lambda own: (-own[0]["n_pages"], min(e["path"] for e in own))):
        outer = min((e["path"] for e in own), key=lambda p: (p.count(">"), p))
        held = {e["path"]: sum(x["chars"] for x in elements if _within(x["path"], e["path"])) for e in own if _within(e["path"], outer)}
        wanted = [p for p, chars in held.items() if chars and chars >= HOLDS * held[outer] and _last_label(p) not in ("p", "li")]
        if wanted and not any(_within(outer, x) for x in slots):
            slots.append(max(wanted, key=lambda p: (_last_label(p) in ("article", "main"), p.count(">"), p)))
    return slots


def record_paths(elements: list[dict], slots: list[str]) -> list[str]:
    """The outermost elements in a slot whose class is a list of records: named, on
    some page several times or holding a named class that is, behind the text of
    their parent wherever they occur, and with less than half of the slot's text."""
    by_path = {e["path"]: e for e in elements}
    several = [e["path"] for e in elements if _is_named(e["path"]) and e["single"] < e["n_pages"]]
    found: list[str] = []
    for path, e in sorted(by_path.items()):
        slot = next((x for x in slots if path != x and _within(path, x)), None)
        if slot is None or not _is_named(path) or e["n_pages"] < LEAST_PAGES or e["trailing"] < e["n_pages"] or any(_within(path, x) for x in found):
            continue
        chars = {x: sum(y["chars"] for y in elements if _within(y["path"], x)) for x in (path, slot)}
        if any(_within(x, path) for x in several) and 2 * chars[path] < chars[slot]:
            found.append(path)
    return found


def deduce_templates(pages: DataFrame, support: float = SUPPORT, repeated: float = REPEATED) -> DataFrame:
    """(host, slots, records, fixed): per host the paths of its layouts' article slots
    and of the record lists in them, and the tokens of its template text.

    Gathered per host are only elements on a twentieth of its pages (half, for a host
    of a few pages) and texts on nearly all pages of their element, so a host's
    template is no larger than some average pages."""
    tokens = materialise(page_tokens(pages), "page-tokens")
    hosts = tokens.filter("path = '' AND text = 0").select("host", F.col("n_pages").alias("pages"))
    elements = join_dimension(tokens.filter("text = 0"), hosts, "host")
    least = F.least(F.col("pages") * support, F.greatest(F.lit(float(LEAST_PAGES)), F.col("pages") * LAYOUT_SUPPORT))
    frequent = elements.filter(F.col("n_pages") >= least).withColumn("class", F.xxhash64("n_pages", "vector_a", "vector_b"))
    gathered = frequent.groupBy("host", "pages").agg(F.collect_list(F.struct("path", "class", "n_pages", "single", "chars", "trailing")).alias("elements"))

    @F.pandas_udf("slots array<string>, records array<string>")
    def template(groups: pd.Series, pages: pd.Series) -> pd.DataFrame:
        rows = []
        for group, n in zip(groups, pages, strict=True):
            held = sorted(group, key=lambda e: e["path"])
            slots = layout_slots(held, n, support)
            rows.append((slots, record_paths(held, slots)))
        return pd.DataFrame(rows, columns=["slots", "records"])

    of = elements.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("n_pages").alias("element_pages"))
    texts = tokens.filter((F.col("text") != 0) & (F.col("n_pages") >= LEAST_PAGES))
    texts = texts.join(of, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p"))).filter(F.col("n_pages") >= F.col("element_pages") * repeated)
    fixed = texts.groupBy(F.col("host").alias("h")).agg(F.collect_list("text").alias("fixed"))
    found = gathered.select("host", template("elements", "pages").alias("t"))
    return found.join(fixed, F.col("host") == F.col("h"), "left").select("host", "t.slots", "t.records", "fixed")


def main_text(page: str | None, slots: str | list[str] | None, fixed: frozenset[int], records: list[str] | None = None) -> str:
    """The blocks of the page's article slot, joined by an empty line.  A page without
    a slot of its host falls back on its own ``article`` or ``main``, and without these
    on all blocks that are no furniture.

    Template text and records go wherever they are, unless they are most of what
    is there: a host whose pages are copies of one article has no template."""
    blocks = [(path, text) for path, furniture, text in blocks_of(page or "") if text and not furniture]
    for slot in [slots] if isinstance(slots, str) else slots or ():
        kept = [(p, t) for p, t in blocks if _within(p, slot)]
        if kept:
            break
    else:
        for wanted in ("article", "main"):
            kept = [(p, t) for p, t in blocks if any(x.split(".")[0] == wanted for x in p.split(">"))]
            if kept:
                break
        else:
            kept = blocks
    for left in ([x for x in kept if not any(_within(x[0], r) for r in records or ())], [x for x in kept if _text_token(*x) not in fixed]):
        if 2 * sum(len(t) for _, t in left) >= sum(len(t) for _, t in kept):
            gone = {id(x) for x in kept} - {id(x) for x in left}
            kept = [x for x in kept if id(x) not in gone]
    return "\n\n".join(t for _, t in kept)


def extract_main_text(pages: DataFrame, support: float = SUPPORT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) per row of ``pages``.

    Null and empty pages give an empty text; pages without a host in their url
    form one group; repeated rows come back once each; an empty table gives an
    empty result; extra columns are not read.  Pages of any length are parsed whole;
    of slots that tie, the first by path counts.  The join with the templates is keyed on the host and its hash,
    so AQE may split the pages of a host of any size over tasks."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # stored, so that its size is known: few hosts are broadcast and no page is shuffled
    templates = materialise(deduce_templates(rows, support), "templates").withColumnRenamed("host", "of")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1))
    same = (F.col("host") == F.col("of")) & (F.xxhash64("host") == F.xxhash64("of"))
    met = rows.withColumn("host", host).join(templates, same, "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, slots, records, fixed = (batch.column(i).to_pylist() for i in (2, 3, 4, 5))
            texts = [main_text(p, s, frozenset(f or ()), r) for p, s, r, f in zip(page, slots, records, fixed, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return met.select("page_id", "url", "html", "slots", "records", "fixed").mapInArrow(extract, "page_id long, url string, text string")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
