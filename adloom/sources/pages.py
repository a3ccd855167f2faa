"""Facts from pages: JSON-LD postings, referenced state, labelled values, cards.

Markup is tag soup and JSON is nested at will, so these parsers run in Python,
whole batches at a time in ``mapInPandas``; everything after them is columns.
"""

from __future__ import annotations

import html
import json
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCRIPT = re.compile(r"<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script\s*>", re.I | re.S)
STATE = re.compile(r"<script[^>]*id=[\"']__NUXT_DATA__[\"'][^>]*>(.*?)</script\s*>", re.I | re.S)
POSTING = (
    "title", "company", "url", "date_posted", "valid_through", "employment_type", "location", "country", "remote", "salary_low", "salary_high", "currency", "salary_unit", "description",
)


def loads(text: str):
    """JSON of a script, also if it was escaped for markup; None if broken."""
    for t in (text.strip(), html.unescape(text.strip())):
        try:
            return json.loads(t)
        except ValueError:
            continue
    return None


def walk(node, kind: str):
    """Objects of a type anywhere in nested JSON."""
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            t = x.get("@type")
            if t == kind or isinstance(t, list) and kind in t:
                yield x
            stack.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            stack.extend(reversed(x))


def choose(postings: list[dict], url: str | None, heading: str | None) -> dict | None:
    """The posting with the page's address, else the only one, else the only
    one with the page's heading."""
    for p in postings:
        if url and p.get("url") and str(p["url"]).rstrip("/") == url.rstrip("/"):
            return p
    if len(postings) == 1:
        return postings[0]
    same = [p for p in postings if heading and str(p.get("title", "")).strip().casefold() == heading.strip().casefold()]
    return same[0] if len(same) == 1 else None


def _text(x) -> str | None:
    return None if x is None else str(x)


def posting_fields(p: dict) -> dict[str, str | None]:
    """Flat fields of a job posting; several places are joined by "; "."""
    org = p.get("hiringOrganization")
    places = p.get("jobLocation") or []
    towns, countries = [], []
    for place in places if isinstance(places, list) else [places]:
        address = place.get("address", place) if isinstance(place, dict) else place
        if isinstance(address, dict):
            towns.append(address.get("addressLocality") or address.get("addressRegion"))
            c = address.get("addressCountry")
            countries.append(c.get("name") if isinstance(c, dict) else c)
        else:
            towns.append(address)
    pay = p.get("baseSalary") if isinstance(p.get("baseSalary"), dict) else {}
    value = pay.get("value") if isinstance(pay.get("value"), dict) else {"value": pay.get("value")}
    kind = p.get("employmentType")
    join = lambda xs: "; ".join(dict.fromkeys(str(x) for x in xs if x)) or None
    return {
        "title": _text(p.get("title")), "company": _text(org.get("name") if isinstance(org, dict) else org), "url": _text(p.get("url")),
        "date_posted": _text(p.get("datePosted")), "valid_through": _text(p.get("validThrough")), "employment_type": join(kind) if isinstance(kind, list) else _text(kind),
        "location": join(towns), "country": join(countries), "remote": "REMOTE" if p.get("jobLocationType") == "TELECOMMUTE" else None,
        "salary_low": _text(value.get("minValue", value.get("value"))), "salary_high": _text(value.get("maxValue", value.get("value"))),
        "currency": _text(pay.get("currency")), "salary_unit": _text(value.get("unitText")), "description": _text(p.get("description")),
    }


def find_posting(page: str | None, url: str | None = None) -> dict[str, str | None]:
    """Fields of the page's job posting, all None if there is none to choose."""
    found = [p for body in SCRIPT.findall(page or "") if (data := loads(body)) is not None for p in walk(data, "JobPosting")]
    h1 = re.search(r"<h1[^>]*>(.*?)</h1\s*>", page or "", re.I | re.S)
    p = choose(found, url, html.unescape(re.sub(r"<[^>]+>", "", h1.group(1))) if h1 else None)
    return posting_fields(p) if p else dict.fromkeys(POSTING)


def resolve(table: list, index: int, depth: int = 40, seen: frozenset = frozenset()):
    """Value of a state table whose objects hold numbers of other entries;
    cycles and depths beyond ``depth`` give None."""
    if depth < 0 or index in seen or not isinstance(index, int) or not 0 <= index < len(table):
        return None
    x, seen = table[index], seen | {index}
    if isinstance(x, list):
        if len(x) == 2 and isinstance(x[0], str) and x[0] in ("Reactive", "ShallowReactive", "Ref", "ShallowRef", "EmptyRef"):
            return resolve(table, x[1], depth - 1, seen)
        return [resolve(table, i, depth - 1, seen) for i in x]
    if isinstance(x, dict):
        return {k: resolve(table, i, depth - 1, seen) for k, i in x.items()}
    return x


def page_state(page: str | None):
    """Resolved state object of a page, None if absent or broken."""
    body = STATE.search(page or "")
    table = loads(body.group(1)) if body else None
    return resolve(table, 0) if isinstance(table, list) and table else None


class _Cards(HTMLParser):
    """Text of each element with a class, by the classes of its inner elements."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, card: str, fields: dict[str, str]):
        super().__init__(convert_charrefs=True)
        self.card, self.fields, self.cards = card, fields, []
        self.stack: list[tuple[str, str | None]] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if self.card in classes and not self.depth:
            self.cards.append({k: "" for k in self.fields} | {"url": ""})
            self.depth = len(self.stack) + 1
        if self.depth and tag == "a" and a.get("href") and not self.cards[-1]["url"]:
            self.cards[-1]["url"] = a["href"]
        if tag not in self.VOID:
            self.stack.append((tag, next((k for k, c in self.fields.items() if c in classes), None)))

    def handle_endtag(self, tag):
        while self.stack:
            name, _ = self.stack.pop()
            if len(self.stack) < self.depth:
                self.depth = 0
            if name == tag:
                break

    def handle_data(self, data):
        if self.depth:
            for _, field in self.stack[self.depth - 1 :]:
                if field:
                    self.cards[-1][field] = " ".join(f"{self.cards[-1][field]} {data}".split())


def listing_cards(page: str | None, card: str, fields: dict[str, str]) -> list[dict[str, str]]:
    """Cards of a listing page: field -> text of the element with its class."""
    parser = _Cards(card, fields)
    parser.feed(page or "")
    out, seen = [], set()
    for c in parser.cards:  # exact repeats in one page count once
        key = c["url"] or tuple(c.items())
        if key not in seen:
            seen.add(key)
            out.append(c)
    return out


def labelled(page: str | None, label: str) -> str | None:
    """Value beside a label: definition list, table row or "Label: value" line."""
    t = page or ""
    mark = re.escape(label)
    for pattern in (rf"<dt[^>]*>\s*{mark}\s*:?\s*</dt>\s*<dd[^>]*>(.*?)</dd>", rf"<th[^>]*>\s*{mark}\s*:?\s*</th>\s*<td[^>]*>(.*?)</td>", rf"(?:^|>|\n)\s*{mark}\s*:\s*([^<\n]+)"):
        if m := re.search(pattern, t, re.I | re.S):
            return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", m.group(1))).split()) or None
    return None


def parse_postings(pages: DataFrame, ident: str, page: str, url: str | None = None) -> DataFrame:
    """(ident, posting fields) of every page."""

    def run(batches):
        for pdf in batches:
            urls = pdf["u"] if url else [None] * len(pdf)
            rows = [find_posting(p, u) for p, u in zip(pdf["p"], urls)]
            out = pd.DataFrame(rows, columns=list(POSTING))
            out.insert(0, "i", pdf["i"].to_numpy())
            yield out

    inner = pages.select(F.col(f"`{ident}`").alias("i"), F.col(f"`{page}`").alias("p"), *([F.col(f"`{url}`").alias("u")] if url else []))
    kind = pages.schema[ident].dataType.simpleString()
    return inner.mapInPandas(run, f"i {kind}, " + ", ".join(f"{c} string" for c in POSTING)).withColumnRenamed("i", ident)


def merge_renders(static: Column, rendered: Column) -> Column:
    """The longer of two texts of one page; the static one if equal."""
    return F.when(F.length(F.coalesce(static, F.lit(""))) >= F.length(F.coalesce(rendered, F.lit(""))), static).otherwise(rendered)


def availability(valid_through: Column, as_of: str, status: Column) -> Column:
    """LIKELY_CLOSED or LIKELY_OPEN by an expiry, else the status."""
    at = F.lit(as_of).cast("timestamp")
    return F.when(valid_through < at, "LIKELY_CLOSED").when(valid_through >= at, "LIKELY_OPEN").otherwise(F.coalesce(status, F.lit("UNKNOWN")))


# --- trees, sites, details --------------------------------------------------------------------
class Node:
    """An element with its attributes, children and texts in order."""

    __slots__ = ("tag", "attrs", "items", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.items, self.parent = tag, attrs, [], parent

    def walk(self):
        stack = [self]
        while stack:
            x = stack.pop()
            yield x
            stack.extend(reversed([c for c in x.items if isinstance(c, Node)]))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in ("script", "style", "noscript"):
                stack.extend(reversed(x.items))
        return " ".join(" ".join(out).split())


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.items.append(node)
        if tag not in _Cards.VOID:
            self.at = node

    def handle_endtag(self, tag):
        up = self.at
        while up.parent is not None and up.tag != tag:
            up = up.parent
        if up.parent is not None:  # an end without a start is left out
            self.at = up.parent

    def handle_data(self, data):
        if data.strip():
            self.at.items.append(data)


def tree(page: str | None) -> Node:
    parser = _Tree()
    parser.feed(page or "")
    return parser.root


def is_like(node: Node, selector: str) -> bool:
    """Whether a node fits "tag", ".class", "tag.class" or "tag[attribute=value]"."""
    m = re.fullmatch(r"(\w*)(?:\.([\w\-]+))?(?:\[([\w\-]+)=([^\]]*)\])?", selector)
    tag, cls, attr, value = m.groups()
    return bool(node.tag) and (not tag or node.tag == tag) and (not cls or cls in node.attrs.get("class", "").split()) and (not attr or node.attrs.get(attr) == value)


def select(node: Node, selector: str) -> list[Node]:
    return [x for x in node.walk() if is_like(x, selector)]


@dataclass(frozen=True)
class Site:
    """How one board sets its cards: the card's selector (none: cards are found
    from their links), a pattern of links, and a selector per field."""

    link: str
    card: str = ""
    fields: dict[str, str] = field(default_factory=dict)


#: listing pages by source
SITES = {
    "jobs": Site(r"/rpd/|/ad/", "article.SearchResultCard", {"title": "h2", "company": ".SearchResultCard__footerItem", "location": "[data-test=serp-locality]", "salary": ".Tag--success"}),
    "builtin": Site(r"/job/|/ad/", "div[data-id=job-card]", {"title": "[data-id=job-card-title]", "company": "[data-id=company-title]", "location": ".location", "salary": ".salary", "seniority": ".seniority"}),
    "jobstack": Site(r"/job/|/ad/", "li.job-item", {"title": "h3", "company": ".company", "location": ".location", "seniority": ".seniority"}),
    "indeed": Site(r"[?&]jk=|/ad/", "div.job_seen_beacon", {"title": "h2", "company": "[data-testid=company-name]", "location": "[data-testid=text-location]", "salary": ".salary-snippet"}),
    "startupjobs": Site(r"/nabidka/\d+|/ad/"),
}


def site_cards(page: str | None, source: str, sites: dict[str, Site] = SITES) -> list[dict[str, str]]:
    """Cards of a listing page of a source: url and fields, each address once;
    several values of a field are joined by "; "."""
    site = sites.get(source)
    if site is None:
        return []
    root, out, seen = tree(page), [], set()
    if site.card:
        for card in select(root, site.card):
            links = [a.attrs["href"] for a in select(card, "a") if re.search(site.link, a.attrs.get("href", ""))]
            row = {"url": links[0] if links else ""} | {k: "; ".join(dict.fromkeys(t for t in (x.text() for x in select(card, q)) if t)) for k, q in site.fields.items()}
            out.append(row)
    else:
        out = _anchor_cards(root, site.link)
    return [c for c in out if (key := c["url"] or tuple(c.items())) not in seen and not seen.add(key)]


def _anchor_cards(root: Node, link: str) -> list[dict[str, str]]:
    """Cards around job links of a page without marks: the widest element that
    holds no other job's link; its heading or link is the title, the next text
    the company."""
    anchors = [a for a in select(root, "a") if re.search(link, a.attrs.get("href", ""))]
    at = lambda n: {a.attrs["href"].split("?")[0] for a in select(n, "a") if re.search(link, a.attrs.get("href", ""))}
    out = []
    for a in anchors:
        card = a
        while card.parent is not None and card.parent.tag and len(at(card.parent)) == 1:
            card = card.parent
        heads = [h for t in ("h1", "h2", "h3", "h4") for h in select(card, t)] or [a]
        title = heads[0].text() or a.attrs.get("title", "") or a.text()
        texts = [t for x in card.walk() for t in (" ".join(c.split()) for c in x.items if isinstance(c, str)) if t]
        after = texts[texts.index(title) + 1 :] if title in texts else texts
        out.append({"url": a.attrs["href"], "title": title, "company": next((t for t in after if t != title), "")})
    return out


def listing_rows(pages_df: DataFrame, ident: str, page: str, source: str) -> DataFrame:
    """(ident, position, url, title, company, location, salary, seniority) of every card of every page."""
    columns = ["url", "title", "company", "location", "salary", "seniority"]

    def run(batches):
        for pdf in batches:
            rows = [(i, k, *(c.get(n, "") for n in columns)) for i, p, s in zip(pdf["i"], pdf["p"], pdf["s"]) for k, c in enumerate(site_cards(p, s), 1)]
            yield pd.DataFrame(rows, columns=["i", "position", *columns])

    kind = pages_df.schema[ident].dataType.simpleString()
    inner = pages_df.select(F.col(f"`{ident}`").alias("i"), F.col(f"`{page}`").alias("p"), F.col(f"`{source}`").alias("s"))
    return inner.mapInPandas(run, f"i {kind}, position int, " + ", ".join(f"{c} string" for c in columns)).withColumnRenamed("i", ident)


def meaningful(text: str | None, letters: int = 30, words: int = 6) -> bool:
    """Whether a text is a description rather than a mark or a placeholder."""
    t = text or ""
    return sum(c.isalpha() for c in t) >= letters and len(re.findall(r"\w+", t)) >= words and not re.search(r"\{\{|lorem ipsum|\[object Object\]", t, re.I)


def localized(value, languages: tuple[str, ...] = ("en", "cs")) -> str | None:
    """A text that may be given by language: the first of the languages, else any."""
    if isinstance(value, dict):
        return next((str(value[k]) for k in (*languages, *value) if value.get(k)), None)
    return None if value is None else str(value)


def pay_text(low, high, currency=None, unit=None) -> str | None:
    """"low - high CUR UNIT" of what is known."""
    amount = " - ".join(dict.fromkeys(str(x) for x in (low, high) if x not in (None, "")))
    return " ".join(str(x) for x in (amount, currency, unit) if x) or None if amount else None


def find_offer(state) -> dict | None:
    """The object of a page's state that describes an offer: it has a title and
    a text; of several the one with the longest text."""
    best, size, stack = None, -1, [state]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if (x.get("title") or x.get("name")) and (texts := [t for k in ("description", "content", "body", "text") if (t := localized(x.get(k)))]):
                if (n := max(map(len, texts))) > size:
                    best, size = x, n
            stack.extend(x.values())
        elif isinstance(x, list):
            stack.extend(x)
    return best


def offer_fields(offer: dict | None) -> dict[str, str | None]:
    """Flat fields of an offer; the description is its longest meaningful text."""
    if not offer:
        return dict.fromkeys(POSTING)
    plain = lambda t: " ".join(html.unescape(re.sub(r"<[^>]+>", " ", t)).split())
    texts = [plain(t) for k in ("description", "content", "body", "text", "requirements") if (t := localized(offer.get(k)))]
    company, pay = offer.get("company"), offer.get("salary") if isinstance(offer.get("salary"), dict) else {}
    places = offer.get("locations") or offer.get("location") or []
    places = [localized(p.get("name") if isinstance(p, dict) else p) for p in (places if isinstance(places, list) else [places])]
    return dict.fromkeys(POSTING) | {
        "title": localized(offer.get("title") or offer.get("name")), "company": localized(company.get("name") if isinstance(company, dict) else company), "url": _text(offer.get("url")), "date_posted": _text(offer.get("publishedAt")),
        "location": "; ".join(dict.fromkeys(p for p in places if p)) or None, "remote": "REMOTE" if offer.get("remote") is True else None, "salary_low": _text(pay.get("min")), "salary_high": _text(pay.get("max")),
        "currency": _text(pay.get("currency")), "salary_unit": _text(pay.get("unit")), "description": max((t for t in texts if meaningful(t)), key=len, default=None),
    }


#: labels of detail pages by source
LABELS = {
    "jobs": {"location": "Lokalita", "employment_type": "Typ úvazku"}, "jobstack": {"location": "Location", "employment_type": "Employment type"}, "indeed": {"employment_type": "Job type"},
    "builtin": {"location": "Location", "employment_type": "Job type"},
}


def section(page: str | None, heading: str, level: str = "h3") -> str | None:
    """Text between a heading and the next one of its level."""
    root, out, inside = tree(page), [], False
    for node in root.walk():
        if node.tag == level:
            if inside:
                break
            inside = node.text().casefold() == heading.casefold()
        elif inside and node.tag in ("p", "li", "div", "td") and not any(c.tag in ("p", "li", "div", "td", level) for c in node.walk() if c is not node):
            out.append(node.text())
    return "\n".join(t for t in out if t) or None


def column(page: str | None, header: str) -> list[str]:
    """Cells of the table column under a header."""
    for t in select(tree(page), "table"):
        heads = [h.text().casefold() for h in select(t, "th")]
        if header.casefold() in heads:
            k = heads.index(header.casefold())
            return [cells[k].text() for r in select(t, "tr") if len(cells := [c for c in r.items if isinstance(c, Node) and c.tag == "td"]) > k]
    return []


def html_title(page: str | None, company: str | None = None) -> str | None:
    """Title of a page without the site's tail and the company."""
    t = next((x.text() for x in select(tree(page), "title")), "")
    parts = [p for p in re.split(r"\s[|–·]\s", t) if p and p.casefold() != (company or "").casefold()]
    return parts[0] if parts else None


def detail_fields(page: str | None, source: str | None, url: str | None = None) -> dict[str, str | None]:
    """Fields of a detail page: what the page's own data says first, then its
    state, its labels and its title; a later source only fills what is missing."""
    steps = [find_posting(page, url), offer_fields(find_offer(page_state(page)))]
    steps.append({k: labelled(page, label) for k, label in LABELS.get(source or "", {}).items()})
    h1 = next((x.text() for x in select(tree(page), "h1")), None)
    steps.append({"title": h1 or html_title(page, steps[0]["company"]), "description": next((t for t in (section(page, h) for h in ("Description", "Náplň práce", "Popis")) if meaningful(t)), None)})
    out: dict[str, str | None] = dict.fromkeys(POSTING)
    for found in steps:
        for k, v in found.items():
            if not out.get(k) and v:
                out[k] = v
    return out


def parse_details(pages_df: DataFrame, ident: str, page: str, source: str, url: str) -> DataFrame:
    """(ident, posting fields) of every detail page, by its source."""

    def run(batches):
        for pdf in batches:
            out = pd.DataFrame([detail_fields(p, s, u) for p, s, u in zip(pdf["p"], pdf["s"], pdf["u"])], columns=list(POSTING))
            out.insert(0, "i", pdf["i"].to_numpy())
            yield out

    kind = pages_df.schema[ident].dataType.simpleString()
    inner = pages_df.select(F.col(f"`{ident}`").alias("i"), F.col(f"`{page}`").alias("p"), F.col(f"`{source}`").alias("s"), F.col(f"`{url}`").alias("u"))
    return inner.mapInPandas(run, f"i {kind}, " + ", ".join(f"{c} string" for c in POSTING)).withColumnRenamed("i", ident)


def final_status(status: Column, valid_through: Column, as_of: str, description: Column, enough: int = 500) -> tuple[Column, Column]:
    """(availability, completeness): by expiry or else the status; FULL with a
    description of at least ``enough`` characters."""
    return availability(valid_through, as_of, status), F.when(F.length(F.coalesce(description, F.lit(""))) >= enough, "FULL").otherwise("PARTIAL")
