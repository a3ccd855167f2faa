"""Template residue, filler, error pages and script notices in text fields.

Labelled exemplars (kinds of residue, and sentences that only speak of such
things) are words in an inverted index. Each field is cut into passage windows;
a window retrieves the exemplars that share a word with it, exactly or but for
slips, and is scored by TF-IDF containment: the share of an exemplar's weight
that the window holds (for filler: the share of the window's weight that the
exemplar holds), with words one or two slips apart counting a little less.
Document frequencies are counted over all sentences of all fields. The exemplar
with the highest coverage decides.

What has a shape rather than a wording is read as a word of its own: an
unfilled slot, a window of one repeated word, keys struck at random, marks
without letters, a field that holds nothing else but page frame. Exemplars are
made of such words too, so a slot or "xxx" is found by the index and cleared by
a sentence about it like any other text. More exemplars may be given.

Defined results: null and blank fields give no row; a field is named once
however many windows match; a window that is covered as well by a sentence
about such things is none; markup around a text is no residue; what stands
beside a bar is judged by itself, and a text beside filler keeps the field;
repeated rows give one row each; texts of any length are read whole.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import spread

#: least coverage at which an exemplar matches a window
COVERAGE = 0.72
#: least coverage by a sentence about such things that clears a window with a slot
TALK_COVERAGE = 0.55
#: least share of a window that filler covers
FILLER_COVERAGE = 0.8
#: words of either side in a window across the end of a sentence; no exemplar is longer
REACH = 14
#: kinds of residue that a sentence's end may cut in two
ACROSS = ("notice", "error", "unfilled")
#: words of a part that may be a page's frame ("Home | Jobs | Help")
FRAME = 4
#: words and windows whose judgement is kept in a worker's memory
MEMO = 200_000

# Labelled exemplars. -------------------------------------------------
SCRIPT_NOTICES = (
    "Please enable JavaScript", "Please enable JavaScript to view this page", "Enable JavaScript and cookies to continue",
    "You need to turn on JavaScript in your browser to run this app", "Update your browser or enable scripting to continue",
    "Some parts of the advert cannot be shown until scripts are allowed", "JavaScript is disabled in your browser", "if nothing happens, allow scripts and reload",
    "Loading the vacancy, if nothing happens, allow scripts and reload", "Your browser does not run scripts; the vacancy can't be loaded",
    "noscript: this site works only with scripting switched on", "This page requires JavaScript to work", "JavaScript must be enabled to see this content",
    "Povolte prosím skripty", "Pro zobrazení obsahu povolte ve svém prohlížeči JavaScript", "Tato stránka vyžaduje zapnuté skripty a cookies",
    "Bez JavaScriptu se inzerát nenačte", "Aby stránka fungovala, je nutné mít aktivní javascript", "Zapněte si JavaScript",
    "Bitte aktivieren Sie JavaScript, um die Anzeige zu sehen", "Zugang gesperrt - Skripte aktivieren", "Veuillez activer JavaScript pour afficher l'offre",
    "Bitte schalten Sie JavaScript in Ihrem Browser ein", "Bitte schalten Sie JavaScript ein", "JavaScript ist in Ihrem Browser deaktiviert", "JavaScript est désactivé dans votre navigateur",
    "Activa JavaScript en tu navegador para ver esta página", "Włącz JavaScript w przeglądarce, aby zobaczyć stronę", "Включите JavaScript в браузере для просмотра страницы",
)
ERROR_PAGES = (
    "Access denied", "403 Forbidden", "Internal Server Error", "500 Internal server error", "502 Bad Gateway", "504 Gateway time-out", "Gateway time-out",
    "503 Service temporarily unavailable", "Service temporarily unavailable", "404 Page not found", "Page not found", "404 Not Found", "410 This page is gone",
    "This page is gone", "429 Too many requests", "Too many requests", "404 Sorry, this page does not exist", "Sorry, this page does not exist",
    "Go back to the home page or use the search", "The server could not complete your request", "Something went wrong on our side",
    "We can't find the page you're after", "We're down for maintenance, back in a moment", "Your session has expired, sign in again to continue",
    "Please verify that you are human by ticking the box", "Checking your connection before you proceed", "Just a second, we are checking your browser",
    "Your request was blocked by the gateway", "Unusual traffic was detected from your network", "Error establishing a database connection",
    "Fatal error: Call to undefined function render_ad() in ad.php on line", "Warning: mysql_connect(): Too many connections",
    "Traceback (most recent call last): KeyError: 'description'", "java.lang.NullPointerException at AdView.show",
    "Chyba serveru", "Chyba 503: server dočasně neodpovídá", "Nastala neočekávaná chyba, opakujte akci", "Omlouváme se, něco se pokazilo",
    "Zkontrolujte adresu nebo se vraťte na úvod", "Na stránkách právě probíhá údržba, vraťte se za chvíli", "Váš požadavek byl zablokován ochranou webu",
    "Stránka nebyla nalezena", "Stránka nenalezena", "Přístup odepřen", "Zugriff verweigert, bitte später erneut versuchen", "Seite wurde nicht gefunden",
    "Interner Serverfehler", "Page introuvable. Retour à l'accueil", "Page introuvable", "Erreur interne du serveur", "Accès refusé",
    "Oops! That page can't be found", "The page can't be found", "Die Seite ist leider nicht erreichbar", "upstream connect error or disconnect/reset before headers", "This site can't be reached",
    "The service is temporarily unavailable, please try again later", "Service indisponible, veuillez réessayer plus tard", "Dienst vorübergehend nicht verfügbar",
    "Página no encontrada", "Error interno del servidor", "Acceso denegado", "Nie znaleziono strony", "Wewnętrzny błąd serwera", "Brak dostępu", "Страница не найдена",
    "Внутренняя ошибка сервера", "Доступ запрещён",
)
UNFILLED = (
    "This is a test vacancy, please do not apply", "Created by QA on staging", "Sample job description for preview only, replace before publishing",
    "Insert the duties of the position in this paragraph", "Sem přijde popis pozice", "Your text here", "Text goes here", "Reason goes here", "Text doplnit",
    "TODO: write the text", "Item of the demo data", "Beschreibung folgt", "[object Object]", "lorem ipsum status", "Lorem ipsum dolor sit amet", "Hier steht der Text",
    "Votre texte ici", "Texte à compléter", "Description to be added", "No description given", "Popis bude doplněn", "Žádný popis", "Text folgt in Kürze",
)
FILLER = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud",
    "test", "text", "popis", "bla", "xxx", "abc", "blindtext", "asdf", "qwerty", "foo bar baz",
)
#: values that are filler if they are all that a field holds
WHOLE = tuple("xxx xx todo tbd tba undefined nan lorem lorem-ipsum test text popis bla status_here asdf null none n/a".split())
#: words that stand for a shape
SLOT, SAME, STRUCK, EMPTY, ALONE = "§slot", "§same", "§struck", "§empty", "§alone"
#: exemplars made of shapes: a slot anywhere, one word over and over, struck keys, marks only
SHAPES = (("slot", (SLOT,)), ("filler", (SAME,)), ("filler", (STRUCK,)), ("filler", (ALONE, EMPTY)))
SENTENCES_ABOUT = (
    "You test what users see when access is denied or a session has expired", "You know Jinja and can explain why SLOT must be escaped",
    "You analyse 404 and 500 errors in server logs", "The trial version of our app must run where scripts are disabled",
    "Front-end work where JavaScript is required and CSS is a friend", "Šablony typu SLOT generujete ve vlastním nástroji, JavaScript nutný",
    "Write error pages that people understand", "You replace lorem ipsum by real copy before each launch", "Znalost šablon (např. zápis SLOT) výhodou",
    "HTTP 404 for the advert address", "HTTP 410 for the advert address", "HTTP 503 after two retries", "HTTP 200, body text complete",
    "redirected to the list of adverts", "form and contact block present", "expiry has passed", "closing notice read on the page",
    "expiry lies ahead", "apply control found in the page body", "no apply control found", "You maintain templates with placeholders such as SLOT",
)
#: names that slots bear; bare ones are slots only under weak marks
SLOT_NAMES = (
    "company company_name nazev_firmy firma job_title title position pozice first_name last_name name jmeno recruiter contact kontakt city mesto location"
    " start_date date datum salary plat mzda benefits benefity team_name team popis description status reason email phone telefon nastup"
).split()
# -------------------------------------------------------------------------------------

def _between(left: str, right: str, anything: str = r"[\s\S]") -> str:
    """Any content but blanks between two marks, of any length; a further left
    mark starts anew, so that unclosed ones cost no more than one pass."""
    return rf"{left}(?!\s*{right})(?:(?!{left}|{right}){anything})+{right}"


#: marks that prose and code also bear are closed on their line
_LINE = r"[^\n]"
STRONG_SLOT = re.compile(
    "|".join((
        _between(r"\{\{", r"\}\}"), _between(r"\{%", r"%\}"), _between("<%=?", "%>"), _between(r"\$\{", r"\}"),
        _between(r"\[\[", r"\]\]", _LINE), _between("<<", ">>", _LINE), _between("@@", "@@", _LINE),
    ))
    + r"|\$\$\$\w[\w.|\-]*"
    rf"|%\(\w+\)s|(?<!\w)__[A-Za-z]\w*?__(?!\w)|(?<!\w)XX_\w+?_XX(?!\w)|(?<![\w%])%[A-Za-z][A-Za-z_]+%(?!\w)"
    rf"|\[\s*(?:insert|doplňte|doplnte|doplnit|enter|add|einfügen|insérer)\s[^\[\]\n]+\]|<[^<>\n]+\shere>|(?<!\w)[A-Z]{{3,}}_HERE(?!\w)",
    re.I,
)
_NAMES = "|".join(sorted((n.replace("_", r"[_\s]+") for n in SLOT_NAMES), key=len, reverse=True))
WEAK_SLOT = re.compile(rf"[\[{{«<#]\s*(?:{_NAMES})(?:\|\w+)?\s*[\]}}»>#]", re.I)
TAG = re.compile(r"</?(?:h[1-6]|p|div|br|span|ul|ol|li|b|i|em|strong|a|html|head|body|title|table|tr|td|th|noscript|script|center|hr|section|article|main|header|footer|nav|meta|link|pre|code)(?:\s[^<>]*)?/?>", re.I)
MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff]")
END = re.compile(r"(?<=[.!?])\s+|\n+|\s\.{3}\s|[|×•·…]+")
WORD = re.compile(r"§\w+|[^\W_]+")
HOME_ROW = frozenset("asdfghjklqwe")


def fold(text: str) -> str:
    return (text if text.isascii() else MARKS.sub("", unicodedata.normalize("NFKD", text))).casefold()


#: marks the end of a sentence inside a window
JOINT = " \u241e "
SLOT_MARKS = re.compile(r"[{}\[<«$%@#]|__|XX_|_here", re.I)
SHORT_FORMS = re.compile(r"\b(?:např|napr|e\.g|i\.e|tzv|č)\.")


def plain(text: str) -> str:
    """A text whose slots are one word each and whose markup is gone."""
    t = html.unescape(text) if "&" in text else text
    if SLOT_MARKS.search(t):
        t = WEAK_SLOT.sub(f" {SLOT} ", STRONG_SLOT.sub(f" {SLOT} ", t))
        if "<" in t:
            t = TAG.sub("\n", t)
    return SHORT_FORMS.sub(" ", t)


def sentences(text: str) -> list[str]:
    return [p.strip() for p in END.split(plain(text)) if p and p.strip()]


def across(a: str, b: str) -> str:
    """What stands around the end of a sentence: as wide as any exemplar, so one
    that is cut in two is in it."""
    return f"{' '.join(a.split()[-REACH:])}{JOINT}{' '.join(b.split()[:REACH])}"


def windows(text: str) -> list[str]:
    """Passage windows: sentences, and what stands around the end of each."""
    parts = sentences(text)
    return parts + [across(a, b) for a, b in zip(parts, parts[1:])]


def words(window: str) -> list[str]:
    return WORD.findall(fold(window))


def slips(a: str, b: str, most: int) -> bool:
    """Whether two words are within ``most`` edits (neighbours may exchange)."""
    if abs(len(a) - len(b)) > most:
        return False
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = row[j - 1] if x == y else 1 + min(row[j - 1], row[j], new[j - 1])
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        before, row = row, new
        if min(row) > most:
            return False
    return row[-1] <= most


def exemplar_words(text: str) -> tuple[str, ...]:
    return tuple(words(text.replace("SLOT", SLOT)))


def default_exemplars() -> list[tuple[str, tuple[str, ...]]]:
    """(kind, words) of the labelled exemplars above."""
    named = (("notice", SCRIPT_NOTICES), ("error", ERROR_PAGES), ("unfilled", UNFILLED), ("filler", FILLER), ("about", SENTENCES_ABOUT))
    out = [(kind, exemplar_words(t)) for kind, texts in named for t in texts]
    return out + [("filler", (ALONE, *exemplar_words(t))) for t in WHOLE] + list(SHAPES)


def deletions(word: str, most: int) -> set[str]:
    """A word and what is left of it after up to ``most`` deletions: words that
    are so many slips apart share one."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


class Index:
    """Inverted index of the exemplars with TF-IDF weights.

    An exemplar is listed under its heaviest words only, so many that a window
    without any of them cannot reach the coverage asked for: common words
    retrieve nothing, and nothing is missed."""

    def __init__(self, df: dict[str, int], total: int, exemplars: list[tuple[str, tuple[str, ...]]] | None = None):
        self.total, self.df = max(total, 1), df
        self.usual = math.log(1 + self.total)  # of a word of no exemplar
        self.exemplars: list[tuple[str, dict[str, float], float]] = []
        self.posting: dict[str, list[int]] = defaultdict(list)
        self.memo: dict[str, list[tuple[str, float]]] = {}
        self.known: dict[str, tuple[str | None, bool]] = {}
        self.weight = {w: self.idf(w) for _, ws in exemplars or default_exemplars() for w in ws}
        for kind, ws in exemplars or default_exemplars():
            weight = {w: self.weight[w] for w in ws}
            mass = sum(weight.values())
            least = {"filler": 0.0 if ALONE not in weight else COVERAGE, "about": TALK_COVERAGE}.get(kind, COVERAGE) * mass
            left = mass
            for w in sorted(weight, key=lambda w: (-weight[w], w)):
                if left < least - 1e-6:
                    break
                self.posting[w].append(len(self.exemplars))
                left -= weight[w]
            self.exemplars.append((kind, weight, mass))
        # exemplar words by what is left of them after as many deletions as they may have slips
        self.left: dict[str, list[str]] = defaultdict(list)
        self.short: dict[str, list[str]] = defaultdict(list)
        for w in self.weight:
            if w.startswith("§") or len(w) < 3:
                continue
            if len(w) == 3:
                if not w.isdigit():
                    self.short["".join(sorted(w))].append(w)
                continue
            for rest in deletions(w, 1 if len(w) < 8 else 2):
                self.left[rest].append(w)

    def idf(self, word: str) -> float:
        if word.isdigit():
            return 0.5
        return math.log(1 + self.total / (1 + self.df.get(word, 0)))

    def near(self, h: str) -> list[tuple[str, float]]:
        """Exemplar words that a window's word is a slip of, and how much each counts."""
        if (known := self.memo.get(h)) is None:
            known, n = [], len(h)
            if n == 3:
                known = [(w, 0.8) for w in self.short.get("".join(sorted(h)), ()) if w != h]
            if n > 2 and not h.startswith("§"):
                left = self.left
                for w in sorted({w for rest in deletions(h, 2 if n > 5 else 1) if rest in left for w in left[rest]}):
                    if w != h and h[0] in (w[0], w[1]) and slips(w, h, 1 if len(w) < 8 else 2):
                        known.append((w, 0.9))
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[h] = known
        return known

    def judge(self, window: str, alone: bool = False) -> str | None:
        """Kind of residue that a window is, or None; ``alone`` says that the
        field holds nothing else but frame."""
        return self._judge(window, True)[0] if alone else self.retrieve(window)[0]

    def retrieve(self, window: str) -> tuple[str | None, bool]:
        """(kind, whether an exemplar was retrieved that may go on in the next sentence)."""
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            found = self.known[window] = self._judge(window, False)
        return found

    def held(self, have: set[str]) -> dict[str, float]:
        """Exemplar words that a window holds, and how much each counts."""
        out = {w: 1.0 for w in have if w in self.weight}
        memo = self.memo
        for h in have:
            for w, part in memo[h] if h in memo else self.near(h):
                if part > out.get(w, 0.0):
                    out[w] = part
        return out

    def _judge(self, window: str, alone: bool) -> tuple[str | None, bool]:
        ws = words(window)
        held = self.held(set(ws) | shapes(window, ws, alone))
        best: tuple[float, str] = (0.0, "")
        about, slot = 0.0, False
        listed = {k for w in held for k in self.posting.get(w, ())}
        for k in listed:
            kind, weight, total = self.exemplars[k]
            if alone and ALONE not in weight:
                continue  # a field as a whole is judged by its windows else
            # sums differ in their last digits
            share = min(1.0, sum(x * held[w] for w, x in weight.items() if w in held) / total + 1e-9)
            if kind == "about":
                about = max(about, share)
            elif kind == "slot":
                slot = True
            elif ALONE in weight:
                # a field's only word counts as a whole
                if share >= 1 - 0.1 * (len(max(weight, key=len)) > 6) and len(ws) <= len(weight):
                    best = max(best, (1.0, kind))
            elif kind == "filler" and not next(iter(weight)).startswith("§"):
                if len(ws) >= 3:
                    mass = sum(0.5 if w.isdigit() else self.weight.get(w, self.usual) for w in ws)
                    share = sum(weight[w] for w in ws if w in weight) / mass
                    if share >= FILLER_COVERAGE:
                        best = max(best, (share, kind))
            elif share >= COVERAGE and (JOINT not in window or self.close(ws, weight, total)):
                best = max(best, (share, kind))
        # a slot is all of its exemplar's weight, so less of a sentence about slots clears it
        if slot and about < TALK_COVERAGE:
            return "slot", True
        return best[1] if best[0] and about < max(best[0], COVERAGE) else None, any(self.exemplars[k][0] in ACROSS for k in listed)

    def close(self, ws: list[str], weight: dict[str, float], total: float) -> bool:
        """Whether the exemplar's words stand together: within half as many words again."""
        part = [max((weight[w] * x for w, x in ((h, 1.0), *self.near(h)) if w in weight), default=0.0) for h in ws]
        names = [next((w for w in (h, *(n for n, _ in self.near(h))) if w in weight), "") for h in ws]
        span = len(weight) + (len(weight) + 1) // 2
        for i in range(max(1, len(ws) - span + 1)):
            best: dict[str, float] = {}
            for w, x in zip(names[i : i + span], part[i : i + span]):
                if w:
                    best[w] = max(best.get(w, 0.0), x)
            if sum(best.values()) >= COVERAGE * total - 1e-9:
                return True
        return False


def shapes(window: str, ws: list[str], alone: bool) -> set[str]:
    """Words that stand for the shape of a window."""
    out = {ALONE} if alone else set()
    if not ws:
        t = window.strip()
        return out | {EMPTY} if t and re.fullmatch(r"[-–—._\s]+", t) and re.search(r"[-–—._]", t) else out
    top, n = Counter(ws).most_common(1)[0]
    if len(ws) >= 4 and n >= 0.75 * len(ws) and top.isalpha():
        out.add(SAME)
    if alone and len(ws) == 1 and re.fullmatch(r"(.)\1{2,}", top) and top.isalpha():
        out.add(SAME)
    if mashed(ws):
        out.add(STRUCK)
    return out


def mashed(ws: list[str]) -> bool:
    """Keys struck at random: only home-row letters, hard to pronounce."""
    longest = max(ws, key=len)
    if not set(longest) <= HOME_ROW:
        return False
    struck = [w for w in ws if set(w) <= HOME_ROW]
    if len("".join(struck)) < 8 or len("".join(struck)) < 0.7 * len("".join(ws)) or not set(longest) <= HOME_ROW:
        return False
    return any(re.search(r"[^ae]{4}", w) for w in struck) or (len(longest) >= 8 and bool(re.search(r"[^ae]{3}", longest)))


NOISE = re.compile(r"\[\d+\s*ms\]|\([0-9a-f]{8}\)|[×©]")


def alone(text: str) -> list[str]:
    """The parts of a field of which each may be all that it says: parts between
    bars, if all are as short as a page's frame; a text beside them is more."""
    parts = [p.strip(" \n\t\r\xa0") for p in NOISE.sub(" ", TAG.sub(" ", html.unescape(text))).split("|")]
    parts = [p for p in parts if p]
    long_ = [p for p in parts if len(p.split()) > FRAME]
    return [] if long_ else parts


def judge_field(index: Index, text: str | None) -> str | None:
    if not text or not text.strip():
        return None
    for p in alone(text) if len(text) < 400 or "|" in text else ():
        if (kind := index.judge(p, True)) is not None:
            return kind
    parts = sentences(text)
    listed = []
    for p in parts:
        kind, some = index.retrieve(p)
        if kind is not None:
            return kind
        listed.append(some)
    for a, b, x, y in zip(parts, parts[1:], listed, listed[1:]):
        # an exemplar that both hold in part is retrieved by one of them
        if (x or y) and (kind := index.judge(across(a, b))) is not None:
            return kind
    return None


def _frequencies(cells: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """Document frequencies of the exemplars' words over all windows; what
    comes to the driver is bounded by the words of the exemplars."""

    def count(batches):
        known: dict[str, frozenset[str]] = {}
        seen: Counter = Counter()
        for pdf in batches:
            for t in pdf["text"]:
                for w in sentences(t):
                    hit = known.get(w)
                    if hit is None:
                        if len(known) >= MEMO:
                            known.clear()
                        hit = known[w] = vocabulary.intersection(words(w))
                    seen[""] += 1
                    seen.update(hit)
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    rows = cells.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r["word"]: r["n"] for r in rows}
    return df, df.pop("", 1)


_indexes: dict[tuple, Index] = {}


def shared_index(df: dict[str, int], total: int, exemplars: list[tuple[str, tuple[str, ...]]]) -> Index:
    """One index per worker process and corpus, so that tasks share what is kept."""
    key = (total, tuple(sorted(df.items())), tuple(exemplars))
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(df, total, exemplars)
    return _indexes[key]


def find_residue(df: DataFrame, fields: list[str], row_id: str = "row_id", exemplars: list[tuple[str, str]] = ()) -> DataFrame:
    """(row_id, field, kind) of each field that holds residue. ``exemplars`` are
    further (kind, text): notice, error, unfilled, filler or about."""
    each = F.array_compact(F.array(*(F.when(F.col(f"`{f}`").rlike(r"(?U)\S"), F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("text"))) for f in fields)))
    cells = spread(df.select(F.col(f"`{row_id}`").alias("row_id"), *(F.col(f"`{f}`") for f in fields)), "row_id").select("row_id", F.explode(each).alias("c")).select("row_id", "c.field", "c.text")
    known = default_exemplars() + [(kind, exemplar_words(t)) for kind, t in exemplars]
    frequencies, total = _frequencies(cells, frozenset(w for _, ws in known for w in ws))

    def judge(batches):
        index = shared_index(frequencies, total, known)
        for pdf in batches:
            out = pd.DataFrame({"row_id": pdf["row_id"], "field": pdf["field"], "kind": [judge_field(index, t) for t in pdf["text"]]})
            yield out[out["kind"].notna()]

    return cells.mapInPandas(judge, "row_id bigint, field string, kind string")
