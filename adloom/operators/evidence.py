"""Evidence extractors: a category and the text that shows it.

Each extractor is a cascade over the listed fields and returns
struct(value, evidence); everything stays in JVM expressions. Fields come as
``Field``: a name, the cleaned text and the folded one, computed once per row
(see ``with_fields``). Patterns run on folded text and avoid look-around, so
that they mean the same in any regex dialect.

Defined results: null and blank fields say nothing; a text of any length is
read whole; mentions of a skill within ``NEAR`` characters share their context.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.text import clean, field_evidence, fold, join_unique, snippet, strip_accents

#: characters around a mention that may say how much it is wanted
NEAR = 110

# Words of the extractors.
CZECH = r"(?:czech|cestin[a-z]*|cesk(?:y|eho|em) jazyk[a-z]*)"
WELCOME = r"bonus|nice to have|a plus|advantage|vyhodou|vitan|von vorteil"
WAIVED = rf"{CZECH}[^.!?]{{0,80}}(?:not (?:required|needed|necessary|mandatory)|isn.?t required|neni (?:podminkou|nutn[a-z]+|treba))|not (?:required|mandatory)[^.!?]{{0,80}}{CZECH}"
CZECH_WELCOME = rf"{CZECH}[^.!?]{{0,80}}(?:{WELCOME})"
CZECH_REQUIRED = rf"(?:fluent|native) czech|{CZECH}[^.!?]{{0,50}}(?:required|mandatory|needed|podminkou|nutn[a-z]+|pozadov)|(?:required|mandatory)[^.!?]{{0,50}}{CZECH}|znalost (?:cestiny|ceskeho jazyka)"
SPOKEN = r"(?:language|speak|fluent|communicative|knowledge|uroven|mluvi|jazyk)"
CZECH_SPOKEN = rf"{CZECH}[^.!?]{{0,55}}{SPOKEN}|{SPOKEN}[^.!?]{{0,55}}{CZECH}"
ENGLISH_LISTED = r"(?:^|[^a-z])(?:en|english|anglicky|anglictina)(?:$|[^a-z])"
ENGLISH_WANTED = r"fluent english|english[^.!?]{0,60}(?:required|mandatory|proficien|working|communicative|advanced|intermediate|daily)|(?:required|mandatory|proficien)[^.!?]{0,60}english|anglictin[a-z]*[^.!?]{0,60}(?:plynul|pokrocil|komunikativ|urovn|denne|nutn)|znalost anglictiny"
PREFERRED = r"nice to have|advantage|preferr|preferab|bonus|a plus|ideally|idealne|vyhodou|vitan|neni podmink|not (?:a )?requirement|not required|von vorteil|apprecie"
REQUIRED = r"must|requir|proficien|strong|solid|expect|experience with|knowledge of|need|znalost|zvlad|potreb|pozad|nutn|erforderlich|souhaitee|exige"
UNIT = r"(?:years?|yrs?|roky?|roku|let)"
RANGE = rf"(\d{{1,2}}) ?[-–—] ?(\d{{1,2}}) ?{UNIT} (?:of )?(?:experience|praxe|zkusenosti)"
MINIMA = (
    rf"(\d{{1,2}}) ?\+ ?{UNIT}", r"(\d{1,2}) ?(?:years?|yrs?) (?:of )?(?:relevant |professional |commercial |hands.on )?experience", r"(\d{1,2}) ?(?:roky?|roku|let) (?:praxe|zkusenosti)",
    r"(?:at least|minimum|minimum of|min\.?) ?(\d{1,2}) ?(?:years?|yrs?)[^.!?]{0,45}(?:experience|practice)", r"(?:alespon|minimalne|min\.?) ?(\d{1,2}) ?(?:roky?|roku|let)[^.!?]{0,45}(?:praxe|zkusenosti)",
)
MOST_YEARS = 15
LEVELS = (("JUNIOR", r"\b(?:junior|entry.?level|graduate|trainee|absolvent)\b"), ("MID", r"\b(?:medior|mid.?level|intermediate)\b"), ("SENIOR", r"\b(?:senior|lead|principal|staff)\b"))
STATUSES = ("OPEN", "LIKELY_OPEN", "CLOSED", "LIKELY_CLOSED", "UNKNOWN", "REQUEST_FAILED", "HTTP_ERROR")
#: skills by name: aliases as parts of folded text
SKILLS = {
    "python": "python", "sql": r"sql|postgresql|mysql|sql server|oracle sql|t.sql|pl.sql", "ml": "machine learning|scikit.learn|sklearn|xgboost|tensorflow|pytorch|predictive model[a-z]*",
    "statistics": r"statistics|statistical|statistician|statistik[a-z]*|probability|inference|regression|time series|hypothesis testing|econometrics",
}
#: what a text must hold for a pattern to match; looked for first, as that is far cheaper.
#: Parts of words that begin with a rare letter, as each place of the first letter is compared
CZECH_SAYS, ENGLISH_SAYS, R_SAYS = ("czech", "cestin", "cesk"), ("glish", "glictin"), ("R", "data.table")
SKILL_SAYS = {
    "python": ("python",), "sql": ("ql",), "ml": ("machine learning", "kit", "klearn", "xgboost", "flow", "pytorch", "predictive model"),
    "statistics": ("statisti", "probability", "ference", "gression", "me series", "hypothesis testing", "conometrics"),
}
#: in every match of ``RANGE`` and of ``MINIMA``
YEARS_SAY = rf"\d ?\+? ?{UNIT}"
CHALLENGE = r"captcha|verify (?:that )?you are (?:a )?human|unusual traffic|are you a robot|access denied|checking your browser"
NO_RESULTS = r"no (?:matching )?(?:results|jobs|vacancies) (?:were )?found|nenalezen[aoy]? zadn[aey]|zadne (?:nabidky|vysledky)|we found no"
CLOSED = r"(?:position|vacancy|job|offer|advert) (?:is )?(?:no longer|not) (?:available|active|open)|(?:has been|is) (?:filled|closed)|closing notice|(?:pozice|nabidka|inzerat) (?:jiz |uz )?(?:neni aktivni|byla obsazena|byl ukoncen)"
APPLY = r"apply (?:now|here|for this|control found)|send (?:us )?(?:your )?cv|odpovedet na (?:nabidku|inzerat)|prihlasit se"


@dataclass(frozen=True)
class Field:
    name: str
    raw: Column
    folded: Column
    #: whether evidence is asked for; else it is blank and costs nothing
    shown: bool = True


#: white space that is not one blank, in any text and in ASCII
WIDE, WIDE_ASCII = r"[\s\p{Z}&&[^ ]][\s\p{Z}]*| [\s\p{Z}]+", r"[\t-\r]\s*| \s+"


def spellings(x: Column) -> Column:
    """struct(raw, folded): ``clean`` and ``fold`` of a text, with each step done once
    and accents looked for only where a character is not ASCII."""

    ascii = lambda t: F.octet_length(t) == F.length(t)
    tidy = lambda t: F.trim(F.when(ascii(t), F.regexp_replace(t, WIDE_ASCII, " ")).otherwise(F.regexp_replace(t, WIDE, " ")))

    def both(t: Column) -> Column:
        raw = F.when((F.octet_length(t) == 3) & (F.lower(t) == "nan"), F.lit("")).otherwise(t)
        folded = F.when(ascii(t), F.lower(raw)).otherwise(F.replace(strip_accents(F.lower(raw)), F.lit("ß"), F.lit("ss")))
        return F.struct(raw.alias("raw"), folded.alias("folded"))

    return bind(bind(F.coalesce(x, F.lit("")), tidy), both)


def with_fields(df: DataFrame, names: list[str], shown: bool = True) -> tuple[DataFrame, dict[str, Field]]:
    """The table with each field cleaned and folded once, and the fields."""
    one = F.struct(*(spellings(F.col(f"`{n}`")).alias(f"f{k}") for k, n in enumerate(names)))
    out = df.select("*", F.explode(F.array(one)).alias("_fields"))
    return out, {n: Field(n, F.col(f"_fields.f{k}.raw"), F.col(f"_fields.f{k}.folded"), shown) for k, n in enumerate(names)}


def found(value: Column, evidence: Column) -> Column:
    return F.struct(value.alias("value"), evidence.alias("evidence"))


def bind(x: Column, f) -> Column:
    """f(x) with x evaluated once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def says(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds one of the words anywhere; always true without words."""
    return reduce(or_, (text.contains(w) for w in words)) if words else F.lit(True)


def hit(field: Field, pattern: str, value: str) -> Column:
    """struct(value, "Field: snippet") if the field matches, else null."""
    if not field.shown:
        return F.when(field.folded.rlike(pattern), none(value))
    first = F.regexp_extract(field.folded, pattern, 0)
    shown = F.concat(F.lit(f"{field.name}: "), snippet(field.raw, F.position(first, field.folded), F.length(first)))
    return F.when(field.folded.rlike(pattern), found(F.lit(value), shown))


def first_hit(fields: list[Field], pattern: str, value: str, words: tuple[str, ...] = ()) -> Column:
    """The first field that matches, else null; ``words``: one of them is in every match."""
    return F.coalesce(*(F.when(says(f.folded, words), hit(f, pattern, value)) for f in fields))


def regex_evidence(field: Field, pattern: str, most: int = 3) -> Column:
    """Up to ``most`` matches of a pattern as snippets."""
    hits = F.slice(F.array_distinct(F.regexp_extract_all(field.folded, F.lit(pattern), F.lit(0))), 1, most)
    return join_unique(F.transform(hits, lambda h: F.concat(F.lit(f"{field.name}: "), snippet(field.raw, F.position(h, field.folded), F.length(h)))), " | ")


def whole(field: Field) -> Column:
    return field_evidence(field.name, field.raw) if field.shown else F.lit("")


def none(value: str) -> Column:
    return found(F.lit(value), F.lit(""))


def czech_requirement(languages: Field, requirements: Field, description: Field) -> Column:
    """NOT_REQUIRED or PREFERRED where a field says so, in order of the fields;
    else REQUIRED by prose, REQUIRED by the listed languages, MENTIONED where
    the wording is about language, NOT_MENTIONED."""
    soft = [F.when(says(f.folded, CZECH_SAYS), F.coalesce(hit(f, CZECH_WELCOME, "PREFERRED"), hit(f, WAIVED, "NOT_REQUIRED"))) for f in (languages, requirements, description)]
    prose = [requirements, description]
    listed = F.when(languages.folded.rlike(rf"(?:^|[^a-z])(?:cs|{CZECH}|cesky)(?:$|[^a-z])"), found(F.lit("REQUIRED"), whole(languages)))
    return F.coalesce(*soft, first_hit(prose, CZECH_REQUIRED, "REQUIRED", CZECH_SAYS), listed, first_hit(prose, CZECH_SPOKEN, "MENTIONED", CZECH_SAYS), none("NOT_MENTIONED"))


def english_acceptable(languages: Field, requirements: Field, description: Field, page_language: Field, enough: int = 180) -> Column:
    """YES by the listed languages or the prose, LIKELY for a long English page, else UNKNOWN."""
    listed = F.when(languages.folded.rlike(ENGLISH_LISTED), found(F.lit("YES"), whole(languages)))
    likely = F.when(page_language.folded.startswith("en") & (F.length(description.raw) >= enough), found(F.lit("LIKELY"), whole(page_language)))
    return F.coalesce(listed, first_hit([requirements, description], ENGLISH_WANTED, "YES", ENGLISH_SAYS), likely, none("UNKNOWN"))


def _numbers(text: Column, pattern: str, group: int = 1) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda n: n.try_cast("int"))


def minimum_years(structured: Field, *prose: Field) -> Column:
    """Largest minimum of years asked for; a range counts with its lower end and
    hides the numbers inside it; numbers beyond ``MOST_YEARS`` are no experience."""

    def of(text: Column) -> Column:
        return F.when(text.rlike(YEARS_SAY), named(text)).otherwise(F.array().cast("array<int>"))

    def named(text: Column) -> Column:
        spans = F.arrays_zip(_numbers(text, RANGE, 1).alias("lo"), _numbers(text, RANGE, 2).alias("hi"))
        lows = F.transform(F.filter(spans, lambda s: (s["lo"] <= s["hi"]) & (s["hi"] <= MOST_YEARS)), lambda s: s["lo"])
        rest = F.regexp_replace(text, RANGE, " ")
        return F.concat(lows, *(_numbers(rest, p) for p in MINIMA))

    years = F.concat(_numbers(structured.folded, rf"(\d{{1,2}}) ?{UNIT}"), *(of(f.folded) for f in prose))
    most = F.array_max(F.filter(years, lambda n: (n > 0) & (n <= MOST_YEARS)))
    return F.when(reduce(or_, (f.folded.rlike(YEARS_SAY) for f in (structured, *prose))), most)


def seniority(fields: list[Field]) -> Column:
    """Levels named in any of the fields as one of eight values."""
    # no level is read across the line end between two fields
    levels = lambda t: F.struct(*(t.rlike(p).alias(v) for v, p in LEVELS))

    def of(named: Column) -> Column:
        j, m, s = (named[v] for v, _ in LEVELS)
        return (
            F.when(j & m & s, "MIXED").when(j & m, "JUNIOR_MID").when(m & s, "MID_SENIOR").when(j & s, "JUNIOR_SENIOR")
            .when(j, "JUNIOR").when(m, "MID").when(s, "SENIOR").otherwise("UNKNOWN")
        )

    value = bind(bind(F.concat_ws("\n", *(f.folded for f in fields)), levels), of)
    shown = F.array(*(F.when(f.folded.rlike("|".join(p for _, p in LEVELS)), whole(f)).otherwise("") if f.shown else F.lit("") for f in fields))
    return found(value, join_unique(shown, " | "))


#: a mark before each mention; other characters stand for it in a text
MARK, NO_MARK = "\x01", "\x02"


def _windows(text: Column, pattern: str, later: str | None = None, words: tuple[str, ...] = ()) -> Column:
    """What the pattern with up to ``NEAR`` characters on both sides extracts: from
    the first mention left, the last one begun within ``NEAR`` characters, and so on.

    The mentions' places are looked up in one pass and the windows cut by number, as
    a pattern with such a prefix is tried ``NEAR`` times at every character.
    ``later`` is the pattern where a mention does not begin the text; one of ``words``
    is in every mention."""
    # a character is taken with each mark, so that the search goes on behind it, not inside of it
    marked = F.regexp_replace(F.when(text.contains(MARK), F.translate(text, MARK, NO_MARK)).otherwise(text), rf"(?={pattern})([\s\S])", f"{MARK}$1")
    # characters before each mention
    sizes = F.transform(F.split(marked, MARK), F.length)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    add = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"] + n)).alias("all"))
    sums = lambda sizes: F.aggregate(F.slice(sizes, 1, F.size(sizes) - 1), empty, add, lambda acc: acc["all"])
    places = bind(sizes, sums)

    def cut(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("end"), F.array().cast("array<string>").alias("out"))

        def window(acc: Column, first: Column) -> Column:
            begin = F.greatest(acc["end"], first - NEAR)
            last = F.array_max(F.filter(F.slice(places, acc["k"] + 1, NEAR + 1), lambda p: p <= begin + NEAR))
            said = F.when(last == 0, F.regexp_extract(text, f"^(?:{pattern})", 0)).otherwise(F.regexp_extract(F.substring(text, last + 1, F.length(text)), f"^(?:{later or pattern})", 0))
            end = F.least(last + F.length(said) + NEAR, F.length(text))
            beyond = first >= acc["end"]
            out = F.when(beyond, F.concat(acc["out"], F.array(F.substring(text, begin + 1, end - begin)))).otherwise(acc["out"])
            return F.struct((acc["k"] + 1).alias("k"), F.when(beyond, end).otherwise(acc["end"]).alias("end"), out.alias("out"))

        return F.aggregate(places, start, window, lambda acc: acc["out"])

    return F.when(says(text, words) if words else text.rlike(pattern), bind(places, cut)).otherwise(F.array().cast("array<string>"))


def _kind(window: Column) -> Column:
    """How much the folded words around a mention want it."""
    return F.when(window.rlike(PREFERRED), F.lit("soft")).when(window.rlike(REQUIRED), F.lit("hard")).otherwise(F.lit(""))


def word(pattern: str) -> str:
    """A pattern as a whole word of folded text."""
    return rf"(?:^|[^a-z0-9_])(?:{pattern})(?:$|[^a-z0-9_])"


def skill_signal(pattern: str, skills: Field, prose: list[Field], words: tuple[str, ...] = ()) -> Column:
    """REQUIRED, PREFERRED, MENTIONED or NOT_MENTIONED of one skill; ``words``: one
    of them is in every mention.

    In prose a word for "welcome" beats one for "wanted"; if all prose says
    "welcome", it beats the list. A listed skill is required if it is marked so
    or stands left of a bar, preferred right of it."""
    p = word(pattern)
    left, bar = F.substring_index(skills.folded, "|", 1), skills.folded.contains("|")
    right = F.when(bar, F.regexp_replace(skills.folded, r"^[^|]*\|", "")).otherwise("")
    listed = says(skills.folded, words)

    def weigh(ws: Column, kinds: Column) -> Column:
        soft, hard = F.array_contains(kinds, "soft"), F.array_contains(kinds, "hard")
        value = (
            F.when(soft & ~hard, "PREFERRED")
            .when(listed & (skills.folded.rlike(rf"{p[: -len('(?:$|[^a-z0-9_])')]} ?\[required\]") | left.rlike(p)), "REQUIRED").when(listed & right.rlike(p), "PREFERRED")
            .when(hard, "REQUIRED").when(soft, "PREFERRED").when(F.size(ws) > 0, "MENTIONED").otherwise("NOT_MENTIONED")
        )
        return found(value, F.coalesce(F.get(ws, F.lit(0)), F.when(skills.folded.rlike(p), whole(skills)), F.lit("")) if skills.shown else F.lit(""))

    windows = F.flatten(F.array(*(_windows(f.folded, p, p.replace("^|", "", 1), words) for f in prose)))
    signal = bind(windows, lambda ws: bind(F.transform(ws, _kind), lambda kinds: weigh(ws, kinds)))
    # most pages do not name the skill at all
    return F.when(reduce(or_, (says(f.folded, words) for f in prose), listed), signal).otherwise(none("NOT_MENTIONED"))


#: R as an item of a list, and where the words around it speak of programming
R_ITEM = r"(?:^|[;,]\s*)R(?:\s*[;,]|$)"
R_PROSE = r"\bPython ?(?:and/or|or|and|/) ?R\b|\bR ?(?:and/or|or|and|/) ?Python\b|\b(?:using|with|in|language) R(?:[ ,.;)]|$)|\bR programming\b|\bRStudio\b|\bdata\.table\b"


def r_signal(skills: Field, prose: list[Field]) -> Column:
    """The language R, told from the letter by case and context; the strongest
    of several mentions counts."""
    left, bar = F.substring_index(skills.raw, "|", 1), skills.raw.contains("|")
    right = F.when(bar, F.regexp_replace(skills.raw, r"^[^|]*\|", "")).otherwise("")
    listed = skills.raw.contains("R")

    def weigh(ws: Column, kinds: Column) -> Column:
        soft, hard = F.array_contains(kinds, "soft"), F.array_contains(kinds, "hard")
        value = (
            F.when(listed & (skills.raw.rlike(r"(?:^|[;|,]\s*)R\s*\[required\]") | F.trim(left).rlike(R_ITEM)), "REQUIRED").when(listed & F.trim(right).rlike(R_ITEM), "PREFERRED")
            .when(hard, "REQUIRED").when(soft, "PREFERRED").when(F.size(ws) > 0, "MENTIONED").otherwise("NOT_MENTIONED")
        )
        return found(value, F.coalesce(F.get(ws, F.lit(0)), F.lit("")))

    windows = F.flatten(F.array(*(_windows(f.raw, R_PROSE) for f in prose)))
    signal = bind(windows, lambda ws: bind(F.transform(ws, lambda w: bind(fold(w), _kind)), lambda kinds: weigh(ws, kinds)))
    return F.when(reduce(or_, (says(f.raw, R_SAYS) & f.raw.rlike(R_PROSE) for f in prose), listed), signal).otherwise(none("NOT_MENTIONED"))


REMOTE, HYBRID, ONSITE = r"\bremote\b", r"\bhybrid\b", r"\bon.?site\b"
FULLY, PARTLY, OFFICE = r"\b(?:fully|full|100 ?%) remote\b", r"\bhybrid\b|\bhome office\b|\bwork from home\b|\bpraci? z domova\b", r"\bon.?site\b|\boffice.based\b"

FULLY_SAYS, PARTLY_SAYS, OFFICE_SAYS = ("mote",), ("ybrid", "home", "domova"), ("site", "ffice")


def work_mode(mode: Field, prose: list[Field]) -> Column:
    """HYBRID, FLEXIBLE, REMOTE, ONSITE or UNKNOWN; the field beats the text, and
    in a text only a full remote job is one."""
    m = mode.folded
    by_field = (
        F.when(m.rlike(HYBRID), found(F.lit("HYBRID"), whole(mode))).when(m.rlike(REMOTE) & m.rlike(ONSITE), found(F.lit("FLEXIBLE"), whole(mode)))
        .when(m.rlike(REMOTE), found(F.lit("REMOTE"), whole(mode))).when(m.rlike(ONSITE), found(F.lit("ONSITE"), whole(mode)))
    )
    by_text = [F.when(says(f.folded, words), hit(f, p, v)) for f in prose for p, v, words in ((FULLY, "REMOTE", FULLY_SAYS), (PARTLY, "HYBRID", PARTLY_SAYS), (OFFICE, "ONSITE", OFFICE_SAYS))]
    return F.coalesce(by_field, *by_text, none("UNKNOWN"))


def page_status(status: Field, http: Field, shown: Field | None = None) -> Column:
    """The status if it is an allowed one, else CLOSED for a gone page, else UNKNOWN;
    ``shown`` is a text that is evidence only."""
    s = F.upper(status.raw)
    evidence = join_unique(F.array(*(whole(x) for x in (status, shown) if x)), " | ") if status.shown else F.lit("")
    stated = F.when(s.isin(*STATUSES), found(s, evidence))
    return F.coalesce(stated, F.when(http.raw.isin("404", "410"), found(F.lit("CLOSED"), whole(http))), none("UNKNOWN"))


def publication(published: Column, upper_bound: Column, mined: Column | None = None) -> Column:
    """struct(value, evidence): the instant that an age is counted from, and
    whether it is exact, the least age, or only when the page was seen."""
    out = F.when(published.isNotNull(), found(published, F.lit("EXACT"))).when(upper_bound.isNotNull(), found(upper_bound, F.lit("MINIMUM_AGE")))
    if mined is not None:
        out = out.when(mined.isNotNull(), found(mined, F.lit("SEEN")))
    return out.otherwise(found(F.lit(None).cast("timestamp"), F.lit("UNKNOWN")))


def flags(pairs: list[tuple[Column, str]]) -> Column:
    """Names of the conditions that hold, joined by " | " in order."""
    return join_unique(F.array(*(F.when(c, F.lit(n)).otherwise("") for c, n in pairs)), " | ")


def conflicts(czech: Column, status: Column) -> Column:
    return flags([(czech == "REQUIRED", "CZECH_REQUIRED"), (status == "CLOSED", "CLOSED")])


def review_flags(extraction: Column, status: Column, years: Column, level: Column, czech: Column, english: Column) -> Column:
    """What a reviewer should look at, in a fixed order."""
    e = F.upper(clean(extraction))
    return flags([
        (e == "PARTIAL", "PARTIAL_EXTRACTION"), (e.isin("FAILED", "BLOCKED"), "EXTRACTION_UNAVAILABLE"), (status == "LIKELY_CLOSED", "LIKELY_CLOSED"),
        (status.isin("REQUEST_FAILED", "HTTP_ERROR"), "CURRENT_STATUS_UNCERTAIN"), (F.coalesce(years >= 3, F.lit(False)), "EXPERIENCE_3_PLUS"),
        (level.isin("SENIOR", "MID_SENIOR", "MIXED", "JUNIOR_SENIOR"), "SENIOR_LEVEL_PRESENT"), (czech.isin("PREFERRED", "MENTIONED"), "CZECH_SIGNAL_REVIEW"), (english == "UNKNOWN", "ENGLISH_UNCLEAR"),
    ])


def warnings(hard: Column, kinds: Column, review: Column, status: Column) -> Column:
    """Conflicts (or that there is one), flags and a bad status, each once."""
    split = lambda x: F.split(F.coalesce(x, F.lit("")), r"\s*[|;]\s*")
    named = F.when(F.upper(clean(hard)) == "YES", F.when(clean(kinds) != "", split(kinds)).otherwise(F.array(F.lit("HARD_CONFLICT")))).otherwise(F.array().cast("array<string>"))
    s = F.upper(clean(status))
    bad = F.when(s.isin("CLOSED", "LIKELY_CLOSED", "REQUEST_FAILED", "HTTP_ERROR"), F.array(s)).otherwise(F.array().cast("array<string>"))
    return join_unique(F.concat(named, split(review), bad), " | ")
