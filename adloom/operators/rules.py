"""Rule engines compiled to Column expressions.

Rules are plain data; they are compiled once on the driver into one projection,
so a row is classified inside whole-stage code without joins or Python. Titles
are classified once per distinct spelling and joined back. All patterns run on
folded text (ASCII, single blanks) and avoid look-around, so that the same
rules also run as plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.text import normalise, title_key
from adloom.operators.evidence import bind
from adloom.operators.tables import distinct_spelling


@dataclass(frozen=True)
class Rule:
    label: str
    signal: str
    ground: int  # why it counts, as a place in ``GROUNDS``: lower beats higher
    pattern: str


#: grounds on which a word of a title names its occupation, strongest first, each
#: with the confidence of a title that rests on it
GROUNDS = (
    ("leads others", 0.98),  # whoever leads is no longer what they lead
    ("named trade", 0.96),  # a phrase whose words alone would mislead ("business developer")
    ("designs the whole", 0.95),  # an architect who also builds or analyses is an architect
    ("occupation", 0.92),  # a plain noun; of several the first in the title
    ("specialist", 0.88),  # a specialist of whatever else the title says
    ("standing", 0.85),  # trainees, clerks, officers, agents: what they do stands elsewhere
    ("function", 0.75),  # no person is named, only what is done
)
#: what a second occupation on the same ground takes off
RIVAL = 0.12
UNCLASSIFIED = 0.25


def masked(text: Column) -> Column:
    """A normalised title without phrases that name someone or something else."""
    for pattern, keep in MASKS:
        text = F.regexp_replace(text, pattern, keep)
    return text


def _matches(text: Column, rules: list[Rule]) -> Column:
    """Array of struct(rank, start, length, position, label, signal) of the
    rules that match, best first: ground, then earliest, then longest, then order."""
    out = []
    for k, r in enumerate(rules):
        hit = F.regexp_extract(text, r.pattern, 0)
        out.append(
            F.when(
                text.rlike(r.pattern),
                F.struct(
                    F.lit(r.ground).alias("rank"), F.position(hit, text).alias("start"),
                    (-F.length(hit)).alias("length"), F.lit(k).alias("position"), F.lit(r.label).alias("label"), F.lit(r.signal).alias("signal"),
                ),
            )
        )
    return F.array_sort(F.array_compact(F.array(*out)))


def confidence(ground: Column, rival: Column) -> Column:
    """Confidence of the winning ground; a rival on the same ground takes some off."""
    base = F.lit(UNCLASSIFIED)
    for k, (_, value) in enumerate(GROUNDS):
        base = F.when(ground == k, F.lit(value)).otherwise(base)
    return F.when(rival == ground, F.round(base - RIVAL, 2)).otherwise(base)


def classify(df: DataFrame, column: str, rules: list[Rule], overrides: dict[str, str] | None = None, fallback: str = "Other") -> DataFrame:
    """Adds root, confidence, method, signal and alternatives of a text column.

    Blank texts give the fallback with confidence 0; an exact override wins with
    confidence 1; no match gives the fallback with 0.25.
    """
    # bound by explode: the text and its matches are computed once
    once = df.select("*", F.explode(F.array(normalise(F.col(f"`{column}`")))).alias("_text")).select("*", F.explode(F.array(masked(F.col("_text")))).alias("_masked"))
    base = once.withColumn("_hits", _matches(F.col("_masked"), rules))
    top = F.get("_hits", F.lit(0))
    others = F.filter(F.col("_hits"), lambda h: h["label"] != top["label"])
    exact = F.lit(None).cast("string")
    for k, v in (overrides or {}).items():
        exact = F.when(F.col("_text") == k, F.lit(v)).otherwise(exact)
    base = base.withColumn("_exact", exact)
    second = F.get(others, F.lit(0))["rank"]
    blank = F.col("_text") == ""
    found = F.size("_hits") > 0
    pick = lambda b, e, h, n: F.when(blank, b).when(F.col("_exact").isNotNull(), e).when(found, h).otherwise(n)
    none = F.array().cast("array<string>")
    return base.select(
        *(F.col(f"`{c}`") for c in df.columns),
        pick(F.lit(fallback), F.col("_exact"), top["label"], F.lit(fallback)).alias("root"),
        pick(F.lit(0.0), F.lit(1.0), confidence(top["rank"], second), F.lit(UNCLASSIFIED)).alias("confidence"),
        pick(F.lit("blank"), F.lit("exact override"), F.lit("grounds"), F.lit("unclassified")).alias("method"),
        pick(F.lit(""), F.col("_text"), top["signal"], F.lit("")).alias("signal"),
        pick(none, none, F.array_distinct(F.transform(others, lambda h: h["label"])), none).alias("alternatives"),
    )


def first_match(text: Column, rules: list[tuple[str, str]], fallback: str) -> Column:
    """Label of the first rule that matches."""
    out = F.lit(fallback)
    for label, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def tags(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Labels of all rules that match, in rule order."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(v)) for v, p in rules)))


def _once(x: Column, f) -> Column:
    """f(x) with x bound once: keeps long rule lists out of generated code."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def subtype_candidates(text: Column, root: Column) -> Column:
    """Array of struct(order, start, label): the subtypes of a root that a
    normalised title names, in the root's order; a label counts once."""
    out = F.array().cast("array<struct<order:int,start:int,label:string>>")
    for name, pairs in SUBTYPES.items():
        hits = F.array(
            *(F.when(text.rlike(p), F.struct(F.lit(k).alias("order"), F.position(F.regexp_extract(text, p, 0), text).alias("start"), F.lit(label).alias("label"))) for k, (label, p) in enumerate(pairs))
        )
        out = F.when(root == name, F.array_compact(hits)).otherwise(out)
    return out


def subtype(text: Column, root: Column) -> Column:
    """The root's first subtype that a normalised title names, else its general one."""
    first = F.get(_once(text, lambda t: subtype_candidates(t, root)), F.lit(0))["label"]
    general = F.concat(F.lit("General "), root)
    for name, label in GENERAL.items():
        general = F.when(root == name, F.lit(label)).otherwise(general)
    return F.when(root == "Other", "Other").otherwise(F.coalesce(first, general))


def secondary(title: Column, root: Column) -> Column:
    """A second subtype: of two roles parted by a spaced slash that both name an
    occupation of the root, the first subtype of another part that differs from
    the title's own; '' otherwise. All parts are looked at."""
    parts = F.transform(F.split(title, r"\s/\s"), normalise)
    own = subtype(normalise(title), root)
    named = F.filter(parts, lambda p: _names_root(p, root))
    others = F.filter(F.transform(named, lambda p: F.get(subtype_candidates(p, root), F.lit(0))["label"]), lambda v: v.isNotNull() & (v != own))
    return F.when(F.size(named) > 1, F.coalesce(F.get(others, F.lit(0)), F.lit(""))).otherwise("")


def _names_root(text: Column, root: Column) -> Column:
    """Whether a part of a title names an occupation of the root."""
    hit = F.lit(False)
    for label in sorted({r.label for r in ROOTS}):
        hit = F.when(root == label, text.rlike("|".join(r.pattern for r in ROOTS if r.label == label and GROUNDS[r.ground][0] != "function"))).otherwise(hit)
    return hit


def classify_distinct(df: DataFrame, column: str, order: str, rules: list[Rule], **kw) -> DataFrame:
    """Classify each distinct spelling once and join the result back."""
    once = classify(distinct_spelling(df, column, order).select("key", "value"), "value", rules, **kw).drop("value")
    return df.withColumn("_key", title_key(F.col(f"`{column}`"))).join(once.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")


def any_word(*stems: str) -> str:
    """Pattern of words that begin with one of the stems."""
    return r"\b(?:" + "|".join(stems) + r")[a-z]*"


def word(*forms: str) -> str:
    """Pattern of whole words or phrases."""
    return r"(?:^| )(?:" + "|".join(forms) + r")(?: |$)"


def noun(*stems: str) -> str:
    """Pattern of nouns with their usual English and Czech endings."""
    return r"\b(?:" + "|".join(stems) + r")(?:s|a|e|i|y|u|em|um|ka|ky|ku|kou|ove|ova|uv)?\b"


LEADING = r"ceo|cfo|cto|cio|coo|cdo|ciso|cmo|vp|chief|head|director|manager|reditel[a-z]*|vedouci[a-z]*"
#: phrases that are taken out: a superior whom the title only names, a place to
#: grow into, an office, and words that only look like an occupation
MASKS = (
    (rf"\b(assistant|asistent[a-z]*|support|reporting) (?:to|for|pro)(?: [a-z0-9]+){{0,2}} (?:{LEADING})\b", r"$1"),
    (r"\b(?:grow into|vyrust v|path to|cesta k)(?: [a-z0-9]+)?", " "),
    (r"\boffice of(?: the)?(?: [a-z0-9]+)?", " "),
    (r"\b(?:ceo|cfo|cto|cio|coo|cdo|ciso|cmo|vp) office\b", " "),
    (r"\blead generation\b", " "),
    (r"\bdeveloper experience\b", " "),
    (r"\b(?:support|podpora) (engineer|inzenyr)", r"$1"),
)
_LEADS, _TRADE, _DESIGNS, _NOUN, _SPECIALIST, _STANDING, _FUNCTION = range(len(GROUNDS))
ROOTS = [
    Rule("Manager", "leads people or a unit", _LEADS, noun("[a-z]*manager", "[a-z]*manazer", "manazerk", "teamleader", "teamlead", "leader", "lead", "head", "director", "reditel", "reditelk", "chief", "vp", "vedouci", "owner")),
    Rule("Manager", "holds a top office", _LEADS, r"\b(?:ceo|cfo|cto|cio|coo|cdo|ciso|cmo)\b"),
    Rule("Sales Representative", "wins business", _TRADE, r"\bbusiness develop(?:er|ment)\b|\bsales (?:rep[a-z]*|entry point|executive|agent|consultant)\b|\baccount executive\b|\bobchodni(?:ho)? zastupc[a-z]+\b|\bobchodni zastupkyne\b"),
    Rule("Customer Service Representative", "serves customers by line or desk", _TRADE, r"\bcall cent[a-z]+\b|\bzakaznick[a-z]+ (?:centr|link|servis)[a-z]*\b|\bcustomer (?:service|care)\b|\bklientsk[a-z]+ (?:centr|link)[a-z]*\b"),
    Rule("Support Specialist", "helps users", _TRADE, r"\b(?:technical|customer|it|hr|hardware|application|client) (?:and )?support\b|\bhelp ?desk\b|\bservice ?desk\b|\b(?:klientsk|zakaznick|technick|uzivatelsk)[a-z]+ podpor[a-z]+\b"),
    Rule("Assistant", "keeps an office running", _TRADE, r"\bback office\b|\bpodpora (?:controlling|uctar|veden|kancelar)[a-z]*\b|\badministrativni podpora\b"),
    Rule("Tester", "analyses by testing", _TRADE, r"\btest(?:ovaci)? analy(?:st|tik)[a-z]*\b"),
    Rule("Analyst", "analyses systems or processes", _TRADE, r"\b(?:systemov|procesn)[a-z]+ (?:a [a-z]+ )?analyti[a-z]+\b"),
    Rule("Planner", "plans supply", _TRADE, r"\b(?:supply|demand)(?: [a-z]+){0,2} planner\b|\bplanovac[a-z]* vyroby\b"),
    Rule("Designer", "designs fashion", _TRADE, r"\b(?:fashion|modni) (?:developer|designer|navrhar)[a-z]*\b"),
    Rule("Specialist", "looks after applications", _TRADE, r"\baplikacni specialist"),
    Rule("Specialist", "practises law", _TRADE, noun("lawyer", "pravnik", "pravnick", "counsel")),
    Rule("Accountant", "keeps accounts", _TRADE, r"\bucetni\b|" + noun("accountant", "fakturant")),
    Rule("Architect", "designs systems", _DESIGNS, noun("architect", "architekt")),
    Rule("Controller", "controls costs", _NOUN, noun("controller", "kontroler") + r"|\bfinancni[a-z]* kontrolor"),
    Rule("Scientist", "does science", _NOUN, noun("scientist", "vedec", "vedk", "statistician", "statistik", "modeller")),
    Rule("Researcher", "does research", _NOUN, noun("researcher", "vyzkumnik", "vyzkumnic")),
    Rule("Auditor", "audits", _NOUN, noun("auditor")),
    Rule("Recruiter", "recruits", _NOUN, noun("recruiter", "naborar") + r"|\btalent acquisition\b"),
    Rule("Tester", "tests", _NOUN, noun("tester")),
    Rule("Designer", "designs", _NOUN, noun("designer", "navrhar")),
    Rule("Developer", "develops software", _NOUN, noun("developer", "vyvojar", "programmer", "programator")),
    Rule("Engineer", "engineers", _NOUN, noun("engineer", "inzenyr")),
    Rule("Analyst", "analyses", _NOUN, noun("analyst", "analytik", "analytick", "actuary", "aktuar", "matematik")),
    Rule("Administrator", "administers", _NOUN, noun("administrator", "spravce", "spravkyn")),
    Rule("Consultant", "advises", _NOUN, noun("consultant", "konzultant", "poradc", "advisor")),
    Rule("Sales Representative", "sells", _NOUN, noun("obchodnik", "obchodnic", "prodejc", "salesman", "seller")),
    Rule("Coordinator", "coordinates", _NOUN, noun("coordinator", "co ordinator", "koordinator", "allocator")),
    Rule("Technician", "does technical work", _NOUN, noun("technician", "technik", "inspector", "inspektor")),
    Rule("Planner", "plans", _NOUN, noun("planner", "planovac")),
    Rule("Assistant", "assists", _NOUN, noun("assistant", "asistent")),
    Rule("Teacher/Trainer", "teaches", _NOUN, noun("teacher", "trainer", "lektor", "ucitel", "skolitel") + r"|\bvyucujici\b"),
    Rule("Healthcare Professional", "heals", _NOUN, noun("nurse", "doctor", "sestr", "lekar", "lekarnik", "pharmacist", "optometrist")),
    Rule("Operator", "operates", _NOUN, noun("operator")),
    Rule("Driver", "drives", _NOUN, r"\b(?:driver|courier|kuryr|ridic|ridicka|ridice)\b"),
    Rule("Warehouse Worker", "works in a warehouse", _NOUN, noun("skladnik", "picker", "packer") + r"|\bwarehouse worker\b"),
    Rule("Production Worker", "works in production", _NOUN, noun("delnik", "montazni") + r"|\b(?:production|assembly) worker\b"),
    Rule("Specialist", "knows a field", _SPECIALIST, r"\bspecialist[a-z]*\b|" + noun("expert", "buyer", "nakupci", "metodik", "banker", "odhadc", "editor", "redaktor", "investigator", "curator")),
    Rule("Intern/Trainee", "learns", _STANDING, noun("intern", "trainee", "stazist") + r"|\binternship\b"),
    Rule("Agent", "acts for others", _STANDING, noun("agent")),
    Rule("Officer", "holds an office", _STANDING, noun("officer")),
    Rule("Clerk", "keeps records", _STANDING, noun("clerk")),
    Rule("Administrator", "handles files", _STANDING, noun("referent")),
    Rule("Administrator", "administration", _FUNCTION, r"\badministrati[a-z]+\b"),
    Rule("Specialist", "a partner or skilled worker", _FUNCTION, r"\bpartner\b|\bodborn[a-z]+ pracovni[a-z]+\b"),
    Rule("Sales Representative", "sales", _FUNCTION, r"\bsales\b|\bobchod\b"),
    Rule("Support Specialist", "support", _FUNCTION, r"\bsupport\b|\bpodpora\b"),
]
OVERRIDES = {"scrum master": "Manager", "data steward": "Specialist"}
TAXONOMY = sorted({r.label for r in ROOTS} | {"Other"})

#: what a title without a more particular subtype is called, where it isn't "General <root>"
GENERAL = {"Manager": "Executive/General Manager", "Developer": "General Software Developer", "Intern/Trainee": "General Internship/Traineeship"}
#: subtypes by root: (label, pattern of a normalised title), the more particular
#: first; a label may have a second, weaker pattern further down
SUBTYPES = {
    "Manager": [
        ("Construction/BIM Manager", r"\bbim\b"), ("R&D/Innovation Manager", r"\br and d\b|\bresearch|\binnovat|\binovac"), ("Marketing/Brand Manager", r"\bmarketing|\bbrand"),
        ("IT/Engineering Manager", r"\bbackend|\bfrontend|\bsoftware|\bsw\b|\btech lead|\bengineer\b|\bautomation|\bcontrol systems|\btypescript|\bnet\b|\bdevops"),
        ("Product Manager/Product Owner", r"\bproduct (?:owner|manager)|\bproduktov"), ("Project Manager", r"proje[ck]t"), ("Sales/Account Manager", r"\baccount|\bsales|\bobchod|\bbusiness development"),
        ("Data/AI Manager", r"\bdata|\bai\b|\banalytics"), ("Production/Quality Manager", r"\bqa\b|\bquality|\btest|\bproduction|\bvyrob|\bkvalit"), ("Finance/Risk Manager", r"\bfinanc|\bekonom|\brisk|\bucetn"),
        ("HR/People Manager", r"\bhr\b|\bpeople|\bpersonal|\btalent"), ("Supply Chain/Procurement Manager", r"\bsupply|\bprocure|\bnakup|\blogist|\bsklad"),
        ("Operations/Service Delivery Manager", r"\bservice delivery|\boperations|\bprovoz"), ("Customer Success/Experience Manager", r"\bcustomer|\bzakazn"), ("IT/Engineering Manager", r"\bit\b"),
    ],
    "Specialist": [
        ("Customer Service Specialist", r"\bzakazn|\bcustomer|\bklient"), ("IT/Systems Specialist", r"\bdevops|\bplm\b|\bprojectwise|\bcmdb|\baplikac"), ("Data Governance/Quality Specialist", r"\bmaster data|\bdata (?:governance|quality)|\bkvalit[a-z]* dat"),
        ("Cybersecurity Specialist", r"\bbezpecnost|\bsecurity|\bcyber"), ("Compliance/AML Specialist", r"\baml\b|\bcomplian"), ("Logistics/Supply Chain Specialist", r"\bfreight|\blogist|\bsupply"),
        ("Sales/Commercial Specialist", r"\bsales|\bobchod|\bcrm\b"), ("Risk/Business Continuity Specialist", r"\bkrizov|\bcontinuity|\brisk|\brizik"), ("Real Estate/Valuation Specialist", r"\bnemovit|\bodhad|\breal estate"),
        ("Data/Analytics Specialist", r"\bdat[ay]?\b|\banalyt"), ("HR/People Specialist", r"\bodmen|\bhr\b|\bpersonal|\bmzd|\bpayroll|\bnabor|\brecruit"), ("Marketing/Communications Specialist", r"\bmarket|\bkomunikac|\bcommunicat"),
        ("Finance/Banking Specialist", r"\bfinanc|\bbank|\buver|\baccounting"), ("Legal Specialist", r"\blegal|\bpravn|\blawyer|\bcounsel"), ("Insurance/Actuarial Specialist", r"\binsur|\bpojist|\bactuar"),
        ("Procurement Specialist", r"\bprocure|\bnakup|\bbuyer"), ("Quality/Regulatory Specialist", r"\bqualit|\bkvalit|\bregulat"), ("AI/Automation Specialist", r"\bai\b|\bautomat"), ("Product/Project Specialist", r"\bproduct|\bprodukt|\bproje[ck]t"),
        ("Manufacturing/Production Specialist", r"\bmanufact|\bproduction|\bvyrob"), ("Technical/Engineering Specialist", r"\btechni|\bengineer"), ("Operations Specialist", r"\boperation|\bprovoz"), ("Administrative Specialist", r"\badministr"), ("IT/Systems Specialist", r"\bit\b|\bsystem"),
    ],
    "Engineer": [
        ("Automotive/Safety Engineer", r"\bvoz[ui]|\bautomot|\bsafety"), ("Data Engineer", r"\bdata engineer|\bdatov"), ("AI/ML Engineer", r"\bmachine learning|\bml\b|\bai\b|\bstrojov[a-z]+ uceni"), ("DevOps/SRE Engineer", r"\bdevops|\bsre\b"), ("Security Engineer", r"\bsecurity|\bbezpecnost"),
        ("QA/Test Engineer", r"\btest|\bqa\b"), ("Network/Infrastructure Engineer", r"\bnetwork|\binfrastr|\bsitov"), ("Cloud/Platform Engineer", r"\bcloud|\bplatform"), ("Software Engineer", r"\bsoftware|\bsw\b|\bbackend|\bfrontend"),
        ("Automation/Control Engineer", r"\bautomat|\bcontrol"), ("Mechanical/Automotive Engineer", r"\bmechan|\bstroj"), ("Electrical/Electronics Engineer", r"\belectr|\belektr"), ("Process/Industrial Engineer", r"\bprocess|\bproces|\bindustr"),
    ],
    "Analyst": [
        ("Security/Fraud Analyst", r"\bsecurity|\bbezpecnost|\bfraud|\bpodvod"), ("Technical/R&D Analyst", r"\btechnick|\binovac|\bpatent|\br and d\b"), ("Data/BI Analyst", r"\bdata|\bdatov|\bbi\b|\bbusiness intelligence"), ("AI/ML Analyst", r"\bai\b|\bmachine learning"),
        ("IT/Systems Analyst", r"\bit\b|\bsystem"), ("Finance/Investment Analyst", r"\bm and a\b|\bfinanc|\binvest|\bmiddle office|\bpricing"), ("Risk/Credit Analyst", r"\brisk|\bcredit|\buver"), ("QA/Test Analyst", r"\btest|\bqa\b"), ("Product Analyst", r"\bproduct|\bprodukt"),
        ("Marketing/Customer Insights Analyst", r"\bmarket|\bcustomer|\bzakazn|\binsight"), ("HR/People Analyst", r"\bhr\b|\bpersonal"), ("Sales/Commercial Analyst", r"\bsales|\bobchod|\bcommerc"), ("Operations/Supply Chain Analyst", r"\boperation|\bsupply|\blogist"),
        ("Quantitative/Statistical Analyst", r"\bquant|\bstatist|\baktuar|\bactuar"), ("Economic/Policy Analyst", r"\beconom|\bekonom|\bpolicy"), ("Business/Process Analyst", r"\bbusiness|\bprocess|\bproces"),
    ],
    "Developer": [
        ("Full-Stack Developer", r"\bfull ?stack"), ("Backend Developer", r"\bbackend|\bserverov"), ("Frontend Developer", r"\bfrontend|\brozhrani|\breact|\bangular"), ("Mobile Developer", r"\bmobile|\bandroid|\bios\b"), ("Data/Database Developer", r"\bsql\b|\boracle|\bdatabas|\bdata\b"),
        ("Enterprise Applications Developer", r"\bsap\b|\babap|\bsalesforce|\berp\b"), ("Embedded/Systems Developer", r"\bembedded|\bvestaven"), ("Automation/Low-Code Developer", r"\bautomat|\blow code|\brpa\b"),
    ],
    "Consultant": [
        ("SAP/ERP Consultant", r"\bsap\b|\berp\b"), ("Security Consultant", r"\bsecurity|\bbezpecnost"), ("AI/Transformation Consultant", r"\bai\b|\btransformac|\btransformation"), ("Data/Analytics Consultant", r"\bdata|\banalytic|\bbi\b"), ("Finance/Transactions Consultant", r"\bdan|\bdph\b|\btax|\bfinanc|\btransaction"),
        ("Real Estate Consultant", r"\breal estate|\breality|\brealit"), ("Marketing/Sales Consultant", r"\bmarket|\bsales"), ("Customer Experience Consultant", r"\bcustomer|\bzakazn"), ("Business/Process Consultant", r"\bprocess|\bproces|\bbusiness"), ("Management/Strategy Consultant", r"\bmanagement|\bstrateg"), ("IT/Technology Consultant", r"\bit\b|\btechnolog|\bsoftware"),
    ],
    "Administrator": [
        ("HR/Finance Administrator", r"\bfinanc[a-z]+ a personal|\bhr and financ"), ("Database Administrator", r"\bdatabas"), ("Security/Identity Administrator", r"\bsecurity|\bidentity"), ("Cloud Administrator", r"\bcloud"), ("Network/Infrastructure Administrator", r"\bdata cent|\bnetwork|\binfrastr|\bsit[ei]\b|\bsitov"),
        ("Systems/Server Administrator", r"\bwindows|\blinux|\bserver|\bsystem"), ("HR/Payroll Administrator", r"\bpayroll|\bmzd|\bhr\b|\bpersonal"), ("Procurement Administrator", r"\bprocure|\bnakup"), ("Finance Administrator", r"\bfinanc|\bbilling|\bfakt"), ("Customer Service Administrator", r"\bcustomer|\bzakazn"),
        ("Production Administrator", r"\bproduction|\bvyrob"), ("Application Administrator", r"\bapplication|\baplikac"), ("IT Administrator", r"\bit\b"), ("Business/Office Administrator", r"\boffice|\bbusiness|\bkancelar"),
    ],
    "Sales Representative": [
        ("Business Development Representative", r"\bbusiness develop"), ("Sales Development Representative", r"\bsales development"), ("Account Executive", r"\baccount executive"), ("Presales/Solutions Sales Representative", r"\bpresales|\bsolution"), ("Inside Sales/Telesales Representative", r"\binside|\btelesales|\btelefon"),
        ("Partnership Representative", r"\bpartner"), ("Retail Sales Representative", r"\bretail|\bprodejn"), ("Field Sales Representative", r"\bfield|\bteren"),
    ],
    "Architect": [
        ("AI Architect", r"\bai\b"), ("Data Architect", r"\bdata"), ("Security Architect", r"\bsecurity"), ("Cloud/Infrastructure Architect", r"\bcloud|\binfrastr|\bnetwork|\bsitov"), ("Enterprise Architect", r"\benterprise"), ("Solution Architect", r"\bsolution"), ("Software/Application Architect", r"\bsoftware|\bapplication"), ("Systems/Integration Architect", r"\bsystem|\bintegrat"),
    ],
    "Support Specialist": [
        ("IT Helpdesk/Service Desk", r"\bhelp ?desk|\bservice ?desk"), ("HR/People Support", r"\bhr\b|\bpeople"), ("Infrastructure/Network Support", r"\bhardware|\bnetwork|\binfrastr"), ("Application/Software Support", r"\bapplication|\bsoftware|\baplikac"), ("Data/Analytics Support", r"\bdata|\banalyt"), ("Business/Sales Support", r"\bbusiness|\bsales|\bobchod"),
        ("Customer Support", r"\bcustomer|\bklient|\bzakazn"), ("Technical Support", r"\btechni"),
    ],
    "Controller": [("Financial Controller", r"\bfinanc"), ("Business/Commercial Controller", r"\bbusiness|\bcommerc"), ("Cost/Project Controller", r"\bcost|\bproje[ck]t|\bnaklad"), ("Operations Controller", r"\boperation|\bprovoz"), ("Group/Reporting Controller", r"\bgroup|\breporting"), ("Internal Control Specialist", r"\bintern")],
    "Customer Service Representative": [("Claims/Complaints Representative", r"\bclaim|\bcomplaint|\breklamac"), ("Contact Centre Representative", r"\bcall cent|\bcontact cent|\bcentr|\blink"), ("Customer Onboarding Representative", r"\bonboarding"), ("Customer Care Representative", r"\bcare\b|\bpece"), ("Customer Support Representative", r"\bsupport|\bpodpor"), ("Client Service Representative", r"\bclient|\bklient")],
    "Technician": [("Quality/Test Technician", r"\bqa\b|\bqualit|\bkvalit|\btest"), ("IT Technician", r"\bit\b|\bhelpdesk"), ("Installation Technician", r"\binstal|\bmontaz"), ("Service/Maintenance Technician", r"\bservis|\bservice|\bmainten|\budrzb"), ("Electrical/Electronics Technician", r"\belectr|\belektr"), ("Mechanical Technician", r"\bmechan"), ("Manufacturing/Process Technician", r"\bmanufact|\bproces|\bvyrob"), ("Engineering/Development Technician", r"\bdevelop|\bvyvoj|\bengineer")],
    "Accountant": [("Payroll Accountant", r"\bpayroll|\bmzd"), ("Accounts Payable Accountant", r"\bpayable|\bzavazk"), ("Accounts Receivable/Billing Accountant", r"\breceivable|\bbilling|\bfakt"), ("Tax Accountant", r"\btax|\bdan"), ("Revenue/Intercompany Accountant", r"\brevenue|\bintercompany"), ("Chief/General Ledger Accountant", r"\bchief|\bhlavni|\bgeneral ledger"), ("Financial Accountant", r"\bfinanc")],
    "Coordinator": [("Sales/Marketing Coordinator", r"\bsales|\bmarketing"), ("Project/Program Coordinator", r"\bproje[ck]t|\bprogram"), ("IT/Incident Coordinator", r"\bit\b|\bincident"), ("HR/People Coordinator", r"\bhr\b|\bpersonal"), ("Logistics/Supply Chain Coordinator", r"\blogist|\bsupply|\bpurchas|\bnakup"), ("Operations/Service Coordinator", r"\bfieldwork|\bprovoz|\boperation|\bservice"), ("Finance/Administrative Coordinator", r"\bfinanc|\badministr")],
    "Assistant": [("Executive/Personal Assistant", r"\bexecutive|\bpersonal"), ("Administrative/Back-Office Assistant", r"\bback office|\badministr"), ("Finance/Accounting Assistant", r"\bfinanc|\baccount|\bcontrolling|\bucetn"), ("Sales/Business Assistant", r"\bsales|\bbusiness|\bobchod"), ("Project/Team Assistant", r"\bproje[ck]t|\bteam"), ("Office/Reception Assistant", r"\boffice|\brecep")],
    "Tester": [("Automation Tester", r"\bautomat"), ("Security/Penetration Tester", r"\bsecurity|\bpenetra"), ("Integration/API Tester", r"\bintegr|\bapi\b"), ("Automotive/Embedded Tester", r"\bautomot|\bembedded"), ("Mobile/Web Tester", r"\bmobil|\bweb"), ("Manual Software Tester", r"\bmanual"), ("General Software Tester", r"\bsoftware"), ("Functional/QA Tester", r"\bqa\b|\bfunction|\btest anal")],
    "Designer": [("Fashion/Product Designer", r"\bfashion|\bmodni"), ("UX/UI/Product Designer", r"\bux\b|\bui\b|\bproduct|\bdiscovery|\buser experience"), ("Graphic/Visual Designer", r"\bgraphic|\bgrafi|\bvisual"), ("Brand/Communication Designer", r"\bbrand|\bcommunicat"), ("Mechanical/Technical Designer", r"\bmechan|\btechni"), ("Service/CX Designer", r"\bservice|\bcx\b")],
    "Planner": [("Demand/Supply Planner", r"\bdemand|\bsupply"), ("Production Planner", r"\bproduction|\bvyrob"), ("Logistics/Transport Planner", r"\blogist|\btransport"), ("Financial Planner", r"\bfinanc"), ("Media Planner", r"\bmedia"), ("Project/Capacity Planner", r"\bproje[ck]t|\bcapacit")],
    "Recruiter": [("IT/Technical Recruiter", r"\bit\b|\btechni"), ("Executive Search Recruiter", r"\bexecutive"), ("Talent Acquisition Specialist", r"\btalent")],
    "Scientist": [("Data Scientist", r"\bdata"), ("AI/ML Scientist", r"\bai\b|\bml\b|\bmachine learning"), ("Statistical/Quantitative Scientist", r"\bstatist|\bquant|\bmodel"), ("Domain Scientist", r"\bscientist|\bvedec")],
    "Auditor": [("IT Auditor", r"\bit\b|\bsecurity|\bbezpecnost"), ("Financial Auditor", r"\bfinanc"), ("Internal Auditor", r"\bintern"), ("Compliance/Quality Auditor", r"\bcomplian|\bqualit|\bkvalit")],
    "Officer": [("Compliance/AML Officer", r"\bcomplian|\baml\b"), ("Risk/Finance Officer", r"\brisk|\bfinanc"), ("Legal/Privacy Officer", r"\blegal|\bprivacy|\bdata protection"), ("Operations Officer", r"\boperation")],
    "Intern/Trainee": [("Compliance/Risk Internship", r"\bcomplian|\brisk"), ("Data/Analytics Internship", r"\bdata|\banalyt"), ("Engineering/IT Internship", r"\bit\b|\bengineer|\bsoftware"), ("Finance Internship", r"\bfinanc"), ("HR Internship", r"\bhr\b"), ("Marketing/Sales Internship", r"\bmarket|\bsales")],
    "Teacher/Trainer": [("Academic Teacher", r"\bvs\b|\bvyucuj|\bucitel|\bteacher"), ("Sales Trainer", r"\bsales|\bobchod"), ("Technical Trainer", r"\btechni|\bit\b"), ("Corporate/Professional Trainer", r"\blektor|\btrainer|\bskolitel")],
    "Clerk": [("Master Data Clerk", r"\bmaster data"), ("Finance/Billing Clerk", r"\bfinanc|\bbilling"), ("Administrative Clerk", r"\badministr")],
    "Operator": [("IT/Data-Centre Operator", r"\bit\b|\bdata cent"), ("Logistics/Dispatch Operator", r"\blogist|\bdispatch|\bdispec"), ("Production Operator", r"\bproduction|\bvyrob")],
    "Researcher": [("Market/User Researcher", r"\bmarket|\buser|\bsurvey|\bdotaznik"), ("Academic/Scientific Researcher", r"\bacadem|\bscien|\bvedec"), ("Applied Researcher", r"\bapplied|\baplikovan")],
    "Agent": [("Customer Service Agent", r"\bcustomer|\bzakazn"), ("Sales/Marketing Agent", r"\bsales|\bmarket|\bobchod"), ("Operations Agent", r"\boperation")],
    "Healthcare Professional": [("Pharmacy/Optometry Professional", r"\bpharm|\blekarn|\boptom"), ("Medical/Clinical Professional", r"\bnurse|\bdoctor|\bsestr|\blekar|\bclinic")],
    "Driver": [("Delivery/Courier Driver", r"\bdeliver|\bcourier|\bkuryr|\brozvoz"), ("Commercial Driver", r"\bcommerc|\bkamion|\bnakladni")],
    "Warehouse Worker": [("Warehouse Picker/Packer", r"\bpick|\bpack"), ("Warehouse Handler", r"\bhandl|\bskladnik|\bwarehouse")],
    "Production Worker": [("Assembly Worker", r"\bassembl|\bmontaz"), ("Machine/Production Worker", r"\bmachine|\bproduction|\bstroj")],
}

# Labels of domains, tools and levels of tags.
DOMAINS = [
    ("Data & Analytics", word("data", "analyst", "analytik", "bi", "analytics", "datovy", "statistician", "statistik")), ("AI & Machine Learning", word("ai", "ml", "machine learning", "deep learning", "strojoveho uceni")),
    ("Cybersecurity", any_word("security", "bezpecnost", "cyber")), ("Cloud & Infrastructure", any_word("cloud", "infrastruct", "network", "devops", "sitov")), ("IT & Software", any_word("software", "developer", "vyvojar", "programmer", "programator", "backend", "frontend")),
    ("Finance & Banking", any_word("financ", "bank", "account", "ucetn", "controller", "kontrolor")), ("Insurance", any_word("insur", "pojist", "actuar")), ("Compliance & Risk", any_word("risk", "complian", "audit", "fraud")), ("Business Continuity & Resilience", any_word("continuity", "resilien", "krizov")),
    ("Sales & Business Development", word("sales", "obchod", "business development")), ("Marketing & Communications", any_word("marketing", "brand", "communicat")), ("HR & Recruitment", any_word("recruit", "nabor", "talent", "payroll", "mzdov")),
    ("Customer Service", any_word("customer", "zakazn", "helpdesk")), ("Product Management", any_word("product", "produkt")), ("Project & Program Management", any_word("project", "projekt", "program ")),
    ("Supply Chain & Logistics", any_word("logist", "supply", "sklad", "warehouse")), ("Procurement", any_word("procur", "nakup", "buyer")), ("Manufacturing & Production", any_word("manufactur", "production", "vyrob")),
    ("Engineering & R&D", any_word("engineer", "inzenyr", "research", "vyzkum")), ("Quality & Safety", any_word("quality", "kvalit", "qa", "tester")), ("Automotive & Mobility", any_word("automot", "automobil")),
    ("Energy & Utilities", any_word("energ")), ("Healthcare & Pharma", any_word("clinical", "klinick", "health", "pharm", "laborator")), ("Legal", any_word("legal", "pravn")), ("Real Estate & Construction", any_word("construct", "staveb", "real estate")),
    ("Retail & E-commerce", any_word("retail", "shop", "maloobchod")), ("Education & Research", any_word("educat", "vzdelav", "survey", "dotaznik")), ("Telecommunications", any_word("telec", "telek")), ("Media & Entertainment", any_word("media", "editor", "redaktor")),
]
#: tools are named by themselves, in lower case
TOOLS = (
    "Python SQL PostgreSQL Oracle MySQL Java Kotlin Scala JavaScript TypeScript React Angular PHP C# C++ Rust Ruby ABAP SAP SAS Salesforce Tableau Looker Excel Azure AWS GCP"
    " Docker Kubernetes Terraform Linux Snowflake Databricks Spark dbt Kafka Selenium Playwright ServiceNow BIM PLM 3DEXPERIENCE ProjectWise CMDB Airflow Git R Go"
).split() + ["MS SQL Server", "Power BI", "Node.js", ".NET"]
#: names that are also letters or words: as written, and only as an item of a list
#: or where the words around them speak of programming
CASED = {
    "R": r"(?:^|[,;|/(•]\s*)R(?:\s*[,;|/)•]|$)|\b(?:Python|SQL|SAS|Julia)(?: and/or | or | and |/)R\b|\bR(?: and/or | or | and |/)(?:Python|SQL|SAS|Julia)\b"
    r"|\b(?:using|with|in|programming in|language) R(?:[ ,.;)]|$)|\bR programming\b|\bRStudio\b|\bdata\.table\b",
    "Go": r"(?:^|[,;|/(•]\s*)Go(?:\s*[,;|/)•]|$)|\bGolang\b|\b(?:using|with|in|language|know|of) Go(?:[ ,.;)]|$)|\bGo (?:developer|programmer|programming)\b",
}
#: what may stand before and after a name
BEFORE, AFTER = r"(?:^|[^a-z0-9+#.])", r"(?:$|[^a-z0-9+#])"
#: what a text that names the tool holds, if it isn't the name
PARTS = {"R": ("R", "data.table")}
LEVELS = [
    ("Intern/Trainee", any_word("intern", "trainee", "stazist")), ("Junior/Entry-level", word("junior", "jr", "juniorni", "entry level", "absolvent")), ("Medior/Mid-level", word("medior", "mid", "mid level", "mediorni")),
    ("Senior", word("senior", "sr", "seniorni")), ("Lead/Head", word("lead", "head", "vedouci")), ("Executive", word("chief", "director", "ceo", "cto", "cfo", "reditel")),
]


def tools(text: Column) -> Column:
    """Tools that a raw text names, in order."""
    low = F.lower(text)
    # one pass for all names: no two of them begin at one place, as none is followed by the end of a word in another
    plain = "|".join(tool_name(t) for t in TOOLS if t not in CASED)
    said = F.regexp_extract_all(low, F.lit(f"{BEFORE}(?=({plain}){AFTER})"), F.lit(1))

    def named(said: Column) -> Column:
        # most texts hold not even a part of the cased names, and bytes are found faster than patterns
        cased = lambda t: reduce(or_, (text.contains(p) for p in PARTS.get(t, (t,)))) & text.rlike(tool_pattern(t))
        return F.array_compact(F.array(*(F.when(cased(t) if t in CASED else F.array_contains(said, t.lower()), F.lit(t)) for t in TOOLS)))

    return bind(said, named)


def tool_name(name: str) -> str:
    import re

    return re.escape(name.lower()).replace(r"\ ", " ")


def tool_pattern(name: str) -> str:
    """The tool's name as a whole word of a text in lower case; for ``CASED``
    names of the text as written."""
    return CASED.get(name) or BEFORE + tool_name(name) + AFTER


def taxonomy_faults(roots: list[Rule] | None = None, taxonomy: list[str] | None = None, subtypes: dict | None = None) -> list[str]:
    """What is wrong with the rules themselves: roots outside the taxonomy, unknown
    grounds, rules that stand twice, patterns that don't compile, roots without subtypes."""
    import re

    roots, known = ROOTS if roots is None else roots, set(TAXONOMY if taxonomy is None else taxonomy)
    subtypes = SUBTYPES if subtypes is None else subtypes
    out = [f"root {r.label!r} is not in the taxonomy" for r in roots if r.label not in known]
    out += [f"{r.signal!r} has no ground" for r in roots if not 0 <= r.ground < len(GROUNDS)]
    keys = [(r.label, r.ground, r.pattern) for r in roots]
    out += [f"rule {k} stands twice" for k in sorted(set(keys)) if keys.count(k) > 1]
    for where, pattern in [(r.signal, r.pattern) for r in roots] + [(v, p) for pairs in subtypes.values() for v, p in pairs]:
        try:
            re.compile(pattern)
        except re.error as e:
            out.append(f"{where!r}: {e}")
    return out + [f"{k!r} has no subtypes" for k in sorted(known - {"Other"} - set(subtypes))]


def check_roots(df: DataFrame, title: str, root: str, line: str) -> None:
    """Raise with title and line if a classified table bears a root outside the taxonomy."""
    bad = df.where(~F.col(f"`{root}`").isin(*TAXONOMY) & (F.trim(F.col(f"`{title}`")) != "")).select(f"`{line}`", f"`{root}`").orderBy(f"`{line}`").limit(5).collect()
    if bad:
        raise ValueError("unknown roots: " + ", ".join(f"{r[1]!r} in line {r[0]}" for r in bad))


def as_relation(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    """Rules as a table (position, label, signal, ground, pattern), to be kept and versioned."""
    rows = [(k, r.label, r.signal, GROUNDS[r.ground][0], r.pattern) for k, r in enumerate(ROOTS if rules is None else rules)]
    return spark.createDataFrame(rows, "position int, label string, signal string, ground string, pattern string")


def from_relation(df: DataFrame) -> list[Rule]:
    """Rules of a table, whose size and contents are checked before they are compiled."""
    places = {name: k for k, (name, _) in enumerate(GROUNDS)}
    rows = df.orderBy("position").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10000 rules")
    out = [Rule(r["label"], r["signal"], places.get(r["ground"], -1), r["pattern"]) for r in rows]
    faults = taxonomy_faults(out, sorted({r.label for r in out}), {r.label: [] for r in out})
    if faults:
        raise ValueError("; ".join(faults))
    return out
