from adloom.llm import residue

SCHEMA = "row_id long, Description string, kind string"


def _run(spark, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    return sorted(r["row_id"] for r in residue.find_residue(df, ["Description"]).select("row_id", "field").collect())


BAD = [
    "{{company}}", "Dear #JOB_TITLE#, thank you", "status: <salary here>", "&lt;recruiter&gt;", "[doplňte city]", "Apply by %START_DATE% at the latest.", "403 Forbidden", "chyba serveru",
    "Please enable JavaScript", "You need to turn on JavaScript in your browser to run this app. © [32 ms]", "Traceback (mot recent call last): KeyError: 'description'",
    "Lorem ipsum quis sed tempor elit eiusmod amet magna sed eiusmod.", "test test test test test", "TODO", "- - -", "wkkqdeajkeqewke  shjdsf", "404 - Sorry, this page does not exist",
    "We measure returns per region. Pro zobrazení obsahu povolte ve svém prohlížeči JavaScript.", "<h1>Page not found</h1><p>&nbsp;</p>", "XX_CITY_XX", "[object Object]",
]
GOOD = [
    None, "", "  \n", "ok", "failed", "HTTP 404 for the advert address", "You analyse 404 and 500 errors in server logs.", "Front-end work where JavaScript is required and CSS is a friend.",
    "You know Jinja and can explain why {{ user.name }} must be escaped.", "Znalost šablon (např. zápis {{cena}}) výhodou.", "Salary [gross] and hours <40 a week, 100 % remote.",
    "You replace lorem ipsum by real copy before each launch.", "<p>We offer 4 days of leave.</p>", "The trial version of our app must run where scripts are disabled.", "We need SQL. " * 3000,
]


def test_cases(spark):
    assert _run(spark, BAD + GOOD) == list(range(len(BAD)))


def test_short_notices_with_slips(spark):
    # in each the rarest word has a slip; in the second no word is spelled right
    bad = ["Beschrebiung folgt.", "Acess deneid", "Page introuvabe."]
    usual = ["Access to the page is free. The text folgt here, page by page."] * 40
    assert _run(spark, bad + usual) == [0, 1, 2]


def test_slots_of_any_length_and_content(spark):
    long = "name of the company that offers the vacancy in this paragraph"
    bad = ["Join {{ company|default('') }} now.", f"Join {{{{ {long} }}}} now.", f"[insert {long}]", f"<{long} here>", "Hi ${user['name']}", "{% if a == \"b\" %}"]
    assert _run(spark, [*bad, "{{ }}", "<< >>", "{{ open", "a }} b", "{{" * 20000]) == list(range(len(bad)))


def test_repeats_and_empty(spark):
    assert _run(spark, ["TODO", "TODO"]) == [0, 1]
    assert _run(spark, []) == []


def test_windows_are_whole():
    assert "zz end" in residue.windows("We need SQL.\n" * 5000 + "zz end")


def test_text_beside_a_bar_is_kept(spark):
    advert = "We look for a data analyst who measures returns per region and likes long walks."
    assert _run(spark, [f"xxx | {advert}", "xxx | Home", f"{advert} | xxx", "Jobs | todo | Help"]) == [1, 3]


def test_phrasings_that_are_no_exemplar(spark):
    bad = [
        "Oops! That page can't be found.", "Sorry, but the page can't be found", "Bitte schalten Sie JavaScript im Browser ein", "Die Seite ist nicht erreichbar", "upstream connect error or reset before headers",
        "La página no ha sido encontrada: página no encontrada", "Nie znaleziono strony (404)", "Страница не найдена", "Prosím povolte skripty", "Activer JavaScript pour afficher l'offre",
    ]
    assert _run(spark, bad) == list(range(len(bad)))


def test_notice_across_sentences(spark):
    long = "Our team of nine people builds tools for planners who move goods by rail and by road across six countries"
    assert _run(spark, [f"{long}. Page not\nfound", f"{long}\nEnable JavaScript\nand cookies to continue\n{long}"]) == [0, 1]


def test_exemplars_can_be_given(spark):
    df = spark.createDataFrame([(1, "Friends, the kiosk sleeps until dawn."), (2, "We need SQL.")], "row_id long, f string")
    assert residue.find_residue(df, ["f"]).count() == 0
    assert [r["row_id"] for r in residue.find_residue(df, ["f"], exemplars=[("notice", "Kiosk sleeps until dawn")]).collect()] == [1]


def test_index_finds_what_all_exemplars_would():
    import random

    rng = random.Random(5)
    index = residue.Index({"page": 30, "the": 80, "server": 4}, 400)
    vocabulary = [w for w in index.weight if not w.startswith("§")] + ["data", "analyst", "plan"]
    for _ in range(600):
        ws = list(rng.choice(index.exemplars)[1]) if rng.random() < 0.5 else []
        ws = [w for w in ws if rng.random() < 0.9 and not w.startswith("§")] + [rng.choice(vocabulary) for _ in range(rng.randint(1, 6))]
        ws = [w[:2] + w[3:] if len(w) > 5 and rng.random() < 0.2 else w for w in ws]
        held = index.held(set(ws))
        every = {k for k, (kind, weight, total) in enumerate(index.exemplars) if sum(x * held.get(w, 0.0) for w, x in weight.items()) / total >= residue.COVERAGE}
        assert every <= {k for w in held for k in index.posting.get(w, ())}


def test_equal_coverage_clears_whatever_the_order_of_sums(spark):
    texts = ["You test what users see when access is denied or a session has expired."] * 40
    assert _run(spark, texts) == []
