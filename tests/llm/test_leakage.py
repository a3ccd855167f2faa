import random

from adloom.llm import leakage

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string, item_id string"


def _words(rng, n):
    return ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(n)]


def _corpus():
    rng = random.Random(3)
    filler = _words(rng, 40)
    items = [(i, "Answer the question in one sentence. " + " ".join(_words(rng, 50))) for i in range(12)]
    docs = [(d, " ".join(rng.choice(filler) for _ in range(80)), "c") for d in range(60)]
    ws = [t.split() for _, t in items]
    docs += [
        (100, items[0][1], "c"), (101, "x y z " + " ".join(ws[1][20:50]).upper() + " tail", "c"), (102, "> " + " \n> ".join(ws[2][6:40]), "c"),
        (103, "Answer the question in one sentence.", "c"), (104, " ".join(ws[3][:10]), "c"), (105, " ".join(w if k % 5 else f"{w} filler" for k, w in enumerate(ws[4])), "c"),
        (106, None, "c"), (107, "", "c"), (108, items[0][1], "c"), (109, " ".join(reversed(ws[5])), "c"), (110, " ".join(f for f in filler) * 400 + " " + items[6][1], "c"),
    ]
    return items, docs


def test_finds_what_brute_force_finds(spark):
    items, docs = _corpus()
    got = {tuple(r) for r in leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    its = leakage.Items(items)
    want = {(d, i) for d, t, _ in docs if t for i in its.words if its.check(i, its.numbers(t))}
    assert {(100, 0), (101, 1), (102, 2), (105, 4), (108, 0), (110, 6)} <= want and not any(d in (103, 104, 106, 107, 109) for d, _ in want)
    assert len(got & want) >= 0.9 * len(want) and got <= want


def test_copied_leak_is_found(spark):
    items, docs = _corpus()
    ws = items[0][1].split()
    docs = docs[:60] + [(200 + k, items[0][1], "c") for k in range(60)] + [(300, "head " + " ".join(ws[:30]), "c"), (301, docs[0][1] + " " + " ".join(ws[20:]), "c")]
    got = {tuple(r) for r in leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    its = leakage.Items(items)
    want = {(d, i) for d, t, _ in docs if t for i in its.words if its.check(i, its.numbers(t))}
    assert {(k, 0) for k in (*range(200, 260), 300, 301)} <= want and got == want


def test_empty(spark):
    items, docs = _corpus()
    assert leakage.find_leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    assert leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = [[rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2)]
        assert leakage.common(a, b) == plain(a, b)


def test_index_loses_nothing_that_the_check_takes():
    items, docs = _corpus()
    its = leakage.Items(items + [(90, "in one sentence"), (91, "in one sentence the question"), (92, "one sentence the question")])
    assert its.bare
    for _, t, _ in docs:
        ws = its.numbers(t or "")
        assert {i for i in its.words if ws and its.check(i, ws)} <= set(its.possible(set(ws)))


def test_length_alone_makes_no_case(spark):
    items, docs = _corpus()
    rng = random.Random(9)
    every = [w for _, t in items for w in t.split()]
    long = " ".join(rng.choice(every) for _ in range(40_000))
    its = leakage.Items(items)
    assert any(its.check(i, its.numbers(long)) for i in its.words)  # as a whole it has them all
    df = spark.createDataFrame([(1, long, "c"), (2, long[:100_000] + " " + items[3][1] + " " + long[100_000:], "c"), *docs[:20]], DOCS)
    assert {tuple(r) for r in leakage.find_leaks(df, spark.createDataFrame(items, ITEMS)).collect()} == {(2, 3)}
