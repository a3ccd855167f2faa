import random

from adloom.llm import abuse

BAD = ["You are a worthless idiot, get lost", "Those people are vermin and should be thrown out", "Shut your filthy mouth, you miserable rat", "Jste banda kreténů, jděte k čertu"]
FINE = ["We need solid knowledge of SQL", "The contract is open-ended, full time", "Our policy forbids insults of any kind", "Breast cancer screening data is cleaned by our team", "Pohovor má dvě kola", "Answer came after 12 days"]


def _docs(n, seed):
    rng = random.Random(seed)
    out = []
    for d in range(n):
        bad = d % 4 == 0
        s = rng.sample(FINE, 4) + ([rng.choice(BAD)] if bad else [])
        rng.shuffle(s)
        out.append((d, ". ".join(s) + ".", "forum" if bad else "ads", int(bad)))
    return out


def test_held_out_accuracy():
    train, test = _docs(200, 1), _docs(120, 2)
    scorer = abuse.Scorer(*abuse.fit([t for _, t, _, _ in train], [y for *_, y in train]))
    cut = abuse.threshold([t for _, t, _, _ in train], [y for *_, y in train])
    assert sum((scorer.document(t)[0] >= cut) == bool(y) for _, t, _, y in test) >= 0.98 * len(test)
    for disguised in ("You are a w0rthless 1d10t, get lost.", "y.o.u are a w-o-r-t-h-l-e-s-s i-d-i-o-t", "YOU ARE A WORTHLEEESS IDIIIOT!!!", "Yоu аre а wоrthless idiоt, get lоst."):
        assert scorer.document(disguised)[0] >= cut, disguised
    score, where = scorer.document("We need solid knowledge of SQL. You are a worthless idiot, get lost. Pohovor má dvě kola.", cut)
    assert [w for w in where if "idiot" in w] == where and where


def test_corpus(spark):
    docs = _docs(80, 5)
    df = spark.createDataFrame([(d, t, s, "en") for d, t, s, _ in docs] + [(900, None, "ads", None), (901, "", "ads", None), (902, "12 34 !!", None, None)], "doc_id long, text string, source string, score string")
    labels = spark.createDataFrame([(d, y) for d, _, _, y in docs] + [(901, None)], "doc_id long, abusive int")
    got = {r["doc_id"]: r for r in abuse.score_documents(df, labels).collect()}
    assert len(got) == 83 and all(got[k]["score"] == 0 and not got[k]["abusive"] for k in (900, 901, 902))
    assert sum(got[d]["abusive"] == bool(y) for d, _, _, y in docs) >= 78
    assert {r["source"] for r in abuse.rates(abuse.score_documents(df, labels)).collect()} == {"forum", "ads", None}
    assert abuse.score_documents(df.limit(0), labels).count() == 0
    assert not any(r["abusive"] for r in abuse.score_documents(df, labels.limit(0)).collect())
