"""Consistent forms, and labels that look like their words."""

from paperloom.llm.lookalike import Scripts, consistent, learn_scripts, same_looking_labels, visible

SAME = [("ｔｈｅ", "the"), ("thе", "the"), ("f​il­e", "file"), (" file　", "file"), ("ﬁle", "file"), ("Prüfliste", "Prüfliste"), ("dе́cl", "décl"), ("Ν°", "N°"), ("kwaliteitslĳst", "kwaliteitslijst"), ("пoрвaнный", "порванный"), ("a  b", "a b"), ("pdf‐", "pdf-")]
OTHER = [("After", "AFTER"), ("c0pied", "copied"), ("m²", "m2"), ("①", "1"), ("½", "1/2"), ("™", "TM"), ("rnodern", "modern"), ("ete", "été"), ("end.", "end"), ("l", "I")]


def model(spark):
    words = ["the", "file", "printed", "description", "порванный", "протокол", "σκισμένο", "χαρτί", "Prüfliste"] * 5
    return learn_scripts(spark.createDataFrame([(w,) for w in words], "value string"), "value")


def test_forms(spark):
    form = model(spark).form
    for a, b in SAME:
        assert form(a) == form(b), (a, b)
    for a, b in OTHER:
        assert form(a) != form(b), (a, b)
    assert form("рrоtосоl") == "protocol" and form("прoтoкoл") == "протокол" and form("χapτί".replace("ap", "αρ")) == "χαρτί"
    assert (form(None), form(""), form("​ "), form("é" * 3000)) == (None, "", "", "é" * 3000)
    assert form(form("Cкан")) == form("Cкан") and visible("a\tb") == "a b" and Scripts([]).form("abc") == "abc"


def test_labels(spark):
    w = spark.createDataFrame([(1, "thе", 5), (1, "thе", 5), (2, "the", 5), (3, None, 5), (4, "", 5), (5, "m²", 5), (None, "thе", 5)], "word_id long, value string, text int")
    t = spark.createDataFrame([(10, 1, "the", "x"), (10, 1, "the", "x"), (11, 2, "the", "x"), (12, 3, "a", "x"), (13, 4, "​", "x"), (14, 5, "m2", "x"), (15, 2, None, "x"), (16, 2, "ｔhe", "x"), (17, None, "the", "x"), (18, 99, "the", "x")], "label_id long, word_id long, text string, value string")
    assert sorted(same_looking_labels(w, t).collect()) == [(1, 10), (2, 16)]
    assert same_looking_labels(w.limit(0), t).collect() == [] and same_looking_labels(w, t.limit(0)).collect() == []
    out = consistent(w.select("word_id", "value"), {"value": "form"}, model(spark)).collect()
    assert len(out) == 7 and {r.form for r in out} == {"the", None, "", "m²"}


def test_scores_decide(spark):
    """A letter that looks nearly like another is read by its word: only the learnt scores can tell."""
    words = [(i, w) for i, w in enumerate(["cook", "cooks", "took", "hook", "сок", "кот", "окно", "рак", "cooк", "рак"] * 6)]
    w = spark.createDataFrame(words + [(500, "cooк"), (501, "сок")], "word_id long, value string")
    learned = learn_scripts(w, "value")
    assert learned.form("cooк") == "cook" != Scripts([]).form("cooк") and learned.form("сок") == "сок" and learned.form("рак") == "рак" != learned.form("pak")
    t = spark.createDataFrame([(1, 500, "cook"), (2, 501, "cok")], "label_id long, word_id long, text string")
    assert [tuple(r) for r in same_looking_labels(w, t).collect()] == [(500, 1)]
