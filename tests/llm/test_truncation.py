"""Cut texts: limits, reports, prefixes, and the defined cases."""

import random
from datetime import datetime

from paperloom.llm.truncation import truncated, truncation_shares

SCHEMA = "doc_id long, text string, source string, n_chars long, text_length string"


def corpus():
    random.seed(3)
    noun = ["invoice", "contract", "receipt", "customer record", "shipping list", "monthly report", "apprentice"]
    verb = ["confirms", "replaces", "mentions", "extends"]
    sentence = lambda: f"The {random.choice(noun)} {random.choice(verb)} the {random.choice(noun)} before the end of the month. "
    return ["".join(sentence() for _ in range(random.randint(3, 20))).strip() for _ in range(300)]


def found(spark, rows):
    return {r.doc_id for r in truncated(spark.createDataFrame(rows, SCHEMA)).filter("cut").collect()}


def test_evidence(spark):
    texts = corpus()
    rows = [(i, t, f"s{i % 3}", len(t), "x") for i, t in enumerate(texts)]
    rows += [(1000 + i, (t * 9)[:500], "short", 500, "x") for i, t in enumerate(texts[:12])]
    rows += [(2000, texts[0][:-20], "s0", len(texts[0]), "x"), (2001, texts[1] + " The invo", "s1", None, None), (2002, texts[1] + " The invo", "s2", None, None), (2003, texts[2] + " According to", "s2", None, None)]
    rows += [(3000, None, "s0", 5, None), (3001, "", "s0", 5, None), (3002, " \n ", None, 5, None), (3003, texts[5], None, None, None), (3004, texts[6] + " The customer record confirms the receipt before the end of the month", "s0", None, None), (3005, "- invoice\n- contract", "s1", None, None)]
    got = found(spark, rows)
    assert {*range(1000, 1012), 2000, 2001, 2002} <= got
    assert not got & ({*range(300)} | {3000, 3001, 3002, 3003, 3004, 3005})


def test_empty_and_repeated(spark):
    assert found(spark, spark.createDataFrame([], SCHEMA).collect() or [(1, None, None, None, None)]) == set()
    rows = [(1, "One whole sentence here.", "a", 10**6, None)] * 2
    assert found(spark, rows) == {1}
    shares = truncation_shares(spark.createDataFrame(rows + [(2, "Fine.", "a", 5, None)] * 9, SCHEMA)).collect()
    assert [(r.source, r.n_texts) for r in shares] == [("a", 2)]


def test_very_long(spark):
    assert found(spark, [(1, "A sentence stands here. " * 50000, "a", None, str(datetime.now()))]) == set()


def test_limit_below_the_longest(spark):
    texts = corpus()
    rows = [(i, t, f"s{i % 3}", len(t), "x") for i, t in enumerate(texts)]
    rows += [(1000 + i, (t * 9)[:500], "two", 500, "x") for i, t in enumerate(texts[:12])] + [(1100 + i, (t * 9)[:900], "two", 900, "x") for i, t in enumerate(texts[12:24])]
    rows += [(1200, texts[30] * 4, "two", None, None)]
    evidence = {r.doc_id: r for r in truncated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(evidence[i].by_limit for i in [*range(1000, 1012), *range(1100, 1112)])
    assert not any(evidence[i].by_limit for i in [*range(300), 1200])


def test_prefix_of_many_rare_words(spark):
    texts = corpus()
    rows = [(i, t, f"s{i % 3}", None, None) for i, t in enumerate(texts)]
    rows += [(1000 + i, f"The quorbel{end} confirms the invoice before the end of the month.", "s0", None, None) for i, end in enumerate("ing ed er ist ism ness".split())]
    rows += [(2000, "The invoice replaces the contract before the end of the month. - the month\n- the quorbel", "s1", None, None)]
    rows += [(2001, "The invoice replaces the contract before the end of the month.\n- the month\n- the apprenti", "s1", None, None)]
    evidence = {r.doc_id: r for r in truncated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert evidence[2000].by_prefix and evidence[2001].by_prefix
    assert not any(evidence[i].by_prefix for i in [*range(300), *range(1000, 1006)])


def test_evidence_by_text_and_long_entries(spark):
    """Ids that are null or shared by different texts do not mix their evidence; an entry of any length is one."""
    texts = corpus()
    rows = [(i, t, f"s{i % 3}", None, None) for i, t in enumerate(texts)]
    rows += [(None, texts[1] + " The invo", "s1", None, None), (1, texts[2] + " The cont", "s2", None, None)]
    entry = "a list of the customer record and the receipt and the contract " * 5 + "for the month"
    rows += [(4000 + k, f"- {entry}\n- {entry}\nThe invoice mentions the contract.", "s0", None, None) for k in range(2)] + [(4100, f"The invoice mentions the contract.\n\n{entry}", "s1", None, None)]
    got = [(r.doc_id, r.cut, r.by_prefix) for r in truncated(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert (None, True, True) in got and sorted(c for i, c, _ in got if i == 1) == [False, True]
    assert not any(c for i, c, _ in got if i in (4000, 4001))
