"""Quality and toxicity classifiers: held-out accuracy, matching against plain edit distance."""

import random

import pytest
from helpers import DOCS, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from sediment.llm import quality, toxicity

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def accuracy(scored, labels, column):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    assert len(rows) > 60
    return sum(r["predicted"] == r[column] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.contract(docs, labels)
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1").isEmpty()
    assert accuracy(scored, labels, "quality") > 0.93
    scored = toxicity.contract(docs, labels)
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1").isEmpty()
    assert accuracy(scored, labels, "toxic") > 0.93


@pytest.mark.parametrize("operator,column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_labels(spark, operator, column):
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in odd_rows()], DOCS + ", score double, label int")
    some = spark.createDataFrame([(2, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, None), (4, 7, 7), (8, 0, 1)], LABELS)
    none = spark.createDataFrame([], LABELS)
    for labels in (some, none):
        got = operator.contract(docs, labels).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    kept = operator.score(docs, operator.train(docs, some, column))
    assert set(kept.columns) == set(docs.columns) and kept.count() == len(odd_rows())
    assert operator.contract(docs.limit(0), some).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    for operator, column, fold, mod in ((quality, "quality", 1, 3), (toxicity, "toxic", 0, 5)):
        flipped = labels.withColumn(column, labels[column] + 0).selectExpr(
            "doc_id", *(f"IF(pmod(crc32(cast(cast(doc_id AS string) AS binary)), {mod}) = {fold}, 1 - {c}, {c}) AS {c}"
                        if c == column else c for c in ("quality", "toxic")))
        a, b = (sorted((r["doc_id"], r["score"]) for r in operator.contract(docs, x).collect())
                for x in (labels, flipped))
        assert a == b


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_match(terms, word):
    """(errors of the best term, whether a stem fits) by edit distance to every term."""
    found = [d for t in terms if not t.stem and (d := distance(t.text, word)) <= toxicity.allowed(t)]
    return min(found, default=None), any(t.stem and word.startswith(t.text) for t in terms)


TERMS = [toxicity.Term(t, s, w) for t, s, w in (
    ("worthless", False, 4.0), ("idiot", False, 5.0), ("idiotic", False, 3.0), ("scum", False, 5.0),
    ("disgustingly", False, 6.0), ("loser", False, 4.5), ("vequ", True, 5.0), ("moron", False, 4.0))]


def test_automaton_agrees_with_edit_distance(monkeypatch):
    monkeypatch.setattr(toxicity, "STATES", 40)  # the cache starts anew now and then
    automaton = toxicity.Automaton(TERMS)
    rng = random.Random(4)
    for _ in range(6000):
        own = list(rng.choice(TERMS).text)
        for _ in range(rng.randrange(4)):
            at, c = rng.randrange(len(own) + 1), rng.choice("abcdeiorstu1")
            own[at:at + rng.randrange(2)] = [c] * rng.randrange(2)
        word = "".join(own)
        errors, stem = plain_match(TERMS, word)
        got = automaton.match(word)
        if errors == 0 or (errors is not None and not stem):
            assert got[1] == errors and distance(got[0].text, word) == errors
        elif stem:
            assert got[0].stem
        else:
            assert got is None


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="idotcrlesv", max_size=12))
def test_automaton_on_any_word(word):
    errors, stem = plain_match(TERMS, word)
    assert (toxicity.Automaton(TERMS).match(word) is not None) == (errors is not None or stem)


def test_quotation_is_told_from_abuse():
    read = toxicity.Reader(TERMS)
    abuse, quoted = read("you idiot and loser"), read('they wrote "you idiot and loser" to me')
    marked = read("> you idiot and loser\nplease stop")
    assert abuse[1] > 0 and abuse[3] == 0 and abuse[4] > 0
    assert quoted[1] == 0 and quoted[3] > 0 and marked[1] == 0 and marked[3] > 0
    assert read("you id1ot")[2] > 0 and read("you id1ot")[1] == 0
    assert read("") == [0.0] * 5


def test_misspelled_terms_are_scored(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        own, bad = words(rng, 40, 300), i % 4 == 0
        if bad:
            own[rng.randrange(40)] = rng.choice(["worthless", "horrible", "clownish"])
            own[rng.randrange(40)] = rng.choice(["worthless", "horrible", "clownish"])
        rows.append((i, " ".join(own), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    rows += [(1000, " ".join([*words(rng, 40, 300), "worthles", "horible"]), "en", "s", 0),
             (1001, " ".join(words(rng, 40, 300)), "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert {t.text for t in model.terms if not t.stem} >= {"worthless", "horrible", "clownish"}
    assert got[1000] > got[1001] and got[1001] < 0.1


def test_only_near_copies_leave_the_sample(spark):
    rng = random.Random(9)
    passage = " ".join(words(rng, 60))
    rows = [(i, i % 2, f"{passage} {' '.join(words(rng, 60))}") for i in range(80)]
    text = rows[4][2].split()
    copy = " ".join([*text[:-1], "other"])
    rows += [(100, 0, copy), (101, 1, copy), (102, 0, copy), (103, 1, None), (104, 1, "")]
    got = toxicity.without_copies(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    # A shared passage is no copy, nor is a text of the other label; copies of row 4 are.
    assert {r["doc_id"] for r in got.collect()} == {*range(80), 101, 103, 104}


def test_abuse_is_learnt_where_all_documents_share_a_passage(spark):
    rng = random.Random(10)
    passage = " ".join(words(rng, 60))
    rows = [(i, f"{passage} {' '.join(words(rng, 40))}{' worthless' if i % 4 == 0 else ''}", "en", "s", 0)
            for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(400))


def test_a_rare_telling_term_is_learnt_in_a_large_sample(spark):
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        bad, rare = i % 2, i < 24
        own = [*words(rng, 12, 300), *(["grotesque" if rare else "worthless"] if bad else [])]
        rows.append((i, bad, " ".join(own)))
    sample = spark.createDataFrame(rows, "doc_id long, label int, text string")
    # 12 of 2000 toxic documents, and no other.
    terms = {t.text for t in toxicity.lexicon(sample, {0: 2000, 1: 2000}) if not t.stem}
    assert terms >= {"grotesque", "worthless"} and not any(t.startswith("w") and t[1:].isdigit() for t in terms)


def test_words_and_stems_are_bounded_apart(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TERMS", 3)
    rows = [(i, i % 2, "insulta insultb insultc" if i % 2 else "fine words here") for i in range(80)]
    sample = spark.createDataFrame(rows, "doc_id long, label int, text string")
    terms = toxicity.lexicon(sample, {0: 40, 1: 40})
    assert {t.text for t in terms if not t.stem} == {"insulta", "insultb", "insultc"}


def test_quotation_is_told_in_linear_time():
    """One line of a megabyte with very many hits, and the same places as a plain scan finds."""
    import random
    import time

    def plain(text, at):
        line = text.rfind("\n", 0, at) + 1
        if text[line:at].lstrip().startswith(">"):
            return True
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        marks = [m.start() for m in toxicity.QUOTES.finditer(text)]
        return sum(line <= m <= at for m in marks) % 2 == 1 and any(at < m <= stop for m in marks)

    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice('ab "\n> \r\t') for _ in range(rng.randrange(60)))
        own = toxicity.Quotation(text)
        for at in (i for i, c in enumerate(text) if c in "ab"):
            assert (at in own) == plain(text, at), (text, at)
    began, long = time.process_time(), "bad \"word\" " * 90_000
    own = toxicity.Quotation(long)
    assert sum(at in own for at in range(0, len(long), 11)) == 0
    assert sum(at in own for at in range(5, len(long), 11)) == 90_000
    assert time.process_time() - began < 5
