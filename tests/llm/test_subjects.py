from __future__ import annotations

import random

import pytest

from clipsieve.llm import subjects

AREAS = [("law", "Law"), ("sport", "Sport"), ("music", "Music")]
WORDS = {"law": ["хууль", "шүүх", "гэрээ", "торгууль", "заалт", "яллах"], "sport": ["тэмцээн", "аварга", "медаль", "гүйлт", "барилдаан", "гоол"], "music": ["хөгжим", "дуучин", "аялгуу", "концерт", "эгшиг", "лимбэ"]}
LATIN = {"law": "khuuli", "sport": "avarga"}
DOCS = "doc_id long, text string, subject string, words long, n long, terms string"
LABELS = "label_id long, doc_id long, subject string, annotator string"


def document(pick, topics, length=60):
    """Sections of the topics, a quarter of each section's words its own."""
    filler = [f"дүүргэгч{c}" for c in "абвгдежз"] + [f"{a}{b}лон" for a in "бгдж" for b in "аоуэ"]
    out = []
    for t in topics:
        out += [pick.choice(WORDS[t]) + pick.choice(["", "ийг", "аас"]) if t and pick.random() < 0.3 else pick.choice(filler) for _ in range(length // len(topics))]
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(3)
    topics = [pick.choice([("law",), ("sport",), ("music",), (None,), ("law", "sport"), ("music", "law")]) for _ in range(300)]
    docs = [(i, document(pick, t, 90), "clash", 0, 0, "clash") for i, t in enumerate(topics)]
    labels, n = [], 0
    for i in range(0, 300, 3):
        for who in ("a", "b"):
            for t in topics[i]:
                said = pick.choice(["law", "sport", "music"]) if pick.random() < 0.1 else t
                labels.append((n, i, said if not said or pick.random() < 0.9 else f" {said.upper()} ", who))
                n += 1
    return topics, docs, labels


def test_subjects(spark, tables, corpus):
    topics, docs, labels = corpus
    extra = [(1000, None), (1001, ""), (1002, "  "), (1003, "!!! 123"), (1004, docs[0][1]), (1005, " ".join([document(random.Random(1), (None,), 80), "хууль"])), (1006, "хууль " * 50_000)]
    d = tables(documents=(docs + [(i, t, "clash", 0, 0, "") for i, t in extra], DOCS), doc_subject_labels=([*labels, labels[0], (9999, 5555, "law", "a"), (9998, 1, "unknown", "a"), (9997, None, "law", "a")], LABELS), subject_area=(AREAS, "subject string, title string"))
    rows = [(r.doc_id, r.subject) for r in subjects.p10_found(spark, d).collect()]
    assert len(rows) == len(set(rows))
    found = {}
    for doc, s in rows:
        found.setdefault(doc, set()).add(s)
    right = sum(found.get(i, set()) == {t for t in own if t} for i, own in enumerate(topics))
    assert right >= 0.95 * len(topics)
    assert not {1000, 1001, 1002, 1003, 1005, 5555} & set(found)
    assert found.get(1004, set()) == found.get(0, set()) and found[1006] == {"law"}
    parts = {r.subject: r.n_documents for r in subjects.p10_composition(spark, d).collect()}
    assert parts["law"] == sum("law" in v for v in found.values()) and parts["none"] == 300 + len(extra) - len(found)


def test_held_out_labels(spark, tables, corpus):
    """Labels that were not given agree with what comes out."""
    topics, docs, labels = corpus
    half = [x for x in labels if x[1] % 2]
    d = tables(documents=(docs, DOCS), doc_subject_labels=(half, LABELS), subject_area=(AREAS, "subject string, title string"))
    found = {(r.doc_id, r.subject) for r in subjects.p10_found(spark, d).collect()}
    held = {(i, t) for i, own in enumerate(topics) if i % 2 == 0 for t in own if t}
    assert len(found & held) >= 0.95 * len(held)


def test_alphabets_share_terms(spark, tables):
    """Documents in Latin letters have no label; those in Cyrillic letters do."""
    pick = random.Random(5)
    docs = [(i, document(pick, (("law", "sport")[i % 2],)), "", 0, 0, "") for i in range(60)]
    docs += [(100 + i, " ".join([LATIN[("law", "sport")[i % 2]]] * 4 + ["dugaar"] * 16), "", 0, 0, "") for i in range(6)]
    labels = [(i, i, ("law", "sport")[i % 2], "a") for i in range(60)]
    d = tables(documents=(docs, DOCS), doc_subject_labels=(labels, LABELS), subject_area=(AREAS, "subject string, title string"))
    found = {(r.doc_id, r.subject) for r in subjects.p10_found(spark, d).collect()}
    assert {(100 + i, ("law", "sport")[i % 2]) for i in range(6)} <= found


def test_seeds(spark):
    labels = [(1, 7, "law", "a"), (2, 7, "LAW ", "b"), (3, 7, "law", "b"), (4, 8, "law", "a"), (5, 8, "sport", "b"), (6, 9, None, "a"), (7, 9, "odd", "b")]
    found = {(r.doc_id, r.subject): (r.weight, r.trusted) for r in subjects.seeds(spark.createDataFrame(labels, LABELS), spark.createDataFrame(AREAS, "subject string, title string")).collect()}
    assert found == {(7, "law"): (1.0, True), (8, "law"): (0.5, False), (8, "sport"): (0.5, False), (9, "-"): (1.0, False)}


def test_trusted_labels_stay(spark, tables, corpus):
    """A subject two annotators named is in the result, however few of the document's words are its own."""
    _, docs, labels = corpus
    filler = document(random.Random(7), (None,), 80)
    odd = [(2000, f"{filler} хууль"), (2001, filler), (2002, None), (2003, "!!! 123"), (2004, filler), (2005, document(random.Random(8), ("music",), 90))]
    said = [(2000, "law", "a"), (2000, "LAW ", "b"), (2004, "law", "a"), (2004, None, "b")]
    said += [(i, s, who) for i, s in ((2001, "sport"), (2002, "law"), (2003, "law"), (2005, "law")) for who in "ab"]
    d = tables(documents=(docs + [(i, t, "", 0, 0, "") for i, t in odd], DOCS), doc_subject_labels=(labels + [(5000 + n, *x) for n, x in enumerate(said)], LABELS), subject_area=(AREAS, "subject string, title string"))
    rows = [tuple(r) for r in subjects.p10_found(spark, d).collect()]
    assert len(rows) == len(set(rows))
    assert {r for r in rows if r[0] >= 2000} == {(2000, "law"), (2001, "sport"), (2005, "law"), (2005, "music")}


SIZES = (80, 24, 8, 2)


def chain(tables):
    """Four ever smaller stages of documents: each has the words of its own stage and of the one before, only the first has labels."""
    words = [[f"{c}{d}{v}уудал" for c in "бгджз" for v in "аэ"] for d in "лмнрт"]
    pick = random.Random(9)
    docs, labels = [], []
    for stage, size in enumerate(SIZES):
        for i in range(size):
            own = words[stage] + words[stage + 1]
            docs.append((stage * 100 + i, " ".join(own * 2 + [f"дунд{c}" for c in "авгдежз"]), "", 0, 0, ""))
            if not stage:
                labels.append((i, i, "law", "a"))
    for i in range(200):
        docs.append((1000 + i, " ".join([f"дунд{c}" for c in "авгдежз"] + [pick.choice("кпс") + "эгэл"] * 5), "", 0, 0, ""))
        labels.append((100 + i, 1000 + i, None, "a"))
    return tables(documents=(docs, DOCS), doc_subject_labels=(labels, LABELS), subject_area=(AREAS, "subject string, title string"))


def test_hops_go_on_until_nothing_changes(spark, tables):
    found = {tuple(r) for r in subjects.p10_found(spark, chain(tables)).collect()}
    assert found == {(stage * 100 + i, "law") for stage, size in enumerate(SIZES) for i in range(size)}


def test_a_run_that_does_not_settle_warns(spark, tables, monkeypatch):
    monkeypatch.setattr(subjects, "MOST_HOPS", 2)
    with pytest.warns(RuntimeWarning, match="after 2 hops"):
        subjects.p10_found(spark, chain(tables))


def test_terms_beyond_the_broadcast_limit(spark, tables, corpus, monkeypatch):
    _, docs, labels = corpus
    d = tables(documents=(docs, DOCS), doc_subject_labels=(labels, LABELS), subject_area=(AREAS, "subject string, title string"))
    want = {tuple(r) for r in subjects.p10_found(spark, d).collect()}
    monkeypatch.setattr(subjects, "BROADCAST_TERMS", 0)
    assert {tuple(r) for r in subjects.p10_found(spark, d).collect()} == want


def test_every_labelled_document_is_a_partner(spark, tables):
    """Words of a subject that none of its pool has: 520 trusted documents fill it, and ten with a label of one annotator have words of their own."""
    other = [f"{c}{v}рчлэл" for c in "бгджз" for v in "аэ"]
    filler = [f"дунд{c}" for c in "авгдежз"] * 2
    docs = [(i, " ".join(WORDS["law"] + filler), "", 0, 0, "") for i in range(520)] + [(1000 + i, " ".join(filler), "", 0, 0, "") for i in range(520)]
    docs += [(2000 + i, " ".join(other + filler), "", 0, 0, "") for i in range(20)] + [(3000 + i, " ".join(other[i : i + 2] + filler), "", 0, 0, "") for i in range(5)]
    said = [(i, "law", who) for i in range(520) for who in "ab"] + [(1000 + i, None, "a") for i in range(520)] + [(2000 + i, "law", "a") for i in range(10)]
    d = tables(documents=(docs, DOCS), doc_subject_labels=([(n, *x) for n, x in enumerate(said)], LABELS), subject_area=(AREAS, "subject string, title string"))
    found = {tuple(r) for r in subjects.p10_found(spark, d).collect()}
    assert found == {(i, "law") for i in (*range(520), *range(2000, 2020), *range(3000, 3005))}


@pytest.mark.parametrize("tried", [1, 10, 20_000])
def test_partners(spark, monkeypatch, tried):
    """As comparing all pairs, with partners in many portions and in one."""
    monkeypatch.setattr(subjects, "TRIED", tried)
    monkeypatch.setattr(subjects, "GROWTH", 2)
    pick = random.Random(11)
    terms = [f"t{i}" for i in range(300)]
    own = {i: set(pick.sample(terms, pick.choice([6, 9, 12, 20]) if i % 20 else 4)) for i in range(60)}
    own[60] = own[1] = {*terms[:3], "u1", "u2", "u3", "u4", "u5"}
    labelled = {i for i in range(50)} | {60}
    stems = spark.createDataFrame([(i, sorted(t), [1] * len(t), 50) for i, t in own.items()], "doc_id long, terms array<string>, counts array<int>, words int")
    known = spark.createDataFrame([(t, "law", 1.0) for t in [*terms, "u1", "u2", "u3", "u4", "u5"]], "term string, subject string, purity double")
    rows = spark.createDataFrame([(i, "law", len(t)) for i, t in own.items()], "doc_id long, subject string, _own long")
    found = [r.doc_id for r in subjects.partnered(stems, known, rows, rows.filter(rows.doc_id.isin(labelled))).collect()]
    want = {d for d, a in own.items() if any(d != e and len(a & own[e]) >= max(1, min(len(a), len(own[e])) / 4) for e in labelled)}
    assert sorted(found) == sorted(want) and 0 < len(want) < len(own)


def test_empty(spark, tables):
    none = dict(documents=([], DOCS), doc_subject_labels=([], LABELS), subject_area=([], "subject string, title string"))
    assert subjects.p10_found(spark, tables(**none)).count() == 0
    d = tables(**none | {"documents": ([(1, "үг", "", 0, 0, "")], DOCS)})
    assert subjects.p10_found(spark, d).count() == 0 and subjects.p10_composition(spark, d).first().n_documents == 1
