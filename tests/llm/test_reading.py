from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lexigrove.llm.reading import TRIM_LONG, TRIM_SHORT, WordTable, band_column, familiar_words, features, fit_bands, reading_levels, sentence_lengths

EASY, HARD = "the door is shut and the room can be warm at night".split(), "whenever the probabilistic quantification of the combustibility that authorities scrutinize is attributable to the interdependent verification which practitioners disregard it presupposes reconciliation".split()
FRENCH = "la porte est fermée et le mur doit être droit dans chaque salle pour les voisins".split()


def text(words, n, end=". "):
    return end.join(" ".join(w if k else w.capitalize() for k, w in enumerate(words)) for _ in range(n)) + end.strip()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "xx", 3) for i, t in rows], "doc_id bigint, text string, lang string, words int")


def labels(spark, rows):
    return spark.createDataFrame([(*r, "r", 1) for r in rows], "doc_id bigint, band int, rater string, sentence int")


CORPUS = [(i, text(EASY, 10)) for i in range(20)] + [(100 + i, text(HARD, 5)) for i in range(4)]
LABELS = [(0, 1), (1, 1), (2, 1), (2, 2), (2, 1), (100, 4), (101, 4), (3, None), (999, 2), (4, 1), (4, 2)]


def bands(spark, rows, given=None):
    return {r.doc_id: r.band for r in reading_levels(docs(spark, rows), labels(spark, LABELS if given is None else given)).collect()}


def test_bands_and_print(spark):
    odd = [
        (200, text(EASY, 10).upper()), (201, "\n".join("- " + " ".join(EASY) for _ in range(10))), (202, text(EASY, 10, ".\n\n").replace(" the ", "\nthe ")), (203, "A Short Heading\n\n" + text(EASY, 10)), (204, text(EASY, 10) + " " + text(HARD, 1)),
        (205, text(["the", "door", "of", "Article", "9.10.3.1.", "is", "shut", "and", "the", "room", "can", "be", "warm"], 10)), (206, text(EASY, 10).replace("\n", "\r\n")),
    ]
    got = bands(spark, CORPUS + odd)
    assert {i: b for i, b in got.items() if i < 100} == {i: 1 for i in range(20)} and {b for i, b in got.items() if 100 <= i < 200} == {4}
    assert {i: got.get(i) for i, _ in odd} == {i: 1 for i, _ in odd}


def test_language_and_length(spark):
    rows = CORPUS + [(300, text(FRENCH, 10)), (301, text(FRENCH, 10) + text(EASY, 3)), (302, text(EASY, 10) + text(FRENCH, 3)), (303, text(EASY, 4)), (304, None), (305, ""), (306, "12 34 " * 100), (0, CORPUS[0][1])]
    got = bands(spark, rows)
    assert not {300, 301, 303, 304, 305, 306} & set(got) and 302 in got
    df = reading_levels(docs(spark, rows), labels(spark, LABELS))
    assert df.where("doc_id = 0").count() == 1


def test_without_labels_and_documents(spark):
    got = bands(spark, CORPUS, [])
    assert len(got) == 24 and set(got.values()) == {None}
    assert bands(spark, [], LABELS) == {} and bands(spark, [], []) == {}


def test_very_long_text(spark):
    assert bands(spark, CORPUS + [(400, text(EASY, 20_000)), (401, "the " * 100_000)])[400] == 1


def test_familiar_words_count_every_document(spark):
    df = docs(spark, CORPUS + [(500, text(FRENCH, 20))])
    got = familiar_words(df)
    assert set(EASY) <= set(got) and "porte" not in got
    assert familiar_words(df, share=0.9) == ["is", "the"] and familiar_words(df.where("false")) == []


def test_familiar_list_has_no_cap(spark):
    letters = "abcdefghij"
    long = " ".join(f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in letters[:6])
    assert len(familiar_words(docs(spark, [(i, f"the door is open. {long}") for i in range(3)]))) == 6_004


def lengths_by_hand(sizes):
    inner = sorted(sizes)
    inner = inner[: len(inner) - math.ceil(len(inner) * TRIM_LONG)] if len(inner) > 3 else inner
    kept, words = [], 0
    for n in inner:
        words += n
        if words > TRIM_SHORT * sum(inner):
            kept.append(n)
    return sum(kept) / len(kept)


def test_sentence_lengths_against_a_loop():
    random.seed(8)
    documents = [[random.randint(1, 60) for _ in range(random.randint(1, 40))] for _ in range(200)]
    sentence = np.repeat(np.arange(sum(map(len, documents))), [n for d in documents for n in d])
    doc = np.repeat(np.arange(200), [sum(d) for d in documents])
    assert sentence_lengths(sentence, doc, 200).tolist() == pytest.approx([lengths_by_hand(d) for d in documents])
    assert sentence_lengths(np.zeros(0, np.int64), np.zeros(0, np.int64), 2).tolist() == [0, 0]


def test_features(spark):
    r = features(docs(spark, CORPUS[:1]), EASY).collect()[0]
    assert (r.words, r.unfamiliar, r.sentence) == (120, 0.0, 12.0)


def test_fit_withstands_erring_raters():
    random.seed(5)
    rows = [(b, u + random.gauss(0, 0.02), s * random.uniform(0.95, 1.05)) for b, u, s in ((1, 0.4, 8), (2, 0.15, 16), (3, 0.05, 26), (4, 0.7, 45)) for _ in range(60)]
    noisy = [(min(4, max(1, b + random.choice([-1, 1]))), u, s) if random.random() < 0.15 else (b, u, s) for b, u, s in rows]
    clean, rough = fit_bands(rows), fit_bands(noisy)
    assert all(abs(clean[b][0] - rough[b][0]) < 0.03 and abs(clean[b][2] - rough[b][2]) < 0.1 for b in clean)
    assert fit_bands([]) == {}


def test_band_column_of_held_out_rows(spark):
    random.seed(6)
    draw = lambda: [(b, u + random.gauss(0, 0.03), s * random.uniform(0.85, 1.15)) for b, u, s in ((1, 0.4, 8), (2, 0.15, 16), (3, 0.05, 26), (4, 0.7, 45)) for _ in range(50)]
    model = fit_bands(draw())
    held = spark.createDataFrame(draw(), "want int, unfamiliar double, sentence double").withColumn("band", band_column(model))
    assert held.where("want = band").count() >= 190


def test_soft_ends():
    codes, _ = WordTable().read(["See Article 9.10.3.1. shall. Then 3.2.6. The end."])
    assert [c for c in codes.tolist() if c in (-1, -2)] == [-2, -1, -2, -1]
