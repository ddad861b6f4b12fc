from __future__ import annotations

import itertools
import random

import pytest

from lexigrove.llm.overlap import SMALL, Shard, one_slip, overlap_report, overlaps, passages, question_words, same_question, scan, settled

FIELDS = "qid bigint, q string, target string, kind string, split string, source string, id string, words string"
BASE = "what is the guard height of a wood deck near a gas meter in a school of 12 storeys"


def records(spark, rows):
    return spark.createDataFrame([(i, q, t, "lexical", s, src, "clash", "clash") for i, q, t, s, src in rows], FIELDS)


def corpus():
    """Enough other questions that slips can be told from words."""
    out = []
    things, places = ["wood deck", "fuel tank", "exit stair", "loading dock"], ["near a gas meter", "under a terrace", "below grade", "on a farm site"]
    for i, (p, t, pl, b) in enumerate(itertools.product(["guard height", "exit capacity", "ramp gradient"], things, places, ["school", "church", "hotel"])):
        out.append((1000 + i, f"what is the {p} of a {t} {pl} in a {b} of {3 + i % 15} storeys", f"V1/B/9/9.{i}", "train", "bulk"))
    return out


def pairs(spark, rows, **kw):
    return {(r.train_id, r.held_id) for r in overlaps(records(spark, rows), **kw).collect() if r.train_id < 1000 and r.held_id < 1000}


SAME = [
    BASE.upper() + "??", "Q: " + BASE, "please, " + BASE.replace("the ", ""), BASE.replace("12", "twelve"), BASE.replace("12", "１２"), BASE.replace(" ", "  ").replace("storeys", "storeys​."),
    BASE.replace("storeys", "stories"), BASE.replace("guard", "gaurd"), BASE.replace("meter", "metre"), BASE.replace("height", "heihgt").replace("school", "shcool"),
    "in a school of 12 storeys, what is the guard height of a wood deck near a gas meter",
]
OTHER = [BASE.replace("12", "13"), BASE.replace("school", "church"), BASE.replace("wood deck", "fuel tank"), BASE.replace("guard height", "exit capacity"), BASE.replace("near a gas meter", "under a terrace"), BASE + " and 4 suites"]


@pytest.fixture(scope="module")
def found(spark):
    rows = corpus() + [(1, BASE, "V1/B/9/9.1", "train", "s")]
    rows += [(100 + i, q, "v1/b/9/9.1 ", " DEV", "s") for i, q in enumerate(SAME)] + [(200 + i, q, "V1/B/9/9.1", "test", "s") for i, q in enumerate(OTHER)]
    return pairs(spark, rows)


def test_same_and_other(found):
    assert found == {(1, 100 + i) for i in range(len(SAME))}


def test_targets_splits_nulls_and_repeats(spark):
    rows = corpus() + [
        (1, BASE, "V1/B/9/9.1", "Train ", "s"), (1, BASE, "V1/B/9/9.1", "Train ", "s"), (2, BASE, None, "train", "s"), (3, BASE, "V1/B/9/9.2", "train", "s"),
        (10, BASE, "V1/B/9/9.1/(2)/(a)", "test", "s"), (11, BASE, "  ", "dev", "s"), (12, BASE, "V1/B/9/9.1", "holdout", "s"), (13, BASE, "V1/B/9/9.1", None, "s"),
        (14, None, "V1/B/9/9.1", "dev", "s"), (15, "  ", "V1/B/9/9.1", "dev", "s"), (16, "what is the", "V1/B/9/9.1", "dev", "s"), (17, "what is the", "V1/B/9/9.1", "train", "s"), (None, BASE, None, "dev", "s"), (2, BASE, None, "test", "s"),
    ]
    want = {(1, 10), (1, 11), (2, 10), (2, 11), (3, 11), (1, 2), (3, 2)}
    got = pairs(spark, rows)
    assert got - {(17, 16)} == want
    assert got == pairs(spark, rows, shard_rows=2, block_rows=3)


def test_empty(spark):
    assert pairs(spark, []) == set()
    assert pairs(spark, [(1, BASE, None, "train", "s")]) == set()
    assert pairs(spark, [(1, BASE, None, "dev", "s")]) == set()


def test_very_long_question(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    assert pairs(spark, [(1, long, None, "train", "s"), (2, long + " word7", None, "dev", "s"), (3, long, None, "test", "s")]) == {(1, 3)}


def test_report(spark):
    rows = corpus() + [(1, BASE, None, "train", "s"), (2, BASE, None, "dev", "a"), (3, "how is the exit stair", None, "dev", "a"), (4, BASE, None, "test", None)]
    r = records(spark, rows)
    assert {tuple(x) for x in overlap_report(overlaps(r), r).collect()} == {("dev", "a", 2, 1, 1), ("test", None, 1, 1, 1)}


@pytest.mark.parametrize("text, want", [("Twenty-one storeys", ["21", "storeys"]), ("1,250 kPa", ["1250", "kpa"]), ("007", ["7"]), ("ﬁre ０", ["fire", "0"]), ("thirty", ["30"]), ("twenty 5", ["20", "5"]), (None, []), ("?!", [])])
def test_words(text, want):
    assert question_words(text) == want


def test_helpers():
    assert settled("stories") == settled("storeys") == "storey" and settled("min") == "minimum" and settled("class") == "class"
    assert one_slip("swamill", "sawmill") and one_slip("cofee", "coffee") and one_slip("a", "a") and not one_slip("abcd", "badc")
    assert same_question(["a", "~gaurd"], ["a", "guard"]) and not same_question(["a", "12"], ["a", "13"]) and not same_question(["bank"], ["tank"]) and not same_question(["~bank", "x"], ["tank", "y"])


def test_scan_against_all_pairs():
    words = [["a", "b", "c", "d", "e", x] for x in "fghij"]
    train = [(i, a, w) for i, (w, a) in enumerate(itertools.product(words, [None, "t", "u"]))]
    held = [(100 + i, a, w) for i, (w, a) in enumerate(itertools.product(words, [None, "t"]))]
    want = {(t[0], h[0]) for t in train for h in held if t[2] == h[2] and (t[1] is None or h[1] is None or t[1] == h[1])}
    assert {(a, b) for a, b, _ in scan(train, Shard(held))} == want
    assert list(scan([], Shard(held))) == [] and list(scan(train, Shard([]))) == []


def test_scan_against_all_pairs_with_slips_on_either_side():
    random.seed(4)
    vocabulary = ["alpha", "bark", "cedar", "delta", "echo", "frost", "grain", "12", "13"]

    def row(i):
        words = random.sample(vocabulary, random.choice([1, 2, 3, 4, 5, 8]))
        for _ in range(random.choice([0, 0, 0, 1, 2, 3])):
            k = random.randrange(len(words))
            if words[k].isalpha():
                c = random.randrange(len(words[k]))
                words[k] = "~" + words[k][:c] + words[k][c + 1 :]
        return i, random.choice([None, "t", "u"]), sorted(words)

    train, held = [row(i) for i in range(700)], [row(1000 + i) for i in range(700)]
    want = {(t[0], h[0]) for t in train for h in held if same_question(t[2], h[2]) and (t[1] is None or h[1] is None or t[1] == h[1])}
    found = list(scan(train, Shard(held)))
    assert {(a, b) for a, b, _ in found} == want and len(found) == len(want) > 500
    assert all(0 <= c <= 1 for *_, c in found)
    a, b = ["alpha", "bark", "cedar", "delta", "echo"], ["alpha", "cedar", "delta", "echo", "~bork"]
    assert [x[:2] for x in scan([(1, None, a)], Shard([(2, None, b)]))] == [x[:2] for x in scan([(1, None, b)], Shard([(2, None, a)]))] == [(1, 2)]


def test_slip_of_two_words_and_of_a_number(spark):
    rows = corpus() + [(2000 + i, f"what is the {p} of a {t} near a gas meter in a school of {3 + i % 15} storeys", None, "train", "bulk") for i, (p, t) in enumerate(itertools.product(["floating depth", "footing depth"], [f"item{'abcdefgh'[k]}" for k in range(8)]))]
    q = "what is the {} depth of a wood deck near a gas meter in a school of {} storeys"
    rows += [(1, q.format("floating", 12), None, "train", "s"), (2, q.format("footing", 12), None, "train", "s"), (3, q.format("floting", "twleve"), None, "dev", "s"), (4, q.format("floating", "thrteen"), None, "dev", "s")]
    assert pairs(spark, rows) == {(1, 3), (2, 3)}


def test_word_lists_are_parameters(spark):
    rows = corpus() + [(1, BASE, None, "train", "s"), (2, BASE.replace("deck", "veranda"), None, "dev", "s"), (3, BASE + " zum", None, "dev", "s")]
    assert pairs(spark, rows) == set()
    assert pairs(spark, rows, variants={"veranda": "deck"}, small=[*SMALL, "zum"]) == {(1, 2), (1, 3)}


def test_passages_mark_unknown_words(spark):
    got = {r.id: r.words for r in passages(records(spark, corpus() + [(1, "zyxwv " + BASE, None, "dev", "s")])).collect()}
    assert got[1][-1] == "~zyxwv" and got[1][:-1] == sorted(got[1][:-1])
