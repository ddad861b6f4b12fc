from __future__ import annotations

import random

import pytest

from lexigrove.llm.leak import ItemIndex, find_leaks, leaks, plain_word, raw_words, template_hits

random.seed(11)
VOCAB = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri") for b in ("ban", "dor", "fel", "gus", "hin", "jok", "lam", "mur")]
ITEM = " ".join(random.choice(VOCAB) for _ in range(60))


def found(texts, items, how="passage"):
    index = ItemIndex(list(enumerate(items)))
    return {(a, b) for a, b, h in find_leaks(index, index.memo(), texts) if h == how}


def brute(text, item):
    """Whether the exact definition holds, by all pairs of places and a full alignment table."""
    a, b = [plain_word(w) for w in raw_words(item)], [plain_word(w) for w in raw_words(text)]
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] != b[j]:
                continue
            n, m = min(len(a) - i, 45), min(len(b) - j, 52)
            dist = [[0] * (m + 1) for _ in range(n + 1)]
            for x in range(n + 1):
                for y in range(m + 1):
                    if not x or not y:
                        dist[x][y] = x + y
                        continue
                    same = a[i + x - 1] == b[j + y - 1]
                    dist[x][y] = min(dist[x - 1][y - 1] + (not same), dist[x - 1][y] + 1, dist[x][y - 1] + 1)
                    if same and x >= 15 and 8 * dist[x - 1][y - 1] <= x:
                        return True
    return False


def around(words):
    fill = lambda n: [f"z{random.randint(0, 999)}q" for _ in range(n)]
    return " ".join(fill(12) + words + fill(9))


def test_against_brute_force():
    words = ITEM.split()
    texts = []
    for k in range(160):
        n = random.randint(10, 34)
        at = random.randint(0, len(words) - n)
        part = words[at : at + n]
        for _ in range(random.randint(0, 4)):
            p = random.randrange(len(part))
            what = random.choice(["change", "drop", "add"])
            part[p : p + 1] = {"change": ["other"], "drop": [], "add": [part[p], "more"]}[what]
        texts.append(around(part))
    want = {k for k, t in enumerate(texts) if brute(t, ITEM)}
    assert {a for a, _ in found(texts, [ITEM])} == want and 20 < len(want) < 150


def test_print_does_not_matter():
    words = ITEM.split()[10:32]
    forms = [
        " ".join(words).upper(), "\n> ".join(words), " ".join(f"“{w},”" for w in words), " ".join(words).replace("an", "­an"), " ".join(w[:3] + "-\n" + w[3:] for w in words),
        " ".join(w[:2] + "-" + w[2:] for w in words), " ".join(words).replace("fel", "ﬁl").replace("ﬁl", "fel"), " ".join(chr(ord(w[0]) + 0xFEE0) + w[1:] for w in words),
    ]
    assert found([around(f.split(" ")) for f in forms], [ITEM]) == {(i, 0) for i in range(len(forms))}


def test_too_short_or_too_many_changes():
    words = ITEM.split()
    assert found([around(words[:14]), around(words[:15]), around([w if i % 5 else "no" for i, w in enumerate(words)])], [ITEM]) == {(1, 0)}


def test_repeated_items_and_texts():
    part = around(ITEM.split()[:20])
    assert found([part, part], [ITEM, ITEM.upper(), "few words only"]) == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_variant():
    base = "the Kelvax frame shall hold 40 mm of glass near the Dembor door when the Orukil wind blows over the roof"
    other = base.replace("Kelvax", "Zumtor").replace("40", "75").replace("Dembor", "Palnik").replace("Orukil", "Vestam")
    again = "every frame shall hold glass and the door and the wind and the roof"
    assert found([other, base], [base, again], "variant") == {(0, 0)} and found([other, base], [base, again]) == {(1, 0)}


def test_slots_are_bound_one_to_one():
    item = "the beam spans 7 bays and carries 7 slabs over 7 walls with 7 bolts in 7 rows of 7 holes and 7 plates"
    items = [item, "the and spans bays carries slabs over walls with bolts in rows of holes plates beam"]
    same, other = item.replace("7", "9"), item
    for n in range(7):
        other = other.replace("7", str(20 + n), 1)
    assert found([same, other], items, "variant") == {(0, 0)}
    two = item.replace("7", "8", 3)
    assert found([two.replace("7", "5").replace("8", "4"), two.replace("7", "5").replace("8", "5")], [two, items[1]], "variant") == {(0, 0)}


def test_a_page_of_figures_is_not_multiplied():
    figures = " ".join(str(n) for n in range(400))
    index = ItemIndex([(0, figures), (1, ITEM)])
    page = " ".join(str(random.randint(1_000, 9_000)) for _ in range(2_000))
    words, _ = index.memo().numbers([page.split()])
    assert [len(x) for x in template_hits(index, words, index.templates(words))] == [0, 0]
    assert found([page, page + " " + " ".join(str(n) for n in range(100, 120))], [figures, ITEM]) == {(1, 0)}
    assert found([page], [figures, ITEM], "variant") == set()


def test_words():
    assert [plain_word(w) for w in raw_words("Fire-rated, 42.7 mm; it’s\nA-1 pre-\n  > fab")] == ["firerated", "427", "mm", "its", "a1", "prefab"]
    assert raw_words(None) == [] and raw_words("") == []


@pytest.mark.parametrize("block", [20_000, 1])
def test_tables(spark, block):
    part = around(ITEM.split()[:20])
    docs = spark.createDataFrame([(1, part, "x", 1), (1, part, "x", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "nothing here " * 20_000 + part, "x", 1), (None, part, "x", 1)], "doc_id bigint, text string, how string, item_id int")
    items = spark.createDataFrame([(7, ITEM, "y"), (7, ITEM, "y"), (8, None, "y"), (9, "", "y"), (None, ITEM, "y"), (10, "the end " * 40, "y")], "item_id bigint, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.how) for r in leaks(docs, items, block_items=block).collect()), key=repr)
    assert got == sorted([(1, 7, "passage"), (4, 7, "passage"), (None, 7, "passage")], key=repr)
    assert leaks(docs.where("false"), items).collect() == [] and leaks(docs, items.where("false")).collect() == []
