"""Passages against the edit distance of every substring."""

import random

from made_texts import words

from landfall.llm.decontaminate import build_index, find_passages, indexes, passages, plain


def distance(item, text):
    """Least edits from the item to any substring."""
    row = [0] * (len(text) + 1)
    for i, symbol in enumerate(item, 1):
        new = [i] + [0] * len(text)
        for j, other in enumerate(text, 1):
            new[j] = min(row[j - 1] + (symbol != other), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_whatever_is_within_the_budget_is_found_and_nothing_else():
    rng = random.Random(2)
    items = [(i, words(rng, rng.randint(8, 40), "abcdefghijklmnopqrst")) for i in range(30)]
    index = build_index(items, 0.1, 8)
    for _ in range(60):
        i = rng.randrange(len(items))
        passage = list(items[i][1])
        for _ in range(rng.randint(0, int(0.13 * len(passage)))):
            at, kind = rng.randrange(len(passage)), rng.random()
            if kind < 0.4:
                passage[at] = rng.choice("abcé")
            elif kind < 0.7:
                passage.insert(at, rng.choice("abcx"))
            else:
                del passage[at]
        text = words(rng, 30) + "  " + "".join(passage).upper() + "\n" + words(rng, 30)
        points = plain(text)[0]
        least = distance(index.items[i].tolist(), points.tolist())
        found = [p for p in passages(points, index, 8) if p[0] == i]
        assert bool(found) == (least <= index.budgets[i])
        if found:
            assert min(p[3] for p in found) == least


def test_places_are_those_of_the_text_and_blocks_change_nothing(spark):
    rng = random.Random(3)
    items = [(i, words(rng, 20)) for i in range(12)]
    docs = [(d, words(rng, 50) + " \n  " + (items[d][1] if d < 6 else "") + "  " + words(rng, 9)) for d in range(12)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_passages(rows, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == {(d, d, 0) for d in range(6)}
    assert all(dict(docs)[r.doc_id][r.start:r.end] == dict(items)[r.item_id] for r in found)
    assert len(indexes(benchmark, block_chars=300)) > 2
    assert sorted(map(repr, find_passages(rows, benchmark, block_chars=300).collect())) == sorted(map(repr, found))


def test_a_long_text_is_searched_to_its_end(monkeypatch):
    from landfall.llm import decontaminate as module

    monkeypatch.setattr(module, "_PIECE", 500)
    rng = random.Random(6)
    item = words(rng, 25)
    index = build_index([(1, item)], 0.1, 8)
    for before in (0, 60, 85, 90, 200):
        text = words(rng, before) + " " + item + " " + words(rng, 30)
        assert [p[3] for p in passages(plain(text)[0], index, 8)] == [0]


def test_a_letter_without_a_lower_case_of_one_leaves_the_others_folded(spark):
    rng = random.Random(9)
    item = words(rng, 25)
    near = item.replace(item[40], "\u00e9", 1).upper()
    docs = [(i, words(rng, 30) + " \u0130stanbul \u039f\u0394\u039f\u03a3 " + passage + " " + words(rng, 9))
            for i, passage in enumerate((item.upper(), item.title(), near, item))]
    assert "".join(map(chr, plain("A\u0130B \u039f\u03a3  C")[0])) == "a\u0130b \u03bf\u03c2 c"
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r for r in find_passages(rows, benchmark).collect()}
    assert {i: r.edits for i, r in found.items()} == {0: 0, 1: 0, 2: 1, 3: 0}
    assert all(docs[i][1][r.start:r.end].lower() == item for i, r in found.items() if i != 2)
