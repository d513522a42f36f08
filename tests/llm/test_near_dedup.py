"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
from made_texts import words

from landfall.llm import near_dedup as module
from landfall.llm.near_dedup import connecting_links, near_dedup, shingle_set


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0D]+", low)
    size = min(5, len(found))
    return {tuple(found[i:i + size]) for i in range(len(found) - size + 1)} if size else set()


def components(count, links):
    parent = list(range(count))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(count)]


def linked(sets):
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                yield j, i


def texts(seed, families, copies):
    rng = random.Random(seed)
    out = ["", None, "one two", "one  TWO", "one two three"]
    for _ in range(families):
        base = words(rng, rng.randint(20, 150)).split()
        for _ in range(rng.randint(1, copies)):
            mine = list(base)
            for _ in range(rng.randint(0, 6)):
                mine[rng.randrange(len(mine))] = words(rng, 1)
            out.append(" ".join(mine))
    out.append(out[-1].upper())
    return out


def check(spark, given):
    rows = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(5)
    sets = [shingles(text) for text in given]
    want = components(len(given), linked(sets))
    got = {r.doc_id: r for r in near_dedup(rows).collect()}
    for i, members in enumerate(sets):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(members), want[i], want[i] == i)


def test_groups_are_those_of_all_pairs(spark):
    check(spark, texts(1, 25, 8))


def test_large_nodes_branch_and_fall_back_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "NODE", 4)
    monkeypatch.setattr(module, "DEPTH", 1)
    check(spark, texts(2, 4, 25))


def test_links_within_a_node_connect_all_that_links_do():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets = np.empty(int(rng.integers(1, 30)), object)
        for i in range(len(sets)):
            mine = base.copy()
            changed = rng.integers(0, 40)
            mine[rng.integers(0, 60, changed)] = rng.integers(0, 2**63, changed).astype(np.uint64)
            sets[i] = np.unique(mine[:rng.integers(1, 61)])
        every = list(linked([set(s.tolist()) for s in sets]))
        before = [link for link in every if rng.random() < 0.3]
        found = connecting_links(sets, np.array(components(len(sets), before)), 75)
        assert components(len(sets), before + found.tolist()) == components(len(sets), every)


def test_shingle_hashes_are_as_many_as_shingles():
    for text in texts(3, 10, 3):
        assert len(shingle_set((text or "").encode())) == len(shingles(text))


@pytest.mark.parametrize("similarity", [0.75, 0.85])
def test_a_pair_at_the_threshold_is_rarely_missed(similarity):
    """The chance to meet, from the trees' first nodes alone."""
    assert (1 - similarity) ** module.TREES < 1e-6


def test_only_wanted_texts_are_shuffled(spark, monkeypatch):
    """Rows come through the table of bits if they are wanted, few others do, and none if none is wanted."""
    rows = spark.range(20_000).selectExpr(
        "case when id % 1000 <> 7 then id end as _id", "cast(id as int) as which", "'t' as _text")
    wanted = rows.where("which % 10 = 3 or which % 1000 = 7").select("_id", "which")
    want = {tuple(r) for r in wanted.collect()}
    got = [(r._id, r.which) for r in module.likely(rows, wanted, ["_id", "which"]).collect()]
    assert want <= set(got) and len(got) == len(set(got)) < 1.1 * len(want)
    assert module.likely(rows, wanted.limit(0), ["_id", "which"]).count() == 0
    monkeypatch.setattr(module, "MARKS", 1)   # all bits set: nothing is lost
    assert module.likely(rows, wanted, ["_id", "which"]).count() == 20_000
    near_dedup(spark.createDataFrame([(i, f"a b c d e {i % 3}") for i in range(9)], "doc_id long, text string")).count()
