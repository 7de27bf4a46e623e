"""Mixing sources: targets, rates and copies against brute force."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_rows import awkward, nothing, package  # noqa: F401

from starmill.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, name string, rate int, docs int, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", 1, 2, "z") for i, s, t in rows], SCHEMA)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_force(sizes):
    """``sizes``: source to words; shares by weight, the excess over twice the source shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            break
        each = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * each >= 2 * sizes[s]}
        if not above:
            break
        full |= above
    return {s: 2.0 * sizes[s] if s in full else weight[s] * each for s in names}


def rate_by_force(sizes, target):
    """Halving the interval of the tilt, on every document by itself."""
    low, high = -60.0, 60.0
    sizes = np.array(sizes, float)
    unit = (sizes ** 2).sum() / sizes.sum()
    for _ in range(200):
        tilt = (low + high) / 2
        rate = 2 / (1 + np.exp(-tilt * sizes / unit))
        low, high = (tilt, high) if (rate * sizes).sum() < target else (low, tilt)
    return rate


def corpus(seed, shares):
    r = random.Random(seed)
    out = []
    for source, n, longest in shares:
        out += [(len(out) + k, source, " ".join(["w"] * r.randint(0, longest))) for k in range(n)]
    return out


@pytest.mark.parametrize("shares", [
    [("a", 300, 60), ("b", 40, 200), ("é", 80, 30), (None, 60, 90), ("zz", 5, 5)],
    [("hot", 500, 40), ("B", 6, 900)],
    [("only", 50, 50)],
    [(f"s{k}", 5 + k, 40) for k in range(25)] + [("hot", 200, 40)]])
def test_rates_and_copies(spark, shares):
    rows = corpus(3, shares)
    got = {r.doc_id: r for r in mixing.mix(frame(spark, rows).repartition(5)).collect()}
    assert len(got) == len(rows)
    words, docs = defaultdict(int), defaultdict(list)
    for i, source, text in rows:
        words[source] += size_of(text)
        docs[source].append(i)
    want = targets_by_force(words)
    for source, ids in docs.items():
        own = [got[i] for i in ids]
        sizes = [size_of(rows[i][2]) for i in ids]
        assert [r.size for r in own] == sizes and {r.source_size for r in own} == {words[source]}
        assert own[0].target == pytest.approx(want[source], rel=1e-12)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in own)
        if want[source] >= 2 * words[source]:
            assert all(r.taken == 2 * r.size for r in own)
        else:
            assert [r.rate for r in own if r.size] == pytest.approx([x for x, n in zip(rate_by_force(sizes, want[source]), sizes) if n], abs=1e-6)
            # what is left over is less than the smallest documents can mend
            assert abs(sum(r.taken for r in own) - want[source]) <= max(1, 0.02 * want[source], min(n for n in sizes if n))


def test_runs_agree(spark):
    rows = corpus(5, [("a", 200, 50), ("b", 150, 20), (None, 30, 400)])
    once = sorted(map(str, mixing.mix(frame(spark, rows)).collect()))
    random.Random(1).shuffle(rows)
    assert once == sorted(map(str, mixing.mix(frame(spark, rows).repartition(7)).collect()))


def test_copies_of_one_text_share_the_rate(spark):
    """One group of copies holds most rows; their copies in the mix are as many as the rate asks for."""
    rows = [(i, "a", "same words here") for i in range(900)] + [(900 + i, "b", "other") for i in range(300)]
    got = mixing.mix(frame(spark, rows)).collect()
    want = targets_by_force({"a": 2700, "b": 300})
    assert sum(r.taken for r in got if r.doc_id < 900) == pytest.approx(want["a"], abs=3)
    assert sum(r.taken for r in got if r.doc_id >= 900) == pytest.approx(want["b"], abs=1)


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.selectExpr("*", "key as source")
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in got)
    # copies are whole: with one text that is nearly everything, the mix is off by up to half of it
    assert sum(r.taken for r in got) == pytest.approx(1.5 * sum(r.size for r in got), abs=max(r.size for r in got) / 2 + 20)
    assert {r.size for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix(nothing.selectExpr("*", "key as source")).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted(tuple(r)[:5] for r in mixing.mix(empty).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_no_python_on_the_way(spark, awkward):
    plan = mixing.mix(awkward.selectExpr("*", "key as source"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert math.isfinite(len(plan))
