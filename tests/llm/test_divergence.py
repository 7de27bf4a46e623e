"""The divergence audit against brute force over every pair and term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import awkward, nothing, package  # noqa: F401

from starmill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, word string, value string, rank int"


def terms_of(text):
    return [m.translate({c: c + 32 for c in range(65, 91)}) for m in TERM.findall(text)]


def by_force(rows, least=3, top=200):
    rows = [(i, t or "", lang or "", source or "") for i, t, lang, source in rows]
    out = []
    for lang in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == lang]
        docs = Counter(w for r in own for w in set(terms_of(r[1])))
        kept = {w for w, n in docs.items() if n >= least}
        counts = defaultdict(Counter)
        for r in own:
            counts[r[3]].update(w for w in terms_of(r[1]) if w in kept)
        whole = sum(counts.values(), Counter())
        chance = lambda c: {w: 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        f = lambda p, q: (p - q) * (p - q) // q
        p, q = {s: chance(c) for s, c in counts.items()}, chance(whole)
        for s in counts:
            found = [(t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in counts if t != s]
            out += [(lang, s, "pair", t, v, k) for k, (t, v) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode())), 1)]
            found = [(w, f(p[s][w], q[w])) for w in kept if counts[s][w] and p[s][w] > q[w]]
            out += [(lang, s, "term", w, v, k) for k, (w, v) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode())), 1) if k <= top]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "w", "v", 3) for r in rows], SCHEMA).repartition(3)


def corpus(seed, docs, sources, vocabulary, langs=("en", "de", None)):
    r = random.Random(seed)
    words = [("Wort" if k % 2 else "éa") + chr(97 + k % 26) + chr(97 + k // 26 % 26) for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    return [(i, r.choice([" ", "\n", "1", "_"]).join(r.choices(words, weights, k=r.randint(0, 60))), r.choice(langs),
             r.choice(["hot", *(f"s{k}" for k in range(sources)), None])) for i in range(docs)]


@pytest.mark.parametrize("shape", [(60, 4, 30), (150, 3, 400), (40, 90, 60), (3, 2, 10)])
def test_every_pair_and_term(spark, shape):
    rows = corpus(7, *shape)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == by_force(rows)


def test_small_blocks_and_tiles(spark, monkeypatch):
    """Blocks of 64 ids, tiles of about 3 sources."""
    rows = corpus(11, 120, 12, 300, langs=("en", "de"))
    want = by_force(rows, 2, 5)
    for name, value in (("BLOCK_BITS", 6), ("BLOCK", 64), ("TILE", 3)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), 2, 5).collect())) == want


def test_tasks_pass_on_their_counts(monkeypatch):
    """However often a task passes its counts on, and wherever a text is cut, they add up."""
    rows = [(t, lang or "", source or "") for _, t, lang, source in corpus(13, 50, 3, 80)]
    batch = pa.record_batch([pa.array([x[k].encode() if k == 0 else x[k] for x in rows]) for k in (0, 1, 2)], ["text", "lang", "source"])
    monkeypatch.setattr(divergence, "HELD", 20)
    monkeypatch.setattr(divergence, "SLICE", 16)
    counts, docs, batches = Counter(), Counter(), 0
    for out in divergence.count_batches([batch]):
        batches += 1
        for r in out.to_pylist():
            counts[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    assert batches > 20
    want = Counter((lang, source, w) for t, lang, source in rows for w in terms_of(t))
    assert {k: n for k, n in counts.items() if k[2] is not None} == want
    assert {k: n for k, n in docs.items() if k[2] is not None} == Counter((lang, s, w) for t, lang, s in rows for w in set(terms_of(t)))
    assert {k[:2] for k in counts} == {(lang, s) for _, lang, s in rows}


def test_awkward_rows(spark, awkward, nothing):
    rows = [(1, None, None, None), (2, "", "", "a"), (3, "one one ONE", "en", "a"), (3, "one one ONE", "en", "a"), (4, "one two " * 5000, "en", "b"),
            (5, "two", "en", "c"), (None, "Two's x_two", "en", None), (6, "12 34", "en", "d"), (7, "solo", "xx", "only")]
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == by_force(rows)
    docs = awkward.selectExpr("*", "key as lang", "spans as source")
    assert divergence.audit(docs).count() == len(by_force([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]))
    assert divergence.audit(nothing.selectExpr("*", "key as lang", "spans as source")).count() == 0


def test_terms_are_those_of_the_pattern():
    text = "Aa-bB éÉ_x9y 東京,Z\x7fq \x00end ÀB" * 50
    for size in (1, 7, 1 << 20):
        divergence.SLICE, before = size, divergence.SLICE
        try:
            assert [w.decode() for part in divergence.terms(text.encode()) for w in part] == terms_of(text)
        finally:
            divergence.SLICE = before


def test_joint_cells_by_and_and_popcount():
    r = np.random.default_rng(5)
    size = 4096
    for levels in (2, 9, 60):
        a, b = r.integers(0, levels, size), r.integers(0, levels, size) * (r.random(size) < 0.5)
        sides, total = [], (int(a.sum()), int(b.sum()))
        for counts, n in zip((a, b), total):
            sets = defaultdict(int)
            for k, c in enumerate(counts):
                if c:
                    sets[k // 64, int(c)] |= 1 << (k % 64)
            keys = sorted(sets)
            sides.append(divergence.Side(np.array([w for w, _ in keys]), np.array([c for _, c in keys]),
                                         np.array([sets[k] for k in keys], np.uint64).view(np.int64), n, size))
        p, q = ([1 + 10 ** 9 * (int(c) + 1) // (n + size) for c in counts] for counts, n in zip((a, b), total))
        assert divergence.divergence(*sides, size) == (sum((x - y) ** 2 // y for x, y in zip(p, q)), sum((x - y) ** 2 // x for x, y in zip(p, q)))
