"""Fingerprints, near duplicates and components against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import awkward, nothing, package  # noqa: F401

from starmill.llm import edit_embedding, hnsw, parity_join
from starmill.llm.components import connected


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(2)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(2000, i) for i in range(2001, 2300)] + [(5, 5)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    ends = {x for a, b in links if a != b for x in (a, b)}
    want = smallest(ends, [x for x in links if x[0] != x[1]])
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def words(n, seed, size=3000):
    r = random.Random(seed)
    return [f"w{r.randrange(size)}" for _ in range(n)]


def edited(base, edits, seed):
    r, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"e{r.randrange(10**6)}"
    return out


def corpus():
    rows, passage = [], words(60, 77)
    for g in range(25):
        base = words(random.Random(g).choice([3, 5, 8, 40, 120, 400, 1500]), g)
        rows += [edited(base, k * len(base) // 120, 100 * g + k) for k in range(9)]
    rows += [words(80, 900 + k) + passage + words(80, 2900 + k) for k in range(40)]
    rows += [rows[0], rows[30], rows[30]]
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def sets_of(rows):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def jaccard_by_force(rows):
    sets = sets_of(rows)
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, links


def test_parity_join_is_brute_force(spark):
    rows = corpus() + [(9001, None), (9002, ""), (9003, " \x0b\n"), (9004, "One TWO"), (9005, "one two"), (9006, "one two three")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, sid string, key int").repartition(5)
    sets, links = jaccard_by_force(rows)
    want = smallest(sets, links)
    assert len(set(want.values())) < len(want) - 50
    got = parity_join.join(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    kept = parity_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)


def test_rows_go_by_their_own_sets(spark):
    """Ids that stand in several rows, and none, name no row: exactly the rows of a class that are not its kept one go."""
    words = [f"w{k}" for k in range(40)]
    text, near, other, third = " ".join(words), " ".join([*words, "extra"]), "an unrelated text of some seven words", " ".join(words[::-1])
    rows = [(1, text), (5, near), (5, other), (5, other), (None, near), (None, third), (None, third + " more"), (None, None), (None, ""),
            (7, third), (8, "alone here"), (8, "alone here"), (8, text), (9, None), (9, None), (6, other + " indeed")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sid string").repartition(4)
    kept = parity_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(1, text), (5, other), (7, third), (8, "alone here"), (9, None), (9, None), (None, None), (None, "")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)

    lost = spark.createDataFrame([(None, text), (None, near), (None, other), (None, near + " too")], "doc_id long, text string")
    out = parity_join.keep_one(lost).collect()
    assert len(out) == 2 and {r.text for r in out} > {other}
    roots = {r.root for r in parity_join.join(lost).collect()}
    assert len(roots) == 2  # links between sets without ids are found


def test_a_pair_is_left_out_only_where_it_was_met():
    r = np.random.default_rng(4)
    top = np.iinfo(np.int64).max
    lists = [np.sort(r.choice(60, r.integers(1, 40), replace=False)).astype(np.int64) for _ in range(60)]
    padded = np.full((60, parity_join.LISTED), top)
    for i, own in enumerate(lists):
        own = own[:parity_join.LISTED]
        padded[i, :len(own)] = own
    left, right = np.nonzero(np.triu(np.ones((60, 60), bool), 1))
    for key in range(60):
        before = parity_join.met_before(key, padded[left], padded[right])
        for a, b, out in zip(left, right, before):
            if out:
                assert any(k < key for k in set(lists[a]) & set(lists[b]))
            elif common := set(lists[a][:16]) & set(lists[b][:16]):
                assert min(common) >= key


def test_crowded_buckets_are_cut(spark):
    """Blocks of 8 on the same corpus; and no part holds more than two blocks, while all pairs of two components meet."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets, links = jaccard_by_force(rows)
    assert {r.doc_id: r.component_id for r in parity_join.join(docs, block=8).collect()} == smallest(sets, links)

    r = random.Random(3)
    bucket = [(1, i, 7 if i < 600 else 8 if i < 700 else r.randrange(100, 140)) for i in range(1000)]
    small = [(2, i, i % 3) for i in range(20)]
    frame = spark.createDataFrame([(*x, 1000) for x in bucket] + [(*x, 20) for x in small], "key long, sid long, component long, n long")
    parts = {}
    for x in parity_join.blocks(frame, 100).collect():
        parts.setdefault((x.part, x.key), []).append((x.side, x.sid, x.component))
    assert max(map(len, parts.values())) < 200
    met = {(k, min(a[1], b[1]), max(a[1], b[1])) for (_, k), own in parts.items() for a in own for b in own
           if a[2] != b[2] and (a[0] != b[0] or not a[0])}
    assert met == {(a[0], a[1], b[1]) for own in (bucket, small) for a in own for b in own if a[1] < b[1] and a[2] != b[2]}

    hot = spark.createDataFrame([(1, 20, 5)], "key long, parts long, anchor long")
    published = spark.createDataFrame([(1, i) for i in range(1000)] * 2 + [(2, 1), (2, 9), (3, 1)], "key long, sid long")
    got = sorted(tuple(x) for x in parity_join.meet(published, hot).collect())
    assert got == [(1, i, 5) for i in range(1000)] + [(2, 1, 1), (2, 9, 1)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 140), st.integers(0, 10**6))
def test_linked_sets_publish_an_equal_word(n, apart, seed):
    r = np.random.default_rng(seed)
    both = r.integers(0, 1 << 63, n, np.uint64)
    a = np.unique(np.concatenate((both, r.integers(0, 1 << 63, apart // 2, np.uint64))))
    b = np.unique(np.concatenate((both, r.integers(0, 1 << 63, apart - apart // 2, np.uint64))))
    common = len(np.intersect1d(a, b))
    if 100 * common >= 75 * (len(a) + len(b) - common):
        assert set(parity_join.published(a)) & set(parity_join.published(b))
        bits = [parity_join.parity_bits(x) for x in (a, b)]
        words = parity_join.words_of(bits, 8 * min(map(len, bits)))
        assert parity_join.may_link(np.array(len(a)), words[0], np.array(len(b)), words[1])


def test_parity_join_of_awkward_rows(awkward, nothing):
    got = parity_join.join(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r.component_id == r.doc_id for r in got)
    kept = parity_join.keep_one(awkward).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])
    assert parity_join.join(nothing).count() == parity_join.keep_one(nothing).count() == 0


def naive_walk(text):
    codes, at, step, out = [*map(int, edit_embedding.classes_of(text)), 0], 0, 0, []
    while codes[at]:
        if step % (1 << edit_embedding.level_of(len(text))) == 0:
            out.append(int(edit_embedding.OUTPUT[step % edit_embedding.PERIOD][codes[at]]))
        at += int(edit_embedding.MOVES[step % edit_embedding.PERIOD][codes[at]])
        step += 1
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=700), max_size=8))
def test_walks_of_a_batch_are_single_walks(texts):
    got = edit_embedding.walk([edit_embedding.classes_of(t) for t in texts])
    assert [list(map(int, x)) for x in got] == [naive_walk(t) for t in texts]


def test_likeness_follows_the_edits():
    """Walks fall into step again by chance, sooner for smaller shifts; so the median of several texts counts."""
    near = []
    for seed in range(31):
        r = random.Random(seed)
        text, other = ("".join(r.choice("abcdefghij klmnop") for _ in range(6000)) for _ in range(2))
        edits = (text, text[:100] + "#" + text[101:], text[:100] + "xyz" + text[100:], text[:3000] + other[3000:], other, "")
        near.append([edit_embedding.likeness(*edit_embedding.fingerprints([text, x])) for x in edits])
    same, changed, shifted, half, unlike, nothing = np.median(near, axis=0)
    assert same == 1 and changed > 0.95 and shifted > 0.9 and 0.4 < half < 0.6 and unlike < 0.1 and nothing == 0
    r = random.Random(4)
    text = "".join(r.choice("abcdefghij klmnop") for _ in range(6000))
    assert edit_embedding.likeness(*edit_embedding.fingerprints(["", ""])) == 1
    longer = edit_embedding.fingerprints([text[:4096], text[:4200]])
    assert longer[0][0] != longer[1][0] and edit_embedding.likeness(*longer) > 0.85  # across a level
    assert set(edit_embedding.bands(longer[0])) & set(edit_embedding.bands(longer[1]))


def test_bands_see_the_whole_text():
    """A near copy is met where its opening is replaced, and a changed ending costs bands; lengths across a level too."""
    near, left = [], []
    for seed in range(60):
        r = random.Random(seed)
        n = r.randrange(300, 5000)
        text, other = ("".join(r.choice("abcdefghij klmnop") for _ in range(k)) for k in (n, n // 6))
        prints = edit_embedding.fingerprints([text, other + text[len(other):], text[:n - len(other)] + other])
        own, opening, ending = ({*edit_embedding.bands(p)} for p in prints)
        if edit_embedding.likeness(*prints[:2]) >= 0.75:
            near.append(bool(own & opening))
        left.append(len(own & ending) / len(own))
    assert len(near) > 20 and all(near)
    assert np.mean(left) < 0.7
    text = "".join(r.choice("abcdefghij klmnop") for _ in range(2000))
    for a, b in ((256, 258), (512, 514), (1024, 1030), (300, 330), (440, 470)):
        own, longer = (set(edit_embedding.bands(p)) for p in edit_embedding.fingerprints([text[:a], text[:b]]))
        assert own & longer


def test_edits_against_brute_force(spark, awkward, nothing):
    import hashlib

    rows = [(3, "abcdefgh" * 40), (1, "xy"), (2, None), (9, "zażółć gęślą jaźń " * 300), (9, "zażółć gęślą jaźń " * 300), (10, "tail end text")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, k int").repartition(4)
    order = sorted({(i, t or "") for i, t in rows})
    want = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 4
        new = text[:len(text) - cut] + after[:cut]
        prints = edit_embedding.fingerprints([text, new, after])
        want[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), *prints[:2], edit_embedding.likeness(*prints[:2]),
                   edit_embedding.likeness(prints[0], prints[2]))
    got = edit_embedding.with_edits(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == want[r.doc_id]
    assert edit_embedding.with_edits(awkward).count() == awkward.count()
    assert edit_embedding.with_edits(nothing).count() == 0
    assert edit_embedding.with_edits(docs.filter("doc_id = 1")).first().near_next == 1


def test_near_classes(spark):
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefghijklm ") for _ in range(2000)) for _ in range(6)]
    near = [t[:900] + "??" + t[903:] for t in texts]
    prints = edit_embedding.fingerprints(texts + near + texts[:2])
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    found = {x.fingerprint: x.class_id for x in edit_embedding.near_classes(frame).collect()}
    assert [found[a] for a in prints[:6]] == [found[a] for a in prints[6:12]]
    assert len(set(found.values())) == 6


@pytest.mark.parametrize("block", [2048, 8])
def test_near_classes_are_those_of_the_shared_bands(spark, block):
    r = random.Random(5)
    base = "".join(r.choice("abcdefghijklm ") for _ in range(1000))
    texts = [base[:k] + "?" + base[k + 1:] for k in range(0, 1000, 25)] + [base[k:] for k in range(0, 250, 25)]
    texts += ["".join(r.choice("abcdefghijklm ") for _ in range(r.randrange(0, 1100))) for _ in range(60)] + ["a" * 900, "a" * 901, ""]
    prints = sorted(set(edit_embedding.fingerprints(texts)))
    keys = [set(edit_embedding.bands(p)) for p in prints]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if keys[i] & keys[j] and edit_embedding.likeness(prints[i], prints[j]) >= 0.75]
    want = smallest(range(len(prints)), links)
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint string").repartition(4)
    got = {x.fingerprint: x.class_id for x in edit_embedding.near_classes(frame, block=block).collect()}
    assert len(got) == len(prints)
    assert len({(got[p], want[i]) for i, p in enumerate(prints)}) == len(set(got.values())) == len(set(want.values()))


def vectors():
    r = np.random.default_rng(6)
    centres = r.normal(size=(30, 16))
    rows = [(centres[k % 30] + r.normal(size=16) * 0.09, int(k % 3)) for k in range(360)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    return rows + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[0][1], None), (2004, [], 0),
                   (2005, [None] * 16, 0), (2006, rows[0][1][:8], 0), (None, rows[0][1], 0), (2007, [float("inf")] * 16, 0)]


@pytest.mark.parametrize("shard", [8192, 40])
def test_embeddings_against_brute_force(spark, shard):
    rows = vectors()
    good = [(i, np.array(v, np.float64), y) for i, v, y in rows
            if i is not None and v and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, x, p in good for b, y, q in good
             if a < b and p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= hnsw.LINK]
    want = smallest([i for i, *_ in rows if i is not None], links)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, node int, links string")
    got = hnsw.near_duplicates(frame, shard=shard).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
            continue
        assert r.n_links == sum(r.vec_id in x for x in links)
        assert (r.component_id, r.kept) == (want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


def test_graph_recall_and_full_beams():
    r = np.random.default_rng(1)
    values = np.concatenate((r.normal(size=(1500, 24)), r.normal(size=(1, 24)) + r.normal(size=(500, 24)) * 0.05)).astype(np.float32)
    graph = hnsw.build(values)
    near = graph.unit @ graph.unit.T
    ids, _ = hnsw.search(graph, graph.unit, 64)
    exact = np.argsort(-near, axis=1)[:, :10]
    assert np.mean([len(set(a[:64]) & set(b)) / 10 for a, b in zip(ids[:1500], exact[:1500])]) >= 0.9
    query, node, recall = hnsw.audited(graph, graph.unit, 0.93)
    assert recall >= hnsw.RECALL and len(query) >= 0.99 * (near >= 0.93).sum()  # 500 links each: beams are widened


def test_word_hashes_are_those_of_words(monkeypatch):
    """One hash for each word, equal for equal words only, whatever white space is around it and however the text is cut."""
    text = "Aa aA  b\x0bbb é \0 q" + "q" * 70 + " " + "x" * 64 + "\ty" + "x" * 64 + " aa\n" * 9
    words = text.encode().lower().split()
    hashes = parity_join.word_hashes(text)
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist())))
    for piece in (1, 7, 50):
        monkeypatch.setattr(parity_join, "PIECE", piece)
        assert (parity_join.word_hashes(text) == hashes).all()
    assert len(parity_join.word_hashes("")) == len(parity_join.word_hashes(" \n ")) == 0


def test_keys_come_in_the_order_of_the_words():
    """Words with more members are published first: keys are ordered alike for all sets."""
    members = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 400).astype(np.uint64))
    filled = len(np.unique((members >> np.uint64(32)) * np.uint64(160) >> np.uint64(32)))
    every = np.sort(parity_join._keys(members, 12, 160, filled - 1))  # all words that are not empty
    for differ in (5, 60):
        assert (np.sort(parity_join._keys(members, 12, 160, differ)) == every[:differ + 1]).all()


def test_buckets_of_one_set_are_left_out(spark):
    """Also where a task has no others; the rows of a bucket come in any order."""
    none = spark.createDataFrame([], "key long, parts long, anchor long")
    alone = spark.createDataFrame([(k, 100 + k) for k in range(50)], "key long, sid long")
    assert parity_join.meet(alone, none).collect() == []
    more = alone.union(spark.createDataFrame([(7, 9), (7, 200), (7, 9), (8, 108)], "key long, sid long"))
    assert sorted(map(tuple, parity_join.meet(more, none).collect())) == [(7, 9, 9), (7, 107, 9), (7, 200, 9)]
