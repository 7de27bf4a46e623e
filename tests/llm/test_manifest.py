"""The Merkle manifest against a tree built by hand, and ranks of groups of any size."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_rows import LONG, awkward, nothing, package  # noqa: F401
from pyspark.sql import functions as F

from starmill.llm import merkle
from starmill.llm.queries import LOWER, UPPER, merkle_manifest
from starmill.llm.ranks import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, grp int, rank int, path string, root string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    spelt = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return H(*map(spelt, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(top, path of each node): path is a list of (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, node in enumerate(at):
            run = node // 8 * 8
            paths[k].append(("".join(nodes[run:node]), "".join(nodes[node + 1:run + 8])))
        at = [n // 8 for n in at]
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def by_force(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        tampered = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            tampered = text.translate(str.maketrans(UPPER, LOWER))
        groups[lang].append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, tampered)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        tops[name] = tree([x[1] for x in groups[name]])
    root, over = tree([tops[n][0] for n in names])
    out = []
    for name, above in zip(names, over):
        for (doc_id, leaf, tampered), path in zip(groups[name], tops[name][1]):
            folded = tampered
            for before, after in path + above:
                folded = H(before, folded, after)
            proof = H(*(b + a for b, a in path + above))
            out.append((doc_id, leaf, tops[name][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def docs_of(spark, rows, path):
    spark.createDataFrame([(*r, "d", 1, 2, "p", "r") for r in rows], SCHEMA).repartition(4).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def corpus(sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(k * 7 + len(rows) % 3, f"Text {k} of {lang}", lang, f"s{k % 3}", k) for k in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8, "de": 9}, {"en": 64, "fr": 65, None: 3, "": 2}, {"en": 513, "de": 7, "es": 1},
    {f"l{k}": 1 + k % 9 for k in range(70)}])
def test_trees_and_proofs(spark, tmp_path, sizes):
    rows = corpus(sizes)
    assert sorted(map(tuple, merkle_manifest(spark, docs_of(spark, rows, tmp_path)).collect()), key=str) == by_force(rows)


def test_more_rounds_of_blocks(spark, tmp_path, monkeypatch):
    """Blocks of 8 rows: a few hundred rows need three rounds."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3)
    rows = corpus({"en": 530, "de": 64, "fr": 1, None: 10})
    assert sorted(map(tuple, merkle_manifest(spark, docs_of(spark, rows, tmp_path)).collect()), key=str) == by_force(rows)


def test_awkward_rows(spark, tmp_path):
    rows = [(1, "A", "en", "s", 1), (1, "A", "en", "s", 1), (1, "B", "en", None, 1), (None, "N", "en", "s", None), (None, None, None, None, None),
            (2, "", "é", "s", 0), (3, LONG, "en", "s", 9), (2 ** 62, "Ü 東京 🎉 ABC", "zz", "s", 5), (-5, "neg", "zz", "s", 5)]
    assert sorted(map(tuple, merkle_manifest(spark, docs_of(spark, rows, tmp_path)).collect()), key=str) == by_force(rows)
    assert merkle_manifest(spark, docs_of(spark, [], tmp_path / "none")).count() == 0


def test_a_change_anywhere_is_seen(spark, tmp_path):
    rows = corpus({"en": 20, "de": 3})
    before = merkle_manifest(spark, docs_of(spark, rows, tmp_path)).first().root
    for k, changed in ((0, "text"), (22, None)):
        other = [(*r[:1], changed, *r[2:]) if i == k else r for i, r in enumerate(rows)]
        assert merkle_manifest(spark, docs_of(spark, other, tmp_path)).first().root != before


def test_no_python_and_no_join_for_proofs(spark, tmp_path):
    df = merkle_manifest(spark, docs_of(spark, corpus({"en": 20}), tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Join"))


def test_ranks(spark):
    """A hot group, ties and repeated rows: places are 0 .. n - 1 and follow the order."""
    rows = [("hot", k % 50) for k in range(2000)] + [("b", 3), ("b", 1), ("c", None), ("c", 2)]
    out = ranked(spark.createDataFrame(rows, "g string, v int").repartition(6), ["g"], [F.col("v")]).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r.g].append((r["rank"], r.v))
        assert r.rows == sum(g == r.g for g, _ in rows)
    for g, found in groups.items():
        found.sort()
        assert [k for k, _ in found] == list(range(len(found)))
        assert [v for _, v in found] == sorted((v for x, v in rows if x == g), key=lambda v: (v is not None, v or 0))
    assert ranked(spark.createDataFrame([], "g string, v int"), ["g"], [F.col("v")]).count() == 0
