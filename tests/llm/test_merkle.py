"""op12: Merkle manifest against a plain version that holds all levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from adtally.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, grp int, siblings string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, plus=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + plus, text)
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i: i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _proof(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((at & 1, level[other] if other < len(level) else None))
        at >>= 1
    return out


def _fold(node, proof):
    for left, sibling in proof:
        node = _h(node) if sibling is None else _h(sibling, node) if left else _h(node, sibling)
    return node


def _brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, _leaf(row), row))
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    trees = {g: _levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = _levels([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for at, (_, _, leaf, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            proof = _proof(trees[g], at) + _proof(top, n)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = _fold(_leaf(row, 1) if changed else leaf, proof)
            assert _fold(leaf, proof) == top[-1][0]
            out.append((row[0], leaf, trees[g][-1][0], top[-1][0], _h(*[s for _, s in proof if s]), folded, folded == top[-1][0]))
    return out


def _check(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    got = list(map(tuple, merkle.audit(docs).collect()))
    assert sorted(got, key=str) == sorted(_brute(rows), key=str)
    return got


def _rows(sizes):
    return [(i * 3 + k, f"s{i % 3}", lang, None if i % 11 == 0 else i, "text é " * (i % 4)) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize("stored", [1, 2, 6])
def test_trees_of_all_shapes(spark, monkeypatch, stored):
    monkeypatch.setattr(merkle, "STORED", stored)
    # the SQL text has the constant in it
    text = lambda s: s.replace("sequence(1, 6)", f"sequence(1, {stored})").replace("sequence(0, 5)", f"sequence(0, {stored - 1})").replace("shiftright(63, l)", f"shiftright({2 ** stored - 1}, l)")
    monkeypatch.setattr(merkle, "_REGENERATED", text(merkle._REGENERATED))
    monkeypatch.setattr(merkle, "_SIBLINGS", text(merkle._SIBLINGS))
    got = _check(spark, _rows({None: 1, "": 2, "a": 130, "b": 65, "é": 64, "z": 3}))
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_nulls_ties_and_repeated_rows(spark):
    same = (7, "s", "en", 4, "same")
    _check(spark, [same, same, same, (7, "s", "en", 4, "other"), (None, None, None, None, None), (None, "s", "en", 1, ""), (0, "s", "en", 1, "-"), (9, "a:1", "en", 2 ** 63 - 1, "x" * 100_000)])


def test_one_leaf_is_the_root(spark):
    (row,) = _check(spark, [(1, "s", "en", 2, "ab")])
    assert row[1] == row[2] == row[3] and row[4] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = merkle.build_manifest(docs)
    assert merkle.audit(docs).collect() == [] and manifest.root.collect() == []


def test_manifest_of_other_fields(spark):
    docs = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3)], "name string, n int")
    manifest = merkle.build_manifest(docs, fields=("name", "n"), group="name", order="n")
    proofs = merkle.inclusion_proofs(manifest)
    assert proofs.columns == ["n", "leaf", "subroot", "root", "siblings"]
    rows = proofs.withColumn("back", merkle.fold(F.col("leaf"), F.col("siblings"))).collect()
    leaf = {n: _h(f"1:{name}", f"1:{n}") for name, n in (("b", 1), ("a", 2), ("a", 3))}
    want = _h(_h(leaf[2], leaf[3]), leaf[1])
    assert {r["n"]: r["leaf"] for r in rows} == leaf and {r["back"] for r in rows} == {want} == {manifest.root.first()[0]}
