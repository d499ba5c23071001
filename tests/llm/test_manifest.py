"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from samples import ODD, sorted_rows

from lotflow.llm.manifest import BLOCK, LOWER, UPPER, Tree, levels, manifest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, small=False):
    doc, text, lang, source, n = row
    if small and text is not None:
        text = text.translate(str.maketrans(UPPER, LOWER))
    return digest("".join(field(v) for v in (doc, source, lang, n, text)))


def plain_tree(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([digest("".join(rows[-1][a : a + 8])) for a in range(0, len(rows[-1]), 8)])
    return rows


def plain(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    names = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    for k in names:
        langs[k].sort(key=lambda r: (r[0] is not None, r[0], plain_leaf(r)))
    trees = {k: plain_tree([plain_leaf(r) for r in langs[k]]) for k in names}
    top = plain_tree([trees[k][-1][0] for k in names])
    out = []
    for place, k in enumerate(names):
        for i, r in enumerate(langs[k]):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            proof, node = "", plain_leaf(r, changed)
            for tree, at in ((trees[k], i), (top, place)):
                for row in tree[:-1]:
                    a = at - at % 8
                    left, right = "".join(row[a:at]), "".join(row[at + 1 : a + 8])
                    proof, node, at = proof + left + right, digest(left + node + right), at // 8
            out.append((r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], digest(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def built(docs):
    columns = {c: F.col(c) for c in ("source", "lang", "n_chars")} | {"text": F.translate("text", UPPER, LOWER)}
    return manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, columns)


@pytest.mark.parametrize("count", [1, 8, 9, BLOCK, BLOCK + 1, 9 * BLOCK - 3])
def test_manifest_equals_a_plain_tree(spark, count):
    """One language of one or more blocks, and more languages than a node has children."""
    rows = [(i * 7 % 100_003, f"Text {i}" if i % 5 else None, "de", "a", i) for i in range(count)]
    rows += [(-i, "Other", f"l{i % 11}", None, None) for i in range(1, 23)]
    assert sorted_rows(built(spark.createDataFrame(rows, DDL))) == plain(rows)


def test_odd_rows(odd):
    assert sorted_rows(built(odd)) == plain([r[:5] for r in ODD])


def test_a_single_leaf_is_the_root(spark):
    rows = [(3, "One", None, None, None)]
    assert sorted_rows(built(spark.createDataFrame(rows, DDL))) == plain(rows)


def test_empty_table(none):
    assert built(none).collect() == []


def test_a_fold_resumes_retained_states():
    nodes = [digest(str(i)).encode() for i in range(75)]
    tree, other = Tree(nodes, levels(75)), digest("x").encode()
    for i in range(75):
        changed = nodes[:i] + [other] + nodes[i + 1 :]
        assert tree.fold(i, other, tree.path(i)) == Tree(changed, levels(75)).top
        assert tree.fold(i, nodes[i], tree.path(i)) == tree.top
