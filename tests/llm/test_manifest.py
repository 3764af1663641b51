import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidegate.llm import manifest
from tidegate.llm.manifest import folded, manifest_of, merkle_manifest, prove

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, rank string, leaf int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, lower=False):
    text = row[4]
    if lower and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    return sha("".join(map(written, (*row[:4], text))))


def tree(nodes):
    """Root, and each node's (left, right) siblings from its own level up."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 16, len(nodes))) for a in range(0, len(nodes), 16)]
        for run in runs:
            for k in run:
                for i in below[k]:
                    paths[i].append(("".join(nodes[run.start : k]), "".join(nodes[k + 1 : run.stop])))
        below = [[i for k in run for i in below[k]] for run in runs]
        nodes = [sha("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def brute_force(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    ordered = [sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in names]
    trees = [tree([leaf_of(r) for r in rows]) for rows in ordered]
    root, top = tree([subroot for subroot, _ in trees])
    out = []
    for rows, (subroot, paths), above in zip(ordered, trees, top, strict=True):
        for row, path in zip(rows, paths, strict=True):
            path = path + above
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of(row, lower=changed)
            for left, right in path:
                node = sha(left + node + right)
            out.append((row[0], leaf_of(row), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def result(spark, rows):
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    out = out.withColumn("p", F.sha2(F.concat_ws("", F.transform("proof", lambda s: s["others"])), 256))
    return sorted(map(tuple, out.select("doc_id", "leaf", "subroot", "root", "p", "folded_root", "verified").collect()), key=str)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    out, number = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Some TEXT", "ÄÖ é", "x" * rng.randint(0, 50), f"Row {number}"])
            out.append((number, source, rng.choice([None, "de"]), rng.choice([None, number]), text, "clash", 1))
            number += rng.randint(1, 9)
    return out


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {None: 2, "": 33, "a": 257, "é": 16, "Z": 3}, {f"s{i}": i % 4 + 1 for i in range(18)}]
)
def test_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    assert result(spark, rows) == brute_force(rows)


def test_hot_source_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(manifest, "RANGE_ROWS", 20)
    rows = rows_of({"hot": 400, "a": 5, "b": 40, None: 1})
    assert result(spark, rows) == brute_force(rows)


def test_repeated_rows_and_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(manifest, "RANGE_ROWS", 10)
    same = (7, "a", "de", 3, "Same", "clash", 1)
    rows = [same] * 40 + [(None, "a", None, None, "X", None, None)] * 3 + [(7, "a", None, 3, "other", None, None), (8, None, None, None, None, None, None)]
    assert result(spark, rows) == brute_force(rows)


def test_empty_table_gives_no_rows(spark):
    assert result(spark, []) == []


def test_long_text(spark):
    rows = [(1, "a", None, None, "Ab é " * 2_000_000, None, None), (2, "a", None, None, "b", None, None)]
    assert result(spark, rows) == brute_force(rows)


def test_records_are_content_addressed_and_some_requests_suffice(spark):
    rows = rows_of({"a": 300, "b": 20, "c": 1})
    leaves, tree_ = manifest_of(spark.createDataFrame(rows, SCHEMA))
    for record in tree_.records.collect():
        assert record.digest == sha("".join(record.children)) and len(record.children) <= 16
    assert tree_.records.count() == tree_.records.select("digest").distinct().count()
    some = leaves.where(F.col("doc_id") % 11 == 0)
    proofs = prove(tree_, some).withColumn("up", folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(proofs) == some.count() > 10
    assert {r.up for r in proofs} == {tree_.root}
