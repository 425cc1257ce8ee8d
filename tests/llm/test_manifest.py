"""The Merkle manifest against a tree built in one place."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import merkle

DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp int, place int"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]]
    return digest(*fields)


def tree_of(leaves, fanout):
    """(root, siblings of each leaf from below, numbers of them before and after)."""
    nodes, at = list(leaves), list(range(len(leaves)))
    proofs, steps = [[] for _ in leaves], [[] for _ in leaves]
    while len(nodes) > 1:
        for i, n in enumerate(at):
            run = nodes[n - n % fanout : n - n % fanout + fanout]
            proofs[i] += run[: n % fanout] + run[n % fanout + 1 :]
            steps[i] += [n % fanout, len(run) - 1 - n % fanout]
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [n // fanout for n in at]
    return nodes[0], proofs, steps


def expected(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = tree_of([leaf_of(r) for r in members], fanout)
    root, tops, top_steps = tree_of([trees[g][0] for g in order], fanout)
    out = []
    for name, top, top_step in zip(order, tops, top_steps):
        subroot, proofs, steps = trees[name]
        for row, proof, step in zip(groups[name], proofs, steps):
            out.append((row[0], leaf_of(row), "".join(proof + top), step + top_step, subroot, root))
    return out


def made(sizes):
    rows, n = [], 0
    for name, size in sizes.items():
        for _ in range(size):
            text = [None, "", f"line {n}\nnext\n", "x" * n][n % 4]
            rows.append((n * 7919 % 10007, name, ["de", None][n % 3 == 0], n, text, n, n))
            n += 1
    return rows


@pytest.mark.parametrize(
    "sizes, fanout, levels",
    [
        ({"a": 1}, 3, 2),
        ({"a": 3, None: 1, "": 4}, 3, 1),
        ({"a": 100, "b": 1, "c": 28, "é": 9, None: 10, "z": 2, "": 5}, 3, 1),
        ({"a": 100, "b": 1, "c": 28, "é": 9, None: 10, "z": 2, "": 5}, 3, 0),
        ({"a": 82, "b": 27, "c": 10}, 3, 2),
        ({f"s{i}": 1 + i * i % 11 for i in range(29)}, 3, 1),
        ({"a": 70, "b": 33}, 2, 2),
        ({"a": 200}, 3, 8),
    ],
)
def test_equals_a_tree_built_in_one_place(spark, sizes, fanout, levels):
    rows = made(sizes)
    rows.append((rows[0][0], *rows[0][1:]))  # a row again
    rows.append((rows[-1][0], rows[0][1], None, None, "another text of that id", 0, 0))
    rows.append((None, rows[0][1], None, None, None, None, None))
    docs = spark.createDataFrame(rows, DDL).repartition(5)
    got = merkle.manifest(docs, COLUMNS, settings=merkle.Settings(fanout, levels))
    got = got.withColumn("again", merkle.folded(F.col("leaf"), "proof", "steps"))
    found = got.collect()
    assert all(r.again == r.root for r in found)
    plain = [(r.id, r.leaf, r.proof, r.steps, r.subroot, r.root) for r in found]
    assert sorted(plain, key=str) == sorted(expected(rows, fanout), key=str)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], DDL), COLUMNS).collect() == []


def test_tampering_shows(spark):
    rows = made({"a": 40, None: 3})
    docs = spark.createDataFrame(rows, DDL)
    other = F.replace("text", F.lit("\n"), F.lit(""))
    found = merkle.leaf_of([F.col(c) for c in COLUMNS[:-1]] + [other])
    got = merkle.manifest(docs, COLUMNS, settings=merkle.Settings(3, 2), also={"text": F.col("text"), "found": found})
    for row in got.withColumn("again", merkle.folded(F.col("found"), "proof", "steps")).collect():
        assert (row.again == row.root) == ("\n" not in (row.text or ""))


def test_a_long_text_and_one_large_group(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", "en", i, "word " * (200_000 if i == 7 else 3), 0, 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DDL).repartition(7)
    got = merkle.manifest(docs, COLUMNS, settings=merkle.Settings(3, 3))
    plain = [(r.id, r.leaf, r.proof, r.steps, r.subroot, r.root) for r in got.collect()]
    assert sorted(plain, key=str) == sorted(expected(rows, 3), key=str)


def test_the_query(spark):
    from bazaarlake.llm.queries import QUERIES

    sample = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sample}/documents.parquet").collect()
    rows = [tuple(d[c] for c in COLUMNS) for d in docs]
    want = {w[0]: w for w in expected(rows, 3)}
    texts = {d.doc_id: d.text for d in docs}
    got = QUERIES["op13_merkle_manifest"](spark, sample).collect()
    assert len(got) == len(docs)
    for r in got:
        _, leaf, proof, _, subroot, root = want[r.doc_id]
        touched = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (leaf, subroot, root, digest(proof))
        assert r.verified == (not touched) == (r.folded_root == root)
