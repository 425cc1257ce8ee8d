"""The filter audit against a walk through every order, and its tries."""

import itertools
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlake.llm import filter_audit
from bazaarlake.llm.oracles import ORACLES
from bazaarlake.llm.queries import QUERIES
from bazaarlake.llm.tries import Trie
from oracle.check import database, difference

DDL = "doc_id bigint, text string, source string, key string, part int, n int"
SAMPLE = "/root/testdata/sf0.001"


def failures(text, copy):
    words = text.encode().split()
    rules = [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        any(c in "#$%&*|" for c in text),
        copy,
    ]
    return {letter for letter, broken in zip("ABCDE", rules) if broken}


def expected(rows, labels):
    """One document at a time through all orders."""
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, shapley = defaultdict(lambda: [0] * 6), defaultdict(int)
    parts = {r[2] or "" for r in rows}
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for i, text, source, *_ in rows:
        text, part = text or "", source or ""
        fails = failures(text, i is not None and i > least[text])
        for order in orders:
            gone = False
            for step, letter in enumerate(order, 1):
                cell = out[part, order, step]
                hit = letter in fails
                if hit and not gone:
                    cell[1] += 1
                    cell[4] += i in good
                    cell[5] += i in toxic
                    shapley[part, letter] += 1
                    gone = True
                elif hit:
                    cell[2] += 1
                cell[0] += not gone
                cell[3] += fails == {letter}
    return sorted(
        (part, order, step, *out[part, order, step], shapley[part, order[step - 1]])
        for part in parts
        for order in orders
        for step in range(1, 6)
    )


def rows_of(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ABC", "%", "Été", "日本"]
    shared = " ".join(rng.choices(vocabulary, k=300))
    texts = [None, "", " \n ", shared, shared + "x", shared[:-1], "one", "A", "é" * 40, "x" * 100_000]
    texts += [shared[:200] + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(120))) for _ in range(30)]
    texts += [" ".join(f"u{j}{i}" for j in range(70)) for i in range(5)]
    sources = [None, "", "a", "b"]
    ids = [None, *range(n)]
    return [(rng.choice(ids), rng.choice(texts), rng.choice(sources), "k", 1, 2) for _ in range(n)]


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (5, 1, 1), (999, 1, 1)]


def audited(spark, rows, labels, rules, parts):
    docs = spark.createDataFrame(rows, DDL).repartition(parts)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs, marks, rules)
    assert got.columns[:3] == ["part", "filter_order", "step"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize(
    "rules",
    [
        filter_audit.Settings(),
        filter_audit.Settings(trie_bytes=300, prefix=2, longer=2),  # longer prefixes, many tries
        filter_audit.Settings(trie_rows=3),
    ],
)
def test_equals_a_walk_through_every_order(spark, rules):
    rows = rows_of(5, 150)
    assert audited(spark, rows, LABELS, rules, 4) == expected(rows, LABELS)


def test_a_third_of_all_rows_are_one_text(spark):
    rows = rows_of(6, 200) + [(i, "one text " * 30, "hot", "k", 1, 2) for i in range(1000, 1100)]
    rows += [(7, "one row", "hot", "k", 1, 2)] * 50  # no copies of each other
    assert audited(spark, rows, LABELS, filter_audit.Settings(), 6) == expected(rows, LABELS)


def test_a_copy_is_one_row_a_task_in_the_shuffle(spark):
    docs = spark.createDataFrame([(i, "same text", "a", "k", 1, 2) for i in range(1000)], DDL)
    slim = docs.repartition(4).selectExpr("doc_id AS id", "source AS part", "text")
    rows = filter_audit._per_task(slim, filter_audit.Settings()).filter("text IS NOT NULL")
    assert rows.count() <= 4


def test_no_rows_and_no_labels(spark):
    empty = spark.createDataFrame([], DDL)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(empty, none).collect() == []
    rows = rows_of(8, 40)
    assert audited(spark, rows, [], filter_audit.Settings(), 2) == expected(rows, [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.text("ab", max_size=7)), max_size=40))
def test_trie_holds_the_smallest_id_of_every_text(pairs):
    trie, least = Trie(), {}
    for ident, text in pairs:
        trie.insert(text.encode()).add(ident, None)
        least[text.encode()] = min(ident, least.get(text.encode(), ident))
    assert {text: t.least for text, t in trie.terminals()} == least
    assert trie.bytes <= sum(map(len, least))
    stack = [trie.root]
    while stack:  # compressed: no node without a text or a fork, but the root
        node = stack.pop()
        assert node is trie.root or node.terminal is not None or len(node.children) > 1
        stack += node.children.values()


def test_query_equals_its_sql(spark):
    name = "op11_filter_audit"
    assert difference(QUERIES[name](spark, SAMPLE), ORACLES[name], database(SAMPLE)) == ""
