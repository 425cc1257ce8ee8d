"""What the language model's scores and the secret scan's sample promise."""

import random

import numpy as np
import pyarrow as pa
import pytest

from bazaarlake.llm import gru, language_model, secrets


def _texts(n, seed=1):
    """Sentences whose words follow each other: what a unigram model cannot see."""
    rng = random.Random(seed)
    after = {f"w{i}": [f"w{rng.randrange(300)}" for _ in range(3)] for i in range(300)}
    out = []
    for _ in range(n):
        word, text = "w0", []
        for _ in range(rng.randrange(40, 160)):
            word = rng.choice(after[word])
            text.append(word)
        out.append(" ".join(text))
    return out


def _scored(spark, parts, task_bytes):
    docs = spark.createDataFrame(list(enumerate(_texts(1200))), "doc_id bigint, text string")
    settings = language_model.Settings(task_bytes=task_bytes)
    rows = language_model.scores(docs.repartition(parts), settings).collect()
    return {r["id"]: r for r in rows}


@pytest.mark.parametrize("task_bytes", [32 << 20, 100_000])
def test_scores_do_not_depend_on_the_layout_and_beat_the_base(spark, task_bytes):
    one, *others = (_scored(spark, parts, task_bytes) for parts in (1, 8, 64))
    held = [r for r in one.values() if r["held_out"]]
    n = sum(r["n_tokens"] for r in held)
    gain = sum(r["score"] - r["base_score"] for r in held) / n
    assert gain > (0.2 if task_bytes > 1 << 20 else 0.02)
    for other in others:
        assert all(abs(r["score"] - one[i]["score"]) < 1e-3 * abs(one[i]["score"]) for i, r in other.items())
        assert all(abs(r["base_score"] - one[i]["base_score"]) < 1e-9 for i, r in other.items())


def test_gradient_of_the_network():
    """Against differences of the loss, for a window of documents that begin within it."""
    rng = np.random.default_rng(0)
    classes, words = np.array([0, 0, 0, 1, 1, 2, 3, 4]), np.array([0, 3, 5, 6])
    docs = [rng.integers(0, 8, n).astype(np.int32) for n in (5, 3, 7)]
    start = gru.start(8, 4, np.zeros(5), np.zeros(6))
    start = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in start.items()}

    def loss(parameters):
        return -gru.Network(parameters, classes, words).score(docs, 2).sum() / (2 * gru.WINDOW)

    moved = {k: v.copy() for k, v in start.items()}
    squares = {k: np.zeros_like(v) for k, v in start.items()}
    gru.Network(moved, classes, words).train(docs, squares, 0.0, 2)
    for name, value in start.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            change = {}
            for sign in (1, -1):
                other = {k: v.copy() for k, v in start.items()}
                other[name][at] += np.float32(sign * 0.01)
                change[sign] = loss(other)
            slope = (change[1] - change[-1]) / 0.02
            assert abs(abs(slope) - np.sqrt(squares[name][at])) < 0.02 * abs(slope) + 2e-4, name


def test_one_finding_repeated_beyond_the_sample_decides_nothing_else(spark):
    rng = random.Random(9)
    secret = "".join(rng.choices("0123456789abcdef", k=40))
    texts = [f'token = "{secret}" again'] * 300
    plain = ["".join(rng.choices("abcdefghijklmnop", k=30)) for _ in range(20)]
    texts += [f"a long {word} here" for word in plain]
    texts += [f'key secret: "{"".join(rng.choices("0123456789abcdef", k=40))}"' for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {r["id"]: r["kept"] for r in secrets.scan(docs, most_labelled=50).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 320))


def test_a_text_is_split_once_whatever_its_blanks_are():
    texts = [b"", b" ", b"\x0bA b\tA ", "Ä\x85 b\x1cc\u2003d".encode(), b"\r\n", b"a"]
    raw = b"".join(texts)
    packed = pa.Codec("zstd").compress(raw, asbytes=True)
    lengths = [len(t) for t in texts]
    batch = pa.RecordBatch.from_pylist(
        [{"ids": [1, 2, 3, 4, 5, 6], "chunk": 7, "data": packed, "size": len(raw), "lengths": lengths}]
    )
    coded = pa.Table.from_batches(language_model._code([batch]))
    ((chunk, ids, words),) = language_model._rows(coded)
    assert (chunk, ids) == (7, [1, 2, 3, 4, 5, 6]) and len(set(words.distinct)) == len(words.distinct)
    got = [[words.distinct[p] for p in words.of(i)] for i in range(6)]
    assert got == [t.lower().split() for t in texts]


def test_large_logits_are_scored_and_learned_from():
    classes, cuts = np.array([0, 0, 1, 2, 3]), np.array([0, 2, 3])
    docs = [np.array([0, 1, 2, 3], np.int32), np.array([4, 3], np.int32)]
    wide = gru.start(5, 4, np.array([0, 200.0, 0, -200]), np.array([150.0, 0, 0]))
    network = gru.Network(wide, classes, cuts)
    assert np.isfinite(network.score(docs, 2)).all()
    network.train(docs, {k: np.full_like(v, 1e-5) for k, v in wide.items()}, 0.05, 2)
    assert all(np.isfinite(v).all() for v in wide.values())
