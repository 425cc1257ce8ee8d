"""Every operator against a brute-force version, on rows with all the awkward cases."""

import base64
import collections
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from bazaarlake.llm import (
    attribution,
    codes,
    decontam,
    gru,
    language_model,
    mixing,
    quality,
    secrets,
    simhash,
    similar,
    substrings,
    warc,
)
from bazaarlake.llm.oracles import ORACLES
from bazaarlake.llm.queries import QUERIES
from bazaarlake.llm.tokens import Encoder, tokenizer_path
from oracle.check import database, difference

SAMPLE = "/root/testdata/sf0.001"
# The extra columns have names the operators use themselves.
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, row int, n int"


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(words * rng.random() ** 2)}x" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage = prose(99, 60)
    texts = [prose(i, 80) for i in range(20)]
    texts += [texts[3], texts[3] + " tail", texts[4].upper(), None, "", "  \n ", "one", None]
    texts += [prose(50, 30) + " " + passage + " " + prose(51, 9), passage, prose(52, 4000, 9000)]
    texts += ["Été ñ 日本 語\t\n\n x", "a " * 90, "line one two three\n" * 40, texts[3]]
    out = []
    for i, text in enumerate(texts):
        source = [None, "b", "é", "a"][i % 4]
        out.append((i, text, ["en", None][i % 7 == 0], source, None, i, i, i))
    out[-1] = (3, *out[-1][1:])  # a row again, under the same id
    out.append((None, texts[0] + " null id", None, None, None, None, None, None))
    return out


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DDL)


def words_of(text):
    return (text or "").encode().split()


def test_no_rows(spark, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    results = [
        attribution.count(empty, tokenizer_path()),
        codes.read(codes.write(empty, tokenizer_path(), 2)),
        secrets.scan(empty),
        language_model.scores(empty),
        substrings.repeats(empty),
        decontam.find(empty, items),
        decontam.clean(empty, items),
        simhash.near_groups(empty),
        simhash.keep_one(empty),
        mixing.mix(empty),
        mixing.mixed(empty),
        quality.verdicts(empty),
        warc.read(warc.write(empty.select("doc_id", "lang", "text"), id_col="doc_id", url_col="lang", html_col="text")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


# ---- 1 and 2: tokens


def test_units_encode_as_whole_texts():
    encoder, lib = Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = ["", " ", "a  b", "a \n b", " x", "x ", "it's  I'll\n\n b", "<|endoftext|> x", "a\t b"]
    texts += ["a 　b", "don't stop 12a !?x", "É é́ ñ日本 語 x", "a \tb", "\n a", "x.\nY z"]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    small = Encoder(tokenizer_path(), keep=5)
    for i in range(30):
        text = prose(i, 12)
        ids = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == ids


def test_new_units_take_few_calls_of_the_library():
    encoder, lib = Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    calls, encode = [], encoder.lib.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **how):
            calls.append(len(texts))
            return encode(texts, **how)

        def __getattr__(self, name):
            return getattr(lib, name)

    encoder.lib = Counted()
    units = [f"u{n:x}" for n in range(12_000)]
    texts = [" ".join(["x", *units]), f"a {encoder.special[0]} b{encoder.special[0]}c d\u2003 \u2003e \x1cf"]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    assert len(calls) <= 4


@pytest.mark.parametrize("rule", attribution.RULES)
def test_section_tokens_add_up(docs, rows, rule):
    lib = Tokenizer.from_file(tokenizer_path())
    got = collections.defaultdict(float)
    for r in attribution.count(docs, tokenizer_path(), rule=rule).collect():
        got[r["id"]] += r["tokens"]
    want = collections.Counter()
    for r in rows:
        want[r[0]] += len(lib.encode(r[1] or "", add_special_tokens=False).ids)
    assert {k: round(v, 6) for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_boundary_rules():
    tokens = (np.array([0, 4]), np.array([4, 6]))  # the first token crosses at 1
    sections = (np.array([0, 1, 4]), np.array([1, 4, 5]))
    assert attribution.allocate(tokens, sections, "majority")[0].tolist() == [0, 1, 1, 0]
    assert attribution.allocate(tokens, sections, "start")[0].tolist() == [1, 0, 1, 0]
    assert attribution.allocate(tokens, sections, "split")[0].tolist() == [0.25, 0.75, 0.5, 0.5]
    assert attribution.allocate(tokens, sections, "split")[1].tolist() == [1, 1, 1, 0]


def test_named_sections(spark):
    rows = [(1, "Titre été\nbody text here", [("t", 0, 9), ("b", 10, 99)]), (2, "abc", None)]
    ddl = "doc_id int, text string, s array<struct<name: string, first: int, end: int>>"
    got = attribution.count(spark.createDataFrame(rows, ddl), tokenizer_path(), sections="s")
    names = {(r["id"], r["name"]): r["tokens"] for r in got.collect()}
    assert names[1, "b"] == 3 and names[1, "t"] > 2 and names[2, None] >= 1


@pytest.mark.parametrize("widths", [(8, 8, 16), (16, 16), (8, 8, 8, 8), (32,)])
def test_codes_give_random_access(tmp_path, widths):
    rng = np.random.default_rng(1)
    ids = (rng.integers(0, 2**32, 3000) >> rng.integers(0, 32, 3000)).astype(np.uint32)
    path = str(tmp_path / "x.dac")
    with open(path, "wb") as file:
        file.write(b"".join(codes.shard_parts([7, None], [1000, 3000], ids, widths)))
    shard = codes.Shard(f"file:{path}")
    assert np.array_equal(shard.all(), ids)
    for at in [0, 1, 511, 512, 513, 2999, *rng.integers(0, 3000, 50).tolist()]:
        assert shard.token(at) == ids[at]
    assert shard.documents()[0] == [7, None]


def test_token_files_round_trip(docs, rows):
    lib = Tokenizer.from_file(tokenizer_path())
    manifest = codes.write(docs, tokenizer_path(), 2, shard_tokens=500, rows_per_task=10)
    got = sorted(codes.read(manifest).collect(), key=lambda r: r["start"])
    at, seen = 0, []
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"], r["crc32"]) == (at, len(ids), zlib.crc32(r["ids"]))
        at += len(ids)
        seen.append((r["id"], ids.tolist()))
    want = [(r[0], lib.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows]
    assert sorted(seen, key=str) == sorted(want, key=str)
    order = [-1 if i is None else i for i, _ in seen]
    assert order == sorted(order) and manifest.count() > 3


@pytest.mark.parametrize("words", [16, 24, 38, 58])
def test_items_at_the_start_of_texts_of_one_batch(words):
    item = prose(700 + words, words, 5000)
    texts = [(prose(800 + i, 1 + i % 13) + " " if i % 2 else "") + item for i in range(200)]
    texts = [t + " " + prose(i, i % 29) for i, t in enumerate(texts)]
    index = decontam.Index([(1, item.encode())], decontam.Settings())
    got = {hit[0]: hit[2:] for hit in index.search([t.encode() for t in texts])}
    assert got == {i: (0, 1 + i % 13 if i % 2 else 0, words) for i in range(200)}


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "春天的花园里有许多美丽的蝴蝶在飞舞"
    items = [(1, "Who wrote Hamlet?"), (2, "Paris"), (3, chinese), (4, "東京都"), (5, "... !"), (6, "who WROTE hamlet")]
    texts = [
        "a test: who wrote hamlet, and when; who wrote Hamlet again",
        "who wrote the Hamlet",
        "far (Paris) away who wrote",
        "Hamlet",  # the batch's texts do not run into each other
        "他说：" + chinese[:5] + "，" + chinese[5:] + "。",
        chinese[:6] + "很" + chinese[7:],  # one edit
        "私は東京都に住む",
        "東京の都",
        None,
        "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    table = spark.createDataFrame(items, "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontam.find(docs, table).collect()}
    assert got == {
        (0, 1): (0, 2, 3),
        (0, 6): (0, 2, 3),
        (2, 2): (0, 1, 1),
        (4, 3): (0, 2, 17),
        (5, 3): (1, 0, 17),
        (6, 4): (0, 2, 3),
    }
    assert sorted(r["doc_id"] for r in decontam.clean(docs, table).collect()) == [1, 3, 7, 8, 9]


# ---- 3: secrets


def test_secrets_from_labels(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(60)]
    texts = [f'some text token = "{h}" more' for h in hexes[:30]]
    texts += [f"see https://host.example/files/{h}/index.html now" for h in hexes[30:]]
    texts += [None, "", "plain words only", "x" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["id"]: r for r in secrets.scan(docs).collect()}
    assert all(got[i]["kept"] for i in range(30))
    assert not any(got[i]["kept"] for i in range(30, 60)) and not got[63]["kept"]
    assert got[0]["transitions"] > 5 and got[0]["place"] == 4 and len(got) == 61


def test_every_run_of_a_word_is_a_candidate(spark):
    a, b = "0123456789abcdef0123456789abcdef01234567", "fedcba9876543210fedcba9876543210fedcba98"
    texts = [
        f'x {{"id":"{a}","secret":"{b}"}} y',
        f"k1:{a},k2:{b}",
        f"https://host.example/files/aaaaaaaaaaaaaaaaaaaaaaa/x.html?token={b}",
        "my password = hunter2x ok",
        'password="hunter2x", user=somebody1',
        "password=hunter2x",
        '{"user":"somebody1","password":"hunter2x"}',
        "no password is here somewhere2",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in secrets.featured(secrets.candidates(docs), []).collect():
        got.setdefault(r["id"], []).append(r)
        word = texts[r["id"]].split()[r["place"]]
        assert word[r["offset"] :].startswith(r["finding"])
    found = {i: [r["finding"] for r in sorted(g, key=lambda r: r["offset"])] for i, g in got.items()}
    short = {i: ["hunter2x"] for i in (3, 4, 5, 6)}
    path = "example/files/aaaaaaaaaaaaaaaaaaaaaaa/x"
    assert found == {0: [a, b], 1: [a, b], 2: [path, f"token={b}"], **short}
    assert {r["finding"]: r["credential_word"] for r in got[0]} == {a: 0, b: 1}
    assert {r["finding"]: r["in_path"] for r in got[2]} == {path: 1, f"token={b}": 0}
    assert all(g[0]["credential_word"] == g[0]["assigned"] == 1 for i, g in got.items() if i >= 3)


def test_placeholders_count_in_the_own_field_only(spark):
    h = "0123456789abcdef0123456789abcdef01234567"
    texts = [
        f"mail bo@mail6.example.com token = {h} greatest",
        f"the latest contest token = {h} yourself",
        f"token = your_key_{h}",  # sure and a placeholder: no label
        f"id your_key_{h}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = secrets.featured(secrets.candidates(docs), [])
    assert {r["id"]: r["label"] for r in secrets.weak_labels(found).collect()} == {0: 1, 1: 1, 3: 0}


# ---- 4: language model


def test_language_model_counts(docs, rows):
    got = language_model.scores(docs, language_model.Settings(head=50, lanes=4)).collect()
    counts = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r[0]).encode()) % 10:
            counts.update([*[w.lower() for w in words_of(r[1])], None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        tokens = [*[w.lower() for w in words_of(r[1])], None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((r[0], len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)))
    mine = [
        (r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in got
    ]
    assert sorted(mine, key=str) == sorted(want, key=str)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_gradient_and_carried_state():
    rng = np.random.default_rng(0)
    classes, words = np.array([0, 0, 1, 1, 2, 3]), np.array([0, 2, 4, 5])

    def network():
        p = gru.start(6, 5, np.zeros(4), np.zeros(5))
        p |= {k: np.random.default_rng(1).standard_normal(p[k].shape).astype(np.float32) for k in ("cw", "ww")}
        return gru.Network(p, classes, words)

    docs = [rng.integers(0, 6, n).astype(np.int32) for n in (3, 150, 40)]
    alone = [network().score([d], 1)[0] for d in docs]
    assert np.allclose(network().score(docs, 2), alone, atol=1e-3)
    # All sequences of length 2: the probabilities add up to one (class 3 is open).
    pairs = [np.array([a, b], np.int32) for a in range(6) for b in range(6)]
    assert abs(np.exp(network().score(pairs, 8)).sum() - 1) < 1e-4
    net = network()
    squares = {k: np.full_like(v, 1e-4) for k, v in net.p.items()}
    before = net.score(docs, 2).sum()
    for _ in range(30):
        net.train(docs, squares, 0.05, 3)
    assert net.score(docs, 2).sum() > before + 20


# ---- 5: substrings


def test_substrings_by_brute_force(docs, rows):
    window, counts = 35, collections.Counter()
    for r in rows:
        w = words_of(r[1])
        counts.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    want = []
    for r in rows:
        w = words_of(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    got = [
        (r["id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"])
        for r in substrings.repeats(docs).collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


# ---- 6: decontamination


def edits_to(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_by_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(200 + i, 12 + i)) for i in range(12)] + [(90, "too short"), (91, None)]
    texts = []
    for i, text in items[:12]:
        for n in range(0, len(text.split()) // 5 + 2):
            w = text.split()
            for _ in range(n):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.pop(at), lambda: w.insert(at, "new"), lambda: w.__setitem__(at, "x")])()
            texts.append(prose(rng.random(), 20) + " " + " ".join(w).upper() + ", " + prose(rng.random(), 9))
    texts += [None, "", prose(1, 900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    table = spark.createDataFrame(items, "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontam.find(docs, table).collect()}
    settings, want = decontam.Settings(), {}
    for d, text in enumerate(texts):
        words = decontam.normal_words((text or "").encode())
        for i, item in items[:12]:
            w = decontam.normal_words(item.encode())
            if (edits := edits_to(w, words)) <= settings.edits(len(w)):
                want[d, i] = edits
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want)
    assert all(got[k] == want[k] for k in got)
    left = {r["doc_id"] for r in decontam.clean(docs, table).collect()}
    assert left == set(range(len(texts))) - {d for d, _ in got}


# ---- 7: SimHash


def brute_groups(rows):
    fps = []
    for r in rows:
        w = [x.lower() for x in words_of(r[1])]
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            label[i] = min(label[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 2)
    least = {}
    for r, k in zip(rows, label):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    return [(r[0], f, least.get(k)) for r, f, k in zip(rows, fps, label)]


def test_simhash_by_brute_force(docs, rows):
    got = [(r["id"], r["fp"] % 2**64, r["component"]) for r in simhash.near_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(brute_groups(rows), key=str)


def test_vantage_tree_loses_no_link(spark):
    rng = np.random.default_rng(2)
    points = list(rng.integers(0, 2**64, 3000, np.uint64))
    for p in points[:700]:  # chains of near fingerprints
        for _ in range(int(rng.integers(1, 6))):
            for bit in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                p ^= np.uint64(1) << np.uint64(bit)
            points.append(p)
    centre = np.uint64(12345)  # a ball no vantage point divides
    points += [centre ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(64) for j in range(i)]
    points = np.unique(np.array(points, np.uint64))
    a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2, 1))
    want = simhash._settle(np.arange(len(points)), a, b)
    nodes = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    edges = simhash.links(nodes, shard_rows=400, sample=2000)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    sets = collections.defaultdict(set)
    for p in points.view(np.int64).tolist():
        sets[roots.get(p, p)].add(p)
    others = collections.defaultdict(set)
    for p, k in zip(points.view(np.int64).tolist(), want):
        others[k].add(p)
    assert {frozenset(s) for s in sets.values()} == {frozenset(s) for s in others.values()}


def test_texts_without_copies_meet_no_shuffle(spark, settings, tmp_path):
    rng = random.Random(8)
    rows = [(n, " ".join(rng.choices("abcdefghijklmnop", k=40))) for n in range(300)]
    rows += [(1000 + n, text) for n, text in rows[:20]]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    settings(autoBroadcastJoinThreshold="300")
    kept = similar.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [n for n, _ in rows[:300]]
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    joins = [row for row in plan.splitlines() if "Join" in row]
    assert sum("SortMergeJoin" in row for row in joins) == 1
    assert sum("BroadcastHashJoin" in row and "LeftAnti" in row for row in joins) == 1


def test_keep_one_of_each_group(docs, rows):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    groups = brute_groups(rows)
    kept = [r["doc_id"] for r in got.collect()]
    assert sorted(k for k in kept if k is not None) == sorted({g[2] for g in groups if g[2] is not None})


def test_near_duplicates_stage_by_brute_force(spark, docs, empty, rows):
    rng, texts, steps = random.Random(8), [], []
    for i in range(60):
        words = prose(400 + i, rng.randrange(60, 400), 5000).split()
        texts.append(" ".join(words))
        for edits in (0.004, 0.01, 0.02, 0.03):  # 5 shingles each
            copy = words[:]
            for _ in range(max(1, int(edits * len(words)))):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(texts)))
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                pairs.append((i, j, both / (len(a) + len(sets[j]) - both)))
    for _ in range(9):
        for i, j, _s in pairs:
            label[i] = label[j] = min(label[i], label[j])
    for low in (0.8, 0.85, 0.9):
        assert sum(low <= s < low + 0.05 for _, _, s in pairs) >= 10
    planted = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["id"]: r["component"] for r in similar.similar_groups(planted).collect()}
    assert found.keys() == set(range(len(texts)))
    assert all(label[i] == label[c] for i, c in found.items())  # nothing below 0.8 is linked
    assert sum(found[i] == found[j] for i, j, _ in pairs) >= 0.99 * len(pairs)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, planted, SAMPLE).collect()}
    assert kept == set(found.values())
    # Families above the bound are compared in blocks, with the same result.
    bounded = similar.similar_groups(planted, similar.Settings(most=4000)).collect()
    assert {r["id"]: r["component"] for r in bounded} == found
    assert similar.keep_one(empty).count() == 0
    same_set = collections.defaultdict(list)
    for r in rows:
        w = [x.lower() for x in words_of(r[1])]
        same_set[frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))].append(r[0])
    kept = [r["doc_id"] for r in similar.keep_one(docs).collect()]
    assert None not in kept and len(kept) == len(set(kept)) and {0, 3, 4, 23} <= set(kept)
    assert all(len(set(kept) & set(g)) <= 1 for g in same_set.values())


def test_near_duplicates_through_trees(spark):
    """Copies of near SimHashes are found without any MinHash band, and are still compared."""
    texts = []
    for i in range(40):
        text = prose(600 + i, 900, 5000)
        texts += [text, text + " tail of it"]
    # Equal SimHashes by the many repeats; of 5-word shingles less than 0.8 is shared.
    loop = "v w x y z " * 400
    texts += [loop + "b c", loop + "d e"]
    sets = [similar.shingles(t.encode(), 5) for t in texts]
    alike = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2])]
    bits = [simhash.fingerprint(t.encode(), 5) for t in texts]
    near = [(a ^ b).bit_count() <= 2 for a, b in zip(bits[::2], bits[1::2])]
    want = [2 * i + (not (n and s >= 0.8)) for i, (n, s) in enumerate(zip(near, alike))]
    assert near[-1] and alike[-1] < 0.8 and sum(near) > 20
    planted = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    # One band of 3000 rows: hardly ever shared.
    settings = similar.Settings(bands=1, rows=3000)
    found = {r["id"]: r["component"] for r in similar.similar_groups(planted, settings).collect()}
    assert [found[2 * i + 1] for i in range(41)] == want


def test_one_family_in_blocks(spark):
    """A chain of copies, each a little further from the first, and texts that only share a key with it."""
    rng, words, texts = random.Random(3), prose(1, 100, 5000).split(), []
    for i in range(400):
        if i % 4:
            words = [*words]
            words[rng.randrange(100)] = f"c{i}"
            texts.append(" ".join(words))
        else:  # a half of the chain's words
            texts.append(" ".join([*words[:50], *prose(i, 50, 90000).split()]))
    sets = [similar.shingles(t.encode(), 5) for t in texts]
    want = similar.linked(sets, 8000)
    planted = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for settings in (similar.Settings(rows=2, most=10**9), similar.Settings(rows=2, most=50_000)):
        found = {r["id"]: r["component"] for r in similar.similar_groups(planted, settings).collect()}
        assert [found[i] for i in range(400)] == want.tolist()
    assert len(set(want[1::4])) < 30 and len(set(want)) > 90


def test_bucket_units_are_bounded_and_meet_once(spark):
    rng = random.Random(5)
    settings = similar.Settings(most=60_000)
    rows = []
    for fp in range(1000):
        size = rng.choice([5, 50, 60, 75, 94, 400])
        keys = [1, 1000 + fp % 2] + ([7, 8] if fp < 20 else [9] if fp < 40 else [])
        # Key 9's sets are known to be alike; keys 7 and 8 hold the same sets.
        rows.append((fp, keys, size, size + similar.EACH, 20 if 20 <= fp < 40 else fp))
    sets = spark.createDataFrame(rows, "fp bigint, keys array<bigint>, size bigint, weight bigint, alike bigint")
    got = similar._bucket_units(sets, settings).collect()
    units = collections.defaultdict(list)
    for r in got:
        units[tuple(r["unit"])].append((r["fp"], r["side"]))
    weight = {r[0]: r[3] for r in rows}
    assert all(sum(weight[f] for f, _ in u) <= 4 * settings.most for u in units.values())
    met = collections.Counter()
    for name, members in units.items():
        for i, (a, x) in enumerate(members):
            for b, y in members[:i]:
                if x == 0 or x != y:
                    met[name[1], min(a, b), max(a, b)] += 1
    assert set(met.values()) == {1}
    assert {k for k, _, _ in met} == {1, 7, 1000, 1001}
    size = {r[0]: r[2] for r in rows}
    for key, holds in ((1, lambda f: True), (1000, lambda f: f % 2 == 0), (7, lambda f: f < 20)):
        held = [f for f in range(1000) if holds(f)]
        for i, b in enumerate(held):
            for a in held[:i]:
                if 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b]):
                    assert met[key, a, b] == 1


# ---- 8: mixing


def test_mix_follows_the_targets(docs, rows):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r["id"]), r["key"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words_of(r[1]))
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = {}, set(order)
    while True:
        rest = 1.5 * sum(size.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 2 * size[s] + 1e-9]
        if not over:
            target |= {s: level * weight[s] for s in left}
            break
        target |= {s: 2 * size[s] for s in over}
        left -= set(over)
    taken, longest = collections.Counter(), collections.Counter()
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in order)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)


# ---- 9: WARC


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least):
    pages = [(1, "http://a/", "<p>x</p>"), (2, "http://b/ \r\n", "<p>x</p>"), (3, None, None)]
    pages += [(4, "u", ""), (5, "u", "é" * 300_000), (6, "u", "a\r\n\r\nb"), (None, "u", "<p>x</p>"), (7, "u", "x"), (8, "u", "x")]
    index = warc.write(
        spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2),
        least=least,
        archive_bytes=300,
    )
    assert index.select("file").distinct().count() > 2
    newest = collections.defaultdict(lambda: -1)
    for i, _, html in pages:
        newest[html or ""] = max(newest[html or ""], -1 if i is None else i)
    got = {r["id"]: r for r in warc.read(index).collect()}
    for i, _, html in pages:
        data, r = (html or "").encode(), got[i]
        first = newest[html or ""] == i or len(data) < least
        assert r["payload_bytes"] == len(data) and (r["record_type"] == "response") == first
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["refers_to"] == (None if first else newest[html or ""])
        assert r["payload"] == ((html or "") if first else None)
    some = warc.read(index.filter("id % 3 = 0"), gap=0, with_payload=False)
    assert sorted(r["id"] for r in some.collect()) == [3, 6]


# ---- 10: quality


def test_quality_counts(docs, rows):
    got = quality.verdicts(docs).select("row.doc_id", "row.n", "counts", "base_failed", "kept").collect()
    for r in got:
        text = next(x[1] for x in rows if x[7] == r["n"] and x[0] == r["doc_id"]) or ""
        w = [x.decode() for x in text.encode().split()]
        grams = collections.defaultdict(list)
        for i in range(len(w) - 7):
            grams[tuple(w[i : i + 8])].append(i)
        covered = {j for v in grams.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        c = r["counts"]
        assert (c["n_words"], c["n_repeat_words"], c["word_chars"]) == (len(w), len(covered), sum(map(len, w)))
        assert c["n_dup_lines"] == len(lines) - len(set(lines))
        assert c["n_echoes"] == sum(a == b for a, b in zip(w, w[1:]))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert quality.keep_good(docs).columns == docs.columns


def test_labelled_documents(spark):
    """Words repeated in a row go however few; labelled good documents stay."""
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet").select("doc_id", "quality")
    got = quality.verdicts(docs, columns=["doc_id"]).filter("not base_failed").select("row.doc_id", "kept")
    count = collections.Counter((r["quality"], r["kept"]) for r in got.join(labels, "doc_id").collect())
    assert count[1, True] > 20 and not count[1, False] and not count[0, True]
    good = [(i, prose(i, 80), "en", "a") for i in range(300)]
    bad = [(900 + i, " ".join(f"b{j}{i} " * (4 + i) for j in range(12)).strip(), "en", "a") for i in range(4)]
    planted = spark.createDataFrame(good + bad, "doc_id int, text string, lang string, source string")
    assert {r[0] for r in quality.keep_good(planted).select("doc_id").collect()} == set(range(300))


def test_sketches_merge_and_bound_the_error(spark):
    values = spark.range(1, 5001).select((F.col("id") % 3).alias("g"), (F.col("id") * 7).alias("m"))
    fine = quality.sketch(values, ["g"], ["m"])
    whole = quality.quartiles(quality.merge(fine, []), []).first()
    direct = quality.quartiles(quality.sketch(values, [], ["m"]), []).first()
    assert whole == direct and whole["n"] == 5000
    for q, exact in (("q1", 7 * 1250), ("q3", 7 * 3750)):
        assert exact * (1 - 1 / 16) <= whole[q] <= exact


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SAMPLE), ORACLES[name], database(SAMPLE)) == ""


def test_queries_name_the_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# ---- the pipeline


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    before, ids = docs, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, before, SAMPLE)
        assert got.columns == docs.columns, name
        got.write.parquet(str(tmp_path / name))
        before = spark.read.parquet(str(tmp_path / name))
        now = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert now <= ids and now, name
        ids = now
    last = corpus_pipeline.STAGES[-1][1](spark, before, SAMPLE).collect()
    want = collections.Counter(r["doc_id"] for r in before.collect())
    assert collections.Counter(r["doc_id"] for r in last) == want


def test_codes_reach_workers_without_the_package(tmp_path):
    """The package is on the driver's path only."""
    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
from pyspark.sql import SparkSession
from bazaarlake.llm.queries import QUERIES
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.checkpoint.dir", {str(tmp_path)!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in {[q for q in QUERIES if q.startswith(("op1_", "op2_", "op11_", "op12_", "op13_"))]!r}:
    assert QUERIES[name](spark, {SAMPLE!r}).count() > 0, name
print("all of them")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all of them" in done.stdout, done.stderr[-3000:]


def test_portions_keep_every_text_in_order():
    texts = ["", "a" * 5, "bb", "c" * 20, "", "d"]
    for most in (1, 7, 100):
        got = list(codes._portions(texts, most))
        assert [t for part in got for t in part] == texts
        assert all(len(part) == 1 or sum(map(len, part)) <= most for part in got)
    assert list(codes._portions([])) == []
