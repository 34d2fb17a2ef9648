"""Toxicity, quality and decontamination."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchcost.llm import decontaminate, quality, toxicity
from branchcost.llm.labelled import training_ids
from llm_fixtures import edge_rows, make_docs  # noqa: F401
from llm_words import words


# ---- toxicity


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_matches_like_edit_distance():
    rng = random.Random(2)
    terms = ["idiot", "moron", "scum", "trash", "idiocy", "ab", "abcdefg"]
    trie = toxicity.FuzzyTrie(terms)
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "x", "i", "o"])
        w = "".join(w)
        if not w:
            continue
        ok = [(_distance(w, t), t) for t in terms if w == t or (len(t) >= 5 and _distance(w, t) <= 1)]
        got = trie.match(w)
        assert (got is None) == (not ok), (w, got, ok)
        if ok:
            assert got[1] == min(ok)[0]


def test_stems_match_words_that_begin_with_them():
    trie = toxicity.FuzzyTrie(["trash"], ["lowe"])
    assert trie.match("lowei") == ("lowe*", 0) and trie.match("lowe") == ("lowe*", 0)
    assert trie.match("low") is None and trie.match("slowe") is None
    assert trie.match("trasch") == ("trash", 1)


def _toxic_corpus(spark, make_docs, n=600):
    bad = ["idiot", "moron", "trash", "clown"]
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        body = words(i, 60, 200).split()
        kind = i % 4
        if kind == 0:
            for _ in range(3):
                body.insert(rng.randrange(len(body)), rng.choice(bad))
        if kind == 1:  # quoted: not toxic
            body.insert(30, f'said "you {rng.choice(bad)}" loudly')
        rows.append((i, " ".join(body), "a"))
        labels.append((i, 1, int(kind == 0)))
    return make_docs(rows, clash=True), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_tells_abuse_from_quotation_and_finds_misspellings(spark, make_docs):
    docs, labels = _toxic_corpus(spark, make_docs)
    model = toxicity.train_model(docs, labels, F.col("doc_id") % 5 != 0)
    assert {"idiot", "moron", "trash", "clown"} <= set(model.terms)
    scored = docs.withColumn("s", toxicity.score_column(docs, model)).join(labels, "doc_id")
    held = scored.where("doc_id % 5 = 0").select("toxic", "s").collect()
    assert np.mean([(r["s"] >= 0.5) == (r["toxic"] == 1) for r in held]) >= 0.95
    odd = make_docs([(1, words(9, 40) + " you idlot, you morron, tra5h " + words(8, 20), "a"), (2, words(7, 60), "a")])
    s = {r["doc_id"]: r["s"] for r in odd.withColumn("s", toxicity.score_column(odd, model)).collect()}
    assert s[1] > s[2]


def test_toxicity_edge_cases(spark, make_docs, edge_rows):
    docs, labels = _toxic_corpus(spark, make_docs, 200)
    model = toxicity.train_model(docs, labels)
    edge = make_docs(edge_rows, clash=True)
    scores = edge.select("text", toxicity.score_column(edge, model).alias("s")).collect()
    assert len(scores) == len(edge_rows) and all(0 <= r["s"] <= 1 for r in scores)
    empty = {r["s"] for r in scores if not r["text"]}
    assert len(empty) == 1  # null and empty alike
    left = toxicity.drop_toxic(edge, model)
    assert left.columns == edge.columns and left.count() == len(edge_rows)
    assert toxicity.drop_toxic(make_docs([]), model).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, 1, None), (None, 0, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_models_without_both_classes(spark, make_docs, rows):
    docs = make_docs([(1, "a b", "s"), (2, "c d", "s")])
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    for module, col in ((toxicity, "toxic"), (quality, "quality")):
        model = module.train_model(docs, labels, label_col=col)
        scores = [r[0] for r in docs.select(module.score_column(docs, model)).collect()]
        assert len(scores) == 2 and all(0 <= s <= 1 for s in scores)


def test_sample_bound_ties_and_repeated_labels(spark):
    rows = [(i, i % 3 == 0) for i in range(90)] + [(1, True), (None, True), (2, None)]
    labels = spark.createDataFrame([(i, None if y is None else int(y)) for i, y in rows], "doc_id bigint, y int")
    ids, weights = training_ids(labels, "y", F.lit(True), 10)
    got = ids.collect()
    assert len(got) == 20 and len({r["train_id"] for r in got}) == 20
    assert weights == {0: 5.9, 1: 3.1}  # id 1 takes its larger label


# ---- quality


def test_quality_held_out_accuracy(spark, make_docs):
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        text = words(i, 80) + ". And so it is." if good else " | ".join(words(i, 40).split()) + " %%% $$$"
        if i % 8 == 0:
            text = "same " * 60 + words(i, 5)
        rows.append((i, text, "a"))
        labels.append((i, int(good), 0))
    docs = make_docs(rows, clash=True)
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.train_model(docs, labels, F.col("doc_id") % 3 != 1)
    got = docs.select("doc_id", quality.score_column(docs, model).alias("s")).join(labels, "doc_id").where("doc_id % 3 = 1")
    assert np.mean([(r["s"] >= 0.5) == (r["quality"] == 1) for r in got.collect()]) >= 0.97


def test_quality_edge_cases_and_pieces(make_docs, edge_rows, monkeypatch):
    model = quality.fit([words(i, 30) for i in range(6)], [0, 1] * 3, {0: 1.0, 1: 1.0}, buckets=1 << 10)
    docs = make_docs(edge_rows, clash=True)
    got = docs.select("text", quality.score_column(docs, model).alias("s")).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["s"] <= 1 for r in got)
    assert len({r["s"] for r in got if not r["text"]}) == 1
    for r in got:
        assert r["s"] == pytest.approx(quality.score(r["text"], model))
    texts = [words(4, 3000), "é" * 40 + "ABC x", "x" * 33, "a b", " ", "ab" * 17 + " a", *(r[1] for r in edge_rows if r[1])]
    for text in texts:
        text = text[:20_000]
        whole = Counter(np.concatenate([*quality.hashed_features(text), np.zeros(0, int)]).tolist())
        # brute force of the number of features: n-grams, words, a word twice in a row
        found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        grams = sum(max(0, len(text) - k + 1) for k in quality.GRAMS)
        assert sum(whole.values()) == grams + len(found) + sum(a == b for a, b in zip(found, found[1:]))
        for piece in (1, 2, 3, 16, 17, 1000):  # the features do not depend on the pieces
            if piece > 3 or len(text) < 200:
                monkeypatch.setattr(quality, "PIECE", piece)
                assert Counter(np.concatenate([*quality.hashed_features(text), np.zeros(0, int)]).tolist()) == whole
        monkeypatch.undo()
    assert [b.tolist() for b in quality.bag_of("Äb äb", 1 << 10)] != [b.tolist() for b in quality.bag_of("Äb ob", 1 << 10)]


# ---- decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _brute(text, items, window=13):
    w = WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item_id, body in items:
        b = WORD.findall((body or "").translate(LOWER))
        if item_id is None or not b:
            continue
        n = min(window, len(b))
        windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                ids.add(str(item_id))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("shard_nodes", [1 << 20, 300])
def test_decontamination_against_brute_force(spark, make_docs, edge_rows, shard_nodes):
    items = [(i, words(50 + i, 20 + i)) for i in range(6)]
    items += [(10, "Short, ITEM!"), (2, words(52, 22)), (11, None), (12, "..."), (None, words(60, 30)), (13, words(51, 21))]
    body = items[1][1].upper().split()
    rows = edge_rows + [
        (20, words(70, 30) + " " + ", ".join(body[2:18]) + " " + words(71, 50), "a"),
        (21, " ".join(body[:12]), "a"),
        (22, " ".join(body[:13]), "a"),
        (23, "a short\nitem here, shorter item", "a"),
        (24, items[3][1] + items[4][1], "a"),
        (25, items[0][1] + " " + items[0][1], "a"),
        (26, "short item " * 30, "a"),
        (27, words(80, 400) + " short item", "a"),
    ]
    docs = make_docs(rows, clash=True)
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "2 AS body")
    found = decontaminate.with_hits(docs, bench, "found", shard_nodes=shard_nodes)
    assert found.columns == [*docs.columns, "found"]
    got = found.select("text", "found", decontaminate.items_digest(F.col("found.items")).alias("d"),
                       decontaminate.is_contaminated(F.col("found")).alias("c")).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, ids = _brute(r["text"], items)
        f = r["found"]
        assert (f["n_words"], f["n_hit"], f["items"]) == (n, hit, ids), r["text"]
        assert r["d"] == decontaminate.digest_of(ids) and r["c"] == (hit > 0 and 20 * hit >= n)
        covered = sum(len(WORD.findall(r["text"].translate(LOWER)[int(a) : int(b)])) for a, b in (s.split(":") for s in f["spans"]))
        assert covered == hit
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r["c"] for r in got)


def test_decontamination_of_empty_tables(spark, make_docs, edge_rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(make_docs(edge_rows), none).count() == len(edge_rows)
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(make_docs([]), some).collect() == []


def test_decontamination_of_a_long_item_and_the_size_of_its_automata(spark, make_docs):
    long = [f"w{i}" for i in range(10_000)]
    bench = spark.createDataFrame([("long", " ".join(long)), ("short", "one two")], "item_id string, text string")
    cuts = [(0, 13), (4_090, 4_103), (4_095, 4_115), (4_100, 4_112), (8_185, 8_210), (9_987, 10_000)]
    docs = make_docs([(i, "x " + " ".join(long[a:b]) + " y", "a") for i, (a, b) in enumerate(cuts)])
    parts = decontaminate.pieces(bench.toDF("item", "body"), 13).collect()
    for part in parts:
        auto = decontaminate.Matcher([(part["item"], [bytes(w) for w in part["words"]])], 13).auto
        assert auto.get_stats()["nodes_count"] <= part["nodes"] + 1
    assert sum(p["nodes"] for p in parts) == 2 * 13 * 9_988 + 4
    for nodes in (2_000_000, 60_000):
        hit = decontaminate.with_hits(docs, bench, "f", shard_nodes=nodes).select("doc_id", "f.n_hit", "f.items").collect()
        got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in hit}
        assert got == {i: (b - a, ["long"]) if b - a >= 13 else (0, []) for i, (a, b) in enumerate(cuts)}
