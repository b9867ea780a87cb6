import random
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import minhash, registry
from tests.llm.cases import ODD_TEXTS, documents, save, words

SF = "/root/testdata/sf0.001"


def bag(text, size=5):
    w = words(text)
    runs = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] or ([tuple(w)] if w else [])
    return Counter(runs)


def brute_classes(docs):
    """Smallest id of each document's class, and all pairs' similarities near the bound."""
    bags = {i: bag(t) for i, t in docs}
    held = Counter(r for b in bags.values() for r in b)
    weight = {r: 1 + log(len(docs) / max(2, n)) for r, n in held.items()}
    weighted = {i: {r: c * weight[r] for r, c in b.items()} for i, b in bags.items()}
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    texts = dict(docs)
    by_run = {}
    for i, b in weighted.items():
        for r in b:
            by_run.setdefault(r, []).append(i)
    candidates = {(a, b) for ids in by_run.values() for a in ids for b in ids if a < b}
    same = {}
    for i, t in docs:
        same.setdefault(t or "", []).append(i)
    candidates |= {(ids[0], i) for ids in same.values() for i in ids[1:]}
    for a, b in candidates:
        x, y = weighted[a], weighted[b]
        shared = sum(min(v, y[r]) for r, v in x.items() if r in y)
        whole = sum(x.values()) + sum(y.values()) - shared
        if (texts[a] or "") == (texts[b] or "") or (whole and shared >= 0.8 * whole):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in docs}


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.kept) for r in registry.op7_minhash(spark, SF).collect()}
    expected = brute_classes(docs)
    assert {i: c for i, (c, _) in got.items()} == expected
    assert {i for i, (_, k) in got.items() if k} == set(expected.values())
    assert len(set(expected.values())) < len(docs)


@pytest.fixture
def varied():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, texts = prose(120), []
    for _ in range(60):  # a group of near copies, linked to each other or by way of others
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    footer = " ".join(prose(30))
    texts += [" ".join(prose(rng.randrange(20, 80))) + " " + footer for _ in range(40)]
    texts += [" ".join(prose(rng.randrange(3, 200))) for _ in range(60)]
    return [*texts, *ODD_TEXTS, *ODD_TEXTS, *["same text for many"] * 30, "same text, for MANY!"]


def test_groups_and_odd_rows(spark, tmp_path, varied):
    save(documents(spark, varied), tmp_path, "documents")
    got = {r.doc_id: r.class_id for r in registry.op7_minhash(spark, str(tmp_path)).collect()}
    assert got == brute_classes(list(enumerate(varied)))


def test_one_of_each_class_stays(spark, varied):
    df = documents(spark, varied)
    df = df.unionByName(df.limit(5))
    kept = minhash.kept_documents(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(set(brute_classes(list(enumerate(varied))).values()))


def test_samples_agree_as_the_similarity():
    """The draws come from a table; over many pairs the agreement has no bias, at several similarities."""
    rng = np.random.default_rng(2)
    usual, pairs, size = 6.2, 4000, 120
    for shared in (60, 90, 110):
        runs = rng.integers(0, 2**63, (pairs, 2 * size - shared)).astype(np.uint64)
        weight = usual * rng.choice([1, 1, 1, 2, 3, 0.4], runs.shape)
        rows, hashes, weights, expected = [], [], [], []
        for i in range(pairs):
            for part in (slice(0, size), slice(size - shared, 2 * size - shared)):
                rows.append(np.full(size, len(rows)))
                hashes.append(runs[i, part])
                weights.append(weight[i, part])
            expected.append(weight[i, size - shared : size].sum() / weight[i].sum())
        drawn = minhash.samples(np.concatenate(rows), np.concatenate(hashes), np.concatenate(weights), 2 * pairs, usual)
        agreed = (drawn[::2] == drawn[1::2]).mean(1)
        assert abs(agreed.mean() - np.mean(expected)) < 0.005
        # and spreads as that many independent samples do
        spread = np.sqrt(np.mean((agreed - expected) ** 2)) / np.sqrt(np.mean(np.array(expected) * (1 - np.array(expected))) / minhash.SAMPLES)
        assert 0.9 < spread < 1.1


def test_bags_in_parts_equal_one_part(monkeypatch, varied):
    column = pa.array([*varied, "one two " * 900], pa.string())
    whole = minhash.bags(column)
    monkeypatch.setattr(minhash, "TEXT_BYTES", 500)
    for a, b, c in zip(whole, minhash.bags(column), minhash.bags(column.cast(pa.large_string()))):
        assert np.array_equal(a, b) and np.array_equal(a, c)


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert registry.op7_minhash(spark, str(tmp_path)).collect() == []


def test_rare_runs_weigh_by_their_documents(spark):
    """A footer that fewer than 1 % of the documents share: alike by count, not by weight."""
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    footer = prose(104)
    texts = [f"{prose(10)} {footer}" for _ in range(40)] + [prose(6) for _ in range(8000)]
    texts += [(pair := prose(60)), pair + " " + prose(1)]
    df = documents(spark, texts).repartition(5)
    got = {r.doc: r.class_id for r in minhash.near_duplicates(df).collect()}
    bags_ = [bag(t) for t in texts]
    held = Counter(r for b in bags_ for r in b)
    weight = lambda b: {r: c * (1 + log(len(texts) / max(2, held[r]))) for r, c in b.items()}
    x, y = weight(bags_[0]), weight(bags_[1])
    shared = sum(min(v, y[r]) for r, v in x.items() if r in y)
    assert shared < 0.8 * (sum(x.values()) + sum(y.values()) - shared)
    assert got == {i: i if i < len(texts) - 1 else i - 1 for i in range(len(texts))}


def test_document_counts_of_all_runs(spark):
    texts = ["one two three four five six"] * 30 + [f"w{i // 2} x{i} y z v u" for i in range(70)] + ODD_TEXTS
    held = Counter(r for t in texts for r in bag(t))
    df = documents(spark, texts).selectExpr("doc_id AS doc", "doc_id AS key", "coalesce(text, '') AS text", "'' AS name").repartition(3)
    for r in minhash.sketches(df, len(texts), 40 << 20).collect():
        own = sorted(held[run] for run in bag(texts[r.doc]))
        assert sorted(minhash._numbers(r.held).tolist()) == own
