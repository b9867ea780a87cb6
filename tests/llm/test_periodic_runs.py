import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from newsloom.llm import periodic_runs, registry
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"


def smallest_period(x):
    """By the borders of a sequence."""
    border, k = [0] * len(x), 0
    for i in range(1, len(x)):
        while k and x[i] != x[k]:
            k = border[k - 1]
        k += x[i] == x[k]
        border[i] = k
    return len(x) - border[-1]


def brute_runs(x, least=24, repeats=3):
    out = []
    for q in range(1, len(x) // repeats + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q) and smallest_period(x[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def order(row):
    return tuple(str(x) for x in row)


def run(spark, folder):
    return sorted((tuple(r) for r in registry.op12_periodic_runs(spark, str(folder)).collect()), key=order)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((brute(*d) for d in docs), key=order)
    assert run(spark, SF) == expected
    assert sum(r[1] > 0 for r in expected) > 10


def sequences(seed, count):
    """Words of small alphabets with planted repetitions, some nested, some side by side."""
    rng = random.Random(seed)
    for _ in range(count):
        letters = rng.choice([1, 2, 2, 3, 50])
        out = []
        while len(out) < rng.randrange(1, 400):
            piece = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64, 65]))]
            if rng.random() < 0.3:
                piece = piece * rng.randrange(2, 5) + [rng.randrange(letters)]
            out += piece * rng.choice([1, 1, 2, 3, 4, 12]) + piece[: rng.randrange(len(piece) + 1)]
        yield out


def test_runs_equal_every_diagonal():
    texts = [*sequences(5, 300), [], [0] * 23, [0] * 24, [0, 1] * 12, list(range(8)) * 3, list(range(9)) * 3, [*list(range(9)) * 3][:-1], [7] * 900]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    runs = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int64), offsets)
    expected = [(s + int(o), n, q) for t, o in zip(texts, offsets) for s, n, q in brute_runs(t)]
    assert [tuple(r) for r in runs.tolist()] == expected
    assert {q for _, _, q in expected} >= {1, 2, 8, 9, 16, 17, 33, 64}


def test_confused_hashes_change_nothing(monkeypatch):
    codes = np.array([1, 2, 3] * 20 + [4] + [1, 2, 3] * 9, np.int64)
    whole = periodic_runs.find_runs(codes, np.array([0, len(codes)])).tolist()
    assert periodic_runs.exact(codes, 3, 0, len(codes) - 3) == [(0, 57), (61, 85)]
    assert whole == [[0, 60, 3], [61, 27, 3]]


def test_texts_beside_each_other_do_not_join():
    codes = np.array([5] * 40, np.int64)
    assert periodic_runs.find_runs(codes, np.array([0, 20, 40])).tolist() == []
    assert periodic_runs.find_runs(codes, np.array([0, 30, 40])).tolist() == [[0, 30, 1]]


def test_odd_texts_and_long_periods(spark, tmp_path):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [*ODD_TEXTS, *ODD_TEXTS, "a\tb\x0bc\r\n" * 30, "é " * 30, " ".join(words * 3), " ".join(words * 4 + words[:7]),
             " ".join([*["x"] * 30, *["y", "z"] * 20, *["x"] * 30]), "a" + "\xa0b" * 50, *(" ".join(map(str, t)) for t in sequences(9, 60))]
    save(documents(spark, texts), tmp_path, "documents")
    assert run(spark, tmp_path) == sorted((brute(i, t) for i, t in enumerate(texts)), key=order)


def test_missing_ids_repeats_and_an_empty_table(spark):
    schema = "doc_id long, text string, runs string, n_words string, collapsed string"
    rows = [(None, "a " * 30, "r", "n", "c")] * 2 + [(3, None, "r", "n", "c"), (4, "one two", "r", "n", "c")]
    got = periodic_runs.collapsed(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.collapsed, len(r.runs)) for r in got) == [(0, 30, "a", 1), (0, 30, "a", 1), (3, 0, "", 0), (4, 2, "one two", 0)]
    assert periodic_runs.run_report(spark.createDataFrame([], schema)).collect() == []
