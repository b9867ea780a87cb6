import hashlib
import random
from collections import Counter

import pytest

from newsloom.llm import registry, suffix_dedup
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"


def brute(docs, length=400):
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(hash(b[p : p + length]) for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[hash(b[p : p + length])] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, folder):
    return sorted((tuple(r) for r in registry.op1_suffix_dedup(spark, folder).collect()), key=str)


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(docs)
    assert run(spark, SF) == expected
    assert any(0 < r[2] < r[1] for r in expected)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_passages(spark, tmp_path, seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [noise(rng.choice([380, 399, 400, 401, 500, 900])) for _ in range(8)]
    passages += ["ab" * 300, "x" * 700, noise(7) * 90]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 60) if rng.random() < 0.6 else 0
            parts += [noise(rng.randrange(0, 90)), p[a:]]
        texts.append("".join(parts))
    texts += [*ODD_TEXTS, *ODD_TEXTS[-5:], texts[0], texts[1]]
    df = documents(spark, texts)
    df = df.unionByName(df.limit(3))  # rows that come twice
    save(df, tmp_path, "documents")
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, str(tmp_path)) == brute(rows)


def test_texts_are_cut_and_columns_kept(spark):
    text = "".join(random.Random(4).choice("abcdef ") for _ in range(450))
    df = documents(spark, [f"start {text} end", f"other {text}é", None])
    out = suffix_dedup.deduplicated(df)
    assert out.columns == df.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[2] == "" and text not in kept[0] and kept[0].startswith("start") and kept[0].endswith("end") and kept[1].endswith("é")


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert run(spark, str(tmp_path)) == []
