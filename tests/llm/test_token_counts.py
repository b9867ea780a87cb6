import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import registry, token_counts
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def count():
    library = Tokenizer.from_file(PATH)
    return lambda raw: len(library.encode(raw.decode(), add_special_tokens=False).ids)


def test_given_documents(spark, count):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.op5_token_counts(spark, SF).collect()
    assert len(rows) == len(texts) and any(r.n_edits for r in rows)
    for r in rows:
        raw = texts[r.doc_id]
        assert (r.n_before, r.n_after) == (count(raw), count(token_counts.PRIVATE.sub(b"[private]", raw)))
        assert r.n_edits > 0 or r.n_encoded == 0


def test_random_edits(spark, count):
    rng = random.Random(5)
    letters = "ab cZ.,!'<|>9é \ńs"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(300)] + [t or "" for t in ODD_TEXTS]
    rows = []
    for i, text in enumerate(texts):
        marks = [len(text[:k].encode()) for k in range(len(text) + 1)]
        edits = []
        for _ in range(rng.randrange(0, 5)):
            a, b = sorted((rng.choice(marks), rng.choice(marks[: rng.randrange(1, 60)])))
            edits.append((a, b, rng.choice([None, "", "x", " ", "<|endoftext|>", "́", "'s", "12"])))
        rows.append((i, text if text or i % 2 else None, edits or None))
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {token_counts.EDITS}")
    got = {r.doc_id: r for r in token_counts.count_edits(df, PATH, "edits").collect()}
    for i, text, edits in rows:
        raw = (text or "").encode()
        own = token_counts.ordered([dict(zip(("start", "end", "text"), e)) for e in edits or ()], len(raw))
        assert (got[i].n_before, got[i].n_after) == (count(raw), count(token_counts.edited(raw, own))), (text, edits)


def test_only_touched_regions_are_encoded(spark):
    text = "word " * 2000 + "me@example.org" + " word" * 2000
    row = token_counts.count_edits(documents(spark, [text]), PATH).first()
    assert row.n_edits == 1 and row.n_encoded < 100


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert registry.op5_token_counts(spark, str(tmp_path)).collect() == []
