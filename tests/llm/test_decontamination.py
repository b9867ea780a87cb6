import hashlib

import pytest

from newsloom.llm import decontamination, registry
from tests.llm.cases import ODD_TEXTS, documents, save, words

SF = "/root/testdata/sf0.001"


def brute(docs, items, size=13):
    windows = []
    for item_id, text in items:
        w = words(text)
        runs = [w[i : i + size] for i in range(len(w) - size + 1)] if len(w) >= size else [w] if w else []
        windows += [(item_id, r) for r in runs]
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        places = {}
        for i, x in enumerate(w):
            places.setdefault(x, []).append(i)
        for item_id, run in windows:
            for i in places.get(run[0], []):
                if w[i : i + len(run)] == run:
                    hit.update(range(i, i + len(run)))
                    found.add(item_id)
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        n_items = len(found - {None})
        out[doc_id] = (len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def run(spark, folder):
    return {r.doc_id: tuple(r)[1:] for r in registry.op3_decontamination(spark, folder).collect()}


def test_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    got = run(spark, SF)
    assert got == brute(docs, items)
    assert any(x[1] for x in got.values())


@pytest.fixture
def odd(spark, tmp_path):
    run13 = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu"
    texts = [*ODD_TEXTS, run13, f"x {run13.upper()} xi", f"{run13}, {run13}", "short item here", "a short item", "Naïve-Café", run13[:-3]]
    items = [(1, f"{run13} xi"), (2, run13), (10, run13), (None, "short item"), (3, "short item"), (4, None), (5, " .. "), (6, "naïve"), (7, "x"), (7, "x")]
    save(documents(spark, texts), tmp_path, "documents")
    save(spark.createDataFrame(items, "item_id long, text string"), tmp_path, "benchmark")
    return str(tmp_path), list(enumerate(texts)), items


def test_odd_rows(spark, odd):
    folder, docs, items = odd
    assert run(spark, folder) == brute(docs, items)


def test_many_slices_give_the_same(spark, odd):
    folder, docs, items = odd
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    one, many = (
        {r.doc_id: r for r in decontamination.scan(read("documents"), read("benchmark"), slice_bytes=n).collect()} for n in (1 << 20, 40)
    )
    assert one == many


def test_documents_and_spans_go(spark, odd):
    folder, docs, items = odd
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    clean = decontamination.clean_documents(read("documents"), read("benchmark"))
    assert clean.columns == read("documents").columns
    assert {r.doc_id for r in clean.collect()} == {i for i, x in brute(docs, items).items() if not x[4]}
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(read("documents"), read("benchmark")).collect()}
    assert cut[len(ODD_TEXTS)] == "" and cut[0] == "" and cut[4] == "one" and cut[len(ODD_TEXTS) + 5] == "-Café"


def test_empty_tables(spark, tmp_path):
    save(documents(spark, ["some text"]), tmp_path, "documents")
    save(spark.createDataFrame([], "item_id long, text string"), tmp_path, "benchmark")
    assert run(spark, str(tmp_path))[0][:3] == (2, 0, 0)
