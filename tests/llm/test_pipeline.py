import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm import quality_rules
from newsloom.llm.labelled import held_out
from tests.llm import test_decontamination, test_minhash, test_tokens
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"


def cut(docs, length=400):
    """The texts without bytes that repeat, the plain way."""
    raw = {i: (t or "").encode() for i, t in docs}
    seen = {}
    for b in raw.values():
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        out.append((i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")))
    return out


def test_stages_equal_the_plain_way(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    model = quality_rules.train(read("documents"), read("labels"), held_out(3, 1))
    x = quality_rules.statistics(pa.array([t for _, t in docs]))
    total = model.start + sum(w * np.all([(x[:, i] > b) == above for i, above, b in rule], 0) for rule, w in model.rules)
    docs = [d for d, good in zip(docs, total >= 0) if good]
    classes = test_minhash.brute_classes(docs)
    docs = cut([d for d in docs if classes[d[0]] == d[0]])
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    dirty = {i for i, found in test_decontamination.brute(docs, items).items() if found[4]}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {i: test_tokens.expected(library, t) for i, t in docs if i not in dirty}
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected
    assert 0 < len(got) < 200


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == columns


def test_stages_on_clashing_columns_and_odd_rows(spark, tmp_path):
    names = ("key", "row", "kept", "_doc", "score", "doc", "windows", "n_words", "items", "label", "a.b")
    docs = documents(spark, [*ODD_TEXTS, ODD_TEXTS[0], "one"]).drop("n_tokens", "score").withColumns({n: F.lit(n) for n in names})
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    save(spark.createDataFrame([(1, "x y z")], "item_id long, text string"), tmp_path, "benchmark")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == docs.columns, name
            rows = out.collect()
            assert all(r["a.b"] == "a.b" and r.kept == "kept" for r in rows)
            assert bool(rows) == (frame is docs)


def test_entry_lists_the_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
