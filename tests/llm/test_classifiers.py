import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import quality_rules, registry, toxicity
from newsloom.llm.labelled import held_out, training_rows
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.01"


def judged(spark, name, label, folds, fold):
    rows = registry.QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]


def test_quality_on_held_out_rows(spark):
    pairs = judged(spark, "op10_quality_rules", "quality", 3, 1)
    assert np.mean([a == b for a, b in pairs]) > 0.97


def test_toxicity_on_held_out_rows(spark):
    pairs = judged(spark, "op9_toxicity", "toxic", 4, 2)
    assert np.mean([a == b for a, b in pairs]) > 0.9
    assert sum(b for a, b in pairs if a) >= 0.5 * sum(a for a, _ in pairs)
    assert sum(b for a, b in pairs if not a) <= 3


@pytest.mark.parametrize("name,threshold", [("op9_toxicity", 0.3), ("op10_quality_rules", 0.5)])
@pytest.mark.parametrize("labels", ["none", "one class", "nulls"])
def test_odd_rows(spark, tmp_path, name, threshold, labels):
    df = documents(spark, ODD_TEXTS)
    save(df.unionByName(df.limit(4)).unionByName(df.limit(2).withColumn("doc_id", F.lit(None).cast("long"))), tmp_path, "documents")
    rows = {"none": [], "one class": [(i, 1, 1) for i in range(5)], "nulls": [(0, None, None), (1, 0, 1), (2, 1, 0), (None, 1, 1), (3, 1, 0), (3, 0, 1)]}[labels]
    save(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(got) == len(ODD_TEXTS) + 6
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out is not None for r in got)


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for name in ("op9_toxicity", "op10_quality_rules"):
        assert registry.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_rules_score_as_the_column(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_rules.train(docs, labels, held_out(3, 1))
    assert model.rules
    rows = docs.orderBy("doc_id").limit(200).collect()
    x = quality_rules.statistics(pa.array([r.text for r in rows]))
    total = model.start + sum(w * np.all([(x[:, i] > b) == above for i, above, b in rule], 0) for rule, w in model.rules)
    got = {r.doc_id: r.score for r in quality_rules.score(docs, model, ["doc_id"]).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], 1 / (1 + np.exp(-total)))


def test_gapped_insults_score_high():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abdeghiklmnoprstu") for _ in range(n)).encode()
    insults = [(b"blargon", 50), (b"snorgus", 40), (b"wimplex", 30)]
    clean = [(w, 5) for w in {word(rng.randrange(3, 11)) for _ in range(800)}]
    model = toxicity.ToxicityModel(*toxicity.machine(insults, clean), (0.0,) * 5)
    score = lambda *w: model.word_scores(pa.array(w, pa.large_binary()))
    assert (score(b"blargon", b"blarxgon", b"blaargon", b"snorguus", b"snorgusses", b"wimpplex") > 0).all()
    assert (score(*[word(7) for _ in range(200)]) > 0).mean() < 0.1
    texts = pa.array(["so b l a r g o n then", "so bl*arg*on then", "all fine here", None])
    best = model.features(texts)[:, 0]
    assert (best[:2] > 0).all() and (best[2:] < 0).all()


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = training_rows(docs.unionByName(docs), labels, "toxic", held_out(4, 2), limit=50)
    assert rows.count() == 50
