import random
import re
from collections import Counter
from statistics import fmean, pvariance

import pytest
from pyspark.sql import functions as F

from newsloom.llm import host_rules, registry
from tests.llm.cases import ODD_TEXTS, documents, save

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), len(lines)


def brute(rows, limit=host_rules.HOST_LIMIT):
    """rows of (doc_id, text, host)"""
    every, hosts = [], {}
    for doc_id, text, host in rows:
        n, chars, symbols, dup, repeat, lines = counts(text)
        base = n < 10 or 100 * repeat > 20 * n
        failed = base or chars < 3 * n or chars > 10 * n or 10 * symbols > n or 10 * dup > 3 * lines
        every.append((doc_id, n, chars, symbols, dup, repeat, base, host))
        if host is not None:
            hosts.setdefault(host, []).append(failed)
    rates = {h: sum(f) / len(f) for h, f in hosts.items()}
    rejected = set()
    if rates:
        mean, spread = fmean(rates.values()), pvariance(rates.values())
        excess = spread - mean * (1 - mean) * fmean(1 / len(f) for f in hosts.values())
        for h, f in hosts.items():
            shrunk = mean
            if excess > 0 and mean * (1 - mean) > spread:
                weight = (mean * (1 - mean) - spread) / excess
                shrunk = (sum(f) + mean * weight) / (len(f) + weight)
            if shrunk > limit:
                rejected.add(h)
    return Counter((*r[:7], not r[6] and r[7] not in rejected) for r in every)


def run(spark, folder):
    return Counter(tuple(r) for r in registry.op13_host_rules(spark, str(folder)).collect())


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    expected = brute([tuple(r) for r in docs])
    assert run(spark, SF) == expected
    assert any(r[5] for r in expected) and any(r[4] for r in expected)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def hosts_of(spark, sizes, seed=3):
    """Documents of hosts, each with (number, number of bad ones)."""
    rng = random.Random(seed)
    rows = []
    for host, (n, bad) in sizes.items():
        rows += [(len(rows) + i, prose(rng, 40) if i >= bad else "### *** " * 20, host) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_bad_hosts_go_and_small_ones_lean_on_the_prior(spark):
    sizes = {f"good{i}": (40, i % 3) for i in range(8)} | {"bad.example": (60, 50), "tiny.example": (2, 2), "good": (30, 0)}
    docs, rows = hosts_of(spark, sizes)
    found = host_rules.judged(docs).select("host", "rejected").distinct().collect()
    verdicts = {r.host: r.rejected for r in found}
    assert verdicts["bad.example"] and not any(v for h, v in verdicts.items() if h.startswith("good"))
    assert Counter(tuple(r) for r in host_rules.host_report(docs).collect()) == brute(rows)
    rates = {r.host: r.rate for r in host_rules.host_verdicts(
        docs.select(F.col("source").alias("host"), F.col("text").startswith("#").alias("failed"))).collect()}
    assert rates["tiny.example"] < 0.95  # two failures of two weigh less than their rate of 1


def test_equal_hosts_have_the_mean_rate(spark):
    docs, rows = hosts_of(spark, {"a": (20, 4), "b": (20, 4)})
    assert Counter(tuple(r) for r in host_rules.host_report(docs).collect()) == brute(rows)
    assert all(r.kept != r.base_failed for r in host_rules.judged(docs).collect())


def test_odd_texts_repeats_and_one_hot_host(spark, tmp_path):
    rng = random.Random(4)
    line = prose(rng, 9)
    texts = [*ODD_TEXTS, *ODD_TEXTS, "a b c d e " * 5, "w " * 7000, line + "\n" + line, f"{line}\n \n{line}\r\n{line}\n", "x y " * 12,
             "a b c d e x a b c d e y b c d e x", *(prose(rng, rng.randrange(1, 60)) for _ in range(40))]
    save(documents(spark, texts), tmp_path, "documents")
    assert run(spark, tmp_path) == brute([(i, t, "src0") for i, t in enumerate(texts)])


def test_missing_hosts_ids_and_tables(spark):
    schema = "doc_id long, text string, source string, host string, rejected string, n_words int"
    rows = [(None, "", None, "h", "r", 1), (None, "", None, "h", "r", 1), (1, None, "  ", "h", "r", 1), (2, "ten good words of the usual length and no more here", "S", "h", "r", 1)]
    got = host_rules.judged(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r.doc_id, r.host, r.kept) for r in got) == Counter([(None, None, False), (None, None, False), (1, None, False), (2, "s", True)])
    assert host_rules.host_report(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("source, host", [
    ("src0", "src0"), (" Www.Example.ORG ", "example.org"), ("https://user:pw@www.example.org:8080/a?b#c", "example.org"),
    ("HTTP://a.b/", "a.b"), ("", None), (None, None),
])
def test_host(spark, source, host):
    row = spark.createDataFrame([(source,)], "source string").select(host_rules.host_of(F.col("source")).alias("h")).first()
    assert row.h == host


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    host_rules.host_report(docs).explain()
    docs.select(host_rules.text_stats(F.col("text"))).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)
