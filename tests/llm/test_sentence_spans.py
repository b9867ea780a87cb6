import hashlib
import random

from newsloom.llm import registry, sentence_spans
from tests.llm.cases import ODD_TEXTS, documents, save, words

SF = "/root/testdata/sf0.001"


def sentences(text):
    raw, out, start = (text or "").encode(), [], 0
    for i in range(1, len(raw)):
        if raw[i - 1 : i] == b"\n" or (raw[i - 1 : i] in (b".", b"!", b"?") and raw[i : i + 1] in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")):
            out.append(raw[start:i])
            start = i
    return [*out, raw[start:]] if raw else []


def brute(docs):
    places, runs = {}, {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        own = sentences(text)
        used = [(i, words(s.decode(errors="ignore"))) for i, s in enumerate(own)]
        used = [(i, w) for i, w in used if w]
        found = []
        for size, least in ((2, 24), (3, 8)):
            for k in range(len(used) - size + 1):
                w = [x for _, s in used[k : k + size] for x in s]
                if len(w) >= least:
                    found.append(((size, tuple(w)), used[k][0], used[k + size - 1][0]))
        runs[doc_id] = (own, found)
        for span, a, _ in sorted(found, key=lambda f: f[1]):
            places.setdefault(span, (doc_id, a))
    out = []
    for doc_id, (own, found) in runs.items():
        gone = {i for span, a, b in found if places[span] != (doc_id, a) for i in range(a, b + 1)}
        kept = b"".join(s for i, s in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), len(kept), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, folder):
    return sorted(tuple(r) for r in registry.op6_sentence_spans(spark, folder).collect())


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(docs)
    assert run(spark, SF) == expected
    assert any(0 < r[2] < r[1] for r in expected)


def test_shared_passages_and_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    sentence = lambda n: " ".join("".join(rng.choice("abcde") for _ in range(6)) for _ in range(n)) + rng.choice([". ", "! ", ".\n", "? "])
    passages = ["".join(sentence(rng.randrange(1, 16)) for _ in range(rng.randrange(2, 8))) for _ in range(10)]
    texts = ["".join(rng.choice([sentence(7), rng.choice(passages)]) for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    texts += [*ODD_TEXTS, *ODD_TEXTS, "Yes. No. Yes. No. " * 30]
    save(documents(spark, texts), tmp_path, "documents")
    assert run(spark, str(tmp_path)) == brute(list(enumerate(texts)))
    cut = {r.doc_id: r.text for r in sentence_spans.deduplicated(documents(spark, [passages[0] * 2, passages[0].upper()])).collect()}
    assert len(cut) == 2


def test_empty_table(spark, tmp_path):
    save(documents(spark, []), tmp_path, "documents")
    assert run(spark, str(tmp_path)) == []


def test_clauses_find_passages_inside_sentences(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passages = [prose(51) for _ in range(40)]
    inside = lambda p: f"{prose(rng.randrange(1, 40))} {p} {prose(rng.randrange(1, 40))}"
    single, whole, own = prose(60) + ".", prose(104), [prose(200), prose(9) + ". " + prose(300)]
    across = f"{prose(26)}. {prose(25)}"
    texts = [inside(p) for p in passages for _ in (0, 1)]
    texts += [f"{prose(9)}. {single} {prose(9)}." for _ in (0, 1)] + [whole, whole.upper(), inside(across), inside(across), *own]
    texts += ["é" + prose(80) + "。 ok", *ODD_TEXTS]
    docs = documents(spark, texts)
    plain = {r.doc_id: r.text for r in sentence_spans.deduplicated(docs).collect()}
    assert all(plain[i] == (t or "") for i, t in enumerate(texts))
    got = {r.doc_id: r.text for r in sentence_spans.deduplicated(docs, clauses=True).collect()}
    report = {r.doc_id: r for r in sentence_spans.removal_report(docs, clauses=True).collect()}
    once = range(len(texts) - len(ODD_TEXTS))
    for i in once:
        if i < 80 and i % 2 or i == 85:  # at least the run that is sure to be shared goes
            assert len(words(texts[i])) - len(words(got[i])) >= 24
            assert len(words(texts[i])) - len(words(got[i])) <= 51
        elif i not in (81, 83):
            assert got[i] == texts[i]
    assert single not in got[81] and len(words(got[81])) == 18 and report[81].n_removed == 1
    assert got[83] == "" and report[83].n_removed == report[83].n_sentences == 1
    assert all(report[i].n_bytes == len(t.encode()) for i, t in got.items())
