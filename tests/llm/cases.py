"""Small tables with the awkward cases, and the brute-force side of several tests."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD_TEXTS = [
    None, "", " ", "\n\t ", "one", "A.B.C.", "naïve café É́ ﬁ İ Σας ΣΑΣ", "日本語 テスト 123४५", "a" * 3000, "ab " * 4000,
    "it's we'LL 's'", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "tab\tnbsp u2028  nel\u0085z", "😀😁 *** !!!",
]


def documents(spark, texts, start=0):
    rows = [(start + i, t, "en", "src0", 7, "clash", 1.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score double")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def save(df, folder, name):
    df.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
