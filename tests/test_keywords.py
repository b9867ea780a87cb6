import re
from collections import Counter

from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.functions.python_udfs import token_udf
from newsloom.operators import keywords as K
from newsloom.operators.phrases import merge_phrases
from newsloom.plans import serving

SCHEMA = "publish_date string, source string, chu_de string, title string, content string"
ROWS = [
    ("2026-05-26", "bao1", "GiaiTri", "Phim mới ra mắt", "Phim ĐẸP của năm, phim hay!"),
    ("20260526", "bao1", "GiaiTri", None, "phim hay http khong an_toan a"),
    ("2026-05-27T10:00:00Z", "bao2", "CongNghe", "AI và robot", None),
    ("not a date", "bao2", "CongNghe", "Bỏ qua", "bỏ qua"),
    ("2026-05-27", "bao2", "SucKhoe", "", ""),
    ("2026-05-27", None, "SucKhoe", "Ứng dụng", "tập tập"),
]


def brute(rows, days, compat=False, stop=()):
    counts = Counter()
    for (_, source, category, title, content), day in zip(rows, days):
        if day is None:
            continue
        text = " ".join(x for x in (title, content) if x is not None)
        if not compat:
            text = text.lower()
        cleaned = re.sub(f"[^a-zA-Z0-9_{T.ACCENTED}\\s]", " ", text)
        for token in cleaned.lower().split():
            if len(token) >= 2 and not token.startswith("http") and token.replace("_", " ") not in stop:
                counts[(day, source, category, token)] += 1
    return counts


DAYS = ["20260526", "20260526", "20260527", None, "20260527", "20260527"]


def counts_of(df):
    return {tuple(r)[:4]: r[4] for r in df.collect()}


def test_trending_words_against_brute_force(spark):
    articles = spark.createDataFrame(ROWS, SCHEMA)
    assert counts_of(K.trending_words(articles)) == brute(ROWS, DAYS)
    assert counts_of(K.trending_words(articles, compat=True)) == brute(ROWS, DAYS, compat=True)
    stop = ["phim", "an toan"]
    wanted = brute(ROWS, DAYS, stop=stop)
    assert counts_of(K.trending_words(articles, stopwords=stop)) == wanted
    frame = spark.createDataFrame([(w,) for w in stop], "word string")
    assert counts_of(K.trending_words(articles, stopwords=frame)) == wanted


def test_counts_sum_to_exploded_tokens(spark):
    articles = spark.createDataFrame(ROWS, SCHEMA).where("publish_date <> 'not a date'")
    total = K.trending_words(articles).agg(F.sum(K.COUNT)).first()[0]
    assert total == K.explode_keywords(articles, T.full_text(F.col("title"), F.col("content")), ["chu_de"]).count()


def test_custom_tokenizer_joins_phrases(spark):
    articles = spark.createDataFrame([("2026-05-26", "s", "c", "Hà Nội", "vào thu hà nội")], SCHEMA)
    joiner = token_udf(lambda text: text.replace("hà nội", "hà_nội").split())
    found = counts_of(K.trending_words(articles, tokenizer=joiner, stopwords=["vào"]))
    assert found == {("20260526", "s", "c", "hà_nội"): 2, ("20260526", "s", "c", "thu"): 1}


def test_raw_tokens(spark):
    rows = [(None, "s", "c", "t", "Ab ab ha_noi _"), ("d", None, "c", "t", None), ("d", "s", None, "t", "x\n\tx")]
    found = counts_of(K.trending_tokens_raw(spark.createDataFrame(rows, SCHEMA)))
    assert found == {("", "s", "c", "Ab"): 1, ("", "s", "c", "ab"): 1, ("", "s", "c", "ha noi"): 1,
                     ("", "s", "c", ""): 1, ("d", "s", "", "x"): 2}


def test_phrases_are_joined_leftmost_longest(spark):
    texts = [
        (1, "the New York city of new york"), (2, "york new"), (3, ""), (4, None), (5, "a b c d a b"),
        (6, "a b c d e f g"), (7, "new  york\tNEW"), (8, "x a b a b y"), (9, "one"),
    ]
    articles = spark.createDataFrame(texts, "article_id long, content string")
    lexicon = spark.createDataFrame(
        [("New  York",), ("new york city",), ("a b",), ("b c d",), ("single",), ("c d e f g",), (None,), ("New York",)], "p string",
    )
    merged = merge_phrases(articles, lexicon)
    assert "Python" not in merged._jdf.queryExecution().toString()
    assert {r.article_id: r.content for r in merged.collect()} == {
        1: "the New_York_city of new_york", 2: "york new", 3: "", 4: None, 5: "a_b c d a_b", 6: "a_b c_d_e_f_g",
        7: "new_york NEW", 8: "x a_b a_b y", 9: "one",
    }


def test_serving_queries(spark):
    table = spark.createDataFrame(
        [("d", "s", "c1", "a", 3), ("e", "s", "c1", "a", 2), ("d", "s", "c2", "a", 1), ("d", "s", "c2", "b", 9)],
        "ngay string, nguon string, chu_de string, tu_khoa string, so_lan_xuat_hien long",
    )
    assert sorted(map(tuple, serving.keywords_per_category(table).collect())) == [("c1", 2), ("c2", 2)]
    assert list(map(tuple, serving.top_keywords(table, 1).collect())) == [("b", 9)]
    assert list(map(tuple, serving.category_keywords(table).collect())) == [("c1", "a", 5), ("c2", "b", 9), ("c2", "a", 1)]
    assert [r.tu_khoa for r in serving.top_rows(table, 2).collect()] == ["b", "a"]
    assert [r[0] for r in K.sort_by_count(table).select(K.COUNT).collect()] == [9, 3, 2, 1]


def test_hot_path_is_native(spark):
    plan = K.trending_words(spark.createDataFrame(ROWS, SCHEMA), stopwords=["a"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "partial_count" in plan


def test_the_group_is_worked_out_once_an_article(spark):
    """The day is parsed below the explode, not once a token."""
    rows = spark.createDataFrame([("2026-05-26", "bao", "GiaiTri", "Tin", "phim mới")], "publish_date string, source string, chu_de string, title string, content string")
    for counted, parsed in ((K.trending_words(rows), "date_format"), (K.trending_tokens_raw(rows), "coalesce")):
        plan = counted._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Generate", 1)
        assert parsed not in above and parsed in below
