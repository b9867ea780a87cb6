import random
import re
import unicodedata
from html import unescape
from html.entities import html5

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import python_udfs as P
from newsloom.functions import text as T


def run(spark, values, *functions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", *[f(F.col("v")).alias(f"c{n}") for n, f in enumerate(functions)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(functions) > 1 else r[1] for r in rows]


def test_word_class_is_67_letters():
    assert len(T.ACCENTED) == 67
    assert all(c == c.lower() for c in T.ACCENTED)


def test_clean_text_agrees_with_the_plain_class_on_every_character(spark):
    """The table form of the class keeps and drops the same characters as the listed one."""
    codes = [c for c in (*range(1, 0xD800), *range(0xE000, 0x10000), *range(0x1F300, 0x1F700))]
    text = "|".join(chr(c) for c in codes)
    keep = set(T.ACCENTED + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_" + T.ASCII_SPACE)
    wanted = "".join(c if c in keep else " " for c in text)
    assert run(spark, [text], lambda c: T.clean_text(c, compat=True)) == [wanted]
    tokens = run(spark, [text], lambda c: T.word_tokens(c, compat=True))[0]
    assert [t for t in tokens if t] == wanted.split()


def test_clean_text_keeps_accented_capitals_unless_compat(spark):
    value = "Đây là Ứng dụng https://a.vn/x, AI"
    assert run(spark, [value], lambda c: T.clean_text(c, True), T.clean_text) == [
        (" ây là  ng dụng https   a vn x  AI", "đây là ứng dụng https   a vn x  ai")
    ]


def test_tokenize_null_and_blank(spark):
    assert run(spark, [None, "", " \n\t", " a  b\nc "], T.tokenize) == [[], [], [], ["a", "b", "c"]]


def test_keyword_rules(spark):
    text = "xin chao la http://abc ai vietnam a"
    assert run(spark, [text], lambda c: F.filter(T.tokenize(c), lambda t: T.is_keyword(t, 2, ["la"]))) == [
        ["xin", "chao", "ai", "vietnam"]
    ]
    assert run(spark, ["a ab abc tin"], lambda c: T.extract_keywords(c, 3)) == [["abc", "tin"]]
    assert run(spark, [None], T.extract_keywords) == [[]]
    assert run(spark, ["a_b"], lambda c: T.extract_keywords(c, 2, ["a b"])) == [[]]


def test_normalize_title(spark):
    assert run(spark, ["  Tin   MỚI ", None, "\tA\n B\r"], T.normalize_title) == ["tin mới", "", "a b"]


def test_truncate_text(spark):
    ten = lambda c: T.truncate_text(c, 10)
    assert run(spark, ["abcdefghijk", "abcdefghij", None, "a\nb" * 5], ten) == [
        "abcdefg...", "abcdefghij", "", "a\nba\nba..."
    ]


def test_create_slug(spark):
    long_words = " ".join(["word"] * 101)
    values = ["Đặc biệt", "!!!", "", None, "Giá 1,000,000 đồng", "Tom &amp; Jerry", "x" * 600, long_words, "Straße"]
    slugs = run(spark, values, T.create_slug)
    assert slugs[:6] == ["dac-biet", "article", "", "", "gia-1000000-dong", "tom-jerry"]
    assert slugs[6] == "x" * 500
    assert slugs[7] == "-".join(["word"] * 100)
    assert slugs[8] == "strasse"


def test_slug_cut_at_exact_boundary(spark):
    exact = "a" * 245 + " " + "b" * 254
    assert run(spark, [exact, exact + " c", exact + "c"], T.create_slug) == [
        "a" * 245 + "-" + "b" * 254, "a" * 245 + "-" + "b" * 254, "a" * 245
    ]


def test_link_tail(spark):
    assert run(spark, ["https://a.vn/x/y.html", "plain"], T.link_tail) == ["y.html", "plain"]


def test_strip_html(spark):
    cases = {
        "<p>a &amp; b</p>": "a & b", "<a href='x>y'>t</a>": "t", "x <!-- a <b> --> y": "x  y", "1 < 2": "1 < 2",
        "<br/>&lt;b&gt;": "<b>", "plain": "plain", '<img alt="a > b" src=x>z': "z", "&quot;q&quot;": '"q"',
        "Vi&#7879;t &agrave;&#x20AC;": "Việt à€", "&amp;lt; &eacute;": "&lt; é", "a&nbsp;b": "a\xa0b", "&nosuch; x": "&nosuch; x",
    }
    assert dict(zip(cases, run(spark, list(cases), T.strip_html))) == cases
    assert run(spark, [None], T.strip_html) == [""]


def test_letters_with_combining_marks(spark):
    for form in ("NFD", "NFC"):
        value = unicodedata.normalize(form, "Tiếng VIỆT, đường Ừ")
        assert run(spark, [value], T.clean_text, T.create_slug) == [("tiếng việt  đường ừ", "tieng-viet-duong-u")]
    mixed = "ê\u0323 e\u0302\u0323 e\u0323\u0302"
    assert run(spark, [mixed], T.word_tokens) == [["ệ", "ệ", "ệ"]]


def test_unicode_spaces(spark):
    value = "\u3000Tin\xa0\xa0 MỚI\u2003"
    assert run(spark, [value], T.normalize_title, T.tokenize, T.collapse_space) == [("tin mới", ["Tin", "MỚI"], "Tin MỚI")]


def test_comment_count(spark):
    assert run(spark, ["5", " 7 ", "n/a", None, ""], T.comment_count) == [5, 7, 0, 0, 0]


def test_normalize_tone(spark):
    assert run(spark, ["hòa thủy", "không"], T.normalize_tone) == ["hoà thuỷ", "không"]


def test_token_class(spark):
    cases = {
        "12/05/2024": "date", "2024-05-12": "date", "32.05.2024": "number", "1-2/2024": "compound", "2024": "number",
        "08:30": "time", "24:00": "other", "8:30:59": "time", "5%": "percent", "1,5%": "percent", "-1.000,5": "number",
        "--5": "other", "a.b@c.vn": "email", "a@b": "other", "...": "punctuation", "$": "punctuation", "UBND": "allcaps",
        "Hà": "name", "H": "name", "ABc": "other", "tin": "word", "iPhone": "other", "covid19": "code", "a-b": "compound", "km/h": "compound",
        "<br>": "markup", "“”": "punctuation", "a--b": "other",
    }
    assert dict(zip(cases, run(spark, list(cases), T.token_class))) == cases


def test_keyword_udf_custom_tokenizer(spark):
    def broken(text):
        if "x" in text:
            raise ValueError
        return text.split("-")

    assert run(spark, ["A-bc-http9-de", "x-y", None], P.keyword_udf(broken, ["de"])) == [["bc"], [], []]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30))
def test_word_tokens_equal_clean_then_split(spark, values):
    values = [unicodedata.normalize("NFC", v).replace("\x00", "") for v in values]
    fused = run(spark, values, lambda c: F.filter(T.word_tokens(c), lambda t: t != ""))
    stepwise = run(spark, values, lambda c: T.tokenize(T.clean_text(c)))
    assert fused == stepwise
    assert all(re.fullmatch(f"[a-z0-9_{T.ACCENTED}]+", t) for row in fused for t in row)


def test_composition_equals_nfc(spark):
    rng = random.Random(1)
    marks = [chr(c) for c in range(0x300, 0x370) if c != 0x34F]
    letters = "aeiouyAEIOUYncszdgABêéüđơư xΩαйИ日😀"
    piece = lambda: rng.choice(letters) + "".join(rng.choice(marks[:20] + marks) for _ in range(rng.choice([0, 0, 1, 1, 2, 3])))
    texts = ["".join(piece() for _ in range(rng.randrange(30))) for _ in range(800)]
    texts += [unicodedata.normalize("NFD", t) for t in ("mañana über garçon", "Tiếng Việt Đẹp", "ΐ Ǘ ṩ", "")] + ["plain", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.compose(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [r.t and unicodedata.normalize("NFC", r.t) for r in got]
    words = lambda t: spark.createDataFrame([(t,)], "t string").select(F.array_join(T.word_tokens(F.col("t")), " ").alias("w")).first().w
    assert words(unicodedata.normalize("NFD", "mañana über")) == words("mañana über")


def test_entities_equal_the_standard_library(spark):
    rng, names, texts = random.Random(2), sorted(html5), ["&amp;lt; &ampamp; &notit; &#38;lt;", "&&#108;t; &lt;", "& && &#; &#x;", None, ""]
    numbers = [0, 9, 13, 38, 60, 128, 150, 159, 55296, 65534, 1114112, 128512, 7879, 10**15, 10**40]
    for _ in range(1500):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(rng.choice([
                f"&{rng.choice(names)}", "&" + rng.choice(names).rstrip(";") + rng.choice(["x", "it;", ";", "=", " "]),
                f"&#{rng.choice([*numbers, rng.randrange(70000)])}{rng.choice([';', '', ' '])}",
                f"&#{rng.choice('xX')}{rng.choice(['26', '0', '1F600', '00000000041', 'D800', '110000', 'f' * 30, '9F', 'zz'])}{rng.choice([';', ''])}",
                "plain", "<", "&unknown;", "&a",
            ]))
        texts.append("".join(parts))
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.decode_entities(F.col("t")).alias("c"))
    assert "Python" not in frame._jdf.queryExecution().toString()
    assert [r.c for r in frame.collect()] == [t and unescape(t) if t is not None else None for t in texts]
