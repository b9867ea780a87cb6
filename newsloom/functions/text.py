"""Text functions, each Column -> Column and inside whole-stage codegen."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable, Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The vowels and tone marks of the Vietnamese alphabet.
VOWELS = "aăâeêioôơuưy"
TONE_MARKS = ("", "̀", "́", "̉", "̃", "̣")

# Old-style tone placement and its new-style spelling.
TONE_PAIRS = (
    ("òa", "oà"), ("óa", "oá"), ("ỏa", "oả"), ("õa", "oã"), ("ọa", "oạ"),
    ("òe", "oè"), ("óe", "oé"), ("ỏe", "oẻ"), ("õe", "oẽ"), ("ọe", "oẹ"),
    ("ùy", "uỳ"), ("úy", "uý"), ("ủy", "uỷ"), ("ũy", "uỹ"), ("ụy", "uỵ"),
)

# What a reference to a character may look like, as HTML reads it
ENTITY = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
WHOLE_ENTITY = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]{1,31});"

ASCII_SPACE = " \t\n\x0b\f\r"
ASCII_SPACE_RUN = "[ \\t\\n\\x0b\\f\\r]+"
# Everything that Unicode counts as white space, and the four ASCII separators
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WHITESPACE_RUN = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"
MARKS = "[\u0300-\u036f]"
# The combining marks that move and compose, without the grapheme joiner
COMBINING = "".join(chr(c) for c in range(0x300, 0x370) if unicodedata.combining(chr(c)))
MARKED = "[^\u0300-\u034e\u0350-\u036f][\u0300-\u034e\u0350-\u036f]+"

# A comment, or a tag whose quoted attribute values may hold ">". The loop runs
# once per quoted value, so a long value cannot exhaust the regex stack.
MARKUP = (
    "(?s)<(?:!--.*?-->"
    "|[a-zA-Z/!?][^'\">]*(?:\"[^\"]*\"[^'\">]*|'[^']*'[^'\">]*)*>)"
)


def _accented_letters() -> str:
    letters = {unicodedata.normalize("NFC", v + t) for v in VOWELS for t in TONE_MARKS}
    return "".join(sorted(c for c in letters | {"đ"} if not c.isascii()))


ACCENTED = _accented_letters()


def _canonical() -> tuple[dict[str, str], dict[str, str]]:
    """Letter and mark with what they compose to, and letters with their letter and marks."""
    pairs, parts = {}, {}
    for letter in map(chr, range(0xC0, 0x2000)):
        full = unicodedata.normalize("NFD", letter)
        if full != letter:
            parts[letter] = full
            own = unicodedata.decomposition(letter).split()
            if len(own) == 2 and unicodedata.normalize("NFC", letter) == letter:
                pairs["".join(chr(int(c, 16)) for c in own)] = letter
    return pairs, parts


COMPOSED, PARTS = _canonical()
WORD_CHARS = f"a-zA-Z0-9_{ACCENTED}"
NON_WORD = f"[^{WORD_CHARS}]+"


def _non_word_class(keep: str = "") -> str:
    """A class of the characters outside the word class and ``keep``.

    Equal to ``[^WORD_CHARS keep]``, but with every character below U+0100 listed
    singly, which the regex engine turns into one table lookup. A negated class
    of many ranges tests them one by one, through shared type caches that keep
    the cores of one process from working in parallel.
    """
    word = set(string.ascii_letters + string.digits + "_" + ACCENTED + keep)
    low = "".join(f"\\x{code:02x}" for code in range(256) if chr(code) not in word)
    middle = "".join(c for c in ACCENTED if "\u0100" <= c < "\u1e00")
    high = "".join(c for c in ACCENTED if c >= "\u1e00")
    known = f"{middle}[{high[0]}-{high[-1]}&&[{high}]]"
    return f"[{low}[\\x{{100}}-\\x{{10ffff}}&&[^{known}]]]"


def _ascii_letters() -> tuple[str, str]:
    """Lowercase Latin letters with marks, and the ASCII letter under each."""
    source, target = ["đ", "ø", "ł", "ı"], ["d", "o", "l", "i"]
    for code in (*range(0x00E0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base.isascii() and base.isalpha() and letter == letter.lower():
            source.append(letter)
            target.append(base.lower())
    return "".join(source), "".join(target)


LATIN_MARKED, LATIN_ASCII = _ascii_letters()
# Letters that become two ASCII letters.
LATIN_DIGRAPHS = (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"))


def replace_all(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def lookup(table: dict[str, str]) -> Column:
    """A constant map, folded into the plan once."""
    text = "\x02".join(f"{old}\x03{new}" for old, new in table.items())
    return F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x03"))


def replace_found(text: Column, pattern: str, sign: Callable[[Column], Column], value_of: Callable[[Column], Column]) -> Column:
    """Every match of a pattern replaced by a function of it, in one pass; each different match is worked out once.

    Texts without a ``sign``, which is quickly found and true of every text with a match, are left alone.
    """
    def rebuilt(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        gaps = F.split(t, pattern, -1)

        def joined(x: Column) -> Column:
            values = F.map_from_arrays(F.array_distinct(x["found"]), F.transform(F.array_distinct(x["found"]), value_of))
            pieces = let(values, lambda v: F.transform(x["gaps"], lambda gap, i: F.concat(gap, F.coalesce(v[F.get(x["found"], i)], F.lit("")))))
            return F.array_join(pieces, "")

        return let(F.struct(found.alias("found"), gaps.alias("gaps")), joined)

    return let(text, lambda t: F.when(sign(t), rebuilt(t)).otherwise(t))


def _composed(sequence: Column) -> Column:
    """A letter and its marks as NFC writes them."""
    sequence = F.replace(F.translate(sequence, "\u0340\u0341\u0343", "\u0300\u0301\u0313"), F.lit("\u0344"), F.lit("\u0308\u0301"))
    # the class by which a mark is ordered, as the code of a character
    classes = "".join(chr(unicodedata.combining(m)) for m in COMBINING)
    order = lambda mark: F.ascii(F.translate(mark, COMBINING, classes))

    def step(state: Column, mark: Column) -> Column:
        met = lookup(COMPOSED)[F.concat(state["letter"], mark["mark"])]
        free = met.isNotNull() & (state["last"] != mark["order"])
        kept = F.struct(state["letter"].alias("letter"), F.concat(state["rest"], mark["mark"]).alias("rest"), mark["order"].alias("last"))
        return F.when(free, F.struct(met.alias("letter"), state["rest"].alias("rest"), state["last"].alias("last"))).otherwise(kept)

    def folded(full: Column) -> Column:
        marks = F.filter(F.split(F.substring(full, 2, 1 << 30), ""), lambda m: m != "")
        ordered = F.array_sort(F.transform(marks, lambda m, i: F.struct(order(m).alias("order"), i.alias("place"), m.alias("mark"))))
        start = F.struct(F.substring(full, 1, 1).alias("letter"), F.lit("").alias("rest"), F.lit(-1).alias("last"))
        return F.aggregate(ordered, start, step, lambda s: F.concat(s["letter"], s["rest"]))

    def whole(t: Column) -> Column:
        first = F.substring(t, 1, 1)
        return F.concat(F.coalesce(lookup(PARTS)[first], first), F.substring(t, 2, 1 << 30))

    return let(let(sequence, whole), folded)


def compose(text: Column) -> Column:
    """Letters written with combining marks as single letters, as NFC writes them.

    Holds for all letters below U+2000. Only the sequences that occur in a text are worked out.
    """
    marked = lambda t: (F.length(t) < F.octet_length(t)) & t.rlike(MARKS)
    return replace_found(text, MARKED, marked, _composed)


def trim_space(text: Column) -> Column:
    """Trim every white space character, not just spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def full_text(*columns: Column) -> Column:
    """Title and content in one string; nulls are skipped."""
    return F.concat_ws(" ", *columns)


def clean_text(text: Column, compat: bool = False) -> Column:
    """Replace every character outside the word class and whitespace by a space.

    The default composes and lowers first, so letters with combining marks and accented
    capitals survive. ``compat`` cleans the text as it stands, which turns them into spaces.
    """
    return F.regexp_replace(text if compat else F.lower(compose(text)), _non_word_class(ASCII_SPACE), " ")


def tokenize(text: Column) -> Column:
    """Whitespace tokens of a text; null gives an empty array."""
    words = F.split(trim_space(F.coalesce(text, F.lit(""))), WHITESPACE_RUN)
    return F.filter(words, lambda t: t != "")


def word_tokens(text: Column, compat: bool = False) -> Column:
    """Tokens of the cleaned, lowered text, in one regex pass.

    Cleaning turns unwanted characters into spaces and tokenising splits on
    them, so splitting on runs of unwanted characters gives the same tokens. The
    array may start or end with an empty string; the keyword filter drops it.
    """
    return F.split(F.coalesce(text if compat else F.lower(compose(text)), F.lit("")), _non_word_class() + "+")


def is_keyword(token: Column, min_length: int = 2, stopwords: Iterable[str] | None = None) -> Column:
    """Long enough, no URL, no stopword. A joined word matches its spaced form."""
    keep = (F.length(token) >= max(min_length, 2)) & ~F.startswith(token, F.lit("http"))
    words = sorted(set(stopwords or ()))
    if words:
        keep &= ~F.replace(token, F.lit("_"), F.lit(" ")).isin(words)
    return keep


def extract_keywords(
    text: Column,
    min_length: int = 2,
    stopwords: Iterable[str] | None = None,
    compat: bool = False,
) -> Column:
    """Keyword array of one text. Use ``operators.keywords`` to count keywords."""
    words = list(stopwords or ())
    tokens = F.transform(word_tokens(text, compat), F.lower) if compat else word_tokens(text)
    return F.filter(tokens, lambda t: is_keyword(t, min_length, words))


def phrase_of(token: Column) -> Column:
    """A joined word back as a phrase: underscores become spaces."""
    return F.trim(F.replace(token, F.lit("_"), F.lit(" ")))


def normalize_title(title: Column) -> Column:
    lowered = trim_space(F.lower(F.coalesce(title, F.lit(""))))
    return F.regexp_replace(lowered, WHITESPACE_RUN, " ")


def truncate_text(text: Column, max_length: int = 5000) -> Column:
    """Texts over the limit are cut and end in "...". One pattern, so that a long
    ``text`` expression is not repeated in the plan."""
    longer = f"(?s)^(.{{{max_length - 3}}}).{{4}}.*$"
    return F.regexp_replace(F.coalesce(text, F.lit("")), longer, "$1...")


# What references to some control characters stand for in HTML, in the order of 0x80 to 0x9f.
WINDOWS = (
    "\u20ac\x81\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\x8d\u017d\x8f"
    "\x90\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\x9d\u017e\u0178"
)


def _numbered(code: Column) -> Column:
    """The character of a code point in decimal(38), as HTML reads references by number."""
    invalid = code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
    invalid |= (code % 0x10000 >= 0xFFFE) & (code <= 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
    windows = F.substring(F.lit(WINDOWS), 0, 1 << 30)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd").when(code == 0xD, "\r")
        .when(code.between(0x80, 0x9F), F.substr(windows, (code - 0x7F).cast("int"), F.lit(1))).when(invalid, "").otherwise(char)
    )


def _referred(reference: Column, whole: bool = False) -> Column:
    """What one reference stands for; itself if nothing. A ``whole`` one is no shorter name with letters behind it."""
    named = {name: text for name, text in html5.items()}
    bare = {name: text for name, text in html5.items() if not name.endswith(";")}
    body = F.substring(reference, 2, 1 << 30)
    digits = F.ltrim(F.rtrim(F.substring(reference, 3, 1 << 30), F.lit(";")), F.lit("xX"))
    # numbers of more digits are beyond all characters; leading zeros do not count
    short = lambda d, n: F.when(F.length(F.ltrim(d, F.lit("0"))) > n, F.lit("9999999")).otherwise(d)
    hexed = F.conv(short(digits, 8), 16, 10).cast("decimal(38,0)")
    number = F.when(reference.rlike("^&#[xX]"), F.when(F.length(F.ltrim(digits, F.lit("0"))) > 8, F.lit(1 << 32).cast("decimal(38,0)")).otherwise(hexed))
    number = number.otherwise(short(digits, 12).cast("decimal(38,0)"))

    def beginning(b: Column) -> Column:
        """The longest beginning that is a name which needs no semicolon."""
        lengths = F.sequence(F.length(b) - 1, F.lit(2), F.lit(-1))
        cuts = F.filter(F.transform(lengths, lambda n: F.substr(b, F.lit(1), n)), lambda c: lookup(bare)[c].isNotNull())
        cut = F.get(cuts, F.lit(0))
        return F.when(F.length(b) > 2, F.concat(lookup(bare)[cut], F.substr(b, F.length(cut) + 1)))

    by_name = let(body, lambda b: F.coalesce(lookup(named)[b], F.lit(None) if whole else beginning(b), F.concat(F.lit("&"), b)))
    return F.when(F.startswith(reference, F.lit("&#")), let(number, _numbered)).otherwise(by_name)


def decode_entities(text: Column, whole: bool = False) -> Column:
    """All HTML entities, by name and number, in one pass; only those that occur in a text are looked up.

    ``whole`` decodes those with a semicolon only, so that a cut one does not join the word after it.
    """
    pattern = WHOLE_ENTITY if whole else ENTITY
    return replace_found(text, pattern, lambda t: F.contains(t, F.lit("&")), lambda found: _referred(found, whole))


def create_slug(title: Column, max_length: int = 500) -> Column:
    """ASCII slug, cut at a word boundary; a title without letters gives "article"."""
    text = F.lower(decode_entities(title))
    text = F.translate(replace_all(text, LATIN_DIGRAPHS), LATIN_MARKED, LATIN_ASCII)
    text = F.translate(F.regexp_replace(text, MARKS, ""), "‘’", "")
    text = F.regexp_replace(text, "(?<=[0-9]),(?=[0-9])", "")
    slug = F.btrim(F.regexp_replace(text, f"[^{string.ascii_lowercase}{string.digits}]+", "-"), F.lit("-"))
    whole_words = f"^(?:(.{{0,{max_length}}})(?:-.*)?|(.{{{max_length}}}).*)$"
    slug = F.regexp_replace(F.regexp_replace(slug, whole_words, "$1$2"), "^$", "article")
    return F.when(F.coalesce(title, F.lit("")) == "", F.lit("")).otherwise(slug)


def link_tail(link: Column, max_length: int = 500) -> Column:
    """Last path segment of a link."""
    return F.substring(F.element_at(F.split(link, "/"), -1), 1, max_length)


def strip_html(text: Column, whole: bool = False) -> Column:
    """Text without tags and comments, entities decoded, or only the ``whole`` ones."""
    return F.coalesce(decode_entities(F.regexp_replace(text, MARKUP, ""), whole), F.lit(""))


def collapse_space(text: Column) -> Column:
    return trim_space(F.regexp_replace(text, WHITESPACE_RUN, " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trim_space(text), F.lit(""))


def comment_count(text: Column) -> Column:
    """Whole number in a text, 0 where there is none."""
    return F.coalesce(trim_space(text).try_cast("int"), F.lit(0))


def normalize_tone(text: Column, pairs: Iterable[tuple[str, str]] = TONE_PAIRS) -> Column:
    """Move tone marks from the old-style to the new-style vowel, by the given spelling pairs."""
    return replace_all(text, pairs)


def token_shape(token: Column) -> Column:
    """The token with every run of small letters as "a", of capitals as "A" and of digits as "9"."""
    small = F.regexp_replace(token, "[\\p{L}&&[^\\p{Lu}]]+", "a")
    return F.regexp_replace(F.regexp_replace(small, "\\p{Lu}+", "A"), "\\p{Nd}+", "9")


def _is_date(token: Column, shape: Column) -> Column:
    part = F.split(token, "[-/.]")
    day = lambda i: part[i].try_cast("int").between(1, 31) & (F.length(part[i]) <= 2)
    year_last = day(0) & day(1) & F.length(part[2]).isin(2, 4)
    year_first = (F.length(part[0]) == 4) & day(1) & day(2)
    return shape.isin("9-9-9", "9/9/9", "9.9.9") & (year_last | year_first)


def _is_time(token: Column, shape: Column) -> Column:
    part = F.split(token, ":")
    below = lambda i, n: (F.length(part[i]) == 2) & (part[i].try_cast("int") < n)
    hour = (F.length(part[0]) <= 2) & (part[0].try_cast("int") < 24)
    return hour & F.when(shape == "9:9", below(1, 60)).when(shape == "9:9:9", below(1, 60) & below(2, 60)).otherwise(False)


def token_class(token: Column, shape: Column | None = None) -> Column:
    """What a token is, told by its shape; the first class that fits counts.

    email: one "@" with something before it and a dot inside what follows. markup: "<" first,
    ">" last. date: three numbers with one kind of "-", "/" or "." between, the year of two
    or four digits last or of four digits first, the others 1 to 31. time: hours below 24
    and two-digit minutes, perhaps seconds. percent: a number with at most one mark, and "%".
    number: digits with single marks between, perhaps a sign. punctuation: neither letter nor
    digit. code: letters and digits, both. compound: parts of letters and digits with single
    marks between. allcaps, name and word: letters only, by their case; other: the rest.
    ``shape`` is a column with the token's shape, so that it is not computed for each class.
    """
    shape = token_shape(token) if shape is None else shape
    mail = F.split(token, "@")
    is_mail = (F.size(mail) == 2) & (mail[0] != "") & mail[1].rlike("^[^.].*\\.[^.]+$")
    classes = (
        ("email", is_mail), ("markup", F.startswith(token, F.lit("<")) & F.endswith(token, F.lit(">"))),
        ("date", _is_date(token, shape)), ("time", _is_time(token, shape)),
        ("percent", shape.isin("9%", "9.9%", "9,9%")), ("number", F.ltrim(shape, F.lit("+-")).rlike("^9([.,]9)*$") & ~shape.rlike("^[+-]{2}")),
        ("punctuation", ~shape.rlike("[aA9]")), ("code", shape.rlike("^[aA9]+$") & shape.contains("9") & shape.rlike("[aA]")),
        ("compound", shape.rlike("^[aA9]+([-_./'][aA9]+)+$")), ("allcaps", (shape == "A") & (F.length(token) > 1)),
        ("name", shape.isin("A", "Aa") & ~token.rlike("^\\p{Lu}{2}")), ("word", shape == "a"),
    )
    label = F.when(F.lit(False), "")
    for name, fits in classes:
        label = label.when(fits, name)
    return label.otherwise("other")
