"""Arrow UDFs for the steps that no built-in function expresses."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsloom.functions import text as T
from newsloom.functions.html import find_body, sanitize


def token_udf(tokenizer: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """A custom Python tokeniser as a token array; a text it fails on has no tokens."""
    def tokens(text: str | None) -> list[str]:
        try:
            return list(tokenizer(text)) if text else []
        except Exception:
            return []

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(tokens)

    return run


def keyword_udf(
    tokenizer: Callable[[str], list[str]], stopwords: Iterable[str] = (), min_length: int = 2,
) -> Callable[[Column], Column]:
    """Keywords of the lowered text by a custom tokeniser; the keyword rules stay native."""
    split, words = token_udf(tokenizer), list(stopwords)
    return lambda text: F.filter(split(T.trim_space(F.lower(text))), lambda t: T.is_keyword(t, min_length, words))


@F.pandas_udf(StringType())
def find_body_html(pages: pd.Series) -> pd.Series:
    return pages.map(find_body, na_action="ignore")


@F.pandas_udf(StringType())
def sanitize_html(fragments: pd.Series, urls: pd.Series) -> pd.Series:
    return pd.Series([sanitize(f, u) for f, u in zip(fragments, urls)], dtype=object)
