"""HTML functions: native columns where a pattern can express them, else small parsers."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as T

NOISE = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"
CHROME = r"(?is)<(nav|footer|header)\b.*?</\1\s*>"
ARTICLE = r"(?is)<article\b[^>]*>.*?</article\s*>"

# Tags and attributes kept in a sanitised body, and link schemes.
KEPT_TAGS = {
    "p", "br", "strong", "em", "u", "h1", "h2", "h3", "h4", "h5", "h6",
    "ul", "ol", "li", "blockquote", "a", "img", "div", "span",
}
KEPT_ATTRIBUTES = {
    "a": {"href", "title"},
    "img": {"src", "alt", "title"},
    "div": {"class"},
    "span": {"class"},
}
KEPT_SCHEMES = {"http", "https", "mailto"}
# Class names that mark an article body, in order of preference.
BODY_CLASSES = ("article-content", "post-content", "entry-content", "content")
REMOVED_TAGS = {"script", "style", "nav", "footer", "header"}
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
}
CLOSES_PARAGRAPH = {
    "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}


def without_noise(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, NOISE, "")


def article_of(clean: Column) -> Column:
    """The article element of a page without noise, without navigation, footers and headers."""
    return F.regexp_replace(F.regexp_extract(clean, ARTICLE, 0), CHROME, "")


def is_plain(clean: Column, article: Column) -> Column:
    """True where ``article_of`` is exact: one article, no nested page furniture."""
    marks = F.regexp_count(clean, F.lit(r"(?i)</?article\b"))
    plain = article.rlike(r"(?is)^<article\b") & ~article.rlike(r"(?i)</?(nav|footer|header|script|style)\b")
    return F.coalesce((marks == 2) & plain, F.lit(False))


def html_text(html: Column, whole_references: bool = False) -> Column:
    """Visible text of a fragment on one line, entities decoded."""
    return T.collapse_space(T.strip_html(html, whole_references))


def absolute_link(link: Column, base: Column) -> Column:
    """A link resolved against its page url."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    path = F.regexp_extract(link, "^([^?#]*)", 1)
    suffix = F.regexp_extract(link, "^[^?#]*(.*)$", 1)
    rooted = F.when(F.startswith(path, F.lit("/")), path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    )
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(link == "", base)
        .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, base_path, link))
        .otherwise(F.concat(site, _without_dots(rooted), suffix))
    )


def _without_dots(path: Column) -> Column:
    def step(kept: Column, part: Column) -> Column:
        shorter = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", shorter).when(part == ".", kept).otherwise(F.array_append(kept, part))

    parts = F.split(F.regexp_replace(path, r"(^|/)\.{1,2}$", "$0/"), "/")
    folded = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(folded, "/")).otherwise(path)


class _BodyFinder(HTMLParser):
    """Records where each element that may be the body, or must go, starts and ends."""

    def __init__(self, page: str):
        super().__init__()
        self.page, self.open, self.bodies, self.removed = page, [], [], []
        self.lines = [0] + [m.end() for m in re.finditer("\n", page)]
        self.feed(page)
        self.close()
        self._end_from(0, len(page), len(page))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    @staticmethod
    def _rank(tag: str, attributes: dict) -> int | None:
        if tag == "article":
            return 0
        ranks = [i for i, c in enumerate(BODY_CLASSES, 1) if c in (attributes.get("class") or "")]
        if ranks:
            return ranks[0]
        if tag == "main":
            return 5
        if tag == "div" and attributes.get("role") == "main":
            return 6
        return 7 if tag == "body" else None

    def handle_starttag(self, tag, attrs):
        if tag not in VOID_TAGS:
            self.open.append((tag, self._offset(), self._rank(tag, dict(attrs))))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                start = self._offset()
                self._end_from(depth, start, self.page.find(">", start) + 1 or len(self.page))
                break

    def _end_from(self, depth: int, inner_end: int, outer_end: int) -> None:
        for level in range(len(self.open) - 1, depth - 1, -1):
            tag, start, rank = self.open.pop()
            end = outer_end if level == depth else inner_end
            if rank is not None:
                self.bodies.append((rank, start, end))
            if tag in REMOVED_TAGS:
                self.removed.append((start, end))

    def body(self) -> str | None:
        if not self.bodies:
            return None
        _, start, end = min(self.bodies)
        kept, at = [], start
        for low, high in sorted(s for s in self.removed if start < s[0] and s[1] <= end):
            if low >= at:
                kept.append(self.page[at:low])
                at = high
        return "".join(kept) + self.page[at:end]


def find_body(page: str | None) -> str | None:
    """Main element of any page by the selector order, without page furniture."""
    return _BodyFinder(page).body() if page else None


class _Sanitizer(HTMLParser):
    def __init__(self, fragment: str, url: str):
        super().__init__(convert_charrefs=True)
        self.url, self.out, self.open = url, [], []
        self.feed(fragment)
        self.close()
        self._close_to(0)

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.out.append(f"</{self.open.pop()}>")

    def _attribute(self, name: str, value: str) -> str | None:
        if name in ("href", "src"):
            value = urljoin(self.url, value.strip())
            scheme = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", value)
            if scheme and scheme.group(1).lower() not in KEPT_SCHEMES:
                return None
        return f' {name}="{escape(value)}"'

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_PARAGRAPH and "p" in self.open:
            self._close_to(self.open.index("p"))
        if tag == "li" and self.open and self.open[-1] == "li":
            self._close_to(len(self.open) - 1)
        if tag not in KEPT_TAGS:
            return
        allowed = KEPT_ATTRIBUTES.get(tag, ())
        kept = [self._attribute(n, v or "") for n, v in attrs if n in allowed]
        self.out.append(f"<{tag}{''.join(k for k in kept if k)}>")
        if tag not in VOID_TAGS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            self._close_to(len(self.open) - 1 - self.open[::-1].index(tag))

    def handle_data(self, data):
        self.out.append(escape(data, quote=False))


def sanitize(fragment: str | None, url: str | None) -> str | None:
    """Allowed tags and attributes only, links absolute, whitespace collapsed."""
    if not fragment:
        return None
    clean = " ".join("".join(_Sanitizer(fragment, url or "").out).split())
    return clean or None
