"""Text, URL and record expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(c: Column | str) -> Column:
    """Runs of ASCII letters and digits in lower case; NULL and '' give an empty array."""
    text = F.coalesce(F.lower(_col(c)), F.lit(""))
    return F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))


def keep_terms(tokens: Column, stopwords: Iterable[str] = fixed.STOPWORDS) -> Column:
    """Drop tokens of one character and stopwords."""
    stop = list(stopwords)
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(*stop))


def stem(token: Column) -> Column:
    """Cut the first suffix that fits and leaves at least three characters."""
    out = None
    for suffix in fixed.STEM_SUFFIXES:
        fits = token.endswith(suffix) & (F.length(token) > len(suffix) + 2)
        cut = F.substring(token, F.lit(1), F.length(token) - len(suffix))
        if suffix == "ies":
            cut = F.concat(cut, F.lit("y"))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(token)


def search_terms(c: Column | str, stemming: bool = False) -> Column:
    """Token array of a text: tokenised, filtered and optionally stemmed."""
    terms = keep_terms(tokenize(c))
    return F.transform(terms, stem) if stemming else terms


def query_terms(query: str, stemming: bool = False) -> list[str]:
    """The same rules for one query string, on the driver (a query is a handful of words)."""
    terms = [t for t in re.findall("[a-z0-9]+", query.lower()) if len(t) > 1 and t not in fixed.STOPWORDS]
    if not stemming:
        return terms

    def cut(token: str) -> str:
        for suffix in fixed.STEM_SUFFIXES:
            if token.endswith(suffix) and len(token) > len(suffix) + 2:
                return token[: -len(suffix)] + ("y" if suffix == "ies" else "")
        return token

    return [cut(t) for t in terms]


def stable_id(url: Column | str) -> Column:
    """First 16 hex digits of the SHA-1 of the URL."""
    return F.substring(F.sha1(_col(url)), 1, 16)


def searchable_text(title: Column, abstract: Column, authors: Column, year: Column) -> Column:
    """Title, abstract, authors and year joined by spaces; missing parts count as ''."""
    blank = F.lit("")
    return F.concat_ws(
        " ",
        F.coalesce(_col(title), blank),
        F.coalesce(_col(abstract), blank),
        F.coalesce(F.array_join(_col(authors), " "), blank),
        F.coalesce(_col(year).cast("string"), blank),
    )


def first_year(c: Column | str) -> Column:
    """First year from 1900 to 2099 standing as a word, else ''."""
    return F.regexp_extract(F.coalesce(_col(c), F.lit("")), r"\b((?:19|20)\d{2})\b", 1)


def slug(title: Column | str, limit: int | None = None) -> Column:
    """URL slug of a title, cut at ``limit`` characters when given."""
    s = F.translate(F.lower(_col(title)), fixed.SLUG_DASHES, "-" * len(fixed.SLUG_DASHES))
    s = F.regexp_replace(s, r"(?U)[^\w\s-]", "")
    s = F.btrim(F.regexp_replace(s, r"(?U)[-\s]+", "-"), F.lit("-"))
    if limit is None:
        return s
    return F.when(F.length(s) > limit, F.btrim(F.substring(s, 1, limit), F.lit("-"))).otherwise(s)


def repaired_url(url: Column | str, title: Column | str, prefix: str, limit: int | None = None) -> Column:
    """Canonical URL below ``prefix`` built from the title; other URLs and empty titles stay."""
    url, title = _col(url), _col(title)
    mendable = url.startswith(prefix) & (F.coalesce(title, F.lit("")) != "")
    return F.when(mendable, F.concat(F.lit(prefix), slug(title, limit), F.lit("/"))).otherwise(url)


def highlight(text: Column | str, query: str, css_class: str = "search-highlight") -> Column:
    """Wrap every query word found in the text; an all-stopword query is matched whole."""
    text = _col(text)
    if not query or not query.strip():
        return text
    words = [w for w in query.split() if w.lower() not in fixed.STOPWORDS and len(w) > 1]
    quoted = [re.sub(r"([^\w\s])", r"\\\1", w) for w in (words or [query.strip()])]
    return F.regexp_replace(text, f"(?iu)({'|'.join(quoted)})", f'<mark class="{css_class}">$1</mark>')


def shorten(c: Column | str, limit: int = 1000) -> Column:
    """Cut to ``limit`` characters, the last one an ellipsis when something was cut."""
    c = _col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit("…"))).otherwise(c)


def profile_link(url: Column, name: Column, search_base: str) -> Column:
    """The stored profile link, else a search link with the encoded name."""
    encoded = F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(search_base), encoded))


def _without_steps(path: Column) -> Column:
    """A rooted path with its "." and ".." steps taken, in one walk; steps above the root stay at the root."""
    kept = F.aggregate(
        F.split(path, "/", -1), F.expr("cast(array() AS array<string>)"),
        lambda done, s: F.when(s == ".", done).when(
            s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        ).otherwise(F.concat(done, F.array(s))),
    )
    ends_in_step = path.rlike(r"/\.\.?$")
    return F.concat(F.array_join(kept, "/"), F.when(ends_in_step, "/").otherwise(""))


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """Resolve a link against its page: full, protocol-relative, rooted, query and relative links."""
    base, href = _col(base), _col(href)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    page = F.when(page == root, F.concat(page, F.lit("/"))).otherwise(page)
    folder = F.regexp_extract(page, r"^(.*/)", 1)
    tail = F.regexp_extract(href, r"([?#].*)$", 1)
    own = F.regexp_extract(href, r"^([^?#]*)", 1)
    path = F.when(own.startswith("/"), own).otherwise(F.substr(F.concat(folder, own), F.length(root) + 1))
    joined = F.concat(root, _without_steps(path), tail)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(joined)
    )


def feed_text(title: Column | str, summary: Column | str) -> Column:
    """Title and summary as one text: ``title. summary``, trimmed."""
    blank = F.lit("")
    joined = F.concat(
        F.trim(F.coalesce(_col(title), blank)), F.lit(". "), F.trim(F.coalesce(_col(summary), blank))
    )
    return F.trim(joined)


def host(url: Column | str) -> Column:
    """Host of a URL, NULL when it has none."""
    return F.nullif(F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
