"""Text functions as Columns. All but NFKC run inside the JVM."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a word, as Java and RE2 spell Python's \\w.
WORD = r"\p{L}\p{N}_"
DEVANAGARI = r"\x{0900}-\x{097F}"
TOKEN = rf"[#@]?[{WORD}{DEVANAGARI}%]+"
URL = r"(?i)https?://\S+"


def _text(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nfkc(text: Column | str) -> Column:
    """NFKC form. Only texts with a character beyond ASCII go to Python, in Arrow batches."""
    text = _text(text)

    @F.arrow_udf("string")
    def compose(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in column.to_pylist()], pa.string())

    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, text).otherwise(compose(F.when(~ascii_only, text)))


def tidy(text: Column | str) -> Column:
    """Drops zero-width and control characters (line feed and tab stay), then collapses and trims white space."""
    out = F.regexp_replace(_text(text), r"[\x{200B}-\x{200D}\x{FEFF}]", "")
    out = F.regexp_replace(out, r"[\p{Cc}&&[^\n\t]]", "")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def normalize_text(text: Column | str) -> Column:
    return tidy(nfkc(text))


def for_analysis(normalized: Column | str) -> Column:
    """Of a normalised text: lower case, with <url> for each address."""
    out = F.regexp_replace(F.lower(_text(normalized)), URL, " <url> ")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


HINTS = ("en_or_romanized", "hi_or_indic", "hinglish_or_mixed", "unknown")


def language_hint(text: Column | str) -> Column:
    """One of HINTS."""
    text = _text(text)
    indic = text.rlike(rf"[{DEVANAGARI}]")
    # beside A-Z, two letters that lower-case into a-z
    roman = text.rlike(r"[A-Za-z\x{0130}\x{212A}]")
    return F.when(indic & roman, "hinglish_or_mixed").when(indic, "hi_or_indic").when(roman, "en_or_romanized").otherwise("unknown")


def _sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(values, F.lower)))


def mentions(text: Column | str) -> Column:
    return _sorted_set(F.regexp_extract_all(_text(text), F.lit(rf"(?<![{WORD}])@([A-Za-z0-9_]{{1,15}})"), F.lit(1)))


def hashtags(text: Column | str) -> Column:
    return _sorted_set(F.regexp_extract_all(_text(text), F.lit(rf"(?<![{WORD}])#([{WORD}{DEVANAGARI}]+)"), F.lit(1)))


def clean_tags(tags: Column | str, mark: str) -> Column:
    """Tags without their mark, lower-cased, distinct and in order."""
    return F.array_sort(F.array_distinct(F.transform(F.coalesce(_text(tags), F.array().cast("array<string>")), lambda x: F.lower(F.regexp_replace(tidy(x), f"^{mark}+", "")))))


def clean_username(name: Column | str) -> Column:
    return F.lower(F.regexp_replace(normalize_text(name), "^@+", ""))


def fingerprint(post_id: Column, username: Column, timestamp: Column, analysed: Column) -> Column:
    """SHA-256 of the id, or without one of author, minute and analysed text."""
    by_id = F.concat(F.lit("id:"), post_id)
    fallback = F.concat(F.lit("fallback:"), F.lower(username), F.lit("|"), F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm"), F.lit("|"), analysed)
    return F.sha2(F.when(F.coalesce(post_id, F.lit("")) != "", by_id).otherwise(fallback), 256)


def tokens(lowered: Column | str) -> Column:
    return F.regexp_extract_all(_text(lowered), F.lit(TOKEN), F.lit(0))


def uppercase_ratio(text: Column | str) -> Column:
    text = _text(text)
    # texts without a capital, as all for analysis are, are not counted
    return F.when(text.rlike(r"\p{Lu}"), F.regexp_count(text, F.lit(r"\p{Lu}")) / F.regexp_count(text, F.lit(r"\p{L}"))).otherwise(F.lit(0.0))


def exclamations(text: Column | str) -> Column:
    text = _text(text)
    return F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))


def word_ngrams(text: Column | str) -> Column:
    """Words of two characters or more, then pairs of neighbours joined by a blank."""
    words = F.regexp_extract_all(_text(text), F.lit(rf"[{WORD}]{{2,}}"), F.lit(0))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, F.filter(pairs, lambda x: x.isNotNull()))


def status_id(href: Column | str) -> Column:
    return F.regexp_extract(_text(href), r"/status/(\d+)", 1)


def username_of(hrefs: Column | str) -> Column:
    """Last path part of the first link that names an account; `unknown` without one."""
    last = F.transform(_text(hrefs), lambda h: F.element_at(F.split(F.regexp_replace(h, "/+$", ""), "/"), -1))
    good = F.filter(last, lambda p: (p != "") & ~p.isin("home", "explore", "search") & ~F.startswith(p, F.lit("i")))
    return F.coalesce(F.lower(F.regexp_replace(F.get(good, F.lit(0)), "^@+", "")), F.lit("unknown"))


def search_text(query: Column | str, cutoff: Column, exclude_reposts: bool = True) -> Column:
    """What is sent to a search page for a configured query."""
    parts = [_text(query), F.concat(F.lit("since:"), F.date_format(cutoff, "yyyy-MM-dd"))]
    return F.concat_ws(" ", *parts, *([F.lit("-filter:retweets")] if exclude_reposts else []))


def percent_encoded(text: Column | str) -> Column:
    """URL encoding with %20 for a blank and / kept."""
    out = F.url_encode(_text(text))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def short_hash(text: Column | str) -> Column:
    """16 hex digits that name a path whatever its case."""
    return F.substring(F.sha2(F.lower(_text(text)), 256), 1, 16)


def has_marker(text: Column | str, markers: tuple[str, ...]) -> Column:
    low = F.lower(_text(text))
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(low, F.lit(m))
    return found
