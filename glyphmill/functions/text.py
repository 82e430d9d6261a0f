"""Text columns: folding, stripping, marker search, wrapping, escaping, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CONTENT_SCHEMA_VERSION

_SPACE = r"\s\x1C-\x1F\x85"


def bound(value: Column, use) -> Column:
    """use(value), with the value made once; inside a function of array items each mention would make it anew."""
    return F.get(F.transform(F.array(value), use), 0)


def fold(text: Column) -> Column:
    """Case folding as far as built-in functions go (upper then lower; ß becomes ss)."""
    return F.lower(F.upper(text))


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, f"(?U)^[{_SPACE}]+|[{_SPACE}]+$", "")


def blank(text: Column) -> Column:
    return strip(text) == ""


def contains_any(text: Column, markers: Sequence[str]) -> Column:
    """Whether any marker is a substring of the folded text."""
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(text, F.lit(m))
    return found


def count_markers(text: Column, markers: Sequence[str]) -> Column:
    return sum((F.contains(text, F.lit(m)).cast("bigint") for m in markers), F.lit(0).cast("bigint"))


def shout(text: Column) -> Column:
    return F.concat(F.regexp_replace(text, r"[.!?]+\z", ""), F.lit("!"))


def escape_html(text: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def url_quoted(text: Column) -> Column:
    """Percent-encoded UTF-8; letters, digits, slashes and - . _ ~ stay."""
    out = F.url_encode(text)
    for java, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(java), F.lit(plain))
    return out


def braces(text: Column) -> Column:
    """From the first { to the last }; null where there is none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def tokens(text: Column) -> Column:
    """Words where the text has a space, else characters."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.when(F.contains(text, F.lit(" ")), words).otherwise(F.filter(F.split(text, ""), lambda c: c != ""))


def broken(text: Column, limit: Column, max_lines: int, width=F.length) -> Column:
    """Greedy lines of at most limit; the state of the fold is the lines so far, by line feeds. The first word that
    overflows the last but one line is the last line alone, and what follows it is dropped."""
    separator = F.when(F.contains(text, F.lit(" ")), F.lit(" ")).otherwise(F.lit(""))
    full = max(1, max_lines - 1)

    def step(state: Column, token: Column) -> Column:
        joined = F.concat(F.substring_index(state, "\n", -1), separator, token)
        breaks = F.length(state) - F.length(F.replace(state, F.lit("\n"), F.lit("")))
        return F.when(state == "", token).when(breaks >= full, state).when(width(joined) <= limit, F.concat(state, separator, token)).otherwise(F.concat(state, F.lit("\n"), token))

    # A token is one character or more, so no others can reach a line that stays.
    some = F.slice(tokens(text), F.lit(1), (max_lines * (limit + 1)).cast("int"))
    return F.slice(F.split(F.aggregate(some, F.lit(""), step), "\n"), 1, max_lines)


def wrapped(text: Column, max_width, max_lines: int, width=F.length) -> Column:
    """The lines of broken(); a last line that is too wide ends in dots. No text, no lines."""
    limit = max_width if isinstance(max_width, Column) else F.lit(max_width)
    lines = broken(text, limit, max_lines, width)
    last = F.element_at(lines, -1)
    shorter = F.filter(F.sequence(F.lit(1), F.greatest(F.length(last) - 1, F.lit(1))), lambda n: (n == 1) | (width(F.concat(F.substring(last, F.lit(1), n), F.lit("..."))) <= limit))
    cut = F.when((width(last) <= limit) | (F.length(last) <= 1), last).otherwise(F.concat(F.substring(last, F.lit(1), F.array_max(shorter)), F.lit("...")))
    return F.when((text != "") & (F.size(tokens(text)) > 0), F.concat(F.slice(lines, 1, F.size(lines) - 1), F.array(cut))).otherwise(F.array().cast("array<string>"))


def cache_key(category: Column, seed: Column, count, language, provider, model) -> Column:
    """First 20 digits of the SHA-256 of the request as JSON with sorted keys."""
    quoted = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    json = F.concat(F.lit('{"category": '), quoted(category), F.lit(', "count": '), column(count).cast("string"), F.lit(', "model": '), quoted(column(model).cast("string")), F.lit(', "provider": '), quoted(column(provider)),
                    F.lit(f', "schema_version": "{CONTENT_SCHEMA_VERSION}", "seed": '), seed.cast("string"), F.lit(', "source_language": '), quoted(column(language)), F.lit("}"))
    return F.substring(F.sha2(json.cast("binary"), 256), 1, 20)


def clock(seconds: Column) -> Column:
    """h:mm:ss, mm:ss under an hour, --:-- where unknown."""
    s = seconds.cast("bigint")
    return F.when(s.isNull() | (s < 0), "--:--").when(s >= 3600, F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))).otherwise(F.format_string("%02d:%02d", F.floor(s / 60), F.pmod(s, F.lit(60))))
