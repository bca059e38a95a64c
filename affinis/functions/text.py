"""Text functions as column expressions; each works inside one row, without a shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The common English stop word set of search analyzers.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)
# Message lines whose words count although they stand before the body.
HEADER_NAMES = ("From:", "Subject:", "Keywords:", "Summary:")

_CHAR = r"[\p{L}\p{N}_]"


def _words(text: Column, word: str, stop_words: Iterable[str]) -> Column:
    """All whole words that match ``word`` and are no stop word, in one regular expression pass."""
    stops = "|".join(sorted(stop_words))
    skip = f"(?!(?:{stops})(?!{_CHAR}))" if stops else ""
    pattern = f"(?<!{_CHAR}){skip}{word}(?!{_CHAR})"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def analyze(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of at least 3 letters a-z that are no stop words, in text order."""
    return _words(text, "[a-z]{3,}", stop_words)


def words(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of letters and digits that are no stop words, in text order."""
    return _words(text, f"{_CHAR}+", stop_words)


def sentence_terms(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Blank-separated words reduced to their letters; single letters and stop words drop out.

    ``stop_words`` is any list; a longer list than the default is the caller's choice.
    """
    letters = F.regexp_replace(F.lower(text), r"[^\p{L} ]", "")
    stops = list(stop_words)
    kept = F.filter(F.split(letters, " "), lambda w: F.length(w) > 1)
    return F.filter(kept, lambda w: ~w.isin(stops)) if stops else kept


def lines(text: Column) -> Column:
    """Lines of a text; a newline at the end opens no further line."""
    return F.split(F.regexp_replace(text, "\r?\n\\z", ""), "\r?\n")


def _blank(line: Column) -> Column:
    return line.rlike(r"^\s*$")


def message_text(text_lines: Column) -> Column:
    """Text of a message that counts: header values, and all from the first two blank lines on.

    The body starts at the first blank line that follows a blank line; the line before the
    first one counts as blank. The positions are computed inside the row.
    """
    header = F.filter(
        text_lines,
        lambda x: x.startswith(HEADER_NAMES[0]) | x.startswith(HEADER_NAMES[1])
        | x.startswith(HEADER_NAMES[2]) | x.startswith(HEADER_NAMES[3]),
    )
    values = F.transform(header, lambda x: F.regexp_replace(x, ".*:", ""))
    # The lines are bound once, so that the inner function does not split the text again.
    starts = F.get(
        F.transform(
            F.array(text_lines),
            lambda ls: F.filter(
                F.sequence(F.lit(0), F.size(ls) - 1),
                lambda i: _blank(F.get(ls, i)) & F.coalesce(_blank(F.get(ls, i - 1)), F.lit(True)),
            ),
        ),
        F.lit(0),
    )
    first = F.get(starts, F.lit(0))
    body = F.slice(text_lines, F.coalesce(first, F.size(text_lines)) + 1, F.size(text_lines))
    return F.array_join(F.concat(values, body), "\n")


def adjacent_pairs(tokens: Column) -> Column:
    """``struct(first, second)`` of neighbouring tokens."""
    n = F.size(tokens)
    return F.when(
        n > 1,
        F.zip_with(
            F.slice(tokens, 1, n - 1), F.slice(tokens, 2, n - 1),
            lambda a, b: F.struct(a.alias("first"), b.alias("second")),
        ),
    ).otherwise(F.array().cast("array<struct<first:string,second:string>>"))


def title_of(html: Column) -> Column:
    """Text of the first title element; null where there is none."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(html.rlike(r"(?is)<title[^>]*>.*?</title>"), F.trim(found))


# File kinds by extension.
FILE_TYPES = {
    "text": "text", "txt": "text", "html": "html", "htm": "html", "xml": "xml", "pdf": "pdf",
    "rtf": "rtf", "odt": "ootext", "xls": "msexcel", "xlsx": "msexcel", "doc": "msword",
    "docx": "msword", "ppt": "mspowerpoint", "pptx": "mspowerpoint", "pst": "msoutlook",
    "vsd": "visio", "png": "png", "jpg": "jpeg", "jpeg": "jpeg", "mp3": "mp3",
}


def extension(path: Column) -> Column:
    """Lower-case extension of the last path part, without query and fragment; may be empty."""
    plain = F.regexp_replace(path, "[?#].*", "")
    return F.lower(F.regexp_extract(plain, r"\.([^./]*)$", 1))


def file_type(path: Column) -> Column:
    """Kind of a file by its extension; ``undef`` for others."""
    kinds = F.create_map(*[F.lit(x) for pair in FILE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, extension(path)), F.lit("undef"))
