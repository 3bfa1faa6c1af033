"""String cleaning as columns.

Each function takes and returns a ``Column``, so a whole cleaning chain is one
projection that Catalyst can fuse into the scan stage.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32 ASCII punctuation characters.
ASCII_PUNCTUATION = string.punctuation

# What str.isspace() / Python's \s call white space. Java's \s is
# ASCII only unless told otherwise, and never counts U+001C to U+001F.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# The line ends of str.splitlines(); \v is Java's vertical white space.
LINE_ENDS = r"[\v\x1c-\x1e]+"

# The ASCII punctuation as a Java character class.
PUNCTUATION_RUN = r"\p{Punct}+"

PLAIN_TEXT_HEADER_CHARS = 6


def decode_utf8(content: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD instead of failing."""
    return F.make_valid_utf8(content.cast("string"))


def delete_chars(text: Column, chars: str = ASCII_PUNCTUATION) -> Column:
    if chars == ASCII_PUNCTUATION:
        return F.regexp_replace(text, PUNCTUATION_RUN, "")
    return F.translate(text, chars, "") if chars else text


def squeeze(text: Column, char: str) -> Column:
    """Runs of one character become one; the pattern runs only on texts that have any."""
    return F.when(F.contains(text, F.lit(char * 2)), F.regexp_replace(text, f"{char}{{2,}}", char)).otherwise(text)


def replace_char(text: Column, char: str, by: str) -> Column:
    return F.replace(text, F.lit(char), F.lit(by))


def collapse_whitespace(text: Column) -> Column:
    """Runs of (Unicode) white space become one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def join_lines(text: Column) -> Column:
    """Remove line ends; the lines touch."""
    return F.regexp_replace(text, LINE_ENDS, "")


def universal_newlines(text: Column) -> Column:
    return replace_char(replace_char(text, "\r\n", "\n"), "\r", "\n")


def drop_first(text: Column, n: int) -> Column:
    return F.substring(text, n + 1, 2**31 - 1)


def normalise(text: Column, punctuation: str = ASCII_PUNCTUATION) -> Column:
    return F.lower(delete_chars(text, punctuation))


def clean_plain_text(text: Column) -> Column:
    """Converted .doc / .txt text: blanks, six-character header, bars, breaks, case."""
    text = squeeze(universal_newlines(text), " ")
    text = drop_first(text, PLAIN_TEXT_HEADER_CHARS)
    text = replace_char(text, "|", "")
    text = F.regexp_replace(text, "\n+", " ")
    text = F.regexp_replace(text, "\t+", " ")
    return normalise(text)


def clean_page_text(text: Column, strip_punctuation: bool = False) -> Column:
    """One pdf page: lines touch, white space collapses, lower case.

    Punctuation stays unless asked for; then blanks it leaves behind collapse too.
    """
    text = F.lower(collapse_whitespace(join_lines(text)))
    if strip_punctuation:
        text = collapse_whitespace(delete_chars(text))
    return text


def clean_rtf_text(text: Column, punctuation: str = ASCII_PUNCTUATION) -> Column:
    """Decoded rtf: drop punctuation, collapse blanks, lower case."""
    return F.lower(squeeze(delete_chars(text, punctuation), " "))


def clean_nodes(nodes: Column) -> Column:
    """Text nodes of an html body: one blank between nodes, no punctuation."""
    return normalise(F.array_join(nodes, " "))


def clean_paragraphs(paragraphs: Column, sep: str = "") -> Column:
    """Paragraph texts to one text.

    Paragraphs without any run are dropped. With the default separator the last
    and first words of neighbouring paragraphs touch.
    """
    kept = F.filter(paragraphs, lambda p: p != "")
    return F.array_join(F.transform(kept, lambda p: normalise(p)), sep)
