"""Text and token-array expressions. All are built-in column functions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textweft.functions.arrays import let

# The short stop word list, and the pattern of a line that is rejected.
STOPWORDS = ("for", "a", "of", "the", "and", "to", "in")
BAD_LINE = r"\||[&=][a-zA-Z]"

# Unicode white space as a character class that Java and RE2 read alike.
SPACE = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NON_WORD = r"[^\p{L}\p{N}_]"
REVIEW_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_BREAK = r"\r\n|\r|\n"
# How a header line, a quoted line and a gap of a mail-style post look.
HEADER_LINE = r"^[A-Za-z][A-Za-z-]*:"
QUOTED_LINE = r"writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>"
GAP_LINE = rf"^{SPACE}*-*{SPACE}*$"


def tokenize_ws(text: Column) -> Column:
    """Lower-case words separated by white space."""
    return split_ws(F.lower(text))


def split_ws(text: Column) -> Column:
    """Words separated by white space, case kept."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def tokenize_word(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.array_remove(F.split(F.lower(text), NON_WORD + "+"), "")


def tokenize_review(text: Column) -> Column:
    """Lower-case words and single punctuation marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(REVIEW_TOKEN), 0)


def tokenize_cjk(text: Column) -> Column:
    """Overlapping character pairs of the text without white space."""
    return let(F.regexp_replace(text, SPACE + "+", ""), _character_pairs)


def _character_pairs(text: Column) -> Column:
    n = F.length(text)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(text, i, F.lit(2)))
    none = F.array().cast("array<string>")
    return F.when(n >= 2, pairs).when(n == 1, F.array(text)).otherwise(none)


def remove_stopwords(words: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Drop every occurrence of the given words, keeping order and repeats.

    For a long list held in a table, use ``drop_listed_words``.
    """
    return F.filter(words, lambda w: ~w.isin(*stopwords))


def normalize_ws(text: Column) -> Column:
    """Runs of white space become one space; none at either end."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def is_blank(text: Column) -> Column:
    return F.coalesce(normalize_ws(text), F.lit("")) == ""


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(~is_blank(F.col(text)))


def drop_bad_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Reject lines with a pipe, or with ``&`` or ``=`` before a letter."""
    return df.filter(~F.col(text).rlike(BAD_LINE))


def strip_mail(
    text: Column, headers: bool = True, footers: bool = True, quotes: bool = True
) -> Column:
    """Remove the header block, the quoted lines and the signature block of a post.

    The header block runs to the first empty line, if the post opens with a
    ``Name: value`` line. Quoted lines open with ``>`` or ``|`` or announce a
    quotation. The signature follows the last line that is empty or only dashes.
    """
    lines = F.split(text, LINE_BREAK)
    if headers:
        lines = let(lines, _drop_header)
    if quotes:
        lines = F.filter(lines, lambda line: ~line.rlike(QUOTED_LINE))
    body = F.array_join(lines, "\n")
    if footers:
        body = F.regexp_replace(body, rf"\A{SPACE}+|{SPACE}+\z", "")
        body = F.array_join(let(F.split(body, "\n"), _drop_footer), "\n")
    return body


def _drop_header(lines: Column) -> Column:
    first_gap = F.array_position(F.transform(lines, is_blank), True).cast("int")
    opens = F.get(lines, F.lit(0)).rlike(HEADER_LINE) & (first_gap > 0)
    return F.when(opens, F.slice(lines, first_gap + 1, F.size(lines))).otherwise(lines)


def _drop_footer(lines: Column) -> Column:
    gaps = F.transform(lines, lambda line, i: F.when(line.rlike(GAP_LINE), i).otherwise(0))
    last_gap = F.array_max(gaps)
    return F.when(last_gap > 0, F.slice(lines, F.lit(1), last_gap)).otherwise(lines)


def truncate_tokens(words: Column, n: int) -> Column:
    return F.slice(words, 1, n)


def paragraph_key(words: Column) -> Column:
    return F.array_join(words, " ")


def tagged_words(line: Column) -> Column:
    """Lower-case words of the ``WORD/TAG`` tokens that hold exactly one slash."""
    tokens = F.filter(split_ws(line), lambda t: F.size(F.split(t, "/")) == 2)
    return F.transform(tokens, lambda t: F.lower(F.split(t, "/")[0]))


def shift_label(stars: Column) -> Column:
    """Stars 1…n become classes 0…n-1."""
    return stars - 1
