"""Social-post tokeniser and HTML entity decoding as column expressions.

The pattern uses only constructs that behave alike in Java's regex and RE2:
explicit classes, no look-around, no flags, and no repeated groups (those
recurse per repetition in Java and overflow the stack on long runs).
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the token classes, tried in this order --------------------
SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"          # members of the whitespace class
WORD = r"\p{L}\p{N}_"                         # members of the word class
DIGIT = r"\p{Nd}"
LETTER = "A-Za-z"

_gap = rf"[{SPACE}.-]*"
PHONE = rf"(?:\+?[01]{_gap})?(?:\(?{DIGIT}{{3}}[{SPACE}.)-]*)?{DIGIT}{{3}}{_gap}{DIGIT}{{4}}"
URL = r"[Hh][Tt][Tt][Pp][Ss]?://[!$-_a-z]+"
_eyes, _nose = r"[:;=8]", r"[-oO*']?"
_mouth = r"[)\](\[dDpP/:}{@|\\]"
EMOTICON = rf"[<>]?{_eyes}{_nose}{_mouth}|{_mouth}{_nose}{_eyes}[<>]?"
HTML_TAG = r"<[^>]+>"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#+[{WORD}]+[{WORD}'-]*[{WORD}]+"
COMPOUND = rf"[{LETTER}][{LETTER}'_-]+[{LETTER}]"
NUMBER = rf"[+-]?{DIGIT}+[,/.:-]{DIGIT}+[+-]?"
PLAIN = rf"[{WORD}]+"
ELLIPSIS = rf"\.[{SPACE}.]*\."
OTHER = rf"[^{SPACE}]"
# -----------------------------------------------------------------------------

TOKEN = "(" + "|".join([PHONE, URL, EMOTICON, HTML_TAG, MENTION, HASHTAG,
                        COMPOUND, NUMBER, PLAIN, ELLIPSIS, OTHER]) + ")"
KEEP_CASE = {"url": URL, "emoticon": EMOTICON}


def raw_tokens(text: Column) -> Column:
    """Array of tokens in their original case."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))


def fold_case(token: Column, keep_case: str = "url") -> Column:
    """Lower-case a token unless it contains the kept class."""
    if keep_case not in KEEP_CASE:
        raise ValueError(f"keep_case must be one of {sorted(KEEP_CASE)}")
    kept = token.rlike(KEEP_CASE[keep_case])
    if keep_case == "url":   # cheap test first: the regex runs on few tokens
        kept = token.contains("://") & kept
    return F.when(kept, token).otherwise(F.lower(token))


def explode_tokens(posts: DataFrame, text: str = "text", token: str = "token",
                   keep_case: str = "url", decode_entities: bool = False) -> DataFrame:
    """One row per token occurrence; the text column is not carried along."""
    source = decode_html(F.col(text)) if decode_entities else F.col(text)
    rest = [c for c in posts.columns if c != text]
    return (posts
            .select(*rest, F.explode(raw_tokens(source)).alias(token))
            .withColumn(token, fold_case(F.col(token), keep_case)))


# --- HTML entities ------------------------------------------------------------

NUMERIC_PIECES = r"(&#[0-9]+;|[^&]+|&)"
NAMED_PIECES = r"(&[A-Za-z0-9_]+;|[^&]+|&)"


def named_entities() -> dict[str, str]:
    """Entity text to character, from the standard HTML table; not ``&amp;``."""
    return {f"&{name};": chr(point) for name, point in sorted(name2codepoint.items())
            if name != "amp"}


def _numeric_char(piece: Column) -> Column:
    """The character of ``&#N;``; null when N is no Unicode scalar value."""
    digits = F.regexp_extract(piece, r"^&#0*([0-9]{1,7});$", 1)
    point = F.when(digits != "", digits.cast("int"))
    scalar = point.between(0, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    # A leading byte-order mark is consumed by the decoder, so U+FEFF survives.
    encoded = F.concat(F.lit("0000FEFF"), F.lpad(F.hex(point), 8, "0"))
    return F.when(scalar, F.decode(F.unhex(encoded), "UTF-32"))


def decode_html(text: Column) -> Column:
    """Replace numeric, then named entities; ``&amp;`` becomes `` and `` last.

    Unknown entities stay as they are.  Each step cuts the text into pieces
    once and maps the pieces, so cost is linear in the text for any number of
    known names.
    """
    table = F.create_map(*[F.lit(v) for kv in named_entities().items() for v in kv])

    def numeric(piece: Column) -> Column:
        return F.when(piece.startswith("&#"),
                      F.coalesce(_numeric_char(piece), piece)).otherwise(piece)

    def named(piece: Column) -> Column:
        return F.when(piece.startswith("&"),
                      F.coalesce(F.try_element_at(table, piece), piece)).otherwise(piece)

    def rewrite(value: Column, pieces: str, fn) -> Column:
        cut = F.regexp_extract_all(value, F.lit(pieces), F.lit(1))
        return F.array_join(F.transform(cut, fn), "")

    decoded = rewrite(rewrite(text, NUMERIC_PIECES, numeric), NAMED_PIECES, named)
    out = F.replace(decoded, F.lit("&amp;"), F.lit(" and "))
    return F.when(F.contains(text, F.lit("&")), out).otherwise(text)
