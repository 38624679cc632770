"""Text cleaning as column expressions, with Python forms that parse markup and unfold characters by the library."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Character ranges and patterns that decide what is removed.
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2500}-\x{2BEF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{1F926}-\x{1F937}\x{10000}-\x{10FFFF}\x{2640}-\x{2642}"
    r"\x{2600}-\x{2B55}\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}]+"
)
SQUARE, ANGLE, ROUND = r"\[[^\n]*?\]", r"<[^\n]*?>", r"\([^\n]*?\)"
URL = r"((http|https)://)?[a-zA-Z0-9./?:@\-_=#]+\.([a-zA-Z]){2,6}([a-zA-Z0-9.&/?:@\-_=#])*"
EMAIL, MENTION, HASHTAG = r"\S*@\S*", r"@\S*", r"#\S+"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
WORD_WITH_DIGIT = r"[\p{L}\p{N}_]*\p{Nd}[\p{L}\p{N}_]*"
QUOTES = "[‘’“”…«»]"
NOT_WORD = r"[^\p{L}\p{N}_]"
TAG = r"<[^>]*>"
NON_ASCII = r"[^\x00-\x7F]"
WHITESPACE = r"\s+"
TILDES = ("áéíóúüñÁÉÍÓÚÜ", "aeiouunAEIOUU")
# The same patterns for Java's engine: anchored where a match can only begin, without backtracking, and without
# replacing a blank by a blank. They remove exactly what the plain ones remove.
_URL_START = r"(?<![a-zA-Z0-9./?:@\-_=#])"
_FAST = {
    URL: _URL_START + URL,
    EMAIL: r"(?<!\S)[^\s@]*+@\S*+",
    WORD_WITH_DIGIT: r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_&&[^\p{Nd}]]*+\p{Nd}[\p{L}\p{N}_]*+",
    NOT_WORD: r"[^\p{L}\p{N}_ ]",
    WHITESPACE: r"\s{2,}|[\t\n\r\f\x0B]",
}
#: A character reference as HTML reads it: a number or a name, the semicolon being optional.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Longest of the names that need no semicolon and may run on into a word.
_OPEN = {k: v for k, v in html5.items() if not k.endswith(";")}
_LONGEST = max(map(len, _OPEN))


def _unfoldings() -> tuple[dict[str, str], dict[str, str]]:
    """Characters beyond ASCII whose compatibility decomposition holds one ASCII character, and those with several."""
    one, several = {}, {}
    for code in (*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)):
        base = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if base:
            (one if len(base) == 1 else several)[chr(code)] = base
    return one, several


_ONE, _SEVERAL = _unfoldings()
FOLD_FROM, FOLD_TO = "".join(_ONE), "".join(_ONE.values())


def _class_of(characters: Iterable[str]) -> str:
    """A character class of runs of code points."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


# ASCII is ruled out first: the class is tried on few characters.
_SEVERAL_CLASS = r"(?=[^\x00-\x7F])" + _class_of(_SEVERAL)


def _constant_map(table: Mapping[str, str]) -> Column:
    """A map that is computed once per query."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _replace_each(text: Column, pattern: str, replaced: Callable[[Column], Column]) -> Column:
    """Every match of ``pattern`` replaced by what a function makes of it, in one pass from left to right."""

    def one(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), replaced)
        pieces = F.zip_with(F.split(t, pattern, -1), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.when(t.rlike(pattern), F.array_join(pieces, "")).otherwise(t)

    # Bound to a variable, so that what makes the text is computed once.
    return F.get(F.transform(F.array(text), one), F.lit(0))


def _character(code: Column) -> Column:
    """The character a numeric reference stands for; what no text may hold gives nothing or the replacement character."""
    # Numbers from 0x80 to 0x9F stand for the characters of the Windows code page.
    old = {str(c): bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)} | {"0": "\ufffd", "13": "\r"}
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    low = code.between(1, 8) | (code == 11) | code.between(14, 31) | code.between(127, 159)
    none = low | code.between(0xFDD0, 0xFDEF) | ((code % 65536) >= 65534)
    return (
        F.when((code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .otherwise(F.coalesce(_constant_map(old)[code.cast("string")], F.when(none, F.lit("")).otherwise(plain)))
    )


def _resolved(reference: Column) -> Column:
    name = F.substring(reference, F.lit(2), F.length(reference))
    digits = F.regexp_extract(name, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    # More than eight digits are beyond any character; what an unsigned number can hold is not asked of them.
    short = F.concat(F.lit("0"), F.substring(digits, F.lit(1), F.lit(8)))
    number = F.when(name.rlike("^#[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
    code = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(number.cast("bigint"))
    open_names = _constant_map(_OPEN)
    starts = [
        F.when(F.length(name) > n, F.concat(open_names[F.substring(name, F.lit(1), F.lit(n))], F.substring(name, F.lit(n + 1), F.length(name))))
        for n in range(_LONGEST, 1, -1)
    ]
    named = F.coalesce(_constant_map(html5)[name], *starts, reference)
    return F.when(name.startswith("#"), _character(code)).otherwise(named)


def resolve_references(text: Column) -> Column:
    """All character references of HTML resolved once, named and numeric, as a browser does."""
    return _replace_each(text, REFERENCE, _resolved)


def _blank(text: Column, *patterns: str) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, _FAST.get(p, p), " ")
    return text


def strip_emoji(text: Column) -> Column:
    return _blank(text, EMOJI)


def strip_brackets(text: Column) -> Column:
    return _blank(text, SQUARE, ANGLE, ROUND)


def strip_urls(text: Column) -> Column:
    return _blank(text, URL)


def fold_accents(text: Column) -> Column:
    """Full compatibility decomposition, then ASCII only: accented letters become plain, ligatures their letters."""
    unfolded = _replace_each(text, _SEVERAL_CLASS, lambda c: _constant_map(_SEVERAL)[c])
    return F.regexp_replace(F.translate(unfolded, FOLD_FROM, FOLD_TO), NON_ASCII, "")


@F.pandas_udf(T.StringType())
def fold_accents_exact(text: pd.Series) -> pd.Series:
    """Full compatibility decomposition, then ASCII only."""
    return text.map(
        lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode(),
        na_action="ignore",
    )


def fold_tildes(text: Column) -> Column:
    return F.translate(text, *TILDES)


def strip_html(text: Column) -> Column:
    """Text without tags, all character references resolved."""
    return resolve_references(F.regexp_replace(text, TAG, ""))


class _TextOnly(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _parsed_text(markup: str) -> str:
    parser = _TextOnly()
    parser.feed(markup)
    parser.close()
    return "".join(parser.parts)


@F.pandas_udf(T.StringType())
def strip_html_exact(text: pd.Series) -> pd.Series:
    """Text nodes of the parsed markup, every entity resolved."""
    return text.map(lambda s: None if s is None else _parsed_text(s), na_action="ignore")


def strip_handles(text: Column) -> Column:
    return _blank(text, EMAIL, MENTION, HASHTAG)


def strip_punct_numbers(text: Column) -> Column:
    return _blank(text, PUNCTUATION, WORD_WITH_DIGIT, QUOTES, NOT_WORD)


def squeeze_space_lower(text: Column) -> Column:
    return F.lower(F.trim(_blank(text, WHITESPACE)))


def stop_words(languages: Sequence[str] = ("spanish", "english")) -> list[str]:
    """Spark's bundled lists, merged."""
    return sorted({w for lang in languages for w in StopWordsRemover.loadDefaultStopWords(lang)})


def remove_stopwords(text: Column, words: Sequence[str]) -> Column:
    """Drop listed words from space-separated text; the list becomes a hash set in the plan."""
    kept = F.filter(F.split(text, " "), lambda w: ~w.isin(*words))
    return F.array_join(kept, " ")


def clean_text(text: Column, words: Sequence[str], exact: bool = False) -> Column:
    """The whole chain; a NULL text stays NULL.

    ``exact`` swaps in the Python forms of accent folding and HTML parsing.
    """
    text = strip_urls(strip_brackets(strip_emoji(text)))
    text = strip_html_exact(fold_accents_exact(text)) if exact else strip_html(fold_accents(text))
    text = strip_punct_numbers(strip_handles(text))  # plain ASCII by now: no tildes left to fold
    return remove_stopwords(squeeze_space_lower(text), words)
