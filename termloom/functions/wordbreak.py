"""Words by the Unicode word-break rules, as one regular expression that runs in the JVM.

The rules (UAX 29) join what stands between two breaks; a token is a piece with a letter or a digit in it.
Letters and digits stick together, a middle mark joins two letters ("don't", "e.g"), another one two
digits ("3.14", "1,000"), connectors such as ``_`` join anything, Katakana stays together, Han and
Hiragana stand alone, scripts written without blanks (Thai and others) give one token a run.  Marks and
format characters belong to what they follow.  Every repetition is possessive, so that a token of any
length is read without recursion.
"""

from __future__ import annotations

from .text import Analyzer

# English stop words, and the longest token that is kept.
ENGLISH_STOP_WORDS = tuple(
    (
        "a an and are as at be but by for if in into is it no not of on or such "
        "that the their then there these they this to was will with"
    ).split()
)
MAX_TOKEN_LENGTH = 255

# Word-break classes.
MIDDLE_BOTH = r".\u2018\u2019\u2024\uFE52\uFF07\uFF0E'"
MIDDLE_LETTER = r":\u00B7\u0387\u055F\u05F4\u2027\uFE13\uFE55\uFF1A"
MIDDLE_NUMBER = r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
CONNECTOR = r"\p{Pc}\u202F"
EXTEND = r"\p{M}\p{Cf}"
KATAKANA = r"\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70"
WITHOUT_BLANKS = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}"


def word_pattern() -> str:
    apart = rf"\p{{IsIdeographic}}\p{{IsHiragana}}{KATAKANA}{WITHOUT_BLANKS}\p{{M}}\p{{Nd}}"
    letter = rf"[\p{{IsAlphabetic}}&&[^{apart}]]"
    digit = r"\p{Nd}\u066B"
    # A class within a class is a union: a letter or a digit with what extends it.
    letters = rf"{letter}[{letter}{EXTEND}]*+"
    digits = rf"[{digit}][{digit}{EXTEND}]*+"
    hebrew = rf'(?:(?<=\p{{IsHebrew}})"(?=\p{{IsHebrew}})|[{MIDDLE_BOTH}{MIDDLE_LETTER}][{EXTEND}]*+)'
    worded = rf"{letters}(?:{hebrew}{letters})*+"
    number = rf"{digits}(?:[{MIDDLE_BOTH}{MIDDLE_NUMBER}][{EXTEND}]*+{digits})*+"
    part = rf"(?:(?:{worded}|{number})++|[{KATAKANA}][{KATAKANA}{EXTEND}]*+)"
    joint = rf"[{CONNECTOR}][{CONNECTOR}{EXTEND}]*+"
    word = rf"(?:{joint})?+{part}(?:{joint}{part})*+(?:{joint})?+"
    alone = rf"[\p{{IsIdeographic}}\p{{IsHiragana}}][{EXTEND}]*+"
    run = rf"[{WITHOUT_BLANKS}][{WITHOUT_BLANKS}{EXTEND}]*+"
    return rf"{word}|{alone}|{run}"


WORD_BREAK_PATTERN = word_pattern()
# URLs with a scheme and e-mail addresses are tried first and stay whole.
URL_PATTERN = r"(?:https?|ftp|file)://[^\s<>\"]*[^\s<>\".,;:!?)\]']"
EMAIL_PATTERN = r"[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]{1,63}\.){1,16}\p{L}{2,63}"
URL_EMAIL_WORD_PATTERN = f"{URL_PATTERN}|{EMAIL_PATTERN}|{WORD_BREAK_PATTERN}"


def standard_analyzer(stop_words: tuple[str, ...] = (), **options) -> Analyzer:
    """Words by the word-break rules, lower-cased; too long ones are left out."""
    options = {"max_token_length": MAX_TOKEN_LENGTH, **options}
    return Analyzer(WORD_BREAK_PATTERN, stop_words=stop_words, **options)


def url_email_analyzer(stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS, **options) -> Analyzer:
    """Words, URLs and e-mail addresses; English stop words go before lower-casing."""
    options = {"max_token_length": MAX_TOKEN_LENGTH, "stop_before_lower": True, **options}
    return Analyzer(URL_EMAIL_WORD_PATTERN, stop_words=stop_words, **options)
