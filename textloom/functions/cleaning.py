"""Text cleaning as native column expressions.

Every step takes a string Column and returns a string Column. Most texts hold nothing for most
steps, and a regular expression costs some twenty times as much per character as a search for a
fixed string. So a step first looks for a string that any match must contain, and leaves the text
alone without it. `bound` makes that possible in a chain: it evaluates the input once and gives it
a name, where a plain `CASE WHEN f(x) THEN g(x)` would evaluate everything below x twice.

All repeated groups in the patterns are possessive. Java matches a plain repeated group by
recursion, and one long text is enough to overflow the stack of the task.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("math", "latex", "code", "general")

# ---- fixed values ---------------------------------------------------------------------------

# Characters removed at both ends of a text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java character class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"

UNBOX = r'^[(\[{"]?' + WS + r"*\$*\\boxed\{([^}]*)\}\$*" + WS + r'*[)\]}"]?\.?' + WS + r"*\z"
BOX_INNER_WRAP = r"\\(?:text|mathrm)\{([^}]*)\}"
NEWLINES = r"(?:[\n\r\t]++|\\\\[ntr])++"
FORMATTING = r"(?=[#*_`!?&])(?:[#*_`]++|[!?]{2,}+|&[a-z]++;)"
MATH_WRAPPER = r"\\(?:mathrm|text|operatorname)\{([^}]*)\}"
DOLLAR_SPAN = r"(?<!\$)\$([^$]+)\$(?!\$)"
MATH_SPACING = r"\\(?:,|;|:|!|quad|qquad)" + WS + r"*"
MULTI_SPACE = WS + r"{2,}+"
# An amount such as $1,200.50$ is consumed as group 1, so its closing dollar opens no new span.
LATEX_SPAN = (
    r"(?d)(?<!\$)(\$\p{Nd}[\p{Nd},]*(?:\.\p{Nd}{1,2})?\$)(?!\$)"
    r"|(?<!\$)\$(?:\\.|[^$\\]++)++\$(?!\$)"
)
# One token after the opener, then everything up to the last closer.
TEX_SPAN = (
    r"(?s)\\\((?:[^\\]|\\.)(?:(?:[^\\]++|\\[^)])*+\\\))++"
    r"|\\\[(?:[^\\]|\\.)(?:(?:[^\\]++|\\[^\]])*+\\\])++"
)
MATHRM = r"(?d)\\mathrm\{.*?\}"
ENVIRONMENT = r"(?s)\\begin\{[^}]+\}.*?\\end\{[^}]+\}"
HTML_TAG = r"<[^>]+>"
BOXED = r"(?:(?<!\$)\$++)?\\boxed\{([^}]*+)\}\$*"
CHAT_TAG = r"\[/?(?:INST|SYS|USER|ASSISTANT)\]"
ANSWER_MARKER = (
    r"(?iu)^" + WS + r"*#{3,6}" + WS + r"*(?:final" + WS + r"*answer" + WS + r"*:)?"
    + WS + r"*(?:answer" + WS + r"*:)?" + WS + r"*"
)
DOUBLE_BRACE = r"(?d)\{\{.*?\}\}"
SPECIAL_TOKEN = r"(?d)<\|.*?\|>"
# A line start behind two line ends lies in white space that was tried from an earlier line start.
HEADER_LINE = r"(?dm)^(?<!\n\n)" + WS + r"*#{1,6}" + WS + r".*$"
# A word boundary where letters, numbers and the underscore make words, but no marks and joiners.
EDGE = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
JUNK_PHRASE = r"(?iu)" + EDGE + r"(?:Click here|Subscribe|Follow us|Advertisement)" + EDGE
SHOP_TAG = r"(?iu)" + EDGE + r"(?:SKU|ASIN|MSRP|Price:?" + WS + r"*\$?\p{Nd}[\p{Nd},.]*)" + EDGE
BOLD_SPAN = r"(?d)\*\*.*?\*\*"
INVISIBLE = "[\u200B-\u200F\u202A-\u202E\u2060\uFEFF]"
MEDIA_PLACEHOLDER = r"(?iu)\[(?:image|video|audio|figure)[^\]]*\]"
TRASH_PLACEHOLDER = "[TRASH]"
NON_ASCII = r"[^\x00-\x7F]+"
MATH_SYMBOLS = {
    r"\cdot": "*",
    r"\times": "*",
    r"\le": "<=",
    r"\ge": ">=",
    r"\neq": "!=",
    r"\pm": "+/-",
    r"\div": "/",
    r"\triangle": "triangle",
    r"\quad": " ",
}

PUNCTUATION = {
    "\u201c": '"', "\u201d": '"', "\u2018": "'", "\u2019": "'",
    "\u2013": "-", "\u2014": "-", "\u2192": "->", "\u2190": "<-",
}

BAD_TOKENS = [
    "embedreportprint", "cloneembedreport", "rawdownload", "printrawdownload",
    "reportprintclone", "embedreport", "printclone",
    "guiActive", "guiActiveUnfocused", "externalToEVA", "externalToEVAOnly",
    "PsyNetMessage", "vesselType", "activeRadarLock",
    "unfocusedRange", "targetType", "guiIcon", "stockLegacySensor", "KSPField",
    "persistent",
    "\u00c3\u0082", "\ufffd", "\u00c3\u00a2", "\u00e2\u20ac\u2122",
    "\u00e2\u20ac\u0153", "\u00e2\u20ac\u009d", "\u00e2\u20ac\u201c",
    "\u00e2\u20ac", "\u00c3\u00bc", "\u00c3\u00b6", "\u00c3\u0178",
    "[REJECTED ANSWER PLACEHOLDER]", "[PLACEHOLDER]", "[DUMMY]", "[INSERT]",
    "Traceback (most recent call last):", "NullPointerException",
    "undefined is not a function", "at com.",
    "You are a helpful assistant.", "LanguageModelOutput",
    "<|eot|>", "<unk>",
]

# ---- end of fixed values --------------------------------------------------------------------


def _emoji_pattern() -> str:
    """Emoji as published: the characters of the Unicode property Emoji beyond ASCII, with variation sign, skin
    tone and tags, joined ones as one, and keycaps."""
    points = [c for c in range(0x80, 0x20000) if regex.match(r"\p{Emoji}", chr(c))]
    first = [c for c, before in zip(points, [0, *points], strict=False) if c != before + 1]
    last = [c for c, after in zip(points, [*points[1:], 0], strict=True) if c != after - 1]
    one = "[" + "".join(rf"\x{{{a:X}}}-\x{{{z:X}}}" for a, z in zip(first, last, strict=True)) + "]"
    one += r"[\x{FE0E}\x{FE0F}]?+[\x{1F3FB}-\x{1F3FF}]?+[\x{E0020}-\x{E007F}]*+"
    return rf"[0-9#*]\x{{FE0F}}?\x{{20E3}}|{one}(?:\x{{200D}}{one})*+"


EMOJI = _emoji_pattern()



def bound(c: Column, body: Callable[[Column], Column]) -> Column:
    """body(c), with c evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(c), body), 1)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _has(*needles: str) -> Callable[[Column], Column]:
    return lambda x: _any([x.contains(n) for n in needles])


def _has_byte(*values: int) -> Callable[[Column], Column]:
    """Whether the UTF-8 form of the text holds a byte; finds character ranges in one pass."""
    return lambda x: _any([F.contains(x.cast("binary"), F.lit(bytes([v]))) for v in values])


# Characters that match an ASCII letter when case is ignored: long s, Kelvin sign, both odd i's.
_FOLDED = ("\u017f", "\u212a", "\u0131", "\u0130")


def _has_word(*needles: str) -> Callable[[Column], Column]:
    """As `_has`, whatever the case; the needles are lower case."""
    return lambda x: F.exists(F.array(F.lower(x)), _has(*needles)) | (~_ascii_only(x) & _has(*_FOLDED)(x))


def _sub(pattern: str, by: str, when: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Replace all matches; `when` is a cheap test that holds for every text with a match."""
    return lambda c: bound(c, lambda x: F.when(when(x), F.regexp_replace(x, pattern, by)).otherwise(x))


def _sub_closed(pattern: str, by: str, closers: str | tuple[str, ...], when: Callable[[Column], Column]
                ) -> Callable[[Column], Column]:
    """As `_sub`, for patterns that end at one of the `closers`.

    Only the text up to the last closer can match. Without the rest, an opener that is never
    closed cannot make the pattern run to the end of the text for each opener.
    """
    closers = (closers,) if isinstance(closers, str) else closers

    def replaced(x: Column) -> Column:
        rest = x
        for closer in closers:
            rest = F.substring_index(rest, closer, -1)
        return bound(rest, lambda rest: F.concat(
            F.regexp_replace(F.left(x, F.char_length(x) - F.char_length(rest)), pattern, by), rest))

    return lambda c: bound(c, lambda x: F.when(_has(*closers)(x) & when(x), replaced(x)).otherwise(x))


def _or_rest(pattern: str, opener: str) -> tuple[str, str]:
    """The pattern, or else an opener with all that follows on its line, which is put back.

    Where the first opener of a line finds no closer, no later one of the line does. Taken together
    with the rest, they are not tried one by one.
    """
    return f"{pattern}|({opener}.*+)", "$1"


def _ascii_only(x: Column) -> Column:
    return F.octet_length(x) == F.char_length(x)


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends; touches the ends of the text only."""
    return F.trim(c, F.lit(SPACES))


def to_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def unbox(c: Column) -> Column:
    """The content of a value that is one `\\boxed{...}` as a whole; other values unchanged."""
    def inner(t: Column) -> Column:
        return strip(F.regexp_replace(F.regexp_extract(t, UNBOX, 1), BOX_INNER_WRAP, "$1"))

    return bound(c, lambda x: F.when(
        x.contains(r"\boxed{") & F.rlike(strip(x), F.lit(UNBOX)), inner(strip(x))).otherwise(x))


def collapse_newlines(c: Column) -> Column:
    """Each run of line ends and tabs, also written as escapes, becomes one space."""
    runs = _has("\n\n", "\r", "\t", "\\\\")
    return strip(bound(c, lambda x: F.when(runs(x), F.regexp_replace(x, NEWLINES, " "))
                       .otherwise(F.replace(x, F.lit("\n"), F.lit(" ")))))


strip_formatting = _sub(FORMATTING, "", lambda x: F.rlike(x, F.lit(r"[#*_`!?&]")))
unwrap_math_wrappers = _sub_closed(MATH_WRAPPER, "$1", "}", _has("\\"))
unwrap_dollars = _sub(DOLLAR_SPAN, "$1", _has("$"))


def map_math_symbols(c: Column) -> Column:
    def mapped(x: Column) -> Column:
        for symbol, ascii_form in MATH_SYMBOLS.items():
            x = F.replace(x, F.lit(symbol), F.lit(ascii_form))
        return x

    return bound(c, lambda x: F.when(x.contains("\\"), mapped(x)).otherwise(x))


collapse_math_spacing = _sub(MATH_SPACING, " ", _has("\\"))


def collapse_spaces(c: Column) -> Column:
    """Runs of white space become one space. Other than ASCII, it starts with one of four bytes."""
    def may_match(x: Column) -> Column:
        odd = ~_ascii_only(x) & _has_byte(0xC2, 0xE1, 0xE2, 0xE3)(x)
        return x.contains("  ") | F.rlike(x, F.lit(r"[\x09-\x0d\x1c-\x1f]")) | odd

    return strip(_sub(MULTI_SPACE, " ", may_match)(c))


strip_latex_spans = _sub(LATEX_SPAN, "$1", _has("$"))
# Where an opener of one kind finds no closer, no later one of its kind does: what follows, up to an opener of the
# other kind, is taken with it and put back.
strip_tex_spans = _sub_closed(TEX_SPAN + r"|(\\\((?:[^\\]++|\\(?!\[))*+)|(\\\[(?:[^\\]++|\\(?!\())*+)", "$1$2", (r"\)", r"\]"),
                              _has(r"\(", r"\["))
strip_mathrm = _sub(*_or_rest(MATHRM, r"\\mathrm\{"), _has(r"\mathrm{"))
strip_environments = _sub_closed(*_or_rest(ENVIRONMENT, r"\\begin\{[^}]++\}"), "}",
                                 lambda x: x.contains(r"\begin{") & x.contains(r"\end{"))
strip_html = _sub_closed(HTML_TAG, "", ">", _has("<"))
# An opener without a closer takes the rest of the text, which is put back.
unwrap_boxed = _sub(BOXED + r"|(\\boxed\{[^}]*+)", "$1$2", _has(r"\boxed{"))
strip_chat_tags = _sub(CHAT_TAG, "", _has("["))
strip_answer_marker = _sub(ANSWER_MARKER, "", _has("###"))
strip_double_braces = _sub(*_or_rest(DOUBLE_BRACE, r"\{\{"), lambda x: x.contains("{{") & x.contains("}}"))
strip_special_tokens = _sub(*_or_rest(SPECIAL_TOKEN, r"<\|"), lambda x: x.contains("<|") & x.contains("|>"))
strip_header_lines = _sub(HEADER_LINE, "", _has("#"))
strip_junk_phrases = _sub(JUNK_PHRASE, "", _has_word("click here", "subscribe", "follow us", "advertisement"))
strip_shop_tags = _sub(SHOP_TAG, "", _has_word("sku", "asin", "msrp", "price"))
strip_bold = _sub(BOLD_SPAN, "", _has("**"))
strip_invisible = _sub(INVISIBLE, "", lambda x: ~_ascii_only(x) & _has_byte(0xE2, 0xEF)(x))
strip_media_placeholders = _sub_closed(MEDIA_PLACEHOLDER, "", "]", _has("["))


def strip_trash(c: Column) -> Column:
    return F.replace(c, F.lit(TRASH_PLACEHOLDER), F.lit(""))


def ascii_punctuation(c: Column) -> Column:
    def mapped(x: Column) -> Column:
        single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
        x = F.translate(x, "".join(single), "".join(single.values()))
        for k, v in PUNCTUATION.items():
            if len(v) > 1:
                x = F.replace(x, F.lit(k), F.lit(v))
        return x

    return bound(c, lambda x: F.when(_has_byte(0xE2)(x), mapped(x)).otherwise(x))


strip_emoji = _sub(EMOJI, "", _has_byte(0xC2, 0xE2, 0xE3, 0xF0))
strip_non_ascii = _sub(NON_ASCII, "", lambda x: ~_ascii_only(x))


def strip_junk_and_shop(c: Column) -> Column:
    """Both word steps behind one look for their words."""
    words = _has_word("click here", "subscribe", "follow us", "advertisement", "sku", "asin", "msrp", "price")
    return bound(c, lambda x: F.when(words(x), strip_shop_tags(strip_junk_phrases(x))).otherwise(x))


# Tokens that contain no other token: enough to answer whether any token is present.
_BAD_CORES = [t for t in BAD_TOKENS if not any(o != t and o in t for o in BAD_TOKENS)]
_BAD_CAMEL = [t for t in _BAD_CORES if re.search("[a-z][A-Z]", t)]
_BAD_BRACKET = [t for t in _BAD_CORES if t[0] in "[<"]
_BAD_OTHER = [t for t in _BAD_CORES if not t.isascii()]
_BAD_PLAIN = [t for t in _BAD_CORES if t not in {*_BAD_CAMEL, *_BAD_BRACKET, *_BAD_OTHER}]


def has_bad_token(x: Column) -> Column:
    """Looks for groups of tokens by what the group has in common, so prose is searched little."""
    return (_has(*_BAD_PLAIN)(x)
            | (_has("[", "<")(x) & _has(*_BAD_BRACKET)(x))
            | (F.rlike(x, F.lit("[a-z][A-Z]")) & _has(*_BAD_CAMEL)(x))
            | (~_ascii_only(x) & _has(*_BAD_OTHER)(x)))


def reject_bad_tokens(c: Column) -> Column:
    """Empty text when any rejected literal occurs."""
    return bound(c, lambda x: F.when(has_bad_token(x), F.lit("")).otherwise(x))


def bad_token(c: Column) -> Column:
    """The first rejected literal found in the text, or the empty string."""
    alternatives = "|".join(r"\Q" + t + r"\E" for t in BAD_TOKENS)
    return bound(c, lambda x: F.when(has_bad_token(x), F.regexp_extract(x, f"({alternatives})", 1)).otherwise(""))


def steps(mode: str, emoji: bool = False) -> list[Callable[[Column], Column]]:
    """The cleaning steps of a mode, in order."""
    if mode not in MODES:
        raise ValueError(f"cleaning mode must be one of {MODES}, not {mode!r}")
    out = [unbox]
    out += [strip] if mode == "code" else [collapse_newlines, strip_formatting]
    if mode == "math":
        out += [unwrap_math_wrappers, unwrap_dollars, map_math_symbols,
                collapse_math_spacing, collapse_spaces]
    if mode in ("code", "general"):
        out += [strip_latex_spans, strip_tex_spans, strip_mathrm]
    out += [strip_environments, strip_html, unwrap_boxed, strip_chat_tags, strip_answer_marker,
            strip_double_braces, strip_special_tokens, strip_header_lines, strip_junk_and_shop,
            strip_bold, strip_invisible, strip_media_placeholders]
    if mode != "latex":
        out.append(strip_trash)
    out.append(ascii_punctuation)
    if emoji:
        out.append(strip_emoji)
    if mode in ("math", "general"):
        out.append(strip_non_ascii)
    return out


def clean_text(c: Column, mode: str = "math", emoji: bool = False) -> Column:
    """The whole cleaning chain of a mode; never null."""
    c = to_text(c)
    for step in steps(mode, emoji):
        c = step(c)
    return strip(reject_bad_tokens(c))
