"""Cleaning steps and chains over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import cleaning as c
from workload.common import documents, marked, marked_sql, quoted, table

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"  # white space for the SQL engine's patterns
HIDDEN = "\ue000"


def _re(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(by)}, 'g')"


def _strip(x: str) -> str:
    return _re(x, rf"^{WS}+|{WS}+$")


def _hide_runs(x: str) -> str:
    """Runs of two and more dollars as placeholders: this engine has no look-around."""
    return f"replace(replace({x}, '$$', '{HIDDEN * 2}'), '{HIDDEN}$', '{HIDDEN * 2}')"


def _show_runs(x: str) -> str:
    return f"replace({x}, '{HIDDEN}', '$')"


def _chained_replace(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {quoted(old)}, {quoted(new)})"
    return x


# SQL form of each step
SQL_STEPS = {
    "collapse_newlines": lambda x: _strip(_re(x, r"(?:[\n\r\t]|\\\\[ntr])+", " ")),
    "strip": _strip,
    "strip_formatting": lambda x: _re(x, r"[#*_`]+|[!?]{2,}|&[a-z]+;"),
    "unwrap_math_wrappers": lambda x: _re(x, r"\\(?:mathrm|text|operatorname)\{([^}]*)\}", r"\1"),
    "unwrap_dollars": lambda x: _show_runs(_re(_hide_runs(x), rf"\$([^${HIDDEN}]+)\$", r"\1")),
    "map_math_symbols": lambda x: _chained_replace(x, [
        (r"\cdot", "*"), (r"\times", "*"), (r"\le", "<="), (r"\ge", ">="), (r"\neq", "!="),
        (r"\pm", "+/-"), (r"\div", "/"), (r"\triangle", "triangle"), (r"\quad", " ")]),
    "collapse_math_spacing": lambda x: _re(x, rf"\\(?:,|;|:|!|quad|qquad){WS}*", " "),
    "collapse_spaces": lambda x: _strip(_re(x, rf"{WS}{{2,}}", " ")),
    "strip_latex_spans": lambda x: _show_runs(_re(
        _hide_runs(x),
        rf"(\$\p{{Nd}}[\p{{Nd}},]*(?:\.\p{{Nd}}{{1,2}})?\$)|(?-s)\$(?:\\.|[^$\\{HIDDEN}])+\$", r"\1")),
    "strip_tex_spans": lambda x: _re(x, r"(?s)\\\((?:\\.|[^\\])+\\\)|\\\[(?:\\.|[^\\])+\\\]"),
    "strip_mathrm": lambda x: _re(x, r"(?-s)\\mathrm\{.*?\}"),
    "strip_environments": lambda x: _re(x, r"(?s)\\begin\{[^}]+\}.*?\\end\{[^}]+\}"),
    "strip_html": lambda x: _re(x, r"<[^>]+>"),
    "unwrap_boxed": lambda x: _re(x, r"\$*\\boxed\{([^}]*)\}\$*", r"\1"),
    "strip_chat_tags": lambda x: _chained_replace(x, [
        (f"[{slash}{tag}]", "") for tag in ("INST", "SYS", "USER", "ASSISTANT") for slash in ("", "/")]),
    "strip_answer_marker": lambda x: _re(
        x, rf"(?i)^{WS}*#{{3,6}}{WS}*(?:final{WS}*answer{WS}*:)?{WS}*(?:answer{WS}*:)?{WS}*"),
    "strip_double_braces": lambda x: _re(x, r"(?-s)\{\{.*?\}\}"),
    "strip_special_tokens": lambda x: _re(x, r"(?-s)<\|.*?\|>"),
    "strip_header_lines": lambda x: _re(x, rf"(?m)(?-s)^{WS}*#{{1,6}}{WS}.*$"),
    "strip_junk_phrases": lambda x: _re(x, r"(?i)\b(?:Click here|Subscribe|Follow us|Advertisement)\b"),
    "strip_shop_tags": lambda x: _re(x, rf"(?i)\b(?:SKU|ASIN|MSRP|Price:?{WS}*\$?\d[\d,.]*)\b"),
    "strip_junk_and_shop": lambda x: SQL_STEPS["strip_shop_tags"](SQL_STEPS["strip_junk_phrases"](x)),
    "strip_bold": lambda x: _re(x, r"(?-s)\*\*.*?\*\*"),
    "strip_invisible": lambda x: f"translate({x}, {quoted(''.join(map(chr, [*range(0x200B, 0x2010), *range(0x202A, 0x202F), 0x2060, 0xFEFF])))}, '')",
    "strip_media_placeholders": lambda x: _re(x, r"(?i)\[(?:image|video|audio|figure)[^\]]*\]"),
    "strip_trash": lambda x: f"replace({x}, '[TRASH]', '')",
    "ascii_punctuation": lambda x: _chained_replace(x, c.PUNCTUATION.items()),
    "strip_emoji": lambda x: _re(x, "😀|🚀|☀️|⏰|🇩🇪|1️⃣|©|👍🏽|👩‍💻"),  # all that the fixture holds; stars, ticks and chessmen are none
    "strip_non_ascii": lambda x: _re(x, r"[^\x00-\x7F]+"),
}


def _unbox_sql(x: str) -> str:
    t = _strip(x)
    whole = rf'^[(\[{{"]?{WS}*\$*\\boxed\{{([^}}]*)\}}\$*{WS}*[)\]}}"]?\.?{WS}*$'
    inner = _re(f"regexp_extract({t}, {quoted(whole)}, 1)", r"\\(?:text|mathrm)\{([^}]*)\}", r"\1")
    return f"CASE WHEN regexp_matches({t}, {quoted(whole)}) THEN {_strip(inner)} ELSE {x} END"


def _bad_sql(x: str) -> str:
    return " OR ".join(f"contains({x}, {quoted(t)})" for t in c.BAD_TOKENS)


# Common words of the four languages and the markup that replaces them, per query.
EN, FR, DE, ES = " the ", " la ", " die ", " que "
MARKS = {
    "clean_whitespace": [(EN, " \n\t\r "), (FR, r" \\n\\t "), (DE, "\u00a0\u2003 "), (ES, "\x1c \x85")],
    "clean_format": [(EN, " **the** "), (FR, " &amp;la&NBSP; "), (DE, " !!?! "), (ES, " #_`que` ! ")],
    "clean_math_wrap": [(EN, r" \mathrm{the} "), (FR, r" \text{la} "), (DE, r" \operatorname{die} "), (ES, r" \textbf{que} ")],
    "clean_math_dollar": [(EN, " $the$ "), (FR, " $$la$$ "), (DE, " $5$ die $ "), (ES, " $$$que$ ")],
    "clean_math_symbols": [(EN, r" \cdot \times the "), (FR, r" \left( \le \ge "), (DE, r" \neq \pm \div \\triangle "), (ES, r" \quad\qquad ")],
    "clean_math_spacing": [(EN, r" \,  the "), (FR, r" \;\: la   "), (DE, "\\!\t\tdie"), (ES, r"\qquad   \quad ")],
    "clean_latex_inline": [(EN, r" $x_{the}\$ y$ "), (FR, " $1,200.50$ "), (DE, " $$die$$ "), (ES, " $5$ and $x$ ")],
    "clean_tex": [(EN, r" \(the\) "), (FR, r" \[la \\ b\] "), (DE, r" \(\) "), (ES, r" \( que ")],
    "clean_env": [(EN, r" \begin{align} the \end{align} "), (FR, "\\begin{a}\nla"), (DE, r" \end{b} die"), (ES, r" \begin{} ")],
    "clean_mathrm": [(EN, r" \mathrm{the} "), (FR, r" \mathrm{} la"), (DE, "\\mathrm{\ndie} "), (ES, r" \mathrm{que ")],
    "clean_boxed": [(EN, r" $\boxed{the}$ "), (FR, r" \boxed{\text{la}} "), (DE, r" $$\boxed{} "), (ES, r" \boxed{que ")],
    "clean_chat_tags": [(EN, " [INST] the [/INST] "), (FR, " [USER]la[ASSISTANT] "), (DE, " [/SYS] [sys] "), (ES, " [USER ] ")],
    "clean_braces": [(EN, " {{the}} "), (FR, " {{la\n}} "), (DE, " {{{die}}} "), (ES, " {que} ")],
    "clean_special": [(EN, " <|the|> "), (FR, " <|la "), (DE, " |> "), (ES, " <||> ")],
    "clean_junk": [(EN, " Click here the "), (FR, " SUBSCRIBE la "), (DE, " follow us, "), (ES, " Advertisements ")],
    "clean_shop": [(EN, " SKU the "), (FR, " Price: $9.99. la "), (DE, " price 5 asin "), (ES, " MSRPs Price ")],
    "clean_bold": [(EN, " **the** "), (FR, " **la "), (DE, " **** "), (ES, " *que* ")],
    "clean_media": [(EN, " [image: the] "), (FR, " [Video] "), (DE, " [figure\n1] "), (ES, " [pic] [AUDIO x ")],
    "clean_trash": [(EN, " [TRASH] "), (FR, " [trash] "), (DE, " [[TRASH]] ")],
    "clean_punct": [(EN, " “the” "), (FR, " ‘la’ – "), (DE, " — die → "), (ES, " ← que ")],
    "clean_invisible": [(EN, "\u200bthe\u200f"), (FR, "\ufeff la \u2060"), (DE, "\u202a\u202e")],
    "clean_emoji": [(EN, " 😀the🚀 ★ "), (FR, " ☀️ ⏰ ♔ "), (DE, " 🇩🇪 1️⃣ © "), (ES, " 👍🏽 ✓ 👩‍💻 ")],
    "clean_nonascii": [(EN, " thé ")],
}
STEP_OF = {
    "clean_whitespace": "collapse_newlines", "clean_format": "strip_formatting",
    "clean_math_wrap": "unwrap_math_wrappers", "clean_math_dollar": "unwrap_dollars",
    "clean_math_symbols": "map_math_symbols", "clean_latex_inline": "strip_latex_spans",
    "clean_tex": "strip_tex_spans", "clean_env": "strip_environments", "clean_mathrm": "strip_mathrm",
    "clean_boxed": "unwrap_boxed", "clean_chat_tags": "strip_chat_tags",
    "clean_braces": "strip_double_braces", "clean_special": "strip_special_tokens",
    "clean_junk": "strip_junk_phrases", "clean_shop": "strip_shop_tags", "clean_bold": "strip_bold",
    "clean_media": "strip_media_placeholders", "clean_trash": "strip_trash",
    "clean_punct": "ascii_punctuation", "clean_invisible": "strip_invisible",
    "clean_emoji": "strip_emoji", "clean_nonascii": "strip_non_ascii",
}
QUERIES, ORACLES = {}, {}


def _step_query(name: str):
    step, pairs = getattr(c, STEP_OF[name]), MARKS[name]
    return lambda spark, sf: documents(spark, sf).select("doc_id", step(marked(F.col("text"), pairs)).alias("text"))


for _name, _step in STEP_OF.items():
    QUERIES[_name] = _step_query(_name)
    ORACLES[_name] = f"SELECT doc_id, {SQL_STEPS[_step](marked_sql('text', MARKS[_name]))} AS text FROM documents"


def clean_math_spacing(spark, sf):
    text = marked(F.col("text"), MARKS["clean_math_spacing"])
    return documents(spark, sf).select("doc_id", c.collapse_spaces(c.collapse_math_spacing(text)).alias("text"))


QUERIES["clean_math_spacing"] = clean_math_spacing
ORACLES["clean_math_spacing"] = "SELECT doc_id, {} AS text FROM documents".format(
    SQL_STEPS["collapse_spaces"](SQL_STEPS["collapse_math_spacing"](marked_sql("text", MARKS["clean_math_spacing"]))))


def clean_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", c.strip_html(F.col("html")).alias("text"))


QUERIES["clean_html"] = clean_html
ORACLES["clean_html"] = f"SELECT page_id, {SQL_STEPS['strip_html']('html')} AS text FROM pages"


# Whole-value forms: the marker goes around the text of every document, by document number.
def _framed(text, frames):
    out = text
    for i, (before, after) in enumerate(frames):
        out = F.when(F.col("doc_id") % len(frames) == i, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


def _framed_sql(frames):
    cases = " ".join(f"WHEN {i} THEN {quoted(b)} || text || {quoted(a)}" for i, (b, a) in enumerate(frames))
    return f"(CASE doc_id % {len(frames)} {cases} END)"


BOX_FRAMES = [(r" \boxed{", "} "), (r"($\boxed{\text{", r"}}$)."), (r"\boxed{ \mathrm{a} ", '}"'), ("so ", ""), (r"\boxed{", "} .")]
MARKER_FRAMES = [("#### Answer: ", ""), ("\n### Final Answer : answer:", " "), ("## ", ""), ("x ### Answer: ", ""), ("#######", "")]
HEADER_FRAMES = [("# title line\n", "\n### end"), ("#no title\n", "\n \t## b"), ("a\n\n\n###### c\n", ""), ("####### d\n", "\n#\n")]

for _name, _fn, _sql, _frames in (
    ("clean_unbox", c.unbox, _unbox_sql, BOX_FRAMES),
    ("clean_answer_marker", c.strip_answer_marker, SQL_STEPS["strip_answer_marker"], MARKER_FRAMES),
    ("clean_header", c.strip_header_lines, SQL_STEPS["strip_header_lines"], HEADER_FRAMES),
):
    QUERIES[_name] = lambda spark, sf, fn=_fn, frames=_frames: documents(spark, sf).select(
        "doc_id", fn(_framed(F.col("text"), frames)).alias("text"))
    ORACLES[_name] = f"SELECT doc_id, {_sql(_framed_sql(_frames))} AS text FROM documents"

BAD_MARKS = [(" theou ", " persistent "), (" lail ", " [DUMMY] "), (" edoni ", " guiActiveUnfocused "),
             (" eanen ", " <unk> "), (" nonth ", " Persistent "), ("éa", "Ã¼")]


def bad_token_reject(spark, sf):
    text = marked(F.col("text"), BAD_MARKS)
    return documents(spark, sf).select(
        "doc_id", c.bad_token(text).alias("reject_token"), c.reject_bad_tokens(text).alias("text"))


QUERIES["bad_token_reject"] = bad_token_reject
_alternatives = "|".join("".join("\\" + ch if ch in "[]()|.<>" else ch for ch in t) for t in c.BAD_TOKENS)
ORACLES["bad_token_reject"] = f"""
SELECT doc_id, regexp_extract(t, {quoted(_alternatives)}) AS reject_token,
       CASE WHEN {_bad_sql('t')} THEN '' ELSE t END AS text
FROM (SELECT doc_id, {marked_sql('text', BAD_MARKS)} AS t FROM documents)
"""

# Whole chains, over texts that hold a bit of everything.
MIX = {
    "math": [(EN, r" $\mathrm{the} \le x$ "), (FR, " <b>la</b> **x** [INST] "), (DE, r" \boxed{die} \quad [TRASH] "),
             (ES, " “que” → 1 [image: q] SKU ")],
    "latex": [(EN, r" $x^2$ the \begin{a}b\end{a} "), (FR, " la!! &amp; [TRASH] "), (DE, " Ã¶ "), (ES, " que ‘x’ {{y}} ")],
    "code": [(EN, "\n# the comment\n"), (FR, r" $HOME la \(x\) $5$ "), (DE, " **die** a < b > c "), (ES, r" \mathrm{que} – ")],
    "general": [(EN, r" $the$ \[x\] "), (FR, " $1,200.50$ la "), (DE, " <i>die</i> Subscribe "), (ES, "\t\n que é [/USER] ")],
}


# The order of each chain, written out apart from the code it checks.
_TAIL = ["strip_environments", "strip_html", "unwrap_boxed", "strip_chat_tags", "strip_answer_marker", "strip_double_braces",
         "strip_special_tokens", "strip_header_lines", "strip_junk_phrases", "strip_shop_tags", "strip_bold", "strip_invisible",
         "strip_media_placeholders"]
_SPANS = ["strip_latex_spans", "strip_tex_spans", "strip_mathrm"]
CHAINS = {
    "math": ["collapse_newlines", "strip_formatting", "unwrap_math_wrappers", "unwrap_dollars", "map_math_symbols",
             "collapse_math_spacing", "collapse_spaces", *_TAIL, "strip_trash", "ascii_punctuation", "strip_non_ascii"],
    "latex": ["collapse_newlines", "strip_formatting", *_TAIL, "ascii_punctuation"],
    "code": ["strip", *_SPANS, *_TAIL, "strip_trash", "ascii_punctuation"],
    "general": ["collapse_newlines", "strip_formatting", *_SPANS, *_TAIL, "strip_trash", "ascii_punctuation", "strip_non_ascii"],
}


def chain_sql(text: str, mode: str) -> str:
    """Cleaned text of a SQL text expression, without the bad-token test."""
    x = _unbox_sql(f"coalesce({text}, '')")
    for name in CHAINS[mode]:
        x = SQL_STEPS[name](x)
    return x


def clean_sql(text: str, mode: str, keys: str, source: str, name: str = "text") -> str:
    """A query for `keys` and the cleaned text of a source."""
    return f"""SELECT {keys}, CASE WHEN {_bad_sql('_x')} THEN '' ELSE {_strip('_x')} END AS {name}
FROM (SELECT *, {chain_sql('_raw', mode)} AS _x FROM (SELECT *, {text} AS _raw FROM {source}))"""


for _mode, _pairs in MIX.items():
    QUERIES[f"clean_{_mode}"] = lambda spark, sf, mode=_mode, pairs=_pairs: documents(spark, sf).select(
        "doc_id", c.clean_text(marked(F.col("text"), pairs), mode).alias("text"))
    ORACLES[f"clean_{_mode}"] = clean_sql(marked_sql("text", _pairs), _mode, "doc_id", "documents")
