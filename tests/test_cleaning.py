"""Cleaning steps and chains on literals: input, mode, expected text."""

import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import cleaning as c
from textloom.functions.numbers import round_exact
from textloom.operators import prepare as p

CHAIN = [
    # amounts, spans, displays
    ("$5$ and $x$", "math", "5 and x"),
    ("$5$ and $x$", "code", "$5$ and"),
    ("$5$ and $x$", "general", "$5$ and"),
    ("$5$ and $x$", "latex", "$5$ and $x$"),
    ("$$y$$ z", "math", "$$y$$ z"),
    ("a $1,200.50$ b $1,200.505$ c", "code", "a $1,200.50$ b  c"),
    (r"p \(x\) q \(y\) r", "code", "p  r"),  # up to the last closer
    (r"p \[x\] q", "general", "p  q"),
    (r"p \(x\) q", "latex", r"p \(x\) q"),
    (r"\mathrm{kg} of it", "math", "kg of it"),
    (r"\mathrm{kg} of it", "code", "of it"),
    (r"\begin{align}x\end{align} y", "latex", "y"),
    (r"3 \cdot 4 \quad x", "math", "3 * 4 x"),
    # boxes
    (r"\boxed{\text{A}}", "math", r"\text{A"),  # the inner text stops at the first brace, the last is dropped
    (r"\boxed{A}", "latex", "A"),
    (r"so $\boxed{4}$", "latex", "so 4"),
    (r"($\boxed{7}$).", "code", "7"),
    # symbols that turn into markup
    (r"a \le b \ge c", "math", "a = c"),
    (r"\left(x", "math", "<=ft(x"),
    ("a <b\nc> d", "math", "a  d"),
    # tags, braces, markers
    ("{{x}} y {z}", "math", "y {z}"),
    ("[INST] hi [/INST]", "math", "hi"),
    ("[image: x] y [Video 1]", "latex", "y"),
    ("a [TRASH] b", "math", "a  b"),
    ("a [TRASH] b", "latex", "a [TRASH] b"),
    ("#### Answer: 4", "code", "4"),
    ("#### Answer: 4", "math", "Answer: 4"),
    ("x\n# comment\ny", "code", "x\n\ny"),
    ("f(**kw) and **b** c", "code", "f(b** c"),
    ("click here now", "math", "now"),
    ("SKU 1 Price: $9.99 x", "general", "1  x"),
    # characters
    ("“a” – ‘b’ — c → d", "latex", "\"a\" - 'b' - c -> d"),
    ("a\u200bb\ufeffc", "math", "abc"),
    ("caf\u00e9 \u00fcber", "math", "caf ber"),
    ("caf\u00e9", "code", "caf\u00e9"),
    ("\u00a0 x \u2003", "latex", "x"),
    ("\x1cx\x1f", "code", "x"),
    ("wow!! a? &amp; b &NBSP;", "math", "wow a? b &NBSP;"),
    ("a  b", "math", "a b"),
    ("a  b", "general", "a  b"),
    ("a\n\t\rb \\\\n c", "latex", "a b   c"),
    # rejected values
    ("this is persistent state", "math", ""),
    ("Persistent", "math", "Persistent"),
    ("a \ufffd b", "latex", ""),
    ("a \ufffd b", "math", "a  b"),  # removed as non-ASCII before the test
    ("see <unk> x", "code", "see  x"),  # removed as a tag before the test
    ("You are a helpful assistant. Hi", "general", ""),
    ("", "math", ""),
    (None, "code", ""),
]


@pytest.mark.parametrize("mode", c.MODES)
def test_chain(spark, mode):
    cases = [(text, want) for text, m, want in CHAIN if m == mode]
    df = spark.createDataFrame(cases, "text string, want string")
    got = df.select("text", "want", c.clean_text(F.col("text"), mode).alias("got")).collect()
    assert [(r.text, r.got) for r in got] == [(r.text, r.want) for r in got]


STEPS = [
    (c.strip_special_tokens, "a <|x|> b <| c", "a  b <| c"),
    (c.strip_html, "a <b> c > d < e", "a  c > d < e"),
    (c.strip_media_placeholders, "[image a] ] [video", " ] [video"),
    (c.unwrap_math_wrappers, r"\text{a} } \text{b", r"a } \text{b"),
    (c.strip_header_lines, "#\n\n## b\n\n\n\n# c\nd", "\n\nd"),
    (c.strip_bold, "a **b** c **d", "a  c **d"),
    (c.strip_header_lines, "  ## t\nx\n###y\n#\nz", "\nx\n###y\n"),  # the line end behind a lone # is white space too
    (c.strip_answer_marker, " ### Final Answer: x ### y", "x ### y"),
    (c.strip_tex_spans, r"a \(\) b \)", "a "),
    (c.strip_tex_spans, r"a \(\) b", r"a \(\) b"),
    (c.strip_tex_spans, "a \\(x \\[y\\] z", "a \\(x  z"),
    (c.unwrap_dollars, "$a$b$c$ $$d$", "abc $$d$"),
    (c.strip_latex_spans, r"$a\$b$ c $d", " c $d"),
    (c.strip_junk_phrases, "Subscribe subscribed FOLLOW US", " subscribed "),
    (c.strip_junk_phrases, "\u017fubscribe", ""),  # the long s folds to s
    (c.strip_junk_phrases, "subscribe\u0301 subscribe\u200d xsubscribe subscribe_", "\u0301 \u200d xsubscribe subscribe_"),
    (c.strip_shop_tags, "Price: $9.99.x price \u0663", "x "),
    (c.strip_shop_tags, "MSRP asin price 5, prices", "  , prices"),
    (c.strip_environments, "\\begin{a}\nx\\end{b} \\begin{} y", " \\begin{} y"),
    (c.strip_emoji, "a\U0001f600b\u2600\ufe0f", "ab"),
    (c.strip_emoji, "★ ✓ ♪ ♔ | ⏰ ⌚ 🅰 🈁 © 1️⃣ 12 # 👩‍💻🏴\U000e0067\U000e007f|", "★ ✓ ♪ ♔ |       12 # |"),
    (c.ascii_punctuation, "\u2190\u2192\u2018", "<-->'"),
    (c.bad_token, "x printrawdownload", "printrawdownload"),
    (c.bad_token, "guiActiveUnfocused", "guiActive"),
    (c.bad_token, "none", ""),
    (c.map_math_symbols, r"\triangle \leq \neq \qquad", r"triangle <=q != \qquad"),
]


def test_steps(spark):
    for step, text, want in STEPS:
        got = spark.createDataFrame([(text,)], "t string").select(step(F.col("t"))).first()[0]
        assert got == want, (step, text)


def test_long_texts_do_not_overflow_the_stack(spark):
    n = 120_000
    texts = ["$" + "x" * n, "\\(" + "\\a" * n, "\\(" + "x\\)" * n, "[image" + "y" * n, "\n" * n + "x", "{{" + "x" * n,
             "a> " + "<" * n, "a] " + "[image" * n, "} " + "\\text{" * n, "x" + " " * n + "y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for mode in c.MODES:
        assert df.select(F.length(c.clean_text(F.col("t"), mode)).alias("n")).where("n >= 0").count() == len(texts)


def test_unknown_mode():
    with pytest.raises(ValueError):
        c.steps("latex+code")


def test_text_is_cleaned_once(spark):
    """A filter on the cleaned text must not bring the chain into the plan a second time."""
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    text = c.clean_text(F.col("text"))

    def chains(out):  # each chain looks for this rejected token once
        return out._jdf.queryExecution().optimizedPlan().toString().count("embedreport")

    assert chains(p.prepared(df, text, "id")) == 1
    assert chains(df.select(text.alias("t")).where("t <> ''")) == 2  # what is avoided


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=60), min_size=1, max_size=20))
def test_properties(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", c.strip(F.col("t")).alias("s"), c.strip_non_ascii(F.col("t")).alias("a"),
                     c.clean_text(F.col("t")).alias("m")).collect()
    for r in rows:
        assert r.s == r.t.strip()
        assert r.a == "".join(x for x in r.t if ord(x) < 128)
        assert r.m == r.m.strip() and r.m.isascii()


def test_round_exact(spark):
    values = [0.725, 9.55875, -4.89375, 0.00005, 2.5, -0.125, 1 / 3, 123456.78905, 1e-20, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 3, 4, 6):
        got = [r[0] for r in df.select(round_exact(F.col("v"), digits)).collect()]
        assert got == [round(v, digits) for v in values]


@pytest.mark.parametrize("step,head,opener", [
    ("strip_environments", r"\end{a}", r"\begin{a}"), ("strip_double_braces", "}}", "{{ "), ("strip_tex_spans", "", r"\( a "),
    ("strip_mathrm", "}", r"\mathrm{a "), ("unwrap_boxed", "}", r"\boxed{a "), ("strip_special_tokens", "|>", "<| a")])
def test_unclosed_openers_cost_one_pass(spark, step, head, opener):
    text = head + opener * (400_000 // len(opener))
    start = time.time()
    assert spark.createDataFrame([(text,)], "t string").select(getattr(c, step)(F.col("t"))).first()[0] == text
    assert time.time() - start < 10


def test_openers_beside_closed_ones(spark):
    cases = [("strip_double_braces", "a {{b}} {{c\n{{d}} e", "a  {{c\n e"), ("strip_special_tokens", "<|a|> <|b\n<|c|>", " <|b\n"),
             ("strip_environments", r"\begin{a}x\end{a} \begin{b}", r" \begin{b}"), ("unwrap_boxed", r"$\boxed{4}$ \boxed{5", r"4 \boxed{5"),
             ("strip_mathrm", "\\mathrm{a} \\mathrm{b", " \\mathrm{b"), ("strip_tex_spans", r"\(a\) \[b\] \(c", r" ".join(["", "", r"\(c"]))]
    for step, text, want in cases:
        assert spark.createDataFrame([(text,)], "t string").select(getattr(c, step)(F.col("t"))).first()[0] == want, step


@pytest.mark.parametrize("opener,end", [(r"\( a ", r"\]"), (r"\[ a ", r"\)"), (r"\( a \b ", r"\[ b \]")])
def test_openers_of_one_kind_and_a_closer_of_the_other(spark, opener, end):
    text = opener * 20_000 + end
    start = time.time()
    got = spark.createDataFrame([(text,)], "t string").select(c.strip_tex_spans(F.col("t"))).first()[0]
    assert got == (opener * 20_000 if end.startswith(r"\[") else text) and time.time() - start < 2


def test_tex_spans_as_their_pattern(spark):
    """Taking what cannot match in one piece changes nothing."""
    rng = random.Random(6)
    texts = ["".join(rng.choice(["\\(", "\\)", "\\[", "\\]", "\\", "a", "(", "[", ")", "\n"]) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", c.strip_tex_spans(F.col("t")).alias("got"), F.regexp_replace("t", c.TEX_SPAN, "").alias("want")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]
