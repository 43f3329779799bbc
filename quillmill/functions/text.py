"""String functions as Spark columns.  Lengths and positions are in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What str.strip() of Python strips; Spark's trim() takes U+0020 only.
PY_WS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Full-width punctuation and what it becomes, place by place.
CJK_PUNCTUATION, ASCII_PUNCTUATION = "，。“”‘’；：", ",.\"\"'';:"
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
TWO_BARS, TURN_END = "||", "<|im_end|>"


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WS))


def truncated(c: Column, limit: int, marker: str = "......") -> Column:
    """The first ``limit`` characters and a marker, if there are more."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(marker))).otherwise(c)


def titled(title: Column, text: Column) -> Column:
    """Title, line feed, text; a null title counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), text)


def filled(template: str, *values: Column) -> Column:
    """Values for the ``{}`` of a template, in order; other characters, % too, stand for themselves."""
    parts = template.split("{}")
    if len(parts) != len(values) + 1:
        raise ValueError(f"the template has {len(parts) - 1} places for {len(values)} values")
    return F.concat(F.lit(parts[0]), *[x for v, p in zip(values, parts[1:], strict=True) for x in (v, F.lit(p))])


def filled_by_name(template: str, **values: Column) -> Column:
    """Values for the ``{name}`` of a template; ``{{`` and ``}}`` are braces."""
    from string import Formatter

    parts: list[Column] = []
    for text, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if name is not None:
            parts.append(values[name])
    return F.concat(*parts)


def one_turn_prompt(user: Column, before: str = "<|im_start|>user\n", after: str = "<|im_end|>\n<|im_start|>assistant\n") -> Column:
    """A single user turn wrapped for a model, with the start of its answer."""
    return F.concat(F.lit(before), user, F.lit(after))


def conversation_prompt(conversation: Column, *, template: bool = True, suffix: str = "", start: str = "<|im_start|>", end: str = "<|im_end|>\n") -> Column:
    """A list of turns (role, content) as a prompt.

    Without a template it is the first turn's content; of an empty list it is "".  The
    start of an answer is added only after a user's turn; then comes ``suffix``.
    """
    first = F.coalesce(F.get(conversation, 0)["content"], F.lit(""))
    if not template:
        body = first
    else:
        turns = F.transform(conversation, lambda x: F.concat(F.lit(start), x["role"], F.lit("\n"), x["content"], F.lit(end)))
        last = F.try_element_at(conversation, F.lit(-1))["role"]
        body = F.concat(F.array_join(turns, ""), F.when(last == "user", F.lit(f"{start}assistant\n")).otherwise(""))
    return F.when(F.size(conversation) == 0, F.lit("")).otherwise(F.concat(body, F.lit(suffix)))


def edu_score(reply: Column) -> Column:
    """The first digit after the first score mark of a judge's reply, as a string; null without one.  Not clamped."""
    digit = F.regexp_extract(reply, r"(?U)教育得分：[\s\S]*?(\d)", 1)
    return F.nullif(F.translate(digit, FULL_WIDTH_DIGITS, "0123456789"), F.lit(""))


def uniform(c: Column) -> Column:
    """Odd spaces and boxes, runs of line ends, of spaces and of dashes in one form; then stripped."""
    c = F.translate(c, "\u2003□■", "")
    c = F.translate(c, "\u00a0\u3000", "  ")
    c = F.regexp_replace(c, r"[\n\r]{2,}", "\n\n")
    c = F.regexp_replace(c, " {2,}", "  ")
    return py_strip(F.regexp_replace(c, "-{3,}", "---"))


def without_nbsp(c: Column) -> Column:
    return F.translate(c, "\u00a0", "")


def clean_turn(c: Column) -> Column:
    """A turn without the two-bar and end tokens, stripped."""
    return py_strip(F.replace(F.replace(c, F.lit(TWO_BARS), F.lit("")), F.lit(TURN_END), F.lit("")))


def plain_punctuation(c: Column) -> Column:
    return F.translate(c, CJK_PUNCTUATION, ASCII_PUNCTUATION)


def bare_json(c: Column) -> Column:
    """A reply without fences, line feeds, the word json and spaces."""
    for gone in ("```", "\n", "json", " "):
        c = F.replace(c, F.lit(gone), F.lit(""))
    return c


def inner_quotes_repaired(c: Column) -> Column:
    """A quotation mark that borders on none of { } : , becomes a curly one."""
    return F.regexp_replace(c, '(?<![{:,}])"(?![{:,}])', "“")


def first_digit(c: Column) -> Column:
    """The first digit as an integer; null without one."""
    return F.nullif(F.regexp_extract(c, r"(\d)", 1), F.lit("")).try_cast("int")


def stop_tokens_replaced(c: Column, tokens: dict[str, str]) -> Column:
    for old, new in tokens.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def with_suffix(path: Column, old: str, new: str) -> Column:
    """The path with its ending ``old`` swapped for ``new``."""
    return F.when(path.endswith(old), F.concat(F.substr(path, F.lit(1), F.length(path) - len(old)), F.lit(new))).otherwise(path)


def decoded_path(path: Column) -> Column:
    """A file path as it is on disk: no scheme, no percent escapes; a plus stays a plus."""
    bare = F.regexp_replace(path, "^[a-z0-9]+:(//[^/]*)?(?=/)", "")
    return F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))
