"""Text expressions: ordered replacement, text between markers, definition clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements of stored view text, in order.
VIEW_RULES = (
    ("--", "-- -- "),
    ("nvl(", "ifnull("),
    (r"unistr('\0030')", "0"),
    (r"unistr('\0031')", "1"),
    (r"unistr('\0033')", "3"),
)
# Replacements of upper-cased trigger text, in order.
TRIGGER_RULES = (
    ("INTO:", "INTO :"),
    ("SYS.DUAL ", "DUAL"),
    ("SYS.DUAL", "DUAL"),
    ("\n", ""),
)


def replaced(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after the other."""
    return reduce(lambda text, rule: F.replace(text, F.lit(rule[0]), F.lit(rule[1])), rules, col)


def code_tokens(col: Column, whole: Sequence[str] = ()) -> Column:
    """The text cut into quoted parts, comments and code, in order; joined again they are the text.

    A part left open reaches to the end. ``whole`` names texts that are tokens of their own
    wherever code holds them, quotes included. No alternative backtracks, so long parts need no stack.
    """
    named = "".join(java_quoted(text) + "|" for text in sorted(whole, key=len, reverse=True))
    quoted = r"""'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)"""
    comment = r"--[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"
    code = rf"""(?:(?!{named}--|/\*)[^'"])++"""
    return F.regexp_extract_all(col, F.lit(f"{named}{quoted}|{comment}|{code}"), F.lit(0))


def replaced_in_code(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements in code alone; a ``--`` comment without a space after its mark gets one."""
    whole = {old: new for old, new in rules if re.search("""['"]""", old)}
    plain = [(old, new) for old, new in rules if old not in whole and "--" not in old]

    def one(token: Column) -> Column:
        named = reduce(lambda c, rule: c.when(token == rule[0], F.lit(rule[1])), whole.items(),
                       F.when(F.startswith(token, F.lit("--")), F.regexp_replace(token, r"\A--(?=[^ \t])", "-- ")))
        return named.when(token.rlike(r"""\A(?:'|"|/\*)"""), token).otherwise(replaced(token, plain))

    return F.array_join(F.transform(code_tokens(col, list(whole)), one), "")


def normalised(col: Column, rules: Sequence[tuple[str, str]] = TRIGGER_RULES) -> Column:
    """Upper case, then the replacements."""
    return replaced(F.upper(col), rules)


def between(col: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` and before the next ``end``; null if either is absent."""
    after = F.substring(col, F.instr(col, start) + len(start), F.length(col))
    inside = F.substring(after, F.lit(1), F.instr(after, end) - 1)
    return F.when((F.instr(col, start) > 0) & (F.instr(after, end) > 0), inside)


def java_quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9\s])", r"\\\1", text)


def definition(col: Column, marker: str | None = None, schema: str | None = None) -> Column:
    """Stored definition made portable.

    Cut before ``marker`` (any case; null where it is absent), without double quotes, the
    schema prefix and line feeds, trimmed. The prefix counts only where a name starts.
    """
    if marker is not None:
        parts = F.split(col, f"(?i){java_quoted(marker)}", 2)
        col = F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))
    col = F.replace(col, F.lit('"'), F.lit(""))
    if schema is not None:
        col = F.regexp_replace(col, rf"(?i)(?<![A-Za-z0-9_$#]){java_quoted(schema)}\.", "")
    return F.trim(F.replace(col, F.lit("\n"), F.lit("")))
