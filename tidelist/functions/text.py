"""Text functions: RE2 patterns on the JVM, HTML to text, and the ordered rule vocabularies."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed

RE2_SPACE = r"\t\n\f\r "
_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
_TOKEN = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|.", re.S)
_QUANTIFIERS = tuple("?*+{")


def _is_word_char(token: str) -> bool:
    return len(token) == 1 and token.isascii() and (token.isalnum() or token == "_")


def re2_pattern(pattern: str) -> str:
    r"""Rewrite an RE2 pattern so that ``java.util.regex`` matches the same texts.

    The dialects differ in ``\b`` (Unicode-aware on some JVMs, ASCII in RE2), ``\s`` (Java adds
    the vertical tab), ``$`` (Java also matches before a final newline) and ``.`` (Java excludes
    more line terminators). Where the neighbour of a ``\b`` is a plain word character, one
    lookaround is enough; otherwise the general two-sided form is used.
    """
    tokens = _TOKEN.findall(pattern)
    out = []
    for i, token in enumerate(tokens):
        after = tokens[i + 1] if i + 1 < len(tokens) else ""
        after_is_optional = i + 2 < len(tokens) and tokens[i + 2] in _QUANTIFIERS
        before = tokens[i - 1] if i else ""
        if token == r"\b":
            if _is_word_char(after) and not after_is_optional:
                out.append(r"(?<!\w)")
            elif _is_word_char(before):
                out.append(r"(?!\w)")
            else:
                out.append(_BOUNDARY)
        elif token == r"\s":
            out.append(f"[{RE2_SPACE}]")
        elif token == "$":
            out.append(r"\z")
        elif token == ".":
            out.append(r"[^\n]")
        elif token.startswith("[") and len(token) > 1:
            out.append(token.replace(r"\s", RE2_SPACE))
        else:
            out.append(token)
    return "".join(out)


def matches(text: Column, pattern: str) -> Column:
    """Does the RE2 ``pattern`` occur in ``text``? The pattern is a literal, compiled once."""
    return text.rlike(re2_pattern(pattern))


def _alternatives(pattern: str) -> list[list[str]]:
    """Tokens of each top-level alternative."""
    branches: list[list[str]] = [[]]
    depth = 0
    for token in _TOKEN.findall(pattern):
        depth += (token == "(") - (token == ")")
        if token == "|" and depth == 0:
            branches.append([])
        else:
            branches[-1].append(token)
    return branches


def required_literals(pattern: str) -> list[str] | None:
    """Strings of which every match contains at least one, or None if that is not evident.

    Only unquantified characters outside groups and classes count. A cheap byte search for these
    strings spares most texts the regex engine.
    """
    literals = []
    for branch in _alternatives(pattern):
        runs, run, depth = [], "", 0
        for i, token in enumerate(branch):
            quantified = i + 1 < len(branch) and branch[i + 1] in _QUANTIFIERS
            plain = token[1:] if re.fullmatch(r"\\[^\w\s]", token) else token
            is_literal = depth == 0 and len(plain) == 1 and plain not in "()|^$.?*+{}"
            is_literal = is_literal or (depth == 0 and token != plain)
            depth += (token == "(") - (token == ")")
            if is_literal and not quantified:
                run += plain
                continue
            if token == r"\b" and depth == 0 and not quantified:
                continue
            runs.append(run)
            run = ""
        best = max([*runs, run], key=len)
        telling = len(best) > 1 or best and not (best.isascii() and (best.isalnum() or best == " "))
        if not telling or "{" in branch:
            return None
        literals.append(best)
    return literals


# What stands in a spelled-out pattern for a word boundary, and for anything.
_EDGE, _ANY = "\x00", "\x01"
MOST_SPELLINGS = 64


def _spellings(tokens: list[str], at: int = 0) -> tuple[list[str], int]:
    """All ways to spell a pattern's matches, up to a closing bracket, and where that stands."""
    found, current = [], [""]
    while at < len(tokens) and tokens[at] != ")":
        token = tokens[at]
        if token == "|":
            found, current, at = found + current, [""], at + 1
            continue
        if token == "(":
            inside = at + 3 if tokens[at + 1 : at + 3] == ["?", ":"] else at + 1
            item, at = _spellings(tokens, inside)
        elif token in (r"\b", "^", "$"):
            item = [_EDGE]
        elif re.fullmatch(r"\\[^\w\s]", token):
            item = [token[1:]]
        else:
            item = [token if len(token) == 1 and token != "." else _ANY]
        at += 1
        while at < len(tokens) and tokens[at] in _QUANTIFIERS:
            item = ["", *item] if tokens[at] == "?" else [_ANY]
            at += 1 if tokens[at] != "{" else tokens[at:].index("}") + 1
        if len(current) * len(item) > MOST_SPELLINGS:
            item = [_ANY]
        current = [c + x for c in current for x in item]
    return found + current, at


def required_words(pattern: str) -> list[str] | None:
    """Words of which every text with a match has at least one, or None if that is not evident.

    A word is a maximal run of ``[A-Za-z0-9_]``. The pattern is spelled out: optional parts and
    alternatives in brackets are few in a vocabulary. Each spelling must hold a word that is whole
    by an edge or another character on either side.
    """
    words = []
    spellings, _ = _spellings(_TOKEN.findall(pattern))
    for spelling in spellings:
        # An edge within a run of word characters never matches; beside others it says nothing.
        whole = re.findall(r"(?<![A-Za-z0-9_\x01])[A-Za-z0-9_]+(?![A-Za-z0-9_\x01])", spelling)
        if spelling[:1] not in (_EDGE, _ANY) and whole and spelling.startswith(whole[0]):
            whole = whole[1:]
        if spelling[-1:] not in (_EDGE, _ANY) and whole and spelling.endswith(whole[-1]):
            whole = whole[:-1]
        if not whole:
            return None
        words.append(max(whole, key=len))
    return list(dict.fromkeys(words))


def sql_text(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found_sql(column: str, pattern: str) -> str:
    """SQL of ``found`` on a column; many patterns are quicker to state as SQL text."""
    match = f"{column} RLIKE {sql_text(re2_pattern(pattern))}"
    literals = required_literals(pattern)
    if not literals:
        return f"({match})"
    present = " OR ".join(f"contains({column}, {sql_text(word)})" for word in literals)
    return f"(({present}) AND {match})"


def first_match(text: Column, rules: Iterable[tuple], default: str | None) -> Column:
    """Label of the first rule that matches: (pattern, label) or (pattern, veto, label).

    The order of the rules is their meaning, so the chain of conditions keeps it.
    """
    chain = None
    for rule in rules:
        pattern, veto, label = rule if len(rule) == 3 else (rule[0], None, rule[1])
        condition = matches(text, pattern)
        if veto:
            condition = condition & ~matches(text, veto)
        chain = (F if chain is None else chain).when(condition, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def blank_to_null(text: Column) -> Column:
    """Trim spaces; an empty result is NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def decode_entities(text: Column) -> Column:
    """Undo one level of HTML escaping."""
    for entity, character in fixed.HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def html_to_text(html: Column) -> Column:
    """Readable text of an HTML fragment, including fragments that were escaped twice."""
    without_tags = F.regexp_replace(decode_entities(html), "<[^>]+>", " ")
    return blank_to_null(F.regexp_replace(decode_entities(without_tags), f"[{RE2_SPACE}]+", " "))


def workplace_from_location(location: Column) -> Column:
    """Workplace type hinted at by a free-text location."""
    chain = F.when(blank_to_null(location).isNull(), F.lit("unknown"))
    for needle, label in fixed.WORKPLACE_LOCATION_RULES:
        chain = chain.when(F.contains(F.lower(location), F.lit(needle)), F.lit(label))
    return chain.otherwise(F.lit("onsite"))


def workplace_from_label(label: Column, labels: dict[str, str], location: Column) -> Column:
    """Workplace type stated by the provider, else hinted at by the location."""
    lowered = F.lower(label)
    chain = None
    for known, workplace in labels.items():
        chain = (F if chain is None else chain).when(lowered == known, F.lit(workplace))
    return chain.otherwise(workplace_from_location(location))


def employment_type(label: Column, title: Column) -> Column:
    """Employment type from the provider's label, else internships recognised by their title."""
    lower_title = F.lower(F.coalesce(title, F.lit("")))
    by_title = F.when(matches(lower_title, fixed.INTERN_TITLE), F.lit("internship"))
    by_label = first_match(
        F.lower(F.coalesce(label, F.lit(""))), fixed.EMPLOYMENT_LABEL_RULES, default=None
    )
    return F.coalesce(by_label, by_title, F.lit("unknown"))


def seniority(title: Column, employment: Column) -> Column:
    """Seniority from the title; an internship is an intern whatever its title says."""
    by_title = first_match(F.lower(title), fixed.SENIORITY_RULES, default="mid")
    return F.when(employment == "internship", F.lit("intern")).otherwise(by_title)


def role_family(title: Column, rules: Iterable[tuple[int, str, str]]) -> Column:
    """Role family of the matching rule with the lowest priority, else ``other``."""
    ordered = [(pattern, family) for _, family, pattern in sorted(rules)]
    return first_match(F.lower(title), ordered, default="other")


def location_key(location: Column) -> Column:
    return F.md5(F.coalesce(F.lower(F.trim(location)), F.lit("")))


def one_decimal(value: Column) -> Column:
    """Text of a DOUBLE rounded to one decimal: by its exact value, ties to the even digit.

    The midpoint is compared as ``4|x| <=> (2k + 1) - 16|x|``, where no term is rounded.
    """
    size = F.abs(value)
    tenths = F.floor(size * 10)
    excess = size * 4 - ((tenths * 2 + 1) - size * 16)
    up = (excess > 0) | ((excess == 0) & (tenths % 2 == 1))
    rounded = (tenths + up.cast("int")) / 10
    return F.concat(F.when(value < 0, "-").otherwise(""), F.format_string("%.1f", rounded))


def display_value(value: Column, kind: str) -> Column:
    """Presentation of a report cell: ``share`` as a percentage, ``float`` with one decimal;
    NULL is shown as a dash."""
    if kind == "share":
        shown = F.concat(one_decimal(value * 100), F.lit("%"))
    elif kind == "float":
        shown = one_decimal(value)
    else:
        shown = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(shown)


def markdown_cell(text: Column) -> Column:
    """Escape what would end a Markdown table cell or row."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(escaped, F.lit("|"), F.lit("\\|"))
    return F.trim(F.regexp_replace(escaped, r"\s+", " "))
