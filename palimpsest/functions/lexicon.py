"""Dictionary matching in one pass, longest first.

A dictionary becomes one regular expression factored by prefixes: it costs a text's length, not the dictionary's.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SEGMENT


def _quote(c: str) -> str:
    return re.escape(c)


def trie_regex(keys: Iterable[str]) -> str:
    """A pattern for the longest key at each place; without keys it matches nothing."""
    root: dict = {}
    for key in keys:
        node = root
        for c in key:
            node = node.setdefault(c, {})
        if key:
            node[""] = {}

    def pattern(node: dict) -> str:
        chains = []
        for c, child in sorted((c, n) for c, n in node.items() if c):
            text = _quote(c)
            while len(child) == 1 and "" not in child:
                ((c, child),) = child.items()
                text += _quote(c)
            chains.append(text + pattern(child))
        if not chains:
            return ""
        body = chains[0] if len(chains) == 1 and "" not in node else f"(?:{'|'.join(chains)})"
        return f"{body}?" if "" in node else body

    return pattern(root) or r"(?!)"


def matches(text: Column, keys: Iterable[str]) -> Column:
    """All matches in order, none overlapping."""
    return F.regexp_extract_all(text, F.lit(trie_regex(keys)), 0)


def substitute(text: Column, table: dict[str, str]) -> Column:
    """Replace every match by its value, in one pass: a value is never searched again."""
    pattern = trie_regex(table)
    values = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    new = F.transform(found, lambda m: F.element_at(values, m))
    return F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")


def replace_all(text: Column, table: dict[str, str]) -> Column:
    """Replace one entry after the other; later ones see what earlier ones wrote."""
    for a, b in table.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def replace_rules(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Replace by one regular expression after the other; ``$1`` and on in a replacement stand for the pattern's groups."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def align_segments(source: Column, target: Column, table: dict[str, str]) -> Column:
    """Where source and target have equally many segments, those of the target whose source segment is a key get its value."""
    values = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    a, b = F.regexp_extract_all(source, F.lit(SEGMENT), 0), F.regexp_extract_all(target, F.lit(SEGMENT), 0)

    def joined(p: Column) -> Column:
        done = F.array_join(F.zip_with(p["a"], p["b"], lambda s, t: F.coalesce(F.element_at(values, s), t)), "")
        return F.when(F.size(p["a"]) == F.size(p["b"]), done).otherwise(p["t"])

    return F.get(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"), target.alias("t"))), joined), 0)  # segments are cut once


def restore_keys(template: Column, values: Column) -> Column:
    """Fill ``{{keyN}}`` from a map N -> text; unknown keys become empty."""
    numbers = F.regexp_extract_all(template, F.lit(r"\{\{key(\d+)\}\}"), 1)
    new = F.transform(numbers, lambda n: F.coalesce(F.element_at(values, n.cast("int")), F.lit("")))
    return F.array_join(F.zip_with(F.split(template, r"\{\{key\d+\}\}", -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
