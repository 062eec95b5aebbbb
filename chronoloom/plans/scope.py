"""Scopes such as ``all``, ``D001`` or ``E001-E014,M003`` as predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoloom.functions.text import news_code, stem, strip

_CODE = re.compile(r"^([A-Za-z]+)(\d{3,})$")


def parse_scope(text: str | None) -> list[tuple[str, int, int]] | None:
    """(prefix, lower, upper) of each rule, bounds in order; None for everything. A range across prefixes is an error."""
    t = (text or "").strip()
    if not t or t.lower() == "all":
        return None
    rules = []
    for part in filter(None, (p.strip() for p in re.split("[,，]", t))):
        ends = [_CODE.match(e.strip()) for e in part.split("-")]
        if not 1 <= len(ends) <= 2 or not all(ends):
            raise ValueError(f"scope {part!r} isn't understood")
        prefixes = {e[1].upper() for e in ends}
        if len(prefixes) > 1:
            raise ValueError(f"scope {part!r} goes across prefixes")
        numbers = sorted(int(e[2]) for e in ends)
        rules.append((prefixes.pop(), numbers[0], numbers[-1]))
    return rules


def in_scope(file_name: Column, text: str | None) -> Column:
    """Whether a file is in the scope; a file without a code is only in ``all``."""
    rules = parse_scope(text)
    if rules is None:
        return F.lit(True)
    code = news_code(file_name)
    hit = F.lit(False)
    for prefix, low, high in rules:
        hit = hit | ((code["prefix"] == prefix) & code["number"].between(low, high))
    return F.coalesce(hit, F.lit(False))


def names_match(wanted: list[str], *names: Column) -> Column:
    """Whether any of the names, with or without extension, or its first word is wanted; case and outer blanks don't matter."""
    fold = lambda c: F.lower(strip(c))
    forms = [x for n in names for x in (fold(n), fold(stem(n)), F.element_at(F.split(fold(n), " "), 1))]
    return F.arrays_overlap(F.array(*forms), F.array(*[F.lit(w.strip().lower()) for w in wanted]))
