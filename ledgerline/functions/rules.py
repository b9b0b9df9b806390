"""Product classification: ordered rule tables compiled to one ``CASE`` expression.

The rules test a normalised name many times. Put :func:`normalised` into a
column of its own before applying them (``operators.clean.classify`` does), or it
is evaluated once per test. Better still, classify the product dimension before
joining it to the lines: then each name is classified once, not once per line.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import null_if_blank


def normalised(product: Column) -> Column:
    """Upper-case trimmed name, null when blank."""
    return F.upper(null_if_blank(product))


def _any(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(w.upper()) for w in words)


def matches(name: str, rule: fixed.Rule) -> str:
    """SQL test of a rule on the column ``name``: one pattern for all its words.

    Patterns keep the generated code small. A test per word would make one Java
    method of thousands of branches, which the virtual machine does not compile.
    """
    starts = f"^(?:{_any(rule.starts)})" if rule.starts else None
    joint = [c for c in rule.contains if "&" in c]
    loose = _any(tuple(c for c in rule.contains if "&" not in c))
    patterns = [p for p in (starts, loose) if p]
    if rule.both:
        return " AND ".join(f"{name} RLIKE r'{p}'" for p in patterns)
    tests = [f"{name} RLIKE r'{'|'.join(patterns)}'"] if patterns else []
    for words in joint:
        tests.append(" AND ".join(f"contains({name}, '{w.upper()}')" for w in words.split("&")))
    return "(" + " OR ".join(tests) + ")"


def _case(branches: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in branches) + f" ELSE {default} END"


def category(name: str) -> Column:
    """Top-level category of the normalised names in column ``name``."""
    rules = [(matches(name, r), f"'{r.label}'") for r in fixed.CATEGORY_RULES]
    return F.expr(_case([(f"{name} IS NULL", f"'{fixed.DEFAULT_CATEGORY}'"), *rules], f"'{fixed.DEFAULT_CATEGORY}'"))


def _service_code(name: str) -> str:
    def first(tokens: list[tuple[str, str]]) -> str:
        return _case([(f"contains({name}, '{t}')", f"'{v}'") for t, v in tokens], f"'{fixed.UNKNOWN_PART}'")

    kinds, sizes = ([(t, t) for t in w] for w in (fixed.SERVICE_TYPES, fixed.SERVICE_CAPACITIES))
    parts = [f"'{fixed.SERVICE_MARK}'", first(kinds), first(sizes), first(list(fixed.SERVICE_PLANS))]
    return f"concat_ws('-', {', '.join(parts)})"


def service_code(name: str) -> Column:
    """``mark-type-capacity-plan`` from the first tokens found in a normalised name."""
    return F.expr(_service_code(name))


def subcategory(name: str, category_column: str) -> Column:
    """Sub-category of a normalised name within a category; empty where no rule applies.

    The rules of a category form a chain of their own, so a row meets only those.
    """
    others = ", ".join(f"'{n.upper()}'" for n in fixed.OTHER_NAMES)
    anywhere = [(matches(name, r), f"'{r.label}'") for r in fixed.SUBCATEGORY_RULES if r.category is None]
    services = ", ".join(f"'{c}'" for c in fixed.SERVICE_CATEGORIES)
    marked = f"{category_column} IN ({services}) AND contains({name}, '{fixed.SERVICE_MARK}')"
    rest = _case([*anywhere, (marked, _service_code(name))], "''")
    chains = {}
    for rule in fixed.SUBCATEGORY_RULES:
        if rule.category:
            chains.setdefault(rule.category, []).append((matches(name, rule), f"'{rule.label}'"))
    branches = [(f"{name} IS NULL", "''"), (f"{name} IN ({others})", "'Other'")]
    branches += [(f"{category_column} = '{c}'", _case(chain, "NULL")) for c, chain in chains.items()]
    return F.expr(f"coalesce({_case(branches, 'NULL')}, {rest})")


def drive_capacity(product: Column, category_column: Column) -> Column:
    """Capacity in GB of a drive, null when the name does not carry one.

    Only a name that *ends* in ``T`` counts in thousands.
    """
    drive = (category_column == fixed.CAPACITY_CATEGORY) & product.rlike(fixed.CAPACITY_NAME)
    digits = F.regexp_extract(product, fixed.CAPACITY_DIGITS, 1).try_cast("bigint")
    return F.when(drive, digits * F.when(product.endswith("T"), 1000).otherwise(1))
