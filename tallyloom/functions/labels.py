"""Column expressions for hierarchical labels and variable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.fixed import (
    S1810_BASE,
    S1810_CATEGORIES,
    S1810_DISABLED,
    S1810_HISPANIC,
    S1811_GROUPS,
    S1811_INFIXES,
)

OUTER_BLANKS = r"(?U)^\s+|\s+$"


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` mentions it often."""
    return F.transform(F.array(value), body)[0]


def _segments(label: Column) -> Column:
    """Non-empty `!!` segments without the word `estimate`; blanks go before trailing colons."""
    def clean(part: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(part, OUTER_BLANKS, ""), ":+$", "")

    parts = F.transform(F.split(label, "!!"), clean)
    return F.filter(parts, lambda p: (p != "") & (F.lower(p) != "estimate"))


def _without_repeats(parts: Column) -> Column:
    """Drop a segment equal, case aside, to the one before it."""
    return F.filter(
        parts,
        lambda p, i: (i == 0) | (F.lower(p) != F.lower(F.get(parts, i - 1))),
    )


def label_chain(label: Column) -> Column:
    """Label as an array of its levels, a leading `Total` included."""
    return let(_segments(label), _without_repeats)


def label_to_name(label: Column) -> Column:
    """Readable column name: levels joined by ` | `, a leading `Total` only if it stands alone."""
    def name(parts: Column) -> Column:
        headed = (F.size(parts) > 1) & (F.lower(F.get(parts, F.lit(0))) == "total")
        kept = F.when(headed, F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1)))).otherwise(parts)
        return let(kept, lambda k: F.array_join(_without_repeats(k), " | "))

    named = let(_segments(label), name)
    return F.when(named == "", F.lit("Total")).otherwise(named)


def derived_name(name: Column) -> Column:
    """Name of a count computed from a percentage."""
    changed = F.regexp_replace(name, r"(?i)\bPercent\b", "Number [derived]")
    return F.when(changed == name, F.concat(name, F.lit(" [derived count]"))).otherwise(changed)


def classify(var_id: Column) -> Column:
    """`E` estimate, `PE` percentage, `M` margin of error; NULL for anything that is not data."""
    return (
        F.when(var_id.isin("for", "in", "ucgid") | ~var_id.contains("_"), F.lit(None))
        .when(var_id.endswith("EA") | var_id.endswith("MA"), F.lit(None))
        .when(var_id.endswith("PE"), F.lit("PE"))
        .when(var_id.endswith("M"), F.lit("M"))
        .when(var_id.endswith("E"), F.lit("E"))
    )


def is_variable(name: Column) -> Column:
    """Does a header field name a data variable?"""
    return name.rlike(r"^[A-Z]\d+(_C\d+)?_\d+(E|M|PE|PM)$")


def pe_parent_candidate(var_id: Column) -> Column:
    """Id a percentage's denominator would have."""
    subject, detailed = r"^(S\d+)_C(\d+)_(\d+)PE$", r"^([A-Z]\d+)_(\d+)PE$"
    return F.when(
        var_id.rlike(subject),
        F.concat(F.regexp_extract(var_id, subject, 1), F.lit("_C01_"), F.regexp_extract(var_id, subject, 3), F.lit("E")),
    ).when(
        var_id.rlike(detailed),
        F.concat(F.regexp_extract(var_id, detailed, 1), F.lit("_"), F.regexp_extract(var_id, detailed, 2), F.lit("E")),
    )


def count_column_candidate(var_id: Column, suffix: str) -> Column:
    """Id of the count that would make a subject-table percentage redundant."""
    shape = rf"^(S\d+)_C(\d+)_(\d+){suffix}$"
    return F.when(
        var_id.rlike(shape),
        F.concat(F.regexp_extract(var_id, shape, 1), F.lit("_C02_"), F.regexp_extract(var_id, shape, 3), F.lit("E")),
    )


def canon_s1811(name: Column) -> Column:
    """Older S1811 names brought to the present hierarchy.

    The present form of a branch is its old form below one more level, so a branch is moved by
    putting that level between group and branch.
    """
    groups, levels = "|".join(S1811_GROUPS), {}
    for old, new in S1811_INFIXES:
        levels.setdefault(new.removesuffix(old), []).append(old.removesuffix(" | "))
    for level, branches in levels.items():
        name = F.regexp_replace(name, rf"^({groups}) \| ({'|'.join(branches)}) \| ", f"$1 | {level}$2 | ")
    return name


def canon_s1810(name: Column) -> Column:
    """Older S1810 names brought to the present hierarchy."""
    base, disabled = F.lit(f"{S1810_BASE} | "), f"{S1810_DISABLED} | "
    middle = " | Subject | "

    def tail(text: Column, start: str) -> Column:
        return F.substring(text, len(start) + 1, 2**31 - 1)

    def one_race(text: Column) -> Column:
        return F.replace(text, F.lit(" | One Race | "), F.lit(" | "))

    rest = tail(name, "Subject | ")
    below = tail(name, disabled)
    first_below = F.split_part(below, F.lit(" | "), F.lit(1))
    return (
        F.when(
            name.startswith("Subject | "),
            F.when(rest.startswith(S1810_BASE), rest).otherwise(F.concat(base, rest)),
        )
        .when(
            name.contains(middle + S1810_BASE),
            F.replace(name, F.lit(middle), F.lit(" | ")),
        )
        .when(
            name.contains(middle),
            F.replace(name, F.lit(middle), F.lit(f" | {S1810_BASE} | ")),
        )
        .when(
            F.split_part(name, F.lit(" | "), F.lit(1)).isin(*S1810_CATEGORIES),
            one_race(F.concat(base, name)),
        )
        .when(
            name.startswith(disabled) & first_below.isin(*S1810_CATEGORIES),
            one_race(F.concat(F.lit(disabled), base, below)),
        )
        .when(
            name.startswith(disabled) & (below == S1810_HISPANIC),
            F.concat(F.lit(disabled), base, F.lit("RACE AND HISPANIC OR LATINO ORIGIN | "), below),
        )
        .otherwise(name)
    )


def sanitize_name(name: Column) -> Column:
    """Warehouse-safe identifier."""
    flat = F.regexp_replace(name, "[^a-zA-Z0-9]+", "_")
    safe = F.lower(F.regexp_replace(flat, "^_+|_+$", ""))
    safe = F.when(safe.rlike("^[0-9]"), F.concat(F.lit("n_"), safe)).otherwise(safe)
    return F.when(safe == "", F.lit("unknown")).otherwise(F.substring(safe, 1, 300))
