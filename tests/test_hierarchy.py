"""Conversions against a model that works column by column, in place."""

import random

import pytest

from tallyloom.operators import hierarchy as H

LIMIT = 100.5


def random_case(rnd, shuffled):
    """Columns as (id, chain) in column order, with values per row; ids sorted unless shuffled."""
    chains = [("Total",)]
    for _ in range(rnd.randrange(2, 9)):
        base = rnd.choice(chains)
        chains.append(base + (rnd.choice([x for x in "abcd" if x != base[-1]]),))
    if rnd.random() < 0.3:
        chains.append(rnd.choice(chains))
    if shuffled:
        rnd.shuffle(chains)
    columns = [(f"V{i:02d}E", c) for i, c in enumerate(chains)]

    def value(count):
        kind = rnd.random()
        if kind < 0.12:
            return None
        if kind < 0.2:
            return 0.0
        return float(rnd.randrange(1, 10**6)) if count else rnd.randrange(0, 1001) / 10
    counts = {v: len(c) == 1 or rnd.random() < 0.25 for v, c in columns}
    empty = {v for v, _ in columns if rnd.random() < 0.08}
    rows = [{v: None if v in empty else value(counts[v]) for v, _ in columns} for _ in range(4)]
    return columns, rows


def parent_of(columns, v):
    chain = dict(columns)[v]
    owner = {c: i for i, c in columns}
    for k in range(len(chain) - 1, 0, -1):
        if chain[:k] in owner:
            return owner[chain[:k]]
    return None


def apply(rows, v, parent):
    for r in rows:
        ok = r[v] is not None and r[parent] not in (None, 0.0)
        r[v] = r[v] / 100.0 * r[parent] if ok else None


def top(rows, v):
    return max((r[v] for r in rows if r[v] is not None), default=None)


def first_pass(columns, rows):
    rows = [dict(r) for r in rows]
    chosen = []
    for v, chain in columns:
        highest, parent = top(rows, v), parent_of(columns, v)
        if len(chain) > 1 and (highest is None or highest <= LIMIT) and parent:
            chosen.append((v, parent))
    for v, parent in chosen:
        apply(rows, v, parent)
    return rows


def second_pass(columns, rows):
    rows = [dict(r) for r in rows]
    for v, chain in columns:
        highest, parent = top(rows, v), parent_of(columns, v)
        if len(chain) < 2 or highest is None or highest > LIMIT or parent is None:
            continue
        above = top(rows, parent)
        if above is not None and above > LIMIT:
            apply(rows, v, parent)
    return rows


def frames(spark, cases):
    data, meta = [], []
    for year, (columns, rows) in enumerate(cases):
        for i, r in enumerate(rows):
            data.append(("S1811", year, i, r))
        for position, (v, chain) in enumerate(columns):
            meta.append(("S1811", year, v, position, "Estimate!!" + "!!".join(chain), " | ".join(chain)))
    rows = spark.createDataFrame(data, "table_id string, year int, i int, values map<string,double>")
    return rows, spark.createDataFrame(
        meta, "table_id string, year int, var_id string, position int, label string, name string")


def result(df):
    return {(r["year"], r["i"]): r["values"] for r in df.select("year", "i", "values").collect()}


@pytest.mark.parametrize("shuffled", [False, True])
def test_first_pass(spark, shuffled):
    rnd = random.Random(11)
    cases = [random_case(rnd, shuffled) for _ in range(150)]
    rows, meta = frames(spark, cases)
    got = result(H.percent_to_count(rows, meta))
    for year, (columns, values) in enumerate(cases):
        for i, want in enumerate(first_pass(columns, values)):
            assert got[(year, i)] == want, (year, columns, values)


@pytest.mark.parametrize("shuffled", [False, True])
def test_second_pass(spark, shuffled):
    rnd = random.Random(12)
    cases = []
    while len(cases) < 150:
        columns, rows = random_case(rnd, shuffled)
        if len({c for _, c in columns}) == len(columns):
            cases.append((columns, rows))
    rows, meta = frames(spark, cases)
    got = result(H.labelled_percent_to_count(rows, meta))
    for year, (columns, values) in enumerate(cases):
        for i, want in enumerate(second_pass(columns, values)):
            assert got[(year, i)] == want, (year, columns, values)


def test_pe_to_count(spark):
    rows = spark.createDataFrame(
        [("B", 2012, {"a": 200.0, "aPE": 50.0, "xPE": 5.0}), ("B", 2012, {"a": 0.0, "aPE": 50.0, "xPE": 5.0})],
        "table_id string, year int, values map<string,double>")
    parents = spark.createDataFrame([("B", 2012, "aPE", "a"), ("B", 2012, "xPE", None)],
                                    "table_id string, year int, var_id string, pe_parent string")
    got = [r["values"] for r in H.pe_to_count(rows, parents).collect()]
    assert sorted(got, key=str) == [{"a": 0.0, "aPE": None, "xPE": None}, {"a": 200.0, "aPE": 100.0, "xPE": None}]
