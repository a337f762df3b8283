"""The cascade of quality rules: measures, order, short circuits and odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import licenses, rules
from tallyloom.llm.rules import BASE, MEASURES, RULES, Rule

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force():
    rng = random.Random(3)
    some = ["", " \t\n", "a b c a b c", "a a a a", "a b", "x#|y\n\n x#|y\nx#|y \nx#|y", "Größe 日本 \U0001F600 x y\x1cz", "a\rb\vc\fd e"]
    some += [" ".join(rng.choice("abcd") for _ in range(n)) for n in (3, 4, 10, 40, 60)]
    for text in some:
        measured = {"text": text.encode()}
        assert tuple(rules.take(measured, name) for name in BASE) == brute(text)


def test_repeats_in_long_texts_of_many_words():
    words = [b"%d" % i for i in range(300_000)]
    assert rules.repeated(words) == 0
    assert rules.repeated(words + words[7:12] + [b"z"]) == 10


def test_wide_windows_are_named_in_steps():
    words = [b"%d" % (i % 70_000) for i in range(80_000)]
    assert rules.repeated(words, 6) == 20_000


@pytest.mark.parametrize("name, text", [
    ("few_words", "word " * 49), ("repeated_words", "one two three " * 20), ("word_size", " ".join(f"a{i % 10}" for i in range(50))),
    ("symbols", " ".join(f"word{i}#" for i in range(60))), ("without_letters", " ".join(f"{i:05}" for i in range(60))),
    ("top_word", " ".join(f"then word{i} thing{i}" for i in range(60))), ("long_word", "x" * 1001), ("capitals", " ".join(f"WORD{i}" for i in range(60))),
    ("bullets", "\n".join(f"- item{i}" for i in range(60))), ("ellipses", "\n".join(f"line{i} goes on…" for i in range(60))),
    ("duplicate_lines", "the same line\n" * 60)])
def test_each_rule_rejects(name, text):
    rule = next(r for r in RULES if r.name == name)
    assert rules.rejected(rule, {"text": text.encode()})
    fine = "\n".join(f"Sentence number {w} speaks of thing{w} and matter{w}." for w in "abcdefghijkl")
    assert not rules.rejected(rule, {"text": fine.encode()})


def test_order_is_rejection_per_cost_of_what_is_left():
    a = Rule("a", ("n_repeat_words",), lambda r: True)
    b = Rule("b", ("n_upper",), lambda u: True)
    c = Rule("c", ("n_letter_words",), lambda k: True)
    names = rules.needed(n for r in (a, b, c) for n in r.reads)
    assert names == ["words", "n_repeat_words", "n_upper", "n_letter_words"]
    seconds = np.tile([4.0, 4.0, 2.0, 0.5], (10, 1))
    rejects = np.zeros((10, 3), bool)
    rejects[:8, 0] = True  # 0.8 for 8
    rejects[:3, 1] = True  # 0.3 for 2
    rejects[5:9, 2] = True  # 0.4 for 4.5
    assert [r.name for r in rules.ordered((a, b, c), seconds, rejects)] == ["b", "c", "a"]
    # The words are taken anyhow: a costs 4 and c 0.5.
    assert [r.name for r in rules.ordered((a, b, c), seconds, rejects, ["words"])] == ["c", "b", "a"]
    assert [r.name for r in rules.ordered((a, b, c), np.zeros((0, 4)), np.zeros((0, 3), bool))] == ["a", "b", "c"]


def test_rejected_texts_meet_no_later_rule():
    def fail(*_):
        raise AssertionError

    measured = {"text": b"short"}
    later = Rule("later", ("n_upper",), fail)
    by = next((r.name for r in (RULES[0], later) if rules.rejected(r, measured)), None)
    assert by == "few_words" and "n_upper" not in measured


@pytest.fixture(scope="module")
def found(spark, odd):
    order = rules.plan(odd)
    assert sorted(r.name for r in order) == sorted(r.name for r in RULES)
    return rules.cascade(odd, order)


def test_verdict_is_that_of_all_rules(odd, found):
    assert found.columns == [c for c in odd.columns if c not in (*BASE, "kept")] + [*BASE, "kept", "rejected_by"]
    assert found.count() == odd.count()
    for r in found.collect():
        whole = {"text": (r.text or "").encode()}
        hit = {rule.name for rule in RULES if rules.rejected(rule, whole)}
        assert r.kept == (not hit) and (r.rejected_by in hit if hit else r.rejected_by is None)
        assert tuple(r[name] for name in BASE) == (brute(r.text) if len(r.text or "") < 9000 else tuple(whole[n] for n in BASE))
    assert found.where("text is null").select(*BASE, "kept", "rejected_by").collect()[0] == (0, 0, 0, 0, 0, False, "few_words")


def test_any_order_gives_the_same(odd, found):
    turned = rules.cascade(odd, RULES[::-1])
    assert sorted(map(str, turned.drop("rejected_by").collect())) == sorted(map(str, found.drop("rejected_by").collect()))


def test_empty_table_and_bounded_sample(spark, nothing, odd):
    assert rules.cascade(nothing, rules.plan(nothing)).collect() == []
    same = spark.range(0, 5000, 1, 8).select(F.lit(1).alias("doc_id"), F.lit("word").alias("text"))
    assert [r.name for r in rules.plan(same, sample=10)][0] == "few_words"
    assert all(name in MEASURES for r in RULES for name in r.reads)


def test_labelled_documents(spark):
    kept = {r.doc_id: r.kept or r.base_failed for r in rules.op12_rules(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality is not null").collect()
    good = [kept[r.doc_id] for r in labels if r.quality == 1]
    assert all(good)  # beyond the base no rule takes a good document


def test_the_words_of_a_text_are_made_once_for_all_rules(spark):
    """A filter on them would be pushed down to the documents, where it makes them again."""
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.concat(F.lit("Licensed under the MIT License "), "id").alias("text"))
    found = licenses.scan(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "regexp_replace" in line for line in plan.splitlines())
    assert {r.labels for r in found.collect()} == {"mit"}
