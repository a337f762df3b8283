"""Quality rules as a short-circuit cascade, ordered by what they reject for their cost."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import ship, table, tidy

SAMPLE = 2000  # documents that costs and rejections are estimated on, about
CHECK = 2e-7  # seconds that a rule over known measures takes
BLANK = b"\t\n\v\f\r "
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of a character past its first
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
PLAIN = bytes(c for c in range(128) if not chr(c).isalpha())
BULLETS = tuple(c.encode() for c in "-*•")
ELLIPSES = tuple(c.encode() for c in ("...", "…"))


def counted(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def repeated(words: list[bytes], width: int = 3) -> int:
    """Words within windows of `width` words that occur twice or more in the text."""
    if len(words) <= width:
        return 0
    names: dict[bytes, int] = {}
    code = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    window, size = code[:len(code) - width + 1], len(names)
    for k in range(1, width):
        if size * len(names) >= 1 << 62:
            window = np.unique(window, return_inverse=True)[1]
            size = len(window)
        window, size = window * len(names) + code[k:len(code) - width + 1 + k], size * len(names)
    _, which, times = np.unique(window, return_inverse=True, return_counts=True)
    begin = np.flatnonzero(times[which] > 1)
    covered = np.zeros(len(code), bool)
    for k in range(width):
        covered[begin + k] = True
    return int(covered.sum())


# What rules read: name, measures needed first, and the value from those before. `text` is the whole text in UTF-8.
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[dict], object]]] = {
    "words": ((), lambda m: m["text"].split()),
    "lines": ((), lambda m: [line for line in m["text"].split(b"\n") if line.strip()]),
    "counts": (("words",), lambda m: Counter(m["words"])),
    "n_words": (("words",), lambda m: len(m["words"])),
    "word_chars": ((), lambda m: len(m["text"].translate(None, BLANK + CONTINUED))),
    "n_symbols": ((), lambda m: counted(m["text"], SYMBOLS)),
    "n_lines": (("lines",), lambda m: len(m["lines"])),
    "n_dup_lines": (("lines",), lambda m: len(m["lines"]) - len(set(m["lines"]))),
    "n_repeat_words": (("words",), lambda m: repeated(m["words"])),
    "n_letter_words": (("words",), lambda m: sum(map(bool, (w.translate(None, PLAIN) for w in m["words"])))),
    "n_top_word": (("counts",), lambda m: max(m["counts"].values(), default=0)),
    "longest_word": (("words",), lambda m: max(map(len, m["words"]), default=0)),
    "n_upper": ((), lambda m: counted(m["text"], UPPER)),
    "n_lower": ((), lambda m: counted(m["text"], LOWER)),
    "n_bullets": (("lines",), lambda m: sum(line.lstrip().startswith(BULLETS) for line in m["lines"])),
    "n_ellipses": (("lines",), lambda m: sum(line.rstrip().endswith(ELLIPSES) for line in m["lines"])),
}


@dataclass(frozen=True)
class Rule:
    name: str
    reads: tuple[str, ...]
    rejects: Callable[..., bool]  # of the measures read, in that order


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
)
RULES = BASE_RULES + (
    Rule("word_size", ("word_chars", "n_words"), lambda c, n: c < 3 * n or c > 10 * n),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
    Rule("without_letters", ("n_letter_words", "n_words"), lambda k, n: 5 * k < 4 * n),
    Rule("top_word", ("n_top_word", "n_words"), lambda t, n: 5 * t > n),
    Rule("long_word", ("longest_word",), lambda k: k > 1000),
    Rule("capitals", ("n_upper", "n_lower"), lambda u, k: u > k),
    Rule("bullets", ("n_bullets", "n_lines"), lambda b, n: 10 * b > 9 * n),
    Rule("ellipses", ("n_ellipses", "n_lines"), lambda e, n: 10 * e > 3 * n),
)


def needed(names: Iterable[str]) -> list[str]:
    """The measures and all they need, in an order in which they can be taken."""
    found: list[str] = []
    for name in names:
        found += [n for n in (*needed(MEASURES[name][0]), name) if n not in found]
    return found


def take(measured: dict, name: str):
    """A measure of one text, computed on first use."""
    if name not in measured:
        needs, value = MEASURES[name]
        for other in needs:
            take(measured, other)
        measured[name] = value(measured)
    return measured[name]


def rejected(rule: Rule, measured: dict) -> bool:
    return bool(rule.rejects(*(take(measured, name) for name in rule.reads)))


def trial(texts: Iterable[bytes], rules: Sequence[Rule]) -> list[tuple[list[float], list[bool]]]:
    """Per text the seconds of every measure by itself, and which rules reject it."""
    found, names = [], needed(n for r in rules for n in r.reads)
    for text in texts:
        measured, seconds = {"text": text}, []
        for name in names:
            begin = time.perf_counter()
            measured[name] = MEASURES[name][1](measured)
            seconds.append(time.perf_counter() - begin)
        found.append((seconds, [rejected(rule, measured) for rule in rules]))
    return found


def ordered(rules: Sequence[Rule], seconds: np.ndarray, rejects: np.ndarray, paid: Iterable[str] = ()) -> list[Rule]:
    """Rules by rejections per cost among the sampled texts that the rules before leave.

    A rule costs the measures that nothing before it has taken; `paid` are taken anyhow. Draws go to
    the cheaper rule, then to the one given first.
    """
    names = needed(n for r in rules for n in r.reads)
    known, left, alive, found = set(needed(paid)), list(range(len(rules))), np.ones(len(rejects), bool), []
    while left:
        some = alive if alive.any() else np.ones(len(rejects), bool)
        price = dict(zip(names, seconds[some].mean(0).tolist() if len(seconds) else [0.0] * len(names)))

        def rank(k):
            cost = CHECK + sum(price[n] for n in needed(rules[k].reads) if n not in known)
            share = rejects[some, k].mean() if len(rejects) else 0.0
            return -share / cost, cost, k

        best = min(left, key=rank)
        left.remove(best)
        found.append(rules[best])
        known.update(needed(rules[best].reads))
        alive &= ~rejects[:, best]
    return found


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", id_col: str = "doc_id", paid: Sequence[str] = (),
         sample: int = SAMPLE) -> list[Rule]:
    """`rules` in the order of the cascade, estimated on about `sample` documents chosen by a hash of their id.

    The choice bears on speed alone: a document is kept if no rule rejects it, whatever the order. At most
    twice `sample` documents are taken, however often an id occurs.
    """
    ship(docs.sparkSession.sparkContext)
    apart = max(1, docs.count() // max(1, sample))
    chosen = docs.where(F.pmod(F.xxhash64(id_col), F.lit(apart)) == 0).limit(2 * sample)

    def run(batches):
        for batch in batches:
            seconds, rejects = zip(*trial(texts(batch[text_col]), rules)) if len(batch) else ((), ())
            yield pa.RecordBatch.from_pydict({"seconds": pa.array(seconds, pa.list_(pa.float64())), "rejects": pa.array(rejects, pa.list_(pa.bool_()))})

    found = chosen.select(text_col).mapInArrow(run, "seconds array<double>, rejects array<boolean>").collect()
    names = needed(n for r in rules for n in r.reads)
    seconds = np.array([r.seconds for r in found], float).reshape(-1, len(names))
    return ordered(rules, seconds, np.array([r.rejects for r in found], bool).reshape(-1, len(rules)), paid)


def texts(column: pa.Array) -> Iterable[bytes]:
    """Texts in UTF-8, one at a time; a null is empty."""
    return (t.as_py() or b"" for t in column.cast(pa.binary()))


def cascade(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", always: Sequence[str] = BASE, kept_into: str = "kept",
            by_into: str = "rejected_by") -> DataFrame:
    """`docs` with the measures `always`, whether each whole text is kept, and the rule that rejected it.

    Rules are tried in the order given, as `plan` found it, and a text meets none past the first that
    rejects it; measures that only later rules read are not taken for it. `rejected_by` is null for
    kept texts and, like the order, may differ between runs where several rules reject a text. A null
    text is measured as an empty one. Rows and other columns stay; columns of the names added are replaced.
    """
    ship(docs.sparkSession.sparkContext)
    added = [*always, kept_into, by_into]
    names = [c for c in docs.columns if c not in added]

    def run(batches):
        for batch in batches:
            found = []
            for text in texts(batch[text_col]):
                measured = {"text": text}
                row = [take(measured, name) for name in always]
                by = next((rule.name for rule in rules if rejected(rule, measured)), None)
                found.append((*row, by is None, by))
            columns = zip(*found) if found else [[]] * len(added)
            kinds = [pa.int64()] * len(always) + [pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *map(pa.array, columns, kinds)], names=[*names, *added])
        tidy()

    fields = [T.StructField(c, T.LongType()) for c in always] + [T.StructField(kept_into, T.BooleanType()), T.StructField(by_into, T.StringType())]
    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in names), *fields]))


def op12_rules(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = cascade(docs, plan(docs, paid=BASE))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", *BASE, failed.alias("base_failed"), "kept")


OP12_SQL = r"""
with w as (
    select row_number() over () as k, doc_id, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents
), p as (
    select k, unnest(range(1, len(words) - 1)) as i,
           unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) as g
    from w
), r as (
    select k, i from (select k, i, count(*) over (partition by k, g) as n from p) where n > 1
), covered as (
    select k, count(distinct j) as n_repeat_words from (select k, unnest([i, i + 1, i + 2]) as j from r) group by k
), top as (
    select k, max(n) as n_top_word from (select k, word, count(*) as n from (select k, unnest(words) as word from w) group by k, word) group by k
), m as (
    select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
           len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_top_word, 0) as n_top_word,
           len(list_filter(words, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) as n_letter_words,
           coalesce(list_max(list_transform(words, lambda x: strlen(x))), 0) as longest_word,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper,
           length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) as n_lower,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) as n_bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as n_ellipses
    from w left join covered using (k) left join top using (k)
), b as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not (base_failed or word_chars < 3 * n_words or word_chars > 10 * n_words or 10 * n_symbols > n_words
            or 2 * n_dup_lines > n_lines or 5 * n_letter_words < 4 * n_words or 5 * n_top_word > n_words or longest_word > 1000
            or n_upper > n_lower or 10 * n_bullets > 9 * n_lines or 10 * n_ellipses > 3 * n_lines) as kept
from b
"""
