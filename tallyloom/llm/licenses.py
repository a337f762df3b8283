"""License scans by ordered signature rules, as column expressions and joins only."""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import table

# Base phrases and the labels they give (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, identifier as words, name as a pattern over words, and a word that every match of the name holds.
NAMES = [
    ("0bsd", "0bsd", "zero clause bsd license|bsd zero clause license|0 clause bsd license", "bsd"),
    ("aal", "aal", "attribution assurance license", "assurance"),
    ("afl", "afl(?: [123] [0-9])?", "academic free license(?: version| v)?(?: [123] [0-9])?", "academic"),
    ("agpl-3.0", "agpl 3 0(?: only| or later)?", "(?:gnu )?affero general public license(?: (?:version )?3(?: 0)?)?", "affero"),
    ("apache-1.1", "apache 1 1", "apache software license(?: version)? 1 1", "apache"),
    ("apache-2.0", "apache 2 0", "apache (?:software )?license(?:(?: version| v) ?| )2(?: 0)?", "apache"),
    ("apsl", "apsl(?: [12] [0-9])?", "apple public source license", "apple"),
    ("artistic-1.0", "artistic 1 0(?: perl)?", "artistic license(?: version)? 1 0", "artistic"),
    ("artistic-2.0", "artistic 2 0", "artistic license(?: version)?(?: 2 0)?", "artistic"),
    ("beerware", "beerware", "beer ?ware license", "beer|beerware"),
    ("blueoak", "blueoak 1 0 0", "blue oak model license(?: 1 0 0)?", "oak"),
    ("bsd-2-clause", "bsd 2 clause(?: patent)?", "(?:simplified|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) licen[cs]e", "clause|simplified|freebsd"),
    ("bsd-3-clause", "bsd 3 clause(?: clear)?", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[cs]e", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:original bsd|bsd 4 clause|4 clause bsd) licen[cs]e", "bsd"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e", "bsd"),
    ("bsl-1.0", "bsl 1 0", "boost software license(?: version)?(?: 1 0)?", "boost"),
    ("busl-1.1", "busl 1 1", "business source license(?: version)?(?: 1 1)?", "business"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1-4] 0)?", "(?:creative commons |cc )(?:attribution|by) (?:non ?commercial|nc) (?:no ?deriv(?:ative)?s?|nd)(?: works)?(?: [1-4] 0)?", "creative|cc"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] 0)?", "(?:creative commons |cc )(?:attribution|by) (?:non ?commercial|nc) (?:share ?alike|sa)(?: [1-4] 0)?", "creative|cc"),
    ("cc-by-nc", "cc by nc(?: [1-4] 0)?", "(?:creative commons |cc )(?:attribution|by) (?:non ?commercial|nc)(?: [1-4] 0)?", "creative|cc"),
    ("cc-by-nd", "cc by nd(?: [1-4] 0)?", "(?:creative commons |cc )(?:attribution|by) (?:no ?deriv(?:ative)?s?|nd)(?: [1-4] 0)?", "creative|cc"),
    ("cc-by-sa", "cc by sa(?: [1-4] 0)?", "(?:creative commons |cc )(?:attribution|by) (?:share ?alike|sa)(?: [1-4] 0)?", "creative|cc"),
    ("cc-by", "cc by(?: [1-4] 0)?", "creative commons attribution(?: [1-4] 0)?|cc by [1-4] 0", "creative|cc"),
    ("cc0-1.0", "cc0 1 0", "cc0(?: 1 0)?(?: universal)?|creative commons zero", "cc0|creative"),
    ("cddl", "cddl 1 [01]", "common development and distribution license", "development"),
    ("cecill", "cecill(?: [bc12])?(?: [0-9])?", "cecill(?: [bc])? (?:free software )?license", "cecill"),
    ("cpal", "cpal 1 0", "common public attribution license", "attribution"),
    ("cpl", "cpl 1 0", "common public license", "common"),
    ("ecl-2.0", "ecl 2 0", "educational community license", "educational"),
    ("efl", "efl [12] 0", "eiffel forum license", "eiffel"),
    ("elastic-2.0", "elastic 2 0", "elastic license(?: 2 0)?", "elastic"),
    ("epl", "epl [12] 0", "eclipse public license(?: version| v)?(?: [12] 0)?", "eclipse"),
    ("eupl", "eupl 1 [012]", "european union public licen[cs]e", "european"),
    ("gfdl", "gfdl 1 [123](?: only| or later)?", "(?:gnu )?free documentation license", "documentation"),
    ("gpl-2.0", "gpl 2 0(?: only| or later)?", "(?:gnu )?(?:general public license|gpl)(?: version| v) ?2(?: 0)?", "gpl|general"),
    ("gpl-3.0", "gpl 3 0(?: only| or later)?", "(?:gnu )?(?:general public license|gpl)(?: version| v) ?3(?: 0)?", "gpl|general"),
    ("gpl", "gpl", "(?:gnu )?general public license|gnu gpl", "gnu|general"),
    ("hpnd", "hpnd", "historical permission notice and disclaimer", "historical"),
    ("ipl", "ipl 1 0", "ibm public license", "ibm"),
    ("isc", "isc", "isc license", "isc"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu )?(?:lesser general public license|lgpl)(?: version| v) ?2 1", "lesser|lgpl"),
    ("lgpl-3.0", "lgpl 3 0(?: only| or later)?", "(?:gnu )?(?:lesser general public license|lgpl)(?: version| v) ?3(?: 0)?", "lesser|lgpl"),
    ("lgpl", "lgpl", "(?:gnu )?(?:lesser|library) general public license", "lesser|library"),
    ("lppl", "lppl 1 [0-3][ac]?", "latex project public license", "latex"),
    ("mit-0", "mit 0", "mit no attribution(?: license)?", "mit"),
    ("mit", "mit", "mit(?: x11)? licen[cs]e|expat licen[cs]e", "mit|expat"),
    ("mpl-1.1", "mpl 1 1", "mozilla public license(?:(?: version| v) ?| )1 1", "mozilla"),
    ("mpl-2.0", "mpl 2 0", "mozilla public license(?: version| v)?(?: 2 0)?", "mozilla"),
    ("ms-pl", "ms pl", "microsoft public license", "microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal license", "microsoft"),
    ("mulan", "mulanpsl [12] 0", "mulan permissive software license", "mulan"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license", "ncsa"),
    ("odbl", "odbl 1 0", "open (?:data commons open )?database license", "database"),
    ("ofl-1.1", "ofl 1 1", "(?:sil )?open font license(?: version)?(?: 1 1)?", "font"),
    ("osl-3.0", "osl 3 0", "open software license(?: version)?(?: 3 0)?", "open"),
    ("php-3.0", "php 3 0[01]?", "php license(?: version)?(?: 3 0[01]?)?", "php"),
    ("postgresql", "postgresql", "postgresql license", "postgresql"),
    ("psf-2.0", "psf 2 0|python 2 0", "python (?:software foundation )?license", "python"),
    ("qpl", "qpl 1 0", "q public license", "q"),
    ("rpl", "rpl 1 [15]", "reciprocal public license", "reciprocal"),
    ("sspl-1.0", "sspl 1 0", "server side public license", "server"),
    ("unicode", "unicode (?:dfs )?(?:2015|2016|3 0)", "unicode license(?: agreement)?", "unicode"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("upl-1.0", "upl 1 0", "universal permissive license", "universal"),
    ("vim", "vim", "vim license", "vim"),
    ("w3c", "w3c(?: 1998| 2015)?", "w3c software (?:notice and )?license", "w3c"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public license", "fuck"),
    ("x11", "x11", "x11 license", "x11"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib"),
    ("zpl-2.1", "zpl [12] [01]", "zope public license", "zope"),
]

# Frames around an identifier or a name: priority, confidence, pattern and a word that every match holds.
FRAMES = [
    (1, 1.0, "spdx license identifier (?:{id})", "spdx"),
    (2, 0.95, "licensed under (?:the )?(?:terms of )?(?:the )?(?:{name})", "licensed"),
    (2, 0.95, "(?:released|available|distributed|published) under (?:the )?(?:terms of )?(?:the )?(?:{name})", "under"),
    (3, 0.9, "license (?:is )?(?:{id})", "license"),
    (4, 0.8, "{name}", ""),
]

# Signatures of license texts and notices: label, pattern, word, confidence.
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission", 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution", 0.9),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance", 0.9),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu", "redistribute", 0.9),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use", "liable", 0.85),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 0.95),
    ("public-domain", "(?:is|released|placed) (?:in|into|to) the public domain", "domain", 0.7),
    ("proprietary", "all rights reserved", "reserved", 0.6),
    ("proprietary", "confidential and proprietary", "proprietary", 0.6),
    ("warranty-disclaimer", "provided as is without warranty(?: of any kind)?", "warranty", 0.5),
]


def rules() -> list[tuple[int, int, str, str, str, str, float]]:
    """Rule number, priority, label, pattern, words of which a match holds one, a word that it holds too, and
    confidence, in the order in which rules win.

    The first words are those of the identifier or name, the other is the frame's. Between two words stand two blanks; an optional blank of a rule stands for both or none.
    """
    found = []
    for priority, sure, frame, word in FRAMES:
        for label, identifier, name, own in NAMES:
            first = "|".join(re.match("[a-z0-9]+", some)[0] for some in re.sub(r"\([^()]*\)\??", "", identifier).split("|"))
            found.append((priority, label, frame.format(id=identifier, name=name), first if "{id}" in frame else own, word, sure))
    found += [(3, label, text, word, "", sure) for label, text, word, sure in TEXTS]
    found.sort(key=lambda r: r[0])
    return [(i, p, label, f" (?:{text}) ".replace(" ?", "(?: )?").replace(" ", "  ")[1:-1], own, word, sure) for i, (p, label, text, own, word, sure) in enumerate(found)]


def words_of(text):
    """Every word with a blank on both of its sides, so that neighbours share none; A-Z in lower case."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    body = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  "))
    return F.when(body == "", "").otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def blanks(text):
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(docs: DataFrame, key_col: str, words_col: str) -> DataFrame:
    """Columns key, rule, label, sure, first, last (words, from 0): what is left of all rules' matches.

    Rules are joined to a text by the words in it that they need, those of the name and that of the frame,
    so a text meets only patterns all of whose words it holds. A match within another match is suppressed; of equal ones the first rule's stays.
    """
    spark = docs.sparkSession
    each = [(i, p, label, text, w, also, sure) for i, p, label, text, word, also, sure in rules() for w in word.split("|")]
    known = spark.createDataFrame(each, "rule int, priority int, label string, pattern string, word string, also string, sure double")
    own, frames = {w for *_, w, _, _ in each}, {also for *_, also, _ in each if also}
    names, told = (F.array(*map(F.lit, sorted(some))) for some in (own, own | frames))
    rows = docs.select(F.col(key_col).alias("key"), F.col(words_col).alias("words"))
    # The words of a text are looked up in a set. No filter stands here: it would be pushed down to the documents, with all that makes the words.
    rows = rows.withColumn("held", F.array_intersect(F.split("words", " "), told))
    rows = rows.withColumn("word", F.explode_outer(F.when(F.arrays_overlap("held", names), F.col("held"))))
    hits = rows.join(F.broadcast(known), "word").where((F.col("also") == "") | F.array_contains("held", F.col("also")))
    hits = hits.where(F.rlike("words", F.col("pattern")))
    hits = hits.select("key", "rule", "label", "sure", F.posexplode(F.arrays_zip(
        F.transform(F.split("words", F.col("pattern"), -1), blanks).alias("before"),
        F.transform(F.regexp_extract_all("words", F.col("pattern"), F.lit(0)), blanks).alias("own"))).alias("place", "hit"))
    hits = hits.select("key", "rule", "label", "sure", "place", "hit.before", "hit.own").distinct()
    order = Window.partitionBy("key", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum(F.col("before") + F.coalesce("own", F.lit(0))).over(order)
    hits = hits.withColumn("last", last).where("own is not null").select(
        "key", "rule", "label", "sure", ((F.col("last") - F.col("own")) / 2).cast("long").alias("first"),
        (F.col("last") / 2 - 1).cast("long").alias("last"))
    inside = Window.partitionBy("key").orderBy("first", F.desc("last"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    return hits.withColumn("reach", F.max("last").over(inside)).where("reach is null or reach < last").drop("reach")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    Base phrases count wherever their words stand in a row; the rules add labels of their own. The
    score is the confidence of the surest match left, 0.5 if only a base phrase was found, else 0.
    Null and empty texts have no words. Repeated rows have the same result each.
    """
    key = F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), words_of(F.col(text_col)).alias("words"))
    total = (blanks(F.col("words")) / 2).cast("long")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        spread = " " + phrase.replace(" ", "  ") + " "
        has, parts = F.contains("words", F.lit(spread)), F.split("words", spread, -1)
        counts.append(F.when(has, F.size(parts) - 1).otherwise(0))
        firsts.append(F.when(has, blanks(F.element_at(parts, 1)) / 2))
        lasts.append(F.when(has, total - blanks(F.element_at(parts, -1)) / 2 - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    found = rows.select(
        "id", "key", total.alias("n_words"), sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"))
    own = detections(rows, "key", "words").groupBy("key").agg(F.collect_set("label").alias("own"), F.max("sure").alias("sure"))
    found = found.join(own, "key", "left")
    both = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("sure", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return found.select("id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"),
                        F.concat_ws(",", both).alias("labels"), score.alias("score"))


def op6_licenses(spark, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def _sql() -> str:
    values = ", ".join(f"({i}, '{label}', '{text}', '{word}', {sure})" for i, _, label, text, word, _, sure in rules())
    base = ", ".join(f"('{' ' + p.replace(' ', '  ') + ' '}', '{label}', {len(p.split())})" for p, label in BASE.items())
    return rf"""
with rules(rule, label, pattern, word, sure) as (values {values}),
base(phrase, label, n) as (values {base}),
w as (
    select row_number() over () as k, doc_id,
           trim(regexp_replace(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') as body
    from documents
), s as (
    select k, doc_id, case when body = '' then '' else ' ' || body || ' ' end as words from w
), b as (
    select k, label, string_split(words, phrase) as parts, n from s join base on contains(words, phrase)
), bp as (
    select k, count(*) as phrases, sum(len(parts) - 1) as n_base, min((length(parts[1]) - length(replace(parts[1], ' ', ''))) // 2) as first_word,
           min((length(parts[-1]) - length(replace(parts[-1], ' ', ''))) // 2 + n) as behind, list(distinct label) as labels
    from b group by k
), m as (
    select k, rule, label, sure, regexp_split_to_array(words, pattern) as parts, regexp_extract_all(words, pattern) as own
    from s join rules on regexp_matches(words, ' (' || word || ') ') and regexp_matches(words, pattern)
), p as (
    select k, rule, label, sure, parts, own, unnest(range(1, len(own) + 1)) as i from m
), h as (
    select k, rule, label, sure,
           length(array_to_string(own[1:i - 1], '') || array_to_string(parts[1:i], '')) - length(replace(array_to_string(own[1:i - 1], '') || array_to_string(parts[1:i], ''), ' ', '')) as blanks,
           length(own[i]) - length(replace(own[i], ' ', '')) as own_blanks
    from p
), d as (
    select k, rule, label, sure, blanks // 2 as first, (blanks + own_blanks) // 2 - 1 as last from h
), r as (
    select *, max(last) over (partition by k order by first, last desc, rule rows between unbounded preceding and 1 preceding) as reach from d
), f as (
    select k, list(distinct label) as labels, max(sure) as sure from r where reach is null or reach < last group by k
)
select doc_id, ((length(words) - length(replace(words, ' ', ''))) // 2)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
       first_word::bigint as first_word, ((length(words) - length(replace(words, ' ', ''))) // 2 - behind)::bigint as last_word,
       coalesce(array_to_string(list_sort(bp.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bp.labels, []), coalesce(f.labels, [])))), ','), '') as labels,
       greatest(coalesce(sure, 0), case when n_base > 0 then 0.5 else 0 end)::double as score
from s left join bp using (k) left join f using (k)
"""


OP6_SQL = _sql()
