"""Quality, language, packing, licenses, pages and pieces on small tables and odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language, licenses, packing, pages, pieces, quality
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.01"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# quality

def test_held_out_quality(spark):
    found = quality.op4_quality(spark, FOLDER)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality is not None}
    rows = [r for r in found.collect()]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and sum(a == b for a, b in judged) / len(judged) >= 0.95


def test_votes_equal_brute_force():
    rng = np.random.default_rng(2)
    rows = np.array([quality.counts(prose(i, 30 + i)) for i in range(60)])
    labels = rng.integers(0, 2, 60)
    model = quality.fit(rows, labels)
    x = quality.unit(quality.weighted(rows, model["rarity"]) @ model["axes"])
    for i, score in enumerate(quality.vote(model, rows)):
        like = x @ x[i]
        near = np.argsort(-like)[:quality.NEIGHBOURS]
        weight = np.clip(like[near], 1e-6, 1).astype(float) ** quality.SHARPNESS
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-3)


def twin(text, seed):
    """The text with other letters: the same shape, other words."""
    rng = np.random.default_rng(seed)
    other = {c: chr(97 + k) for c, k in zip("abcdefghijklmnopqrstuvwxyz", rng.permutation(26))}
    return "".join(other.get(c, c) for c in text)


def test_words_decide_between_texts_of_one_shape():
    good = [prose(i, 80) for i in range(40)]
    bad = [twin(t, 1) for t in good]
    shape = slice(0, quality.SHAPE)
    assert all((quality.counts(a)[shape] == quality.counts(b)[shape]).all() for a, b in zip(good[:5], bad))
    model = quality.fit(np.array([quality.counts(t) for t in good[:30] + bad[:30]]), np.array([1] * 30 + [0] * 30))
    scores = quality.vote(model, np.array([quality.counts(t) for t in good[30:] + bad[30:]]))
    assert (scores[:10] > 0.7).all() and (scores[10:] < 0.3).all()


def test_equally_near_documents_vote_by_their_order():
    rows = np.array([quality.counts("one two three")] * 40 + [quality.counts(prose(3, 50))] * 5)
    labels = np.array([1] * quality.NEIGHBOURS + [0] * 20)
    model = quality.fit(rows, labels)
    assert quality.vote(model, rows[:1])[0] == 1.0
    many = quality.vote(model, np.concatenate([rows[:1]] * 700 + [rows[-1:]] * 3 + [rows[:1]]))
    assert (many[:700] == 1.0).all() and many[-1] == 1.0


def test_terms_of_long_texts():
    text = ("Some words, and MORE words " * 60_000).encode()
    whole, parts = np.zeros(quality.WORDS + quality.GRAMS, np.float32), np.zeros(quality.WORDS + quality.GRAMS, np.float32)
    quality.terms(text, whole)
    quality.terms(b"some words and more words ", parts)
    assert np.array_equal(whole[:quality.WORDS], parts[:quality.WORDS] * 60_000) and parts[:quality.WORDS].sum() == 5
    quality.terms(b"x" * 3_000_000, whole)
    quality.terms(b"", whole)


def test_odd_rows_of_quality(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2, None) for i in range(12)] + [(3, 1, None), (5, None, None), (None, 1, None), (999, 0, None)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(odd, labels)
    found = quality.score_quality(odd, model)
    assert found.columns == [c for c in odd.columns if c != "score"] + ["score"]
    assert found.count() == odd.count() and found.where("score between 0 and 1").count() == odd.count()
    assert quality.score_quality(nothing, model).collect() == []
    untaught = quality.fit_quality(odd, labels.where("false"))
    assert {r.score for r in quality.score_quality(odd, untaught).collect()} == {0.5}


# language

def phrases(text: bytes, sample: bytes) -> int:
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample and text[at:at + size] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_equal_brute_force(monkeypatch):
    samples = {"a": b"the cat sat on the mat", "b": b"der hund lief um den see", "c": b"aaaa abab"}
    parser = language.Parser(samples)
    texts = [b"the hund sat um den mat zz the", b"abababababzz", b"q", b"", b"aaaaaaaaaaaaaaaaa", b"the cat sat on the mat" * 3]
    want = [[phrases(t, samples[n]) for n in parser.languages] for t in texts]
    assert parser.phrases(texts).tolist() == want
    monkeypatch.setattr(language, "LANES", 2)
    assert parser.phrases(texts).tolist() == want
    monkeypatch.setattr(language, "PIECE", 5)
    cut = [[sum(phrases(t[i:i + 5], samples[n]) for i in range(0, len(t), 5)) for n in parser.languages] for t in texts]
    assert parser.phrases(texts).tolist() == cut


def test_held_out_languages(spark):
    rows = language.op9_language(spark, FOLDER).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.98


def test_every_language_is_learned(spark):
    rows = spark.range(1200).select(F.format_string("l%05d", "id").alias("lang"), F.concat(F.lit("words of "), F.col("id")).alias("text"))
    found = language.fit_languages(rows, total=1 << 10)
    assert set(found) == {f"l{i:05}" for i in range(1200)} and all(found.values())


def test_rates_tell_strange_texts(spark):
    samples = {"xx": prose(1, 2000).encode()}
    texts = ["q", prose(2, 3), prose(2, 500), "Привет как дела", "Привет как дела " * 500, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rate = {r.doc_id: r.rate for r in language.identify(df, samples, rate_into="rate").collect()}
    assert rate[0] == rate[5] == rate[6] == 0 and max(rate[1], rate[2]) < 0.3 and min(rate[3], rate[4]) > 0.8


def test_odd_rows_of_languages(odd, nothing, spark):
    samples = {"xx": b"loren midal rasil", "yy": b"quick brown fox"}
    found = language.identify(odd, samples)
    assert sorted(found.columns) == sorted({*odd.columns, "lang_pred", "score"}) and found.count() == odd.count()
    blank = {r.doc_id for r in found.where("lang_pred = 'und' and score = 0").collect()}
    assert blank == {40, 41, 42}
    assert found.where("score between 0 and 1").count() == odd.count()
    assert language.identify(nothing, samples).collect() == []
    assert language.fit_languages(nothing) == {} and set(language.fit_languages(odd)) == {"xx"}
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    one = language.identify(odd.where("doc_id = 1"), {"xx": b"loren"}).first()
    assert (one.lang_pred, one.score) == ("xx", 1.0)


# packing

def test_ids_equal_the_library():
    import random

    from tallyloom.llm.tokens import Encoder, ranks

    encoder = Encoder(packing.vocabulary())
    assert encoder.ranked is not None
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "a", "é", "日本", "'s", "'LL", "12", "٣", "!", "<|endoftext|>", "\U0001F600", "\u0301", "\x1c", "\ufeff", "Z"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)]
    texts += ["a" * 50_000, " " * 50_000, "\n" * 30_000, "word " * 20_000 + " " * 5_000 + "end", "x <|endoftext|>y", prose(1, 30_000)]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    assert np.frombuffer(encoder.encode(["a<|endoftext|>"])[0], "<u4")[-1] == 50256
    assert ranks({"model": {"type": "WordPiece"}}) is None


def check_packing(rows, texts, window):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for i, text in texts:
        want[(i, np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes())] += 1
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.id, []).append(r)
    for i, own in by_doc.items():
        whole = [ids for (j, ids), n in want.items() for _ in range(n) if j == i]
        assert sum(r.length for r in own) == sum(len(x) // 4 for x in whole)
        for r in own:
            assert any(len(x) // 4 == r.doc_tokens and x[4 * r.start:4 * (r.start + r.length)] == bytes(r.ids) for x in whole)
    assert set(by_doc) == {i for i, _ in want}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window


@pytest.mark.parametrize("window", [2048, 64])
def test_every_id_is_packed_once(odd, window):
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check_packing(packing.pack(odd, window=window).collect(), texts, window)


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).collect() == []


def test_solver_fits_the_histogram():
    patterns = packing.combinations(np.array([1, 3, 5, 7]), 8)
    assert {tuple(sorted(p)) for p in patterns.tolist()} >= {(0, 1, 7), (0, 3, 5)}
    histogram = np.zeros(8)
    histogram[[1, 7, 3, 5]] = [100, 100, 40, 40]
    x = packing.repeats(patterns, histogram)
    used = np.bincount(patterns.ravel(), np.repeat(x, 3), 8)
    assert np.allclose(used[[1, 7, 3, 5]], [100, 100, 40, 40], atol=0.5)
    plan = packing.layout(histogram.astype(int), 8)
    assert plan["first"] >= 138 and plan["taken"][[1, 7, 3, 5]].sum() >= 276


# licenses

def test_rules_and_suppression(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0. MIT License MIT license.",
        2: "SPDX-License-Identifier: GPL-3.0-or-later", 3: "emit license", 4: "ÉMIT LICENSE mit  LICENSE", 5: "cc by cc by", 6: None, 7: "", 8: "éMIT License",
        9: "This is the GNU Lesser General Public License version 2.1 and nothing else", 10: "all rights reserved " * 3000,
    }
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts.items()] * 2, "doc_id long, text string, key int, words int")
    found = {r.id: r for r in licenses.scan(df).collect()}
    assert licenses.scan(df).count() == 2 * len(texts)
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].last_word) == (12, 3, 3, 10)
    assert found[1].base_labels == "apache,mit" and found[1].labels == "apache,apache-2.0,mit"
    assert found[2].labels == "gpl-3.0" and found[2].score == 1.0 and found[2].n_base == 0
    assert (found[3].labels, found[3].first_word, found[3].score) == ("", None, 0.0)
    assert (found[4].n_base, found[4].first_word) == (1, 2)
    assert (found[5].n_base, found[5].first_word, found[5].last_word, found[5].base_labels) == (2, 0, 2, "cc-by")
    assert (found[6].n_words, found[6].labels, found[7].n_words) == (0, "", 0)
    assert found[8].n_base == 0
    assert found[9].labels == "lgpl-2.1" and found[10].labels == "proprietary"
    assert licenses.scan(df.where("false")).collect() == []


@pytest.mark.parametrize("one, two", [
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "creative commons attribution non commercial share alike 4 0"),
    ("CC BY-NonCommercial-NoDerivs", "cc by non commercial no derivs"), ("GNU GPL v3", "gnu gpl v 3"), ("GNU LGPL v2.1", "gnu lgpl v 2.1"),
    ("the General Public License version2", "general public license version 2"), ("beerware license", "beer ware license"),
    ("Apache License v2.0", "apache license v 2.0"), ("Mozilla Public License v1.1", "mozilla public license v 1.1"),
])
def test_words_written_as_one(spark, one, two):
    want = {"creative": "cc-by-nc-sa", "cc": "cc-by-nc-nd", "gnu gpl": "gpl-3.0", "gnu lgpl": "lgpl-2.1", "general": "gpl-2.0", "beer": "beerware",
            "apache": "apache-2.0", "mozilla": "mpl-1.1"}
    rows = licenses.scan(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")).collect()
    base = {"cc by", "apache license"}
    (label,) = [v for k, v in want.items() if two.startswith(k)]
    for r in rows:
        assert set(r.labels.split(",")) - set(r.base_labels.split(",")) == {label}, r
        assert bool(r.base_labels) == any(b in two for b in base)


def test_every_rule_has_its_words():
    found = licenses.rules()
    assert len(found) > 300 and all(own for _, _, _, _, own, _, _ in found)
    texts = {label: name.split("|")[0] for label, _, name, _ in licenses.NAMES if "(" not in name and "?" not in name}
    for _, _, label, pattern, own, also, _ in found:
        if label in texts and (match := re.search(pattern, f"  licensed  under  {texts[label].replace(' ', '  ')}  ".join("  "))):
            held = match[0].split()
            assert set(own.split("|")) & set(held) and (not also or also in held)


# pages

def test_main_text(spark):
    menu = "<div class='x'><p>Welcome to our site</p><p>All offers of the week</p></div>"
    html = {
        1: "<html><head><title>t</title><style>p{}</style><script>var a='</p><article>no</article>'</script></head><body><nav>menu</nav>"
           "<div class=ad>buy</div><article><header><h1>Title &amp; more</h1></header><p>One<b>two</b>\n three<br>four<p>five &lt;tag&gt; &#233;"
           "<form>f</form><div class='comments'><p>reader</p></div></article><footer>&copy; x</footer></body></html>",
        2: None, 3: "", 4: "no markup at all &nbsp; here", 5: "<p>unclosed <!-- hidden",
        6: "<main><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main><aside>side</aside>",
        7: "<div>" * 3000 + "deep" + "</div>" * 3000,
    }
    rows = [(i, "http://a.example/x", h, 0, 0) for i, h in html.items()] + [(100 + i, f"https://B.example:80/{i}", f"<body>{menu}<p>Story {i}</p></body>", 0, 0) for i in range(8)]
    rows.append((200, None, f"<body>{menu}<p>Story</p></body>", 0, 0))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int, template int")
    found = {r.id: r.text for r in pages.extract(df).collect()}
    assert found[1] == "Title & more\n\nOnetwo three four\n\nfive <tag> é"
    assert (found[2], found[3], found[4], found[5]) == ("", "", "no markup at all here", "unclosed")
    assert found[6] == "a\n\nb\n\nc\n\nd" and found[7] == "deep"
    assert all(found[100 + i] == f"Story {i}" for i in range(8))  # the site's template is gone
    assert found[200].startswith("Welcome")  # seen once on its site
    assert pages.extract(df.where("false")).collect() == []


def test_copies_make_no_template(spark):
    story = "<p>First of the story</p><p>Second of it</p>"
    rows = [(i, "http://a.example/", f"<body><div class='x'>{story}</div></body>") for i in range(5)]  # copies
    rows += [(10 + i, "http://b.example/", f"<body><nav>{i}</nav><main>{story}</main></body>") for i in range(5)]  # mirrors
    rows += [(20 + i, "http://c.example/", f"<body><p>Same</p><p>{'Same' if i < 4 else i}</p></body>") for i in range(9)]
    found = {r.id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == found[10 + i] == "First of the story\n\nSecond of it" for i in range(5))
    assert found[20] == "Same\n\nSame" and found[28] == "8"  # a page of template alone keeps it


@pytest.mark.parametrize("html, want", [
    ("<body class='has-sidebar'><p>Text</p><div class='sidebar'>side</div></body>", "Text"),
    ("<body class='menu'><main class='sidebar'><p>Text</p></main><div class='ad box'>buy</div></body>", "Text"),
    ("<div class='content no-comments'><p>Text</p></div>", "Text"),
    ("<div id='menu-page'><p>Text</p></div>", "Text"),
    ("<div class='article related'><p>A longer text</p></div><div class=related>more</div>", "A longer text"),
    ("<div class='related'><article><p>Text</p></article></div>", "Text"),
    ("<article><p class='social'>A</p><p class=notice>B</p><p class='share-price'>C</p><p class=promotion>D</p><div class=comments>x</div></article>",
     "A\n\nB\n\nC\n\nD"),
])
def test_names_of_wrappers(html, want):
    assert pages.main_text(html, frozenset()) == want


def site(story, side):
    return [(100 * k + i, f"http://site{k}.example/{i}", page(i)) for k, page in enumerate([
        lambda i: f"<body><article><h1>Story {i}</h1>{story(i)}{side(i)}<p>End of {i}</p></article></body>",
        lambda i: f"<body><h1>Story {i}</h1>{story(i)}{side(i)}<p>End of {i}</p></body>"]) for i in range(8)]


@pytest.mark.parametrize("side, inside", [
    (lambda i: "<div class='x1'><p>Our letter brings the best of the week</p></div>", True),  # the same words everywhere
    (lambda i: f"<div class='x1' id='unit-{i}'><ul>{f'<li>Offer {i}' * (1 + i % 3)}</ul></div>", False),  # one shape, other words
])
def test_templates_decide(spark, side, inside):
    rows = site(lambda i: f"<p>{f'Words of {i} that only this page has. ' * 9}</p><p>More {i}</p>", side)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.id: r.text for r in pages.extract(df).collect()}
    for number, _, html in rows:
        i, bare = number % 100, pages.main_text(html, frozenset())
        want = [f"Story {i}", ("Words of %d that only this page has. " % i * 9).strip(), f"More {i}", f"End of {i}"]
        assert (bare != found[number]) == (inside or number >= 100)
        if inside or number >= 100:
            assert found[number].split("\n\n") == want


def test_revisions_keep_their_paragraphs(spark):
    """Paragraphs that fewer than half of a site's pages share stay in an article."""
    rows = [(i, "http://a.example/", f"<article><h1>T{i}</h1><p>{'Shared by revisions' if i < 9 else i}</p></article>") for i in range(20)]
    found = {r.id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"T{i}\n\n{'Shared by revisions' if i < 9 else i}" for i in range(20)}


@pytest.mark.parametrize("html, want", [
    ("<article><p>Text</p></article><article class='comment'><p>A reader's long opinion of it all</p></article>", "Text"),
    ("<div><p>Text</p><article class='Comments__list'>reader</article></div>", "Text"),
    ("<article><p>Text</p><article class=comment>reader</article></article>", "Text"),
    ("<article class='widget'><p>Text</p></article>", "Text"),
    ("<p>A text of some words</p><div class='user-comments'>r</div><div class='comment-section'>r</div><div class='ad-unit'>r</div>",
     "A text of some words"),
    ("<article><p class=widget>A</p><div class=related><p>B</p></div><div class=share><a href=x>C</a></div><p class=comment>D</p></article>",
     "A\n\nB\n\nD"),
])
def test_comments_and_names(html, want):
    assert pages.main_text(html, frozenset()) == want


def test_very_long_page(spark):
    html = "<article>" + "".join(f"<p>Paragraph {i}</p>" for i in range(60000)) + "</article>"
    df = spark.createDataFrame([(1, "http://a.example", html)], "page_id long, url string, html string")
    assert pages.extract(df).first().text == "\n\n".join(f"Paragraph {i}" for i in range(60000))


def test_given_pages(spark):
    import html as entities
    import re

    want = {}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>|<br>", article))
        want[r.page_id] = "\n\n".join(p for p in parts if p)
    assert {r.page_id: r.text for r in pages.op7_pages(spark, FOLDER).collect()} == want


# pieces

def test_pieces_equal_the_library(odd, nothing):
    from sentencepiece import SentencePieceProcessor

    model = pieces.model_file()
    library = SentencePieceProcessor(model_proto=model)
    coded = pieces.with_text(pieces.with_ids(odd, model), model)
    assert sorted(coded.columns) == sorted({*odd.columns, "ids", "decoded"})
    for r in coded.select("text", "ids", "decoded").collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "")
    assert pieces.with_text(pieces.with_ids(nothing, model), model).collect() == []


def test_prefixes_share_no_wrong_state():
    model = pieces.Pieces(pieces.model_file())
    library = model.processor
    texts = ["the thesis theses these then", "  a  b ", "a\n\tb", "ｆｕｌｌ \U0001F600\U0001F600 <0x0A> </s>", "x" * 300, " " * 40 + "x" + " " * 17, "aa aaa aaaa aaaaa aaaaaa " * 3]
    for text in texts:
        assert model.encode([text])[0].tolist() == library.encode(text)
        assert model.decode(library.encode(text)) == text
    assert [x.tolist() for x in model.encode(texts)] == library.encode(texts)


def test_unigram_scores():
    """With log probabilities the best sum wins, as in trying all ways to cut a word."""
    model = pieces.Pieces(pieces.model_file())
    model.unigram = True
    model.scores = {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -1.2, "aba": -4.0, "bab": -2.9, "▁": -0.5, "▁a": -1.1}
    model.ids = {p: i for i, p in enumerate(model.scores)}
    model.tails = {"aba": [3, 2, 1], "bab": [3, 2, 1]}
    model.worst = -20.0

    def best(word):
        if not word:
            return 0.0, []
        return max((model.scores[word[:k]] + best(word[k:])[0], [word[:k]] + best(word[k:])[1]) for k in range(1, 4) if word[:k] in model.scores)

    words = sorted(["▁abab", "▁ababab", "▁b", "▁bab", "▁babba"])
    model.learn(words)
    for word in words:
        ids = np.frombuffer(model.known[word], np.int32).tolist()
        assert sum(list(model.scores.values())[i] for i in ids) == pytest.approx(best(word)[0])


def test_query_rows(spark):
    coded = pieces.op10_pieces(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    joined = coded.join(docs, "doc_id").where(F.sha2("text", 256) == F.col("text_sha256"))
    assert joined.count() == docs.count() == coded.count()
    assert not math.isnan(coded.agg(F.avg("n_ids")).first()[0])
