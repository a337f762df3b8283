"""Language identification by cross-parsing against labelled text of each language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import held, light, ship, stored, table
from tallyloom.llm.quality import fold

TEXTS = 64  # labelled texts taken per language, the bound of what is learned from
CHARS = 1000  # characters taken of each
BYTES = 192 << 10  # bytes of labelled text over all languages, shared evenly
LEAST = 256  # bytes of a language's share at least, however many languages there are
EASE = 8
LANES = 4096  # pieces parsed in step
PIECE = 1024  # bytes of a piece
UNKNOWN = "und"


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: state 0 reads exactly the substrings of `text`."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Parser:
    """Counts, for many texts at once, the phrases each language's labelled text parses them into.

    A phrase is the longest match with a substring of the language's text, from where the phrase
    before it ended; a byte the language never has is a phrase of its own. All languages' automata
    lie in one table of moves; a move that ends a phrase holds the complement of the state in which
    the next phrase begins.
    """

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        seen = sorted(set(b"".join(samples.values())))
        self.code = np.zeros(256, np.int32)
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        base, tables = 0, []
        self.roots = np.zeros(len(self.languages), np.int32)
        for k, language in enumerate(self.languages):
            graph = automaton(samples[language])
            strange = base + len(graph)  # the state after a byte that the language never has
            first = np.full(self.width, strange, np.int32)
            for c, to in graph[0].items():
                first[self.code[c]] = base + to
            moves = np.repeat(~first[None], len(graph) + 1, 0)
            moves[0] = first
            for state, out in enumerate(graph):
                for c, to in out.items():
                    moves[state, self.code[c]] = base + to
            tables.append(moves.ravel())
            self.roots[k] = base
            base = strange + 1
        self.moves = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases per text and language. Long texts are parsed in pieces, each ending with a phrase."""
        found = np.zeros((len(texts), len(self.languages)), np.int64)
        pieces = [(i, at) for i, t in enumerate(texts) for at in range(0, len(t), PIECE)]
        for low in range(0, len(pieces), LANES):
            some = pieces[low:low + LANES]
            parts = [texts[i][at:at + PIECE] for i, at in some]
            size = np.array([len(p) for p in parts])
            order = np.argsort(-size, kind="stable")
            longest = int(size[order[0]])
            grid = np.zeros((longest, len(parts)), np.int32)
            for lane, k in enumerate(order.tolist()):
                grid[:size[k], lane] = self.code[np.frombuffer(parts[k], np.uint8)]
            alive = np.searchsorted(-size[order], -np.arange(1, longest + 1), "right")
            state = np.repeat(self.roots[:, None], len(parts), 1)
            ended = np.zeros((len(self.languages), len(parts)), np.int32)
            for step in range(longest):
                n = alive[step]
                to = self.moves.take(state[:, :n] * self.width + grid[step, :n])
                sign = to >> 31
                ended[:, :n] -= sign
                state[:, :n] = to ^ sign
            ended += state != self.roots[:, None]
            np.add.at(found, np.array([some[k][0] for k in order.tolist()]), ended.T)
        return found


def parser(samples: dict[str, bytes]) -> Parser:
    """The parser of these samples, built once in each worker."""
    return held(("language", *sorted(samples.items())), lambda: Parser(samples))


def normal(text: str) -> bytes:
    """Lower case, every run of characters that are no letters as one space; empty without a letter."""
    import regex

    if not regex.search(r"\p{L}", text):
        return b""
    return regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip().encode("utf-8", "replace")


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = TEXTS,
                  chars: int = CHARS, total: int = BYTES) -> dict[str, bytes]:
    """Labelled text per language: at most `texts` texts of `chars` characters and an even share of `total` bytes.

    Every language is learned; past total / LEAST of them each has LEAST bytes, so what workers hold is bounded by
    the languages that labels name. The texts are those with the smallest hash, counted once each, so that copies and
    the order of the input do not matter. Null or blank texts and null languages teach nothing.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.substring(text_col, 1, chars).alias("text"))
    rows = rows.where("lang is not null and trim(text) <> ''").withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    # Only hashes that can be among the smallest are ranked: some EASE times as many as are wanted.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    close = rows.join(light(stored(sizes, "sizes")), "lang").where(F.col("h") <= F.lit(EASE * texts * 2.0**63) / F.col("n"))
    ranked = close.select("lang", "h").distinct().withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    least = ranked.where(F.col("r") <= texts).drop("r")
    chosen = rows.join(light(stored(least, "least")), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    chosen = chosen.orderBy("lang", "h")
    found: dict[str, list[bytes]] = {}
    for lang, text in chosen.select("lang", "text").toLocalIterator():
        found.setdefault(lang, []).append(normal(text))
    share = max(LEAST, total // max(1, len(found)))
    return {lang: b" \n ".join(parts)[:share] for lang, parts in found.items() if b"".join(parts)}


def identify(docs: DataFrame, samples: dict[str, bytes], text_col: str = "text", lang_into: str = "lang_pred",
             score_into: str = "score", rate_into: str | None = None) -> DataFrame:
    """`docs` with the language whose text parses each whole text into the fewest phrases per byte.

    The score is s / (b + s) for the fewest b and second fewest s phrases, so 0.5 for a draw and
    towards 1 the clearer the choice; with one learned language it is 1. Draws go to the first name
    in order. A text that is null or without letters, or any text when nothing was learned, is `und` with score 0. With
    `rate_into` there is also b, less the phrase that the text's end cuts off, per byte: low where the text is in the
    language, whatever its length, and 0 for `und`. Rows and all other columns stay as they are.
    """
    ship(docs.sparkSession.sparkContext)
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    names_added = [lang_into, score_into, *([rate_into] if rate_into else [])]

    def run(batches):
        parse = parser(shared.value)
        names = parse.languages
        for batch in batches:
            texts = [normal(t.as_py() or "") for t in batch[text_col]]
            counted = parse.phrases(texts) if names else np.zeros((len(texts), 0))
            langs, scores, rates = [], [], []
            for text, row in zip(texts, counted):
                if not text or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rates.append(0.0)
                    continue
                best = int(np.argmin(row))
                second = np.delete(row, best).min() if len(row) > 1 else None
                langs.append(names[best])
                rates.append(float(row[best] - 1) / len(text))
                scores.append(float(second / (row[best] + second)) if second is not None else 1.0)
            kept = batch.drop_columns([c for c in names_added if c in batch.schema.names])
            for name, values, kind in zip(names_added, (langs, scores, rates), (pa.string(), pa.float64(), pa.float64())):
                kept = kept.append_column(name, pa.array(values, kind))
            yield kept

    kept = [f for f in docs.schema.fields if f.name not in names_added]
    added = [T.StructField(c, T.StringType() if c == lang_into else T.DoubleType()) for c in names_added]
    return docs.mapInArrow(run, T.StructType([*kept, *added]))


def op9_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    part = F.coalesce(fold("doc_id", 3), F.lit(0))
    samples = fit_languages(docs.where(part != 1))
    return identify(docs.select("doc_id", "text", (part == 1).alias("held_out")), samples).select(
        "doc_id", "held_out", "lang_pred", "score")
