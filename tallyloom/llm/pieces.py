"""SentencePiece encoding and decoding with forward scores shared along common prefixes."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import held, ship, table

HELD = 1 << 18  # words, and pairs of pieces, that a worker remembers
STEP = 1024  # texts whose words are sorted together
MARK = "▁"  # stands for a blank
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a model file (fixed values)
UNIGRAM = 1  # kind of model whose scores are log probabilities (fixed value)


class Pieces:
    """Encodes marked words by a model's pieces.

    Distinct words are sorted, which walks their trie depth first; a word keeps the forward states of
    the prefix that it has in common with the word before. The state after a prefix is its best last
    piece. In a unigram model that is the piece with the largest sum of scores. In a model of merges it
    is the one piece that merging would end the prefix with: a sequence of pieces is what merging
    makes of a text exactly if that holds for every two neighbours in it, so states need no more
    than the piece before. A character without a piece becomes its bytes' pieces, or the unknown one.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.processor = SentencePieceProcessor(model_proto=model)
        self.unigram = proto.trainer_spec.model_type == UNIGRAM
        self.prefixed = proto.normalizer_spec.add_dummy_prefix
        self.ids, self.scores, self.bytes, self.raw, self.unknown = {}, {}, {}, [], 0
        for i, p in enumerate(proto.pieces):
            text = p.piece.replace(MARK, " ").encode()
            if p.type in (NORMAL, USER, UNUSED):
                self.ids[p.piece], self.scores[p.piece] = i, p.score
            elif p.type == BYTE:
                text = bytes([int(p.piece[3:-1], 16)])
                self.bytes[text[0]] = i
            elif p.type == UNKNOWN:
                self.unknown, text = i, " ⁇ ".encode()
            else:
                text = b""
            self.raw.append(text)
        tails: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 3:
                tails.setdefault(piece[-4:], {3, 2}).add(len(piece))
        self.tails = {tail: sorted(sizes, reverse=True) for tail, sizes in tails.items()}
        self.worst = min(self.scores.values(), default=0.0) - 10.0
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the neighbours with the best joint score first, the left ones of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: str, piece: str) -> bool:
        """Whether merging leaves `piece` whole behind the piece before it, or at the start of a word."""
        key = (before, piece)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > HELD:
                self.fits.clear()
            if before and before not in self.ids:  # a character without a piece joins nothing
                before = ""
            found = self.fits[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return found

    def extend(self, word: str, last: list[str], best: list[float]) -> None:
        """States for the prefixes of `word` past those there are.

        Without a longer piece that fits, the last piece is the last character.
        """
        ids, scores, tails, fits = self.ids, self.scores, self.tails, self.fits
        if self.unigram:
            for end in range(len(last), len(word) + 1):
                chosen = word[end - 1]
                top = best[end - 1] + scores.get(chosen, self.worst)
                for size in tails.get(word[max(0, end - 4):end], (3, 2)):
                    score = scores.get(word[end - size:end]) if size <= end else None
                    if score is not None and best[end - size] + score > top:
                        chosen, top = word[end - size:end], best[end - size] + score
                last.append(chosen)
                best.append(top)
            return
        for end in range(len(last), len(word) + 1):
            chosen = word[end - 1]
            # Sizes of the pieces with these last four characters, longest first.
            for size in tails.get(word[end - 4:end] if end > 3 else word[:end], (3, 2)):
                if size <= end and (piece := word[end - size:end]) in ids:
                    fit = fits.get((last[end - size], piece))
                    if fit or fit is None and self.follows(last[end - size], piece):
                        chosen = piece
                        break
            last.append(chosen)

    def learn(self, words: list[str]) -> None:
        """Remember the ids of sorted distinct words."""
        before, last, best = "", [""], [0.0]
        for word in words:
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1:], best[same + 1:]
            self.extend(word, last, best)
            found, end = [], len(word)
            while end:
                piece = last[end]
                end -= len(piece)
                if piece in self.ids:
                    found.append(self.ids[piece])
                elif self.bytes:
                    found.extend(self.bytes[b] for b in reversed(piece.encode("utf-8", "replace")))
                elif not found or found[-1] != self.unknown:
                    found.append(self.unknown)
            self.known[word] = array("i", found[::-1]).tobytes()
            before = word

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [WORD.findall(self.processor.normalize(t)) for t in texts]
        if len(self.known) > HELD:
            self.known.clear()
        self.learn(sorted({w for words in split for w in words if w not in self.known}))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32) for words in split]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text.startswith(" ") else text


def pieces(model: bytes) -> Pieces:
    return held(("pieces", model), lambda: Pieces(model))


def model_file(path: str | None = None) -> bytes:
    import public_tokenizers

    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def with_ids(docs: DataFrame, model: bytes, text_col: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with the ids of every whole text; a null or empty text has none. Rows and other columns stay."""
    ship(docs.sparkSession.sparkContext)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                found = pieces(shared.value).encode([t or "" for t in part[text_col].to_pylist()])
                sizes = np.cumsum([0, *map(len, found)])
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
                kept = part.drop_columns([into]) if into in part.schema.names else part
                yield kept.append_column(into, ids)

    kept = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.ArrayType(T.IntegerType()))]))


def with_text(docs: DataFrame, model: bytes, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """`docs` with the text that the ids stand for; null ids give an empty text.

    Decoding gives back the encoded text where the model's normal form is the text itself and the
    text holds no mark.
    """
    ship(docs.sparkSession.sparkContext)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                ids = part[ids_col].fill_null([])
                ends, flat = np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False)), ids.flatten().to_numpy(zero_copy_only=False)
                found = [pieces(shared.value).decode(flat[a:z].tolist()) for a, z in zip(np.append(0, ends[:-1]), ends)]
                kept = part.drop_columns([into]) if into in part.schema.names else part
                yield kept.append_column(into, pa.array(found, pa.string()))

    kept = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.StringType())]))


def op10_pieces(spark, folder: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the text decoded from them."""
    model = model_file()
    coded = with_text(with_ids(table(spark, folder, "documents").select("doc_id", "text"), model).drop("text"), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("text_sha256"))
