"""Token counts of a unigram vocabulary without building the tokens.

An Aho-Corasick automaton lists every piece of the vocabulary that ends at each character; dynamic
programming carries the best score and its number of pieces to that place. The rules are those of the
``tokenizers`` library's unigram model behind its metaspace pre-tokenizer:

* spaces become ``▁``, one is put before a text that does not begin with it, and the text is cut before each;
* of two ways to one place the better score wins, and the earlier start (the longer last piece) on a tie;
* a character that is no piece by itself may stand for the unknown piece, whose score is the least score
  of the vocabulary less ten; with byte fallback it counts its UTF-8 bytes, else a run of unknown
  characters counts one.

The vocabulary is the list of pieces of a public file; that file's own scores are merge ranks, which say
nothing of likelihood, so each piece's score is the logarithm of its share of all pieces of the corpus, as
the file's tokenizer cuts it (every piece counted once more, so that none has a share of nothing). The counts
are sums over all documents, made in each task and added up. What is counted then is the likeliest cut
under these scores; it is not the cut of the file's own tokenizer.

Words are counted once and remembered; no text is shuffled.

Defined cases: a null or empty text has no pieces; very long words take time in proportion to their
length; repeated rows get equal counts; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words remembered by one worker (about 150 bytes each); at the bound the memory starts anew.
REMEMBERED = 300_000
#: Words given to the tokenizer in one call.
ENCODED = 1 << 14
LONGEST = 48
SPACE = "▁"
COUNTED = "doc_id long, n_pieces long"


class Counter(dict):
    """Pieces of each word; a new word is counted when it is asked for."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        super().__init__()
        self.find = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.find.add_word(piece, (len(piece), float(score)))
        self.find.make_automaton()
        self.unknown = min(score for _, score in pieces) - 10.0
        names = {piece for piece, _ in pieces}
        self.fallback = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))

    def count(self, word: str) -> int:
        """Pieces on the best path through ``word``."""
        best, number, unknown = [0.0], [0], [False]
        ends: list[list] = [[] for _ in word]
        for last, found in self.find.iter(word):
            ends[last].append(found)
        for at, candidates in enumerate(ends, 1):
            score = pieces = None
            single = False
            # The automaton lists the longest piece first, so only a better score replaces it.
            for length, own in candidates:
                through = own + best[at - length]
                if score is None or through > score:
                    score, pieces = through, number[at - length] + 1
                single |= length == 1
            blank = False
            if not single:
                through = self.unknown + best[at - 1]
                if score is None or through > score:
                    score, blank = through, True
                    if self.fallback:
                        pieces = number[at - 1] + len(word[at - 1].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = number[at - 1] + (not unknown[at - 1])
            best.append(score)
            number.append(pieces)
            unknown.append(blank)
        return number[-1]

    def __missing__(self, word: str) -> int:
        n = self.count(SPACE + word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def total(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        words = text.split(SPACE)
        return sum(map(self.__getitem__, words[1:] if text.startswith(SPACE) else words))


def model_pieces(model: str) -> list[str]:
    """The pieces of a sentencepiece file in the order of ids."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model)
    return [own.id_to_piece(i) for i in range(own.get_piece_size())]


def _piece_counts(model: str):
    """How often each piece occurs in the texts of a task; a batch's distinct words are cut once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=model)
        total = np.zeros(own.get_piece_size(), dtype=np.int64)
        for batch in batches:
            words = pc.value_counts(pc.split_pattern(batch.column("text").fill_null(""), " ").flatten())
            counts = words.field("counts").to_numpy()
            for at in range(0, len(words), ENCODED):
                ids = own.encode(words.field("values").slice(at, ENCODED).to_pylist(), num_threads=1)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.int64, int(sizes.sum()))
                total += np.bincount(flat, weights=np.repeat(counts[at : at + ENCODED], sizes), minlength=len(total)).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    return run


def unigram_pieces(docs: DataFrame, model: str) -> list[tuple[str, float]]:
    """(piece, score) of the pieces of a file, scored by the whole of ``docs``; as many rows as the file has."""
    pieces = model_pieces(model)
    counts = np.ones(len(pieces), dtype=np.float64)
    found = docs.select("text").mapInArrow(_piece_counts(model), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in found.collect():
        counts[row["id"]] += row["n"]
    return list(zip(pieces, np.log(counts / counts.sum()).tolist()))


def _counted(pieces, byte_fallback: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces.value, byte_fallback)
        for batch in batches:
            n = [counter.total(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_pieces"])

    return run


def token_counts(
    docs: DataFrame, model: str | None = None, byte_fallback: bool = True, pieces: list[tuple[str, float]] | None = None
) -> DataFrame:
    """(doc_id, n_pieces): pieces of each whole text.

    ``model`` is a sentencepiece file on every executor, whose pieces ``docs`` itself scores; or give
    ``pieces`` with their scores, a unigram vocabulary of your own.
    """
    if pieces is None:
        if model is None:
            import public_tokenizers

            model = public_tokenizers.path("piece_bpe_32k.model")
        pieces = unigram_pieces(docs, model)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_counted(docs.sparkSession.sparkContext.broadcast(pieces), byte_fallback), COUNTED)
