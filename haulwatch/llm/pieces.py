"""SentencePiece encoding and decoding of a BPE model with byte fallback, by a Viterbi pass over shared prefixes.

A text is marked as the model's library marks it: a space becomes the mark, and one mark is put before the text. No piece
has a mark after another character, so each word, with the mark before it, is encoded on its own; words are parted further
where two bytes meet that no piece has next to each other, such as letters and commas. The distinct marked words
of a block of texts are sorted, which lays them out as a trie in depth-first order; the forward table of a word keeps the
entries of the prefix that it shares with the word before. The model is a BPE model, whose segmentation is not the one of
the highest sum of scores; the forward entry of a prefix is therefore the last piece of the prefix's own encoding, and a
piece extends a path only if the merge order leaves it apart from the piece before. Exactly one path has this property, and
it is the encoding of the library. Characters without a piece are their UTF-8 bytes. Marks of a longer run of spaces
are joined after all else, from the left.

Empty and null texts have no pieces and are decoded as empty texts. Rows are independent: repeated rows and other columns
don't matter. A literal mark in a text is decoded as a space, as in the library.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import Memo, Texts, blocks, give_back, lists, span_hashes, spread

MARK = "▁"
MARK_BYTES = MARK.encode()
#: Marked words, and pairs of pieces, that a task remembers.
WORDS = 2_000_000
REMEMBERED = 200_000
#: Bytes of text that are encoded, and ids that are decoded, at once; a longer row is a block of its own.
ENCODED_BYTES = 1 << 20
DECODED_IDS = 250_000


class Model:
    """Pieces and merge order of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id, self.id_of, self.score = {}, {}, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id_of[piece], self.score[piece] = i, model.get_score(i)
        if len(self.byte_id) < 256 or any(MARK in p.lstrip(MARK) or (p[:2] == MARK * 2 and p.strip(MARK)) for p in self.id_of):
            raise ValueError("a model with byte fallback and pieces of single words is needed")
        self.piece = {p[k:]: -1 for p in self.id_of for k in range(len(p))} | self.id_of  # -1: only the end of a piece
        self.text_of = {i: p for p, i in self.id_of.items()}
        self.apart: dict[int, bool] = {}
        self.longest_run = max(len(p) for p in self.id_of if not p.strip(MARK))
        if any(self.marks(n) != [self.id_of[p] for p in self.merged([MARK] * n)] for n in range(1, 3 * self.longest_run)):
            raise ValueError("long runs of spaces are joined in an order that is not known here")
        self.bytes_of = [b""] * n  # what a piece decodes to
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        for p, i in self.id_of.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        # pairs of bytes that no piece has inside: whatever meets there is encoded apart
        self.parted = np.ones((256, 256), bool)
        for p in self.id_of:
            raw = np.frombuffer(p.encode(), np.uint8)
            self.parted[raw[:-1], raw[1:]] = False
        self.parted[:, 0x80:0xC0] = False
        self.parted[:, 0x20] = self.parted[0x20] = False

    def merged(self, parts: list[str]) -> list[str]:
        """Joins the pair of the highest score, leftmost first, as long as a piece comes of it."""
        while True:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def follows(self, left: int, right: int) -> bool:
        """Does the merge order leave the two pieces apart? left is -1 at the front of a word."""
        if len(self.apart) > REMEMBERED:
            self.apart.clear()
        parts = [self.text_of[i] for i in (left, right) if i >= 0]
        known = self.apart[left << 20 | right] = self.merged(list("".join(parts))) == parts
        return known

    def encoded(self, words: list[str]) -> list[list[int]]:
        """Pieces of words, which are sorted: a word starts from the forward table of what it shares with the last."""
        result, before, last, sizes = [], "", [-1], [0]
        piece_of, apart = self.piece.get, self.apart
        for word in words:
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], sizes[shared + 1 :]
            for i in range(shared, len(word)):
                k = i
                while k >= 0 and (piece := piece_of(word[k : i + 1])) is not None:
                    if piece >= 0:
                        if (fits := apart.get(last[k] << 20 | piece)) is None:
                            fits = self.follows(last[k], piece)
                        if fits:
                            last.append(piece)
                            sizes.append(i + 1 - k)
                            break
                    k -= 1
                else:  # a character without a piece: nothing is joined over it
                    last.append(-1)
                    sizes.append(0)
            ids, i = [], len(word)
            while i:
                if sizes[i]:
                    ids.append(last[i])
                    i -= sizes[i]
                else:
                    ids += [self.byte_id[b] for b in reversed(word[i - 1].encode())]
                    i -= 1
            ids.reverse()
            result.append(ids)
            before = word
        return result

    def marks(self, n: int) -> list[int]:
        """Pieces of a run of n marks."""
        whole, rest = divmod(n, self.longest_run)
        return [self.id_of[MARK * self.longest_run]] * whole + [self.id_of[p] for p in self.merged([MARK] * rest)]


class Encoder:
    """Encodes blocks of texts; keeps the words it has met from block to block."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.known = Memo(WORDS)

    def words(self, texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts with each literal mark as a space; of each word, spaces and all: row, spaces before it, start and end."""
        raw = texts.data.tobytes()
        if MARK_BYTES in raw:
            parts = [raw[a:b].replace(MARK_BYTES, b" ") for a, b in zip(texts.bounds, texts.bounds[1:], strict=False)]
            texts = Texts(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
        space = texts.data == 0x20
        first = np.zeros(len(space), bool)
        first[texts.bounds[:-1][np.diff(texts.bounds) > 0]] = True
        after_space = np.zeros(len(space), bool)
        after_space[1:] = space[:-1]
        parted = np.zeros(len(space), bool)
        parted[1:] = self.model.parted[texts.data[:-1], texts.data[1:]]
        begins = np.flatnonzero(first | (space & ~after_space) | parted)  # of a run of spaces, of a text, of what stands apart
        past = np.append(begins[1:], len(space))
        # spaces at the front of each
        n_before = np.concatenate(([0], np.cumsum(space)))
        letters = np.flatnonzero(~space)
        at = np.searchsorted(letters, begins)
        word = np.minimum(letters[np.minimum(at, len(letters) - 1)], past) if len(letters) else past
        word = np.where(at < len(letters), word, past)
        n_spaces = n_before[word] - n_before[begins] + first[begins]
        return texts, np.searchsorted(texts.bounds, begins, "right") - 1, n_spaces, word, past

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all rows one after another, and how many each row has."""
        if not len(texts.data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        texts, row, n_spaces, start, end = self.words(texts)
        filled = end > start
        hashes = np.zeros(len(start), np.uint64)
        hashes[filled] = span_hashes(texts.data, start[filled], end[filled])
        hashes += n_spaces.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)

        def encoded(missing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = first[missing]
            marked = [MARK + texts.text(a, b) if n else texts.text(a, b) for a, b, n in zip(start[at].tolist(), end[at].tolist(), n_spaces[at].tolist(), strict=True)]
            order = sorted(range(len(marked)), key=marked.__getitem__)
            found: list[list[int]] = [[]] * len(marked)
            for i, ids in zip(order, self.model.encoded([marked[i] for i in order]), strict=True):
                if (n := int(n_spaces[at[i]])) > 1:
                    ids = self.model.marks(n) + ids[1:] if ids[0] == self.model.id_of[MARK] else self.model.marks(n - 1) + ids
                found[i] = ids
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return sizes, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))

        at, sizes, stored = self.known(distinct, encoded)
        n = sizes[back]
        return stored[spread(at[back], n)], np.bincount(row, n, len(texts)).astype(np.int64)


def encode(text: Column, path: str) -> Column:
    """Piece ids (array of int) of a text column, as the library encodes it, without begin or end."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encoded_blocks(batches, path)

    return encoded(text)


def encoded_blocks(batches: Iterable[pa.Array], path: str) -> Iterator[pa.Array]:
    """Piece ids of the texts of all batches, in order. Each block goes to the JVM when it is done: no batch is put together."""
    encoder = Encoder(path)
    for batch in batches:
        for texts in blocks(batch, ENCODED_BYTES):
            yield lists(*encoder(texts))
    del encoder
    give_back()


def decode(ids: Column, path: str) -> Column:
    """Text of an array of piece ids; bytes that are no UTF-8 become U+FFFD each, null becomes an empty text."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from decoded_blocks(batches, path)

    return decoded(ids)


def decoded_blocks(batches: Iterable[pa.Array], path: str) -> Iterator[pa.Array]:
    """Texts of the lists of ids of all batches, in order, a block of rows at a time."""
    pieces = Model(path).bytes_of
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    stored = np.frombuffer(b"".join(pieces), np.uint8)
    at = np.concatenate(([0], np.cumsum(length)))[:-1]
    for batch in batches:
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = batch.flatten().fill_null(0).to_numpy(zero_copy_only=False)
        lo, row = 0, 0
        past = np.cumsum(sizes)
        while row < len(sizes):  # some rows at a time: a byte of output takes many of working space
            hi = max(row + 1, int(np.searchsorted(past, lo + DECODED_IDS, "right")))
            ids = flat[lo : past[hi - 1]]
            n = length[ids]
            n_past = np.cumsum(n)
            data = stored[np.repeat(at[ids] - n_past + n, n) + np.arange(int(n.sum()))].tobytes()
            ends = np.concatenate(([0], n_past))[past[row:hi] - lo]
            texts, begin = [], 0
            for end in ends.tolist():
                whole = data[begin:end]
                texts.append((whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace"))
                begin = end
            lo, row = int(past[hi - 1]), hi
            yield pa.array(texts, pa.string())
    give_back()


def encode_documents(docs: DataFrame, path: str, text: str = "text", into: str = "pieces") -> DataFrame:
    """The rows with a column into (array<int>) of piece ids. A column of that name is replaced."""
    return docs.withColumn(into, encode(docs[text], path))


def decode_documents(docs: DataFrame, path: str, pieces: str = "pieces", into: str = "text") -> DataFrame:
    """The rows with the text of their pieces in the column into, which is replaced if there is one."""
    return docs.withColumn(into, decode(docs[pieces], path))
