"""Token counts of a byte-level BPE by compiled transducers.

Two deterministic transducers count the tokens of a text. The first one reads characters and marks where a pretoken begins.
It has eleven states, so a chunk of characters is a map from state to state; the maps of all chunks of a block of texts are
made side by side, composed by a parallel prefix scan, and each chunk is then read once more from its true state. A text is
thus cut into chunks wherever it is long. The second transducer reads the bytes of a pretoken; each transition carries the
number of tokens that the byte adds to (or takes from) the count. Its states are compiled from the merge list when first
reached: for the bytes so far, a state holds those that a longer vocabulary entry may still cover and how each of their
prefixes ends, which is all that later bytes depend on. Only spellings not met before in a task run through it.

Empty and null texts have no tokens. Texts are counted whole; rows are independent of each other, so repeated rows, other
columns and their names don't matter.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import Memo, Texts, blocks, joined, span_hashes, struct_array

CHUNK = 256
#: Spellings and transitions that a task remembers; what it forgets is made anew, which changes no count.
SPELLINGS = 2_000_000
REMEMBERED = 400_000

# Character classes. Letters that take part in 's 't 'm 'd 're 've 'll have classes of their own.
(LETTER, SINGLE, R, V, L, E, NUMBER, SPACE, WHITE, QUOTE, OTHER, RESET, PAD) = range(13)
LETTERS = (LETTER, SINGLE, R, V, L, E)
# States: what the characters up to here end with. TICK is a quote that opens a pretoken; TICK_R etc. the same and one letter.
(START, IN_LETTERS, IN_NUMBER, IN_OTHER, TICK, TICK_R, TICK_V, TICK_L, CLOSED, AFTER_SPACE, AFTER_WHITE) = range(11)
BEGINS, PREVIOUS_BEGINS = 1, 2


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks of [class, state] for the splitting pattern of byte-level BPE."""
    to, marks = np.zeros((13, 11), np.int8), np.zeros((13, 11), np.int8)
    entered = {NUMBER: IN_NUMBER, SPACE: AFTER_SPACE, WHITE: AFTER_WHITE, QUOTE: TICK, OTHER: IN_OTHER, RESET: START} | dict.fromkeys(LETTERS, IN_LETTERS)
    goes_on = {IN_LETTERS: LETTERS, IN_NUMBER: (NUMBER,), IN_OTHER: (OTHER, QUOTE), TICK: (OTHER, QUOTE), AFTER_SPACE: (SPACE, WHITE), AFTER_WHITE: (SPACE, WHITE)}
    for kind in range(12):
        for state in range(11):
            to[kind, state], marks[kind, state] = entered[kind], BEGINS
            if kind in goes_on.get(state, ()):
                marks[kind, state] = 0
                if state == TICK:
                    to[kind, state] = IN_OTHER
                elif kind not in (SPACE, WHITE):
                    to[kind, state] = state
            elif state in (TICK_R, TICK_V, TICK_L):  # no contraction after all: the quote stands alone
                marks[kind, state] = PREVIOUS_BEGINS | (0 if kind in LETTERS else BEGINS)
            elif kind != RESET and state == AFTER_SPACE:  # the last space belongs to what follows
                to[kind, state], marks[kind, state] = (IN_OTHER if kind == QUOTE else entered[kind]), PREVIOUS_BEGINS
            elif kind != RESET and state == AFTER_WHITE:
                marks[kind, state] = PREVIOUS_BEGINS | BEGINS
    for kind, state in ((SINGLE, CLOSED), (R, TICK_R), (V, TICK_V), (L, TICK_L)):
        to[kind, TICK], marks[kind, TICK] = state, 0
    for kind, state in ((E, TICK_R), (E, TICK_V), (L, TICK_L)):
        to[kind, state], marks[kind, state] = CLOSED, 0
    to[PAD] = np.arange(11)
    return to, marks


def states_before(kinds: np.ndarray, to: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """State before each character, from START: chunk maps, their prefix scan, and one reading of each chunk."""
    n = len(kinds)
    rows = -(-n // chunk)
    cut = np.full(rows * chunk, PAD, np.uint8)
    cut[:n] = kinds
    columns = np.ascontiguousarray(cut.reshape(rows, chunk).T)
    n_states = to.shape[1]
    flat = to.ravel().astype(np.intp)
    maps = np.tile(np.arange(n_states), (rows, 1))
    for column in columns:
        maps = flat[column.astype(np.intp)[:, None] * n_states + maps]
    step = 1
    while step < rows:  # maps[i] becomes the map of all chunks up to i
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    state = np.zeros(rows, np.intp)
    state[1:] = maps[:-1, START]
    before = np.empty((chunk, rows), np.int8)
    for k, column in enumerate(columns):
        before[k] = state
        state = flat[column.astype(np.intp) * n_states + state]
    return before.T.ravel()[:n]


def character_kinds(tokenizer) -> bytes:
    """Class of each code point as the tokenizer's own splitter sees it, compressed."""
    import regex

    everything = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(everything)
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in regex.findall(r"\s", text):
        kinds[ord(c)] = WHITE
    for pattern, before, kind in ((r"\p{L}", "a", LETTER), (r"\p{N}", "1", NUMBER)):
        # Unicode versions differ: a character is a letter if the splitter joins it to one
        for c in regex.findall(pattern, text):
            if len(tokenizer.pre_tokenizer.pre_tokenize_str(before + c)) == 1:
                kinds[ord(c)] = kind
    kinds[ord(" ")], kinds[ord("'")] = SPACE, QUOTE
    for letters, kind in (("stmd", SINGLE), ("r", R), ("v", V), ("l", L), ("e", E)):
        for c in letters:
            kinds[ord(c)] = kind
    return zlib.compress(kinds.tobytes())


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Counter:
    """The transducer from bytes to token counts, compiled as far as its input needs."""

    def __init__(self, merges: list[tuple[bytes, bytes]], vocabulary: list[bytes]):
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.tokens = set(vocabulary)
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.halves = {a + b: (a, b) for a, b in merges}
        if len(self.halves) < len(merges):
            raise ValueError("two merge rules make the same token")
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.held: list[tuple] = []
        self.steps: dict[int, int] = {}
        self.fits.clear()
        self.state_of(((b"", b"", 0),))

    def state_of(self, held: tuple) -> int:
        if (state := self.states.setdefault(held, len(self.held))) == len(self.held):
            self.held.append(held)
        return state

    def edge(self, token: bytes, half: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one end of a token while it is built, and the rank of the rule that ends each."""
        spine, ends = [], len(self.rank)
        while True:
            spine.append((token, ends))
            if token not in self.halves:
                return spine
            ends = self.rank[self.halves[token]]
            token = self.halves[token][half]

    def follows(self, left: bytes, right: bytes) -> bool:
        """Do the rules, lowest rank first and leftmost first, leave the two tokens apart?"""
        if (known := self.fits.get((left, right))) is None:
            rank, known = self.rank, True
            begins = self.edge(right, 0)
            for x, x_ends in self.edge(left, 1):
                for y, y_ends in begins:
                    if (r := rank.get((x, y))) is not None and r < x_ends and r <= y_ends:
                        known = False
            self.fits[left, right] = known
        return known

    def compile(self, state: int, byte: int) -> int:
        """The next state and the tokens added, as one number. A state holds, for each place where a later token may begin:
        the bytes from there on, the last token before it, and the count up to it minus that of the whole."""
        b = bytes([byte])
        held = [(tail + b, last, count) for tail, last, count in self.held[state]]
        for token, last, count in held:  # the token that ends here is the one that its predecessor leaves alone
            if token in self.tokens and (not last or self.follows(last, token)):
                added = count + 1
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        following = self.state_of((*((tail, last, count - added) for tail, last, count in held if tail in self.prefixes), (b"", token, 0)))
        step = self.steps[state << 8 | byte] = following << 9 | added + 256
        return step

    def count(self, pretoken: bytes) -> int:
        state, total, step_of = 0, 0, self.steps.get
        for byte in pretoken:
            step = step_of(state << 8 | byte) or self.compile(state, byte)
            state = step >> 9
            total += (step & 511) - 256
        if len(self.steps) > REMEMBERED:
            self.clear()
        return total


def load(path: str) -> tuple[bytes, list[str]]:
    """What tasks need of a tokenizer file: character classes, and the special strings that it cuts out first."""
    import tokenizers

    described = json.loads(tokenizers.Tokenizer.from_file(path).to_str())
    special = [t for t in described["added_tokens"]]
    if described["normalizer"] or (described["pre_tokenizer"] or {}).get("type") != "ByteLevel" or described["pre_tokenizer"]["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
        raise ValueError("only plain byte-level tokenizers are compiled")
    return character_kinds(tokenizers.Tokenizer.from_file(path)), [t["content"] for t in special]


def counter_of(path: str) -> Counter:
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte_of = byte_letters()
    raw = lambda piece: bytes(byte_of[c] for c in piece)
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return Counter([(raw(a), raw(b)) for a, b in merges], [raw(t) for t in model["vocab"] if all(c in byte_of for c in t)])


class TextCounter:
    """Counts tokens of blocks of texts; keeps what it has compiled from block to block."""

    def __init__(self, path: str, kinds: bytes, special: list[str]):
        self.kinds = np.frombuffer(zlib.decompress(kinds), np.uint8)
        self.special = sorted((s.encode() for s in special), key=len, reverse=True)
        self.counter = counter_of(path)
        self.to, self.marks = splitter()
        self.known = Memo(SPELLINGS)

    def __call__(self, texts: Texts) -> np.ndarray:
        data, n_rows = texts.data, len(texts)
        result = np.zeros(n_rows, np.int64)
        if not len(data):
            return result
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kinds = self.kinds[codes]
        hidden = np.zeros(len(lead), bool)  # characters of special strings
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                row = int(np.searchsorted(texts.bounds, at, "right")) - 1
                first, past = np.searchsorted(lead, [at, at + len(special)])
                inside = at + len(special) <= texts.bounds[row + 1] and not hidden[first:past].any()
                if inside:
                    hidden[first:past] = True
                    result[row] += 1
                at = raw.find(special, at + (len(special) if inside else 1))
        kinds = np.where(hidden, RESET, kinds)
        # one more character before each text, so that nothing crosses from one to the next
        firsts = np.searchsorted(lead, texts.bounds[:-1])
        kinds = np.insert(kinds, firsts, RESET)
        kinds = np.append(kinds, RESET).astype(np.uint8)
        marks = self.marks[kinds, states_before(kinds, self.to)]
        begins = (marks & BEGINS).astype(bool)
        begins[:-1] |= (marks[1:] & PREVIOUS_BEGINS).astype(bool)
        begins[kinds == RESET] = True
        place = np.delete(np.arange(len(kinds)), [*(firsts + np.arange(n_rows)), len(kinds) - 1])  # of each character
        begins = begins[place]
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(lead))
        # a pretoken never crosses texts: the first character of each text begins one
        offset = np.append(lead, len(data))
        shown = ~hidden[start]
        start, end = offset[start[shown]], offset[end[shown]]
        hashes = span_hashes(data, start, end)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)

        def count(missing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = first[missing]
            counts = [self.counter.count(raw[a:b]) for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            return np.ones(len(missing), np.int64), np.array(counts, np.int32)

        at, _, values = self.known(distinct, count)
        counts = values[at]
        row = np.searchsorted(texts.bounds, start, "right") - 1
        return result + np.bincount(row, counts[back], n_rows).astype(np.int64)


def token_counter(path: str, text: Column | str) -> Column:
    """Struct (n_bytes, n_tokens) of a text column for the byte-level BPE file at path, which every executor can read."""
    kinds, special = load(path)

    @F.arrow_udf("struct<n_bytes:bigint,n_tokens:bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counted = TextCounter(path, kinds, special)
        for batch in batches:
            parts = [counted(texts) for texts in blocks(batch)]
            sizes = pc.binary_length(batch.cast(pa.large_string()).fill_null("")).cast(pa.int64())
            yield struct_array({"n_bytes": sizes, "n_tokens": np.concatenate(parts) if parts else np.zeros(0, np.int64)})

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512, into: str = "tokens") -> DataFrame:
    """The rows with a struct column into: n_bytes, n_tokens and over_limit. A column of that name is replaced."""
    counted = docs.withColumn(into, token_counter(path, docs[text]))
    return counted.withColumn(into, F.col(into).withField("over_limit", F.col(f"{into}.n_tokens") > limit))
