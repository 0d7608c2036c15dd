"""Quality rules: plain counts of a text, and bands on how a public vocabulary takes it apart (tokeniser fertility).

Base counts of a text, over words of anything but blanks (x20, x09-x0D): see `MEASURES`. A text fails the base rules with
fewer than MIN_WORDS words, or with more than half of its words inside three-word windows that it has twice or more. A text
that passes them is measured with the pieces of a public vocabulary: characters per token, tokens per word, share of byte
fallback and entropy of its tokens in bits. Each has a rejection band for the language of the row; without a known language
the band is that of the script most letters are in. Short texts cannot reach the entropy of long ones, so what is asked is
the lower of the band's figure and ENTROPY_OF_LENGTH of the highest entropy that so many tokens can have.

Empty and null texts have no words and fail. Rows are independent; repeated rows get the same verdict each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.llm.arrays import BLANK, Texts, Words, blocks, give_back, mix, shingle_hashes, span_hashes, struct_array
from haulwatch.llm.pieces import ENCODED_BYTES, Encoder

MIN_WORDS = 50
ENTROPY_OF_LENGTH = 0.75
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
#: least and most characters per token, most tokens per word, most share of byte fallback, least entropy in bits
BANDS = {
    "en": (1.7, 8.0, 3.3, 0.1, 5.2),
    "de": (1.7, 8.0, 3.4, 0.1, 5.2),
    "es": (1.7, 8.0, 3.5, 0.1, 5.2),
    "fr": (1.7, 8.0, 3.8, 0.1, 5.2),
    "script:latin": (1.5, 8.0, 5.0, 0.15, 4.8),
    "script:cyrillic": (1.2, 8.0, 6.0, 0.15, 4.8),
    "script:cjk": (0.3, 4.0, 1e9, 0.6, 4.8),  # no blanks between words
    "script:other": (0.2, 8.0, 1e9, 0.98, 3.5),
}
#: Script by the first byte of a letter's UTF-8 form.
SCRIPTS = ("script:latin", "script:cyrillic", "script:cjk", "script:other")
SCRIPT_OF = np.full(256, -1, np.int8)
SCRIPT_OF[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]] = 0
SCRIPT_OF[0xD0:0xD5] = 1
SCRIPT_OF[0xE3:0xEE] = 2
SCRIPT_OF[[*range(0xCA, 0xD0), *range(0xD5, 0xE3), *range(0xEE, 0xF5)]] = 3

MEASURES = {
    "n_words": "bigint",
    "word_chars": "bigint",  # code points in words
    "n_symbols": "bigint",  # characters of #*$%&|<>
    "n_dup_lines": "bigint",  # lines with a word that equal an earlier line
    "n_repeat_words": "bigint",  # words in three-word windows that the text has twice or more
    "n_tokens": "bigint",
    "chars_per_token": "double",  # 0 without tokens
    "tokens_per_word": "double",
    "byte_share": "double",
    "token_entropy": "double",
    "script": "string",
}


def per_row(mask: np.ndarray, texts: Texts) -> np.ndarray:
    """How many bytes of each row are marked."""
    sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return sums[texts.bounds[1:]] - sums[texts.bounds[:-1]]


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    data, n = texts.data, len(texts)
    words = Words(texts, ~BLANK)
    leads = (data & 0xC0) != 0x80
    # lines: a text begins one, and so does what follows a line feed
    begins = np.unique(np.concatenate((texts.bounds[:-1][np.diff(texts.bounds) > 0], np.flatnonzero(data[:-1] == 0x0A) + 1)))
    begins = begins[np.unique(np.searchsorted(begins, words.start, "right") - 1)] if len(words) else begins[:0]
    feeds = np.append(np.flatnonzero(data == 0x0A), len(data))
    ends = np.minimum(feeds[np.searchsorted(feeds, begins)], texts.bounds[np.searchsorted(texts.bounds, begins, "right")]) if len(begins) else begins
    line_row = np.searchsorted(texts.bounds, begins, "right") - 1
    lines = mix(span_hashes(data, begins, ends) + line_row.astype(np.uint64))
    distinct = np.unique(lines, return_index=True)[1]
    # windows of three words
    windows, first = shingle_hashes(span_hashes(data, words.start, words.end), words.row, 3)
    _, back, times = np.unique(mix(windows + words.row[first].astype(np.uint64)), return_inverse=True, return_counts=True)
    twice = first[times[back] > 1]
    repeated = np.zeros(len(words), bool)
    for k in range(3):
        repeated[twice + k] = True
    return {
        "n_words": words.per_row(),
        "word_chars": per_row(leads & ~BLANK[data], texts),
        "n_symbols": per_row(SYMBOLS[data], texts),
        "n_dup_lines": np.bincount(line_row, minlength=n) - np.bincount(line_row[distinct], minlength=n),
        "n_repeat_words": words.per_row(repeated),
        "n_chars": per_row(leads, texts),
        "script": np.array([per_row(SCRIPT_OF[data] == k, texts) for k in range(4)]).argmax(axis=0),
    }


def fertility(encoder: Encoder, texts: Texts) -> dict[str, np.ndarray]:
    """Tokens of each row, byte tokens, and the entropy of its tokens."""
    ids, sizes = encoder(texts)
    row = np.repeat(np.arange(len(texts)), sizes)
    is_byte = np.zeros(len(encoder.model.bytes_of), bool)
    is_byte[list(encoder.model.byte_id.values())] = True
    keys, times = np.unique(row * len(is_byte) + ids, return_counts=True)
    bits = np.bincount(keys // len(is_byte), times * np.log2(times), len(texts))
    total = np.maximum(sizes, 1)
    return {"n_tokens": sizes, "n_bytes": np.bincount(row, is_byte[ids], len(texts)), "entropy": np.log2(total) - bits / total}


def measured(text: Column, path: str) -> Column:
    """Struct of MEASURES of a text column."""

    @F.arrow_udf(", ".join(f"{k} {v}" for k, v in MEASURES.items()))
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from measured_blocks(batches, path)

    return measure(text)


def measured_blocks(batches: Iterable[pa.Array], path: str) -> Iterator[pa.Array]:
    """MEASURES of the texts of all batches, in order, a block at a time."""
    encoder = Encoder(path)
    names = np.array(SCRIPTS)
    kind = pa.struct([(k, {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}[v]) for k, v in MEASURES.items()])
    for batch in batches:
        for texts in blocks(batch, ENCODED_BYTES):
            base, cut = base_counts(texts), fertility(encoder, texts)
            tokens = np.maximum(cut["n_tokens"], 1)
            base["n_tokens"] = cut["n_tokens"]
            base["chars_per_token"] = base["n_chars"] / tokens
            base["tokens_per_word"] = cut["n_tokens"] / np.maximum(base["n_words"], 1)
            base["byte_share"] = cut["n_bytes"] / tokens
            base["token_entropy"] = cut["entropy"]
            base["script"] = names[base["script"]]
            yield struct_array({k: base[k] for k in MEASURES}).cast(kind)
    del encoder
    give_back()


def judge_quality(docs: DataFrame, path: str, text: str = "text", lang: str | None = "lang", into: str = "rules", bands: dict = BANDS) -> DataFrame:
    """The rows with a struct column into (replaced if there is one): MEASURES, base_failed, reason (null if kept) and kept.

    lang names the column with the language, None if there is none; a language without a band is judged by its script."""
    of = F.create_map(*(x for name, band in bands.items() for x in (F.lit(name), F.array(*map(F.lit, map(float, band))))))
    rows = docs.withColumn(into, measured(docs[text], path))
    m = {name: F.col(into)[name] for name in MEASURES}
    names = [rows[lang].cast("string")] if lang else []
    band = F.coalesce(*(of[n] for n in (*names, m["script"], F.lit("script:other"))))
    reason = (
        F.when(m["n_words"] < MIN_WORDS, "few words")
        .when(100 * m["n_repeat_words"] > 50 * m["n_words"], "repeated words")
        .when((m["chars_per_token"] < band[0]) | (m["chars_per_token"] > band[1]), "characters per token")
        .when(m["tokens_per_word"] > band[2], "tokens per word")
        .when(m["byte_share"] > band[3], "byte fallback")
        .when(m["token_entropy"] < F.least(band[4], ENTROPY_OF_LENGTH * F.log2(m["n_tokens"].cast("double"))), "token entropy")
    )
    rows = rows.withColumn(into, F.col(into).withField("reason", reason))
    failed = F.coalesce(F.col(into)["reason"].isin("few words", "repeated words"), F.lit(False))
    return rows.withColumn(into, F.col(into).withField("base_failed", failed).withField("kept", F.col(into)["reason"].isNull()))
