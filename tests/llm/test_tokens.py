"""Token counts, SentencePiece pieces and quality rules against the libraries and plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from pyspark.sql import functions as F

from haulwatch.llm import decontamination, near_duplicates, pieces, quality_rules, token_counts
from haulwatch.llm.arrays import BLOCK_BYTES, blocks
from tests.llm.corpus import DOCS, ODD, clashing, empty, odd, prose  # noqa: F401

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"abcdestrvlmE'' '  \n\t!?.,0123４é中ß▁▁  \x1c\x85", "'ll", "'re", "'ve", "<|endoftext|>", "<|endof", " the", "ing", "▁▁▁", " " * 17, "tion"]


def noise(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 70))) for _ in range(n)]
    wild = lambda: chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(32, 700), rng.randrange(0x10000, 0x11000)]))
    return [*texts, *("".join(wild() for _ in range(25)) for _ in range(n // 4)), *(t[1] or "" for t in ODD), " ", "a ", "'", "'r", "  x"]


def test_counts_equal_the_library():
    library = tokenizers.Tokenizer.from_file(BPE)
    counter = token_counts.TextCounter(BPE, *token_counts.load(BPE))
    texts = noise(1, 3000)
    got = np.concatenate([counter(b) for b in blocks(pa.array(texts), 20_000)])
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got.tolist() == want


def test_chunk_maps_compose_to_one_reading():
    to, _ = token_counts.splitter()
    kinds = np.random.default_rng(3).integers(0, 12, 5000).astype(np.uint8)
    state, want = token_counts.START, []
    for kind in kinds:
        want.append(state)
        state = to[kind, state]
    for chunk in (1, 7, 256, 9999):
        assert token_counts.states_before(kinds, to, chunk).tolist() == want


def test_forgetting_changes_no_count(monkeypatch):
    counter = token_counts.TextCounter(BPE, *token_counts.load(BPE))
    texts = [prose(k, 400) for k in range(6)]
    want = np.concatenate([counter(b) for b in blocks(pa.array(texts))])
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    few = token_counts.TextCounter(BPE, *token_counts.load(BPE))
    assert np.array_equal(want, np.concatenate([few(b) for b in blocks(pa.array(texts), 500)]))


def test_count_tokens_rows(spark, odd, empty):
    library = tokenizers.Tokenizer.from_file(BPE)
    rows = token_counts.count_tokens(clashing(odd, "tokens", "n_tokens", "n_bytes"), BPE).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        text = row.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.tokens.n_bytes, row.tokens.n_tokens, row.tokens.over_limit) == (len(text.encode()), n, n > 512)
    assert token_counts.count_tokens(empty, BPE).count() == 0


def test_pieces_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = pieces.Encoder(MODEL)
    texts = noise(2, 3000)
    got = []
    for b in blocks(pa.array(texts), 20_000):
        ids, sizes = encoder(b)
        got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == library.encode(texts, num_threads=1)


def test_pieces_round_trip(spark, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = pieces.encode_documents(clashing(odd, "pieces", "decoded"), MODEL)
    for row in pieces.decode_documents(rows, MODEL, into="decoded").collect():
        text = row.text or ""
        assert row.pieces == library.encode(text)
        assert row.decoded == text.replace(pieces.MARK, " ")
    assert pieces.decode_documents(pieces.encode_documents(empty, MODEL), MODEL).count() == 0
    loose = spark.createDataFrame([([],), (None,), ([259, 28705, 131],)], "pieces array<int>")
    assert [r.text for r in pieces.decode_documents(loose, MODEL).collect()] == ["", "", "  �"]


def test_a_batch_is_handed_on_block_by_block(monkeypatch):
    """A task of any stage of the pipeline holds results of a block only, however many texts come in a batch; none is lost."""
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: lambda column: f)
    texts = [None, *(f"{k} some words, and more of them. " * (1 + 400 * (k % 7)) for k in range(120)), "", "x" * (BLOCK_BYTES + 9), "the end"]
    batches = [pa.array(texts[:90], pa.string()), pa.array([], pa.string()), pa.array(texts[90:], pa.string())]
    tasks = [
        pieces.encode("text", MODEL),
        quality_rules.measured("text", MODEL),
        decontamination.finder(["i"], ["some words and"], "text"),
        *(f.func for f in (near_duplicates.marked, near_duplicates.digested, near_duplicates.packed)),
    ]
    found = []
    for task in tasks:
        parts = [*task(iter(batches))]
        ends = np.cumsum([len(p) for p in parts])
        assert ends[-1] == len(texts)
        sizes = [sum(len(t or "") for t in texts[end - len(p) : end]) for p, end in zip(parts, ends, strict=True)]
        assert all(size <= BLOCK_BYTES or len(p) == 1 for p, size in zip(parts, sizes, strict=True))
        found.append([x for p in parts for x in p.to_pylist()])
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert found[0] == library.encode([t or "" for t in texts])
    assert [x["n_tokens"] for x in found[1]] == [*map(len, found[0])]
    assert [len(x["hits"]) > 0 for x in found[2]] == ["some words" in (t or "") for t in texts]
    decoded = [*pieces.decode("pieces", MODEL)(iter([pa.array(found[0], pa.list_(pa.int32()))]))]
    assert len(decoded) > 1 and [t for p in decoded for t in p.to_pylist()] == [t or "" for t in texts]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(text: str | None, library) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    ids = library.encode(text)
    n = len(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_tokens": n,
        "base_failed": len(words) < 50 or 100 * len(inside) > 50 * len(words), "token_entropy": entropy,
        "chars_per_token": len(text) / n if n else 0.0, "byte_share": sum(library.is_byte(i) for i in ids) / n if n else 0.0,
    }


def test_rules_against_plain_python(spark, odd, empty):
    rng = random.Random(4)
    texts = [*noise(5, 60), *(" ".join(rng.choice("ab cd e\nf | ***".split(" ")) for _ in range(rng.randrange(0, 90))) for _ in range(80)), "a\n\n a\na\na", prose(8, 200), "Und " * 90, "x y z " * 40]
    rows = [(k, t, rng.choice(["en", "fr", None, "xx"]), "s", 1) for k, t in enumerate(texts)] + ODD
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = clashing(spark.createDataFrame(rows, DOCS), "n_words", "rules", "kept", "reason")
    got = quality_rules.judge_quality(docs, MODEL).collect()
    assert len(got) == len(rows)
    for row in got:
        for name, value in plain_rules(row.text, library).items():
            assert row.rules[name] == pytest.approx(value), (name, row.text)
        assert row.rules.kept == (row.rules.reason is None) and not (row.rules.base_failed and row.rules.kept)
    by_text = {r.text: r.rules for r in got}
    assert by_text["Und " * 90].reason == "repeated words" and by_text["a\n\n a\na\na"].n_dup_lines == 2
    assert quality_rules.judge_quality(empty, MODEL).count() == 0
    assert quality_rules.judge_quality(odd.drop("lang"), MODEL, lang=None).count() == len(ODD)


def test_bands_by_language_and_script(spark):
    junk = " ".join(f"{w}***" for w in prose(5, 120).split())
    rows = [(1, prose(6, 150), "en", "s", 1), (2, junk, "en", "s", 1), (3, prose(7, 150), "tlh", "s", 1), (4, "слово и дело " + "наша улица длинная дорога домой " * 1 + " ".join(f"слово{k}м" for k in range(80)), None, "s", 1)]
    got = {r.doc_id: r.rules for r in quality_rules.judge_quality(spark.createDataFrame(rows, DOCS), MODEL).collect()}
    assert got[1].script == "script:latin" and got[4].script == "script:cyrillic"
    assert not got[2].kept and not got[2].base_failed
