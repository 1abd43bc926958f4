from __future__ import annotations

import pytest
from shared import frame, prose

from orderloom.llm import tokens
from orderloom.scratch import new_path

WORD = tokens.vocabulary_path("word_bpe_49k.json")
SPECIAL = ["<|STARTOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|startoftext|>", "A<|EndofText|>b", "X<|endoftext|>Y",
           "Ab<|ENDOFTEXT|>.", "<|EndOfText|>,", "<|ENDOFTEXT", "É<|StartOfText|>"]


@pytest.mark.parametrize("words", [SPECIAL, SPECIAL[::-1]])
def test_added_tokens_in_any_case_match_the_library(words):
    library, encoder = tokens.load_tokenizer(WORD), tokens.WordEncoder(WORD)
    texts = [*words, " ".join(words), "Some " + " WORDS, ".join(words) + " after"]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_token_files_with_added_tokens_in_any_case(spark):
    library, out = tokens.load_tokenizer(WORD), new_path(spark, "test-special")
    rows = [(i, f"{prose(i, 5)} {word} {prose(i + 50, 5)}", "s") for i, word in enumerate(SPECIAL)]
    tokens.write_token_files(frame(spark, rows), out, WORD, end_id=1)
    want = {i: [*library.encode(text, add_special_tokens=False).ids, 1] for i, text, _ in rows}
    assert {r.doc_id: list(r.ids) for r in tokens.read_token_files(spark, out).collect()} == want
    starts = [sum(len(want[k]) for k in range(i)) for i in range(len(rows))]
    digests = tokens.token_digests(spark, out).orderBy("doc_id").collect()
    assert [r.start for r in digests] == starts


def test_every_letter_with_a_sign_behind_it_matches_the_library():
    """Letters whose lower case or composed form ends in a mark are not letters there."""
    library, encoder = tokens.load_tokenizer(WORD), tokens.WordEncoder(WORD)
    letters = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    texts = [f"{c}, a{c}." for c in letters] + [f"A{c}b {c}{c}" for c in letters]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_groups_of_texts_of_any_size_match_the_library(monkeypatch):
    """White space at the ends, empty texts, separators, and texts above a piece."""
    library = tokens.load_tokenizer(WORD)
    texts = ["", " ", "\n a　", "a\x1cb", "b", "\x1f", "Ab, " * 300, "x" * 2000 + " y", *SPECIAL, ""]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for piece, group in [(1 << 18, 1 << 22), (64, 100), (1, 1), (1000, 10)]:
        monkeypatch.setattr(tokens, "PIECE", piece)
        monkeypatch.setattr(tokens, "GROUP", group)
        encoder = tokens.WordEncoder(WORD)
        assert [ids.tolist() for ids in encoder.encode(texts)] == want
    assert list(encoder.encode([])) == []


@pytest.mark.parametrize("kept", [1, 5, 40])
def test_forgetting_words_changes_no_ids(monkeypatch, kept):
    library = tokens.load_tokenizer(WORD)
    texts = [f"{prose(i % 7, 20)} Word{i}, {prose(i, 9).upper()}" for i in range(60)]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    monkeypatch.setattr(tokens, "KEPT_IDS", kept)
    monkeypatch.setattr(tokens, "GROUP", 300)
    encoder = tokens.WordEncoder(WORD)
    for _ in range(2):
        assert [ids.tolist() for ids in encoder.encode(texts)] == want
