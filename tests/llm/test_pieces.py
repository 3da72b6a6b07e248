"""Pieces of texts: words that differ in the sign behind them are one piece, and ids stay those of whole texts."""

from __future__ import annotations

import pyarrow as pa

import public_tokenizers
from marlstone.llm import token_files
from marlstone.llm.texts import slices


def test_a_sign_behind_a_word_makes_no_new_piece(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_files.TOKENIZER)
    encoder, pieces = Tokenizer.from_file(path), token_files.Pieces(path)
    signs = "an" + "".join(f" word{s}" for s in ",.;:!?)]}\"'-/")
    odd = [signs, "a<|endoftext|>b|c <|endoftext| x|> don't we're'll x's 's'S it''s A's't 'Tom", "é.à,ß;ü  z.\n\nC .D ..e\t.f g . h1.2a,3"]
    for _, _, data, at in slices(pa.array(odd)):
        ids, place = pieces.encode(data, at)
        for k, text in enumerate(odd):
            assert ids[place[k]:place[k + 1]].tolist() == encoder.encode(text, add_special_tokens=False).ids
    few = token_files.Pieces(path)
    for _, _, data, at in slices(pa.array([signs])):
        few.encode(data, at)
    assert few.count == 2 + 13  # "an", " word" and the signs


def test_pieces_met_again_stay(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 40)
    pieces = token_files.Pieces(public_tokenizers.path(token_files.TOKENIZER))
    asked = []
    call = pieces._call
    monkeypatch.setattr(pieces, "_call", lambda texts: asked.extend(texts) or call(texts))
    for turn in range(8):
        for _, _, data, at in slices(pa.array(["x common " + " ".join(f"w{turn}q{i}" for i in range(30))])):
            pieces.encode(data, at)
    assert sum(" common" in t for t in asked) == 1
