"""Pieces that the token store's encoder remembers."""

import public_tokenizers
from tokenizers import Tokenizer

from cadastre.llm import token_store as store

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["one two one.\nThree  four\n\n", None, "", "one " * 50 + "x" * 200, "Łódź 12,5 \x01 a\x02b <|endoftext|> one"]


def test_a_piece_is_encoded_once_and_long_ones_are_not_kept():
    asked = []
    known = store.Known(lambda p: asked.append(p) or p.encode(), {"old": b"1"})
    long = "x" * (store.LONGEST + 1)
    assert [known[p] for p in ("a", "a", "old", "old", long, long)] == [b"a", b"a", b"1", b"1", long.encode(), long.encode()]
    assert asked == ["a", long, long] and sorted(known) == ["a", "old"]


def test_texts_are_encoded_as_the_library_does_when_old_pieces_are_dropped(monkeypatch):
    monkeypatch.setattr(store, "CACHE", 3)
    encoder, library = store.Encoder(PATH, "<u2"), Tokenizer.from_file(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    for _ in range(3):
        assert [list(memoryview(x).cast("H")) for x in encoder.encode(TEXTS)] == want
        assert len(encoder.known.older) < 40
