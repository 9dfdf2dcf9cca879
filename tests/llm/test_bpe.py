import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from scorecast.llm import bpe

from .corpus import documents, empty, frame

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["Hello", "WORLD's", "it'll", "<|endoftext|>", "<|startoftext|>", "é", "é", "İ", "ﬁ", "ΑΣ", "ẞ", "٣", "½", "\x1c", "\x85", "\xa0", "​",
         "😀", "...", "!!!?", "'s", "'S", "_", "12", "中文", "\n", " ", " ", "th", "onent", "zz" * 50, "=-" * 60, "日本" * 30, "\x00", "ａＢ", "𞤀", "ª"]


def test_same_as_the_tokenizers_library(spark):
    rng = random.Random(1)
    rows = documents(n=60) + [(4000 + i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))) for i in range(400)]
    library = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in bpe.encode(frame(spark, rows), PATH, lexicon=200).collect()}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False)), repr(t)


def test_edges(spark):
    out = bpe.encode(frame(spark, [(None, "a"), (1, None), (1, None)]), PATH).collect()
    assert sorted(len(r["ids"]) for r in out) == [0, 0, 1] and {r["decoded"] for r in out} == {"", "a</w>"}
    assert bpe.encode(empty(spark), PATH).count() == 0


def test_automaton_is_minimal_and_numbers_words(tmp_path):
    words = sorted({f"{a}{b}{c}".encode() for a in ("un", "re", "") for b in ("do", "make", "é") for c in ("ing", "s", "")})
    auto = bpe.compile_lexicon(words)
    assert bpe.walk(auto, words).tolist() == list(range(len(words)))
    assert bpe.walk(auto, [b"", b"und", b"undoingx", b"zzz"]).tolist() == [-1] * 4
    assert len(auto["final"]) < sum(map(len, words)) / 4        # shared suffixes
    bpe.save(auto, str(tmp_path), "lexicon")
    again = bpe.load(str(tmp_path), "lexicon")
    assert all(np.array_equal(auto[k], again[k]) for k in auto)
    assert bpe.walk(bpe.compile_lexicon([]), [b"a"]).tolist() == [-1]
