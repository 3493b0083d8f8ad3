import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import textkit

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZé ,.!\n\t0'<|>Σ中́\x1c\xa0", max_size=30)), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    column = pa.array(texts, pa.string())
    for kind, pattern in ((textkit.BLANKS, rb"[^\x20\x09-\x0d]+"), (textkit.ALNUM, rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        data, starts, ends, first = textkit.words_of(column, kind)
        for k, t in enumerate(texts):
            want = re.findall(pattern, bytes(textkit.LOWER[np.frombuffer((t or "").encode(), np.uint8)]))
            assert [bytes(data[a:b]) for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])] == want


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_whole_tokenizer(texts):
    encoder = textkit.word_pieces(public_tokenizers.path("word_bpe_49k.json"))
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == encoder.whole.encode(t or "", add_special_tokens=False).ids


def test_ids_after_the_memory_is_emptied():
    encoder = textkit.WordPieces(public_tokenizers.path("word_bpe_49k.json"), keep=3)
    for text in ("one two three four", "Five, six! <|endoftext|> five", "one <|ENDOFTEXT|>"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


def test_window_hashes_tell_windows_apart():
    words = np.arange(200, dtype=np.uint64)
    for size in (5, 35):
        twice = np.concatenate([words, words])
        got = textkit.window_hashes(twice, size)
        assert (got[: 200 - size] == got[200 : 400 - size]).all() and len(np.unique(got[: 200 - size])) == 200 - size
