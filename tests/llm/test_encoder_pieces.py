"""Parts of a text put together from their pieces: the library's ids, and less of its work."""

import random

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm.tokenizer import TextEncoder


@pytest.fixture(scope="module")
def enc():
    return TextEncoder()


def same(enc, text):
    return np.frombuffer(enc.encode_one(text), dtype=enc.type).tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_a_word_meets_the_model_once_whatever_stands_behind_it():
    enc, seen = TextEncoder(), []
    real = enc.tokenize
    enc.tokenize = lambda w: seen.append(w) or real(w)
    assert same(enc, " étude étude. étude, étude$$$ étude.\nétude étude!\nétude,")
    assert sum("tude" in w for w in seen) == 2                    # with a space before it, and without


def test_any_text_has_the_library_s_ids(enc):
    rng = random.Random(5)
    letters = "abzAZéÈñçßđɏɐªº²½×÷µ'sstretd.,;!?$#*_-\"[]{}~^`|<>\n\n\t\r   019ж\U0001d4b3́ ­’"
    words = ["word", "été,", "x.", "it's", "don't.", "a\nb", "Ab.\nCd,", "a\n\nb", "q\n", "\nq", "l'été\nb", "x'd\ny", "a's\n's", " "]
    for _ in range(4000):
        assert same(enc, text := "".join(rng.choices(letters, k=rng.randint(1, 14)))), text
        assert same(enc, text := rng.choice([" ", ""]).join(rng.choices(words, k=rng.randint(1, 9)))), text


def test_many_lines_without_a_space(enc):
    assert same(enc, "a\n" * 5000 + "b") and same(enc, " ab\n" * 20 + "cd." * 40)


def column(enc, texts, end, kind=pa.string()):
    ids, cuts = enc.encode_column(pa.array(texts, kind), end)
    assert ids.dtype == enc.type and len(cuts) == len(texts) + 1
    return [ids[a:z].tolist() for a, z in zip(cuts, cuts[1:])]


def test_a_column_has_the_library_s_ids():
    rng = random.Random(7)
    words = ["word", "été,", "x.", "it's", "don't.", "a\nb", "Ab.\nCd,", "", "  ", "q\n", "\nq", "ж", "\x00", "<|endoftext|>", "y" * 70]
    enc = TextEncoder(memory_bytes=20_000)                        # soon full
    for kind in (pa.string(), pa.large_string()):
        for end in (b"", b"\0\0", b"\1\0\2\0"):
            for n in (0, 1, 2, 40):
                texts = [rng.choice([None, "", " "]) if rng.random() < 0.2 else
                         " ".join(rng.choices(words + [str(rng.random())], k=rng.randint(1, 9))) for _ in range(n)]
                tail = np.frombuffer(end, enc.type).tolist()
                assert column(enc, texts, end, kind) == [
                    enc.tok.encode(t or "", add_special_tokens=False).ids + tail for t in texts], texts


def test_a_worker_remembers_more_parts_than_a_dict_would_in_the_same_bytes():
    enc, seen = TextEncoder(memory_bytes=4 << 20), []
    real = enc.tokenize
    enc.tokenize = lambda w: seen.append(w) or real(w)
    letters = random.Random(3)
    texts = [" " + " ".join("".join(letters.choices("aeioustr", k=9)) for _ in range(200)) for _ in range(100)]
    once = column(enc, texts, b"")
    assert (first := len(seen)) > 19_000
    assert column(enc, texts, b"") == once and len(seen) == first  # nothing meets the model again
    assert enc.parts.find(pa.array(["nothere"], pa.large_string())).tolist() == [-1]


def test_parts_asked_for_last_stay_within_the_bound():
    enc = TextEncoder(memory_bytes=200_000)
    for i in range(60):
        column(enc, [" often " + " ".join(f"w{i}x{j}" for j in range(100))], b"")
    held = enc.parts.parts.to_pylist()
    assert 100 < len(held) < 2000 and "often" in held and "w59x5" in held and "w0x5" not in held
    assert enc.parts.size.sum() == len(enc.parts.ids) and len(enc.parts.used) == len(held)
