"""Texts of long runs: lines without spaces, digits, letters before an at sign."""

import random
import re
import time

import pytest

from ledgerloom.llm import pii, token_files
from ledgerloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return token_files.PieceEncoder(tokenizer_path())


def ids(encoder, text):
    blob = encoder.encode([text])[0]
    return [int.from_bytes(blob[i:i + encoder.id_bytes], "little") for i in range(0, len(blob), encoder.id_bytes)][:-1]


def test_many_lines_without_spaces(encoder):
    rng = random.Random(3)
    few = "\n".join(rng.choice(["12", "word", "Wörter.", "a,b", "", "\t", "é"]) for _ in range(3000))
    assert ids(encoder, few) == encoder.tokenizer.encode(few, add_special_tokens=False).ids
    started = time.time()
    assert len(ids(encoder, "\n".join(f"line{i}" for i in range(100_000)))) >= 200_000
    assert time.time() - started < 30


def test_long_pieces_are_not_kept(encoder):
    text = "x" * 5000 + " " + "y\n" * 200 + "z"
    assert ids(encoder, text) == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert max(map(len, [*encoder.known, *encoder.bare])) <= token_files.KEPT_LETTERS


def strict(text):
    """The base by the contract's forms alone."""
    out = [(m.start(), "email", m.end()) for m in pii.EMAIL.finditer(text)]
    for kind, form in (("ip", pii.IP), ("card", pii.CARD), ("phone", pii.PHONE)):
        out += [(m.start(), kind, m.end()) for m in form.finditer(text) if pii.valid(kind, m.group())]
    return sorted(out)


def test_base_of_odd_texts_is_that_of_the_forms():
    rng = random.Random(4)
    parts = ["a", "b.c", "@", "@@", "_x", "1.2.3.4", "..", "255", ".", "4111 1111 1111 1111", "+1 (2) 345-678-901", " ", "-", "0" * 9, "a@b.c", "%", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert sorted((s, k, e) for s, k, e, sure in pii.candidates(text) if sure) == strict(text), text


def test_numbers_of_any_length():
    assert pii.valid("ip", "1.2.3." + "0" * 5000 + "7") and not pii.valid("ip", "1.2.3." + "5" * 5000)
    assert pii.candidates("1.2.3." + "9" * 6000) is not None


@pytest.mark.parametrize("text", ["7" * 1_000_000, "k" * 1_000_000 + "@", "k@" * 300_000, "k@" + "k" * 1_000_000, "1." * 400_000, "+1" * 400_000, "k.k@k." * 100_000])
def test_runs_of_a_megabyte_take_seconds(text):
    started = time.time()
    pii.candidates(text)
    assert time.time() - started < 10
    assert re.search("@", text) or not any(k == "email" for _, k, _, _ in pii.candidates(text[:1000]))
