"""Keys with few digits: base-62, base-32, short hex and prefixed ones."""

import random
import string

import pytest

from ledgerlake.llm import pii

BASE62, BASE32, HEX = string.ascii_letters + string.digits, string.ascii_uppercase + "234567", "0123456789abcdef"


@pytest.fixture(scope="module")
def field():
    return pii.train([])


@pytest.mark.parametrize(("alphabet", "size"), [(BASE62, 24), (BASE62, 32), (BASE32, 20), (HEX, 16)])
@pytest.mark.parametrize("prefix", ["", "sk_live_", "ghp_", "sk-"])
def test_keys_are_masked(field, alphabet, size, prefix):
    rng = random.Random(size)
    for _ in range(25):
        key = prefix + "".join(rng.choice(alphabet) for _ in range(size - 1)) + rng.choice("234567")
        assert pii.redact(f"the api key {key} is old", field) == "the api key <secret> is old"
        assert pii.redact(f'token = "{key}" x', field) == 'token = "<secret>" x'


def test_words_are_no_keys(field):
    for text in ("the key was internationalization2 of it", "in release2024candidate notes", "see chapter12 and model3000"):
        assert len(text) and pii.all_spans(text.replace("the key was ", ""), field)[1] == []
