import random

import pytest


@pytest.fixture
def rng():
    return random.Random(17)


@pytest.fixture
def words(rng):
    """A vocabulary of invented words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture
def doc_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"
