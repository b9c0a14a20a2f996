import random

import pytest

from tests.session import make_session
from tidelist.llm.common import prepare


@pytest.fixture(scope="session")
def spark():
    return prepare(make_session())


@pytest.fixture(scope="session")
def sentences():
    """Makes texts of invented words, by a fixed seed."""

    def make(seed: int, words: int) -> list[str]:
        rng = random.Random(seed)
        return ["".join(rng.choices("abcdeghiklmnorstu", k=rng.randint(2, 8))) for _ in range(words)]

    return make
