import random

import pytest


@pytest.fixture(scope="session")
def shared(spark):
    return spark


@pytest.fixture
def prose():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def make(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    make.rng = rng
    return make
