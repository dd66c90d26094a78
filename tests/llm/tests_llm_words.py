"""Texts for tests."""

from __future__ import annotations

import random


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the", "of"]) + rng.choice(["", "s", "ing", str(rng.randint(0, 99))]) for _ in range(n))
