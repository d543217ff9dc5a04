"""Made-up words."""

import random


def words(seed: int, n: int) -> str:
    """n words, the same for a seed."""
    rng = random.Random(seed)
    parts = ["an", "er", "ion", "the", "st", "ou", "re", "ble", "é", "ß"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))
