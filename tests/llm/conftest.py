import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

WORDS = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu", "na", "po", "ri", "se", "ta") for b in ("ban", "dor", "kel", "lim", "mos", "nur", "pat", "rin", "sol", "tev")]


@pytest.fixture
def prose():
    """Random words: ``prose(n, seed)``."""

    def write(n, seed):
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) + (draw.choice(WORDS) if draw.random() < 0.7 else "") for _ in range(n))

    return write


@pytest.fixture
def edited():
    """A text with every ``step``-th word replaced: ``edited(text, step, seed)``."""

    def change(text, step, seed):
        words = text.split(" ")
        for i in range(seed % step, len(words), step):
            words[i] = f"x{seed}y{i}"
        return " ".join(words)

    return change
