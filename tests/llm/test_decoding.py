"""Viterbi decoding of disguised tokens against all readings; tokens of any length; the same words' weights as the plain rule."""

import random
import time
from itertools import product

import numpy as np
import pytest

from quartermaster.llm import toxicity


@pytest.fixture(scope="module")
def model():
    words = "idiot stupid the idea of a hat hello cool fool spam worthless".split() * 3
    grams = {}
    s = toxicity.SYMBOL_OF[np.frombuffer(("  " + "  ".join(words) + "  ").encode(), np.uint8)].tolist()
    for a, b, c in zip(s, s[1:], s[2:]):
        g = (a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c
        grams[g] = grams.get(g, 0) + 1
    return toxicity.CharModel(grams)


def probability(model, choice):
    """Logarithm of one choice of readings, symbol by symbol."""
    x = y = 0
    s = 0.0
    for reading, cost in [*choice, (" ", 0.0)]:
        s += cost
        for z in toxicity.SYMBOL_OF[np.frombuffer(reading.encode(), np.uint8)].tolist():
            if z or y:
                s += model.log_p(x, y, z)
                x, y = y, z
    return s


@pytest.mark.parametrize("letters", [False, True])
def test_decoding_finds_the_likeliest_of_all_readings(model, letters):
    rnd = random.Random(1)
    for _ in range(150):
        token = "".join(rnd.choices("idotsh1!0@.-$aé ", k=rnd.randint(1, 6)))
        choices = {}
        for choice in product(*toxicity.lattice(token, letters)):
            text = "".join(r for r, _ in choice).strip()
            choices[text] = max(choices.get(text, -np.inf), probability(model, choice))
        got = toxicity.decode(token, model, letters)
        assert choices[got] == pytest.approx(max(choices.values()), abs=1e-9)


def test_long_tokens_are_read_whole(model):
    assert toxicity.decode(".".join("idiot" * 8), model).replace(" ", "") == "idiot" * 8
    assert "idiot" in toxicity.Restorer(model).words("i" + "." * 300 + "d.i.o.t")
    began = time.time()
    toxicity.Restorer(model).words("1d10t." * 20_000)
    assert time.time() - began < 60


def test_word_weights_are_the_largest_of_their_features():
    weights = {"idi": 1.5, "idiot$": 3.0, "the$": -1.0}
    weight_of = toxicity.WordWeights(weights)
    assert [weight_of[w] for w in ("idiot", "idiom", "the", "x")] == [3.0, 1.5, 0.0, 0.0]
    assert toxicity.evidence({"idiot", "idiom", "the"}, weight_of)[:2] == (3.0, 1.5)
    assert toxicity.evidence(set(), weight_of) == (0.0, 0.0, 0.0)
