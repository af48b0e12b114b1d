"""Likeness of texts that repeat a phrase: repeats weigh as often as they occur."""

import random

from quartermaster.llm import fingerprints


def test_repeats_inside_a_paragraph_do_not_square():
    rnd = random.Random(5)

    def words(n):
        return " ".join("".join(rnd.choices("abcdefghij", k=6)) + ("." if i % 6 == 5 else "") for i in range(n))

    for times in (5, 15, 40):
        shared, phrase = words(400), "say it once more now. "
        a, b = shared + " " + phrase * times, shared + " " + words(6 * times)
        n = 400 // 6
        true = 2 * n / (2 * n + 2 * times)
        assert abs(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - true) < 0.2


def test_still_homomorphic_over_paragraphs():
    a, b = "one two. one two. one two.", "one two. three"
    both = fingerprints.combine(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
    assert both == fingerprints.fingerprint(a + "\n" + b) == fingerprints.fingerprint(b + "\n" + a)
    assert fingerprints.combine(both, fingerprints.fingerprint(a), -1) == fingerprints.fingerprint(b)
