"""Hits and exceptions of the lexicon against a plain comparison of all with all."""

import random
import time
from collections import Counter

from dayledger.llm import toxicity

LEXICON, EXCEPTIONS = ("clown", "rot", "ab", "b c", "abc*", "rotten egg"), ("class clown", "a b c d", "rot away", "the ab", "b c")


def brute(text):
    folded = toxicity.fold(text)

    def places(entry):
        plain, opening = toxicity.fold(entry.rstrip("*")), entry.endswith("*")
        for start in range(len(folded)):
            end = start + len(plain)
            if folded.startswith(plain, start) and not (start and folded[start - 1].isalnum()):
                if opening or not folded[end : end + 1].isalnum():
                    yield start, end

    safe = [p for e in EXCEPTIONS for p in places(e)]
    return Counter(i for i, e in enumerate(LEXICON) for s, t in places(e) if not any(a <= s and t <= b for a, b in safe))


def test_against_all_pairs():
    rng, words = random.Random(4), ["clown", "class", "rot", "away", "ab", "abcd", "a", "b", "c", "d", "the", "rotten", "egg", "!", "cl0wn"]
    for _ in range(3000):
        text = " ".join(rng.choices(words, k=rng.randrange(14)))
        assert toxicity.matches(text, LEXICON, EXCEPTIONS) == brute(text), text


def test_many_exceptions_take_time_in_step_with_the_text():
    def seconds(n):
        start = time.process_time()
        assert toxicity.matches("class clown " * n, LEXICON, EXCEPTIONS) == Counter()
        return time.process_time() - start

    seconds(100)
    assert seconds(80_000) < 16 * seconds(10_000) + 1
