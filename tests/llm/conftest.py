import random

import pytest

WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you".split()


def make_words(rng, n):
    return [rng.choice(WORDS) + rng.choice(["", "a", "en", "ly", "ing", "st"]) + str(rng.randint(0, 9)) * rng.randint(0, 1) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with passages shared by many documents, near copies, copies, odd texts and an over-long one."""
    rng = random.Random(7)
    passage = make_words(rng, 70)
    base = make_words(rng, 200)
    rows = []
    for i in range(40):
        w = make_words(rng, rng.randint(5, 160))
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 10):rng.randint(55, 70)]
        rows.append(" ".join(w))
    for i in range(30):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        rows.append("\n".join([" ".join(w[:90]), " ".join(w[90:])]))
    rows += [" ".join(base)] * 4
    rows += [None, "", " \t\n", "one", "One two", "one TWO", "a b c d", "é 😀 " * 40, "same " * 120, "word " * 3000 + " ".join(passage), " ".join(passage) * 1]
    return list(enumerate(rows))
