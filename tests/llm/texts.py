"""Small tables for the tests, and brute-force counterparts of the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" if rng.random() < 0.9 else f"é{rng.randrange(vocabulary)}," for _ in range(n)]


def corpus(seed=1, n=60):
    """Documents with copies, near copies, shared passages, periodic text, blanks, NULLs and odd white space."""
    rng = random.Random(seed)
    passage = words(rng, 80)
    base = words(rng, 200)
    out = []
    for i in range(n):
        text = words(rng, rng.randrange(5, 150))
        kind = i % 9
        if kind == 1:
            at = rng.randrange(len(text))
            text = text[:at] + passage[rng.randrange(10):len(passage) - rng.randrange(10)] + text[at:]
        if kind == 2:
            text = list(base)
            text[rng.randrange(len(text))] = "edited"
        if kind == 3:
            text = base
        if kind == 4:
            text = ["again"] * rng.randrange(20, 200) + text
        if kind == 5:
            text = text + text
        joined = " ".join(text)
        if kind == 6:
            joined = "\n \t" + joined.replace(" ", "  ", 3) + "\r\n"
        out.append((i, joined, "en" if i % 2 else "fr", f"src{i % 3}", len(joined)))
    out.append((n, None, None, None, None))
    out.append((n + 1, "", "en", "src0", 0))
    out.append((n + 2, " \n", "en", "src0", 2))
    rng.shuffle(out)
    return out
