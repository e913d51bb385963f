import random

import pytest
from llm_words import prose

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "row string, key string, block int, turn int, size int, slot int, shard int, bits string, bucket int, copy int, text_hash int"
)
EXTRA = ("row", "key", 1, 2, 3, 4, 5, "bits", 6, 7, 8)

def odd_rows():
    """NULLs, empty and blank texts, ties, repeated rows, no letters, one very long text."""
    rng = random.Random(4)
    copy = prose(rng, "en", 60)
    return [
        (None, None, None, None, None),
        (None, "the only one without an id", "en", None, 5),
        (None, "the only one without an id", "en", None, 5),
        (1, None, "en", "a", 0),
        (2, "", "fr", "a", 0),
        (3, " \t\n ", "fr", None, 4),
        (4, "123 456", "de", "b", 7),
        (5, "one two", "en", "a", 7),
        (6, copy, "en", "a", len(copy)),
        (7, copy, None, "b", len(copy)),
        (7, copy, None, "b", len(copy)),
        (8, copy.upper(), "en", "b", len(copy)),
        (9, prose(rng, "de", 30_000), "de", "c", 0),
        (10, "é😀 \x00 ß <|endoftext|> 中文", "fr", "c", 12),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    def build(rows):
        return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    return documents(odd_rows())


@pytest.fixture(scope="session")
def corpus():
    """A few hundred texts: unrelated ones, exact copies, chains of near copies, shared passages."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    passage = [rng.choice(words) for _ in range(40)]
    for n in range(60):
        base = [rng.choice(words) for _ in range(rng.choice((6, 40, 120)))]
        texts.append(base)
        if n % 3 == 0:
            texts += [base] * 3
        if n % 4 == 0:
            at = base
            for _ in range(5):  # each near the one before, the ends not near each other
                at = list(at)
                for _ in range(max(1, len(at) // 40)):
                    at[rng.randrange(len(at))] = rng.choice(words)
                texts.append(at)
        if n % 5 == 0:
            texts.append(passage + base[:30])
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]
