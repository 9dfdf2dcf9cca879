"""Small corpora with the awkward cases: nulls, empty texts, white space only,
repeats, near copies, shared passages, one very long text, extra columns whose
names clash with the operators' own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, kept boolean, _maybe boolean, n long"


def documents(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeghé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    texts = [None, "", "   \n", "one", "one two", "One\ttwo", "x " * 50, sentence(6000)]
    passage = sentence(30)
    for _ in range(n):
        kind = rng.random()
        if kind < 0.25 and len(texts) > 12:
            words = rng.choice(texts[8:]).split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind < 0.4:
            texts.append(sentence(rng.randint(1, 40)) + " " + passage + "\n" + sentence(rng.randint(0, 20)))
        elif kind < 0.5 and len(texts) > 12:
            texts.append(rng.choice(texts[8:]).replace(" ", "  ", 1))
        else:
            texts.append(sentence(rng.randint(1, 150)))
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)]
    return rows


def frame(spark, rows):
    full = [(i, t, "en", rng_source(i), None, 7, True, False, 5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def rng_source(i):
    return None if i is None or i % 7 == 0 else f"src{0 if i % 3 else i % 5}"


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
