"""Small document tables with the awkward cases."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, fp string, spans string"
WORDS = ("the of and to tion er ing ea st on re wh sh at nt ti es or ed an in he ha the ou are this that with from").split()


def prose(rng, n, lines=True):
    out = []
    for i in range(n):
        w = "".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4)))
        out.append(w + ("." if rng.random() < 0.1 else ""))
    text = " ".join(out)
    return text.replace(". ", ".\n", 2) if lines else text


def rows(seed=1, n=40):
    """Texts of many lengths with copies and near copies, empty and null ones, and rows that repeat."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([1, 3, 8, 40, 200])) for _ in range(n)]
    texts += [texts[3], texts[3], texts[5] + " more", None, "", " \n\t ", prose(rng, 4000), "x" * 5000, "ab" * 60 + " " + "ab" * 60]
    texts += ["Ünï côdé " * 30, "naïve cœur " * 9, "a\x1cb\x85c ​d"]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None]), 1, "a", "b", "c") for i, t in enumerate(texts)]
    out += [out[1], out[1], (None, texts[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    out.append((-5, texts[0], "en", "s1", 0, None, None, None))
    rng.shuffle(out)
    return out


def table(spark, seed=1, n=40, parts=3):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
