"""Small tables with every awkward row: nulls, empty texts, long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, fp long, words string, score double, n int"


def rows(seed: int = 7) -> list[tuple]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(400)]
    sentence = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    texts = [sentence(r.randint(1, 90)) for _ in range(40)]
    texts += ["\n".join(sentence(r.randint(1, 20)) for _ in range(8)) for _ in range(20)]
    for t in texts[10:30]:
        w = t.split(" ")
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += texts[:6] + [sentence(6000), "ÀÉ ß ñandú Ωmega\t\x0bx\r\n y 漢字 🙂", "", "", " \n\t ", "one", "Two words", "A b C", "a" * 700, "ab" * 400]
    common = sentence(60)
    texts += [f"{sentence(5)}\n{common}\n{sentence(5)}" for _ in range(6)]
    out = [(k, t, "en", 1, "x", 0.5, 3) for k, t in enumerate(texts)]
    out += [(None, texts[3], None, None, None, None, None), (None, None, None, None, None, None, None), (len(texts), None, "en", 1, "x", 0.5, 3)]
    return [*out, out[5], out[5], (7, "another text under the same id", "en", 1, "x", 0.5, 3)]


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
