"""A small table with every odd case: nulls in any column, empty and long texts, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, uid string, `key` int, n_removed int, seq string, `row` string"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(seed=1):
    rng = random.Random(seed)
    shared = words(rng, 60)
    texts = {i: "\n".join(words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5))) for i in range(1, 25)}
    texts[30] = texts[3]                                     # exact copy
    texts[31] = texts[4].upper()                             # equal but for case
    texts[32] = shared + "\n" + words(rng, 10)
    texts[33] = words(rng, 8) + "\n" + shared
    texts[34] = texts[5][:-1] + ("x" if texts[5][-1] != "x" else "y")    # one letter substituted
    texts[35] = "q" + texts[6]                               # one letter inserted
    base = words(rng, 200)
    texts[36], texts[37] = base, base + " zz yy"             # near copies
    texts[40], texts[41], texts[42] = "", "  \n\t", "123 %% 45"
    texts[43] = words(rng, 9000)                             # long
    texts[44] = "ünï é ø 你好 ☃ ▁x  double  blank here don't <|endoftext|>"
    out = [(i, t, rng.choice(["aa", "bb"]), "s", len(t)) for i, t in texts.items()]
    out += [(50, None, None, None, None), (None, "null id " + words(rng, 20), "aa", None, None), (None, None, None, None, None)]
    out += [out[0], out[0], (2, "other text of the same id", "bb", "s", 3)]
    return [r + (r[0], "u", 1, 2, "s", "r") for r in out]


def frame(spark, seed=1):
    return spark.createDataFrame(rows(seed), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
