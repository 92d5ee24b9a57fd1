"""Small tables with the cases each operator must bear: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, kept string, row long, leaks string, _words string, tails string, bin string"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [a + b for a in "ka re mi so tu pal ner dor".split() for b in "nil sta vor em ud ox".split()]


def texts():
    rng = random.Random(3)
    base = sentence(rng, 60)
    words = base.split()
    near = " ".join([*words[:30], "other", *words[31:]])
    far = " ".join(w if k % 4 else "changed" for k, w in enumerate(words))
    return [
        base, base, near, far, None, "", "  \n\t ", "one", "ONE", "two words", "a b c d e", "A B C D E", "Ωμέγα 日本語 😀 naïve café\r\nline", sentence(rng, 5000),
        "same line here\n" * 40, "x" * 100_000, " ".join(["echo"] * 300), 'password = "hunter22xyz!" # note\n' + sentence(rng, 30),
    ]


def edge_rows():
    out = [(k, t, "en", "s", None, "i", "k", "no", 7, "l", "w", "t", "b") for k, t in enumerate(texts())]
    out += [out[0], out[2]]  # rows that repeat
    out += [(None, texts()[0], None, None, None, None, None, None, None, None, None, None, None), (None, None, *[None] * 11), (1, "another text under an id that is taken", *[None] * 11)]
    return out


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
