"""Small tables that hold the odd cases."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = (
    "key string, doc_id long, text string, TEXT string, lang string, source string, n_chars long, "
    "n_words int, block string, component_id string, `a.b` int, tokens string"
)


def prose(seed: int, n: int) -> str:
    """Words in an order of their own."""
    state, out = seed * 7919 + 13, []
    for i in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(f"{WORDS[state // 7 % 20]}{state // 977 % 50 or ''}")
        if i % 11 == 10:
            out.append("\n")
    return " ".join(out)


def rows() -> list[tuple]:
    long = " ".join(prose(i, 400) for i in range(60))
    texts = [
        (1, prose(1, 120)), (2, prose(2, 120)), (3, prose(1, 120)), (4, prose(1, 118) + " changed end"),
        (5, None), (6, ""), (7, " \n\t "), (8, "one two three"), (9, "ONE two Three"), (10, long),
        (11, long + " tail"), (12, "é日本 " * 80), (13, "x" * 5000), (14, prose(2, 120)), (14, prose(2, 120)),
        (None, prose(3, 90)), (None, None), (16, "a b c d"), (17, "a b c d e"), (18, "the same words " * 40),
        (19, "<|endoftext|> <|startoftext|> a"), (20, prose(2, 60) + "\r\n" + prose(5, 60)),
    ]
    sources = ["s1", "s1", "s2", None]
    langs = ["en", None, "de"]
    return [
        ("k", i, t, "other", langs[j % 3], sources[j % 4], len(t or ""), 3, "b", "c", 1, "t")
        for j, (i, t) in enumerate(texts)
    ]


def odd_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows() -> list[tuple]:
    return [(r[1], r[2]) for r in rows()]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
