"""Small tables with nulls, empty, long, repeated and clashing content."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, spans string"


def words(seed, n, stem="w"):
    rng = random.Random(seed)
    return [f"{stem}{rng.randrange(400)}" for _ in range(n)]


def documents(spark, extra=()):
    base = words(1, 120)
    near = base[:60] + ["changed"] + base[61:]
    rows = [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(base).upper().replace("W", "w")),
        (4, None),
        (5, ""),
        (6, "  \n "),
        (7, "one two"),
        (8, "ONE two"),
        (None, "a text without an id"),
        (9, " ".join(words(2, 30_000))),
        (10, "x" * 100_000),
        (11, " ".join(words(3, 50))),
        (11, " ".join(words(3, 50))),
        (12, "naïve \U0001f600 text, Ünïcode"),
        *extra,
    ]
    full = [
        (i, t, None if n % 5 == 0 else "en", None if n % 3 == 0 else f"s{n % 4}",
         None if t is None else len(t), 0.5, True, "own")
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
