"""Small tables with every awkward row: nulls, empty and very long texts, ties, repeats, extra columns."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


def awkward_rows(seed=5, n=60):
    """(doc_id, text, lang, source, n_chars) rows."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 60)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), None)
            for i in range(n)]
    base = rows[3][1]
    rows += [
        (100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n ", "en", "", 4),
        (103, "x" * 5000, "en", "b", 5000), (104, prose(rng, 3000), "fr", "a", None),
        (105, base, "en", "a", None), (106, base.replace(" ", "  \n"), "en", "a", None),
        (107, "Ünï ♥ 日本 " * 5, "fr", None, None), (108, "\x00a\x0b b", None, "b", None),
        (None, base, "en", "a", None), (None, None, None, None, None), (105, base, "en", "a", None),
        (110, "MIT  License! apache-license, General Public\nLicense v3", "en", "a", None),
    ]
    return rows


def frame(spark, rows):
    """The rows with an extra column whose names clash with what operators use inside."""
    wide = [(*r, 1, "t", 2, 3) for r in rows]
    return spark.createDataFrame(wide, DDL + ", id int, digest string, block int, size int").repartition(3)


def empty(spark):
    return spark.createDataFrame([], DDL)
