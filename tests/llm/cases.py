"""Small frames with everything that tables may hold."""

import random

SCHEMA = "doc_id long, text string, source string, kept string, score string, spans string, gid string, tokens string, start string, window string"
SF = "/root/testdata/sf0.001"


def words(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7))) for _ in range(n)]


def texts(seed=5):
    """Null, empty, blank, very short, long, repeated and tied texts, and some that share passages."""
    rnd = random.Random(seed)
    base = " ".join(words(rnd, 120))
    out = [None, "", " ", "\n\n", "one", "one two", "é　ñ 日本語", "x" * 3000, "ab " * 2000, base, base, base + " more", base.upper(),
           "\n".join(["same line here now ok"] * 30), "tab\tand\x0bothers\r\nend  double  space ", "token = \"abcdef0123456789abcdef0123456789abcdef01\""]
    out += [" ".join(words(rnd, rnd.randrange(1, 60))) for _ in range(12)]
    return out


def frame(spark, some=None):
    """The texts with ids, one repeated row, one null id, a null source, and columns whose names results use too."""
    rows = [(i, t, f"s{i % 3}" if i % 5 else None) + ("old",) * 7 for i, t in enumerate(some if some is not None else texts())]
    rows += [rows[min(10, len(rows) - 1)], (None, "a row without an id", None) + ("old",) * 7]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
