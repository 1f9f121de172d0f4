"""Small awkward corpora."""

import random

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, key string, size int, `start` double"


def frame(spark, rows, ddl=DDL, partitions=3):
    width = ddl.count(",") + 1
    data = [tuple(r) + (None,) * (width - len(r)) for r in rows]
    return spark.createDataFrame(data, ddl).repartition(partitions) if data else spark.createDataFrame([], ddl)


def awkward(seed=0, n=60):
    """Nulls, empty and blank texts, copies, repeated rows, a long text, shared passages; columns with clashing names."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéß中 ", k=rng.randint(1, 7))) for _ in range(40)]
    passage = " ".join(rng.choices(words, k=60))
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 80)))
        if i % 4 == 0:
            text = text[: len(text) // 2] + passage + text[len(text) // 2 :]
        if i % 7 == 0:
            text = text.replace(" ", "\n", 3) + "\n" + text[:150]
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", None]), len(text), "u", "k", 1, 1.0))
    long = " ".join(rng.choices(words, k=30_000))
    rows += [(n, long), (n + 1, long[:1000] + "x" + long[1000:9000]), (n + 2, None), (n + 3, ""), (n + 4, " \n\t ")]
    rows += [(n + 5, rows[3][1].replace(" ", "  ")), (n + 6, rows[3][1]), rows[5], rows[5], (None, rows[8][1]), (None, None)]
    rows += [(n + 7, "ab" * 400), (n + 8, "ab" * 300), (n + 9, "1234 5678")]
    return rows
