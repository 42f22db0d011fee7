"""Hard inputs that every operator must take: nulls, empty and very long texts, repeats, ties, extra columns."""

import random


def hard_documents(spark, seed=5):
    """doc_id, text and extra columns whose names clash with the operators' own."""
    rnd = random.Random(seed)
    words = ["Alpha", "beta,", "gamma", "déjà", "ΔΕΖ", "the", "of", "it's", "100%", "x", "漢字", "end."]
    rows = []
    for i in range(60):
        text = " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 4, 30, 80])))
        if rows and rnd.random() < 0.4:
            text = rnd.choice(rows)[1] or ""
            text = text[:40] + rnd.choice(["", " more", "\n\n", "\u2028z"]) + text[40:]
        rows.append((i, text))
    rows += [(None, "null id " * 9), (None, None), (70, None), (71, ""), (72, " \n\t "), (3, rows[3][1]), (3, rows[3][1]), (80, "long " + "abc def ghi " * 20000), (81, "a" * 50000)]
    return rows, spark.createDataFrame([(i, t, "x", 1.0, "c") for i, t in rows], "doc_id long, text string, component_id string, score double, chunk string").repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, component_id string")
