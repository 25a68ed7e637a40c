"""Small tables with the awkward cases every operator has to take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(spark, extra=()):
    """Nulls in every column, empty and long texts, repeated rows, ties, shared passages, clashing columns."""
    rng = random.Random(7)
    vocabulary = ["the", "of", "and", "to", "in", *(f"w{i}é" for i in range(60))]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, long = prose(70), prose(6000)
    texts = [prose(n) for n in (0, 1, 2, 3, 19, 20, 21, 60, 60, 120, 200)]
    texts += [passage, passage, prose(30) + " " + passage + " " + prose(30), passage + "\n" + passage, long, long + " tail"]
    texts += [None, "", " \t\n", "a\nb\na\n\nA", "Again again " * 60, "#$% | <> " * 30, "ﬀ ß İ 你好  x ​", texts[9]]
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, texts[10], None, None, None), (None, None, None, None, None), (9, prose(40), "en", "s1", 1)]
    rows += list(extra)
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(3)


CLASHES = ("row", "shard", "slot", "key", "place", "fp", "digest", "size", "kept", "score", "text_crc32", "matches", "host", "votes",
           "n_words", "target", "copies", "src", "n", "label")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES if c not in df.columns])


def save(df, folder, table):
    df.write.mode("overwrite").parquet(f"{folder}/{table}.parquet")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
