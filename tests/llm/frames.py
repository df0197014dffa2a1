"""Small frames with the odd rows every operator must take."""

import random

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the of and to in is that it was for on are with as his they at be this from".split()
FR = "le la les de des un une et est que qui dans pour pas sur avec ce au par il".split()


def prose(seed, n, words=EN):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", "a", "en", "ti", "or", "x"]) for _ in range(n))


def documents(spark, extra=True):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very
    long text, and extra columns named like the operators' own."""
    base = [(i, prose(i, 30 + 7 * i), "en", f"src{i % 3}") for i in range(24)]
    base += [(100 + i, prose(500 + i, 40, FR), "fr", "src1") for i in range(12)]
    base += [(200 + i, base[3][1], "en", "src0") for i in range(5)]  # copies
    base += [(210 + i, base[5][1] + f" tail{i}", "en", "src2") for i in range(4)]  # near copies
    base += [
        (300, None, "en", "src0"),
        (301, "", None, "src0"),
        (302, " \t\n", "fr", None),
        (303, "123 !!! ???", None, None),
        (304, "Lone", None, "src9"),
        (None, prose(77, 25), "en", "src1"),
        (None, None, None, None),
        (305, prose(9, 20000), "en", "src1"),
        (306, base[0][1], "en", "src2"),
        (306, base[0][1], "en", "src2"),  # a row twice
        (307, "a\x00b \ud7ff 漢字 ñandú ÀÉ", None, "ß"),
    ]
    rows = [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in base]
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    if extra:
        for c in "pos size rank label node n_shingles hits items score lang_pred rec words parts shard slot pass mark".split():
            df = df.withColumn(c, F.lit(c))
    return df


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
