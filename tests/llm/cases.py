"""Documents with the odd cases every operator must bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with those the operators make.
EXTRA = "score double, n_words long, key long, node string, row string, kept boolean, chunk int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


def words(seed, n, size=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}{'abcdefg'[r.randrange(7)]}" for _ in range(n))


def odd(base=0):
    """Nulls, empty and blank texts, repeats, one very long text, texts that differ in case."""
    long = words(99, 60_000, 5_000)
    return [
        doc(base + 1, None), doc(base + 2, ""), doc(base + 3, " \n\t "), doc(base + 4, "one"), doc(base + 5, "One two"),
        (None, None, None, None, None), (None, "no id at all " + words(5, 40), None, None, 3),
        doc(base + 6, words(6, 80)), doc(base + 6, words(6, 80)), doc(base + 7, words(6, 80).upper()), doc(base + 7, words(7, 50)),
        doc(base + 8, long), doc(base + 9, "éàü ñandú — 漢字 " + words(9, 30), None, None), doc(base + 10, "!!! 123 ... ###"),
    ]


def with_extra(df):
    from pyspark.sql import functions as F

    return df.withColumns(
        {
            "score": F.lit(1.5), "n_words": F.lit(7).cast("long"), "key": F.lit(1).cast("long"), "node": F.lit("x"), "row": F.lit("y"),
            "kept": F.lit(None).cast("boolean"), "chunk": F.lit(3), "gw_text": F.lit("z"), "gw_spans": F.lit(1), "mix_rate": F.lit(9.0),
            "failed": F.lit(2), "text_a": F.lit("q"),
        }
    )
