"""Documents with nulls, empty, very long and repeated texts, and columns with clashing names."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        *(T.StructField(c, T.StringType()) for c in ("n", "ids", "start", "score", "doc", "starts", "n_removed", "h")),
    ]
)


def frame(spark, rows):
    """Documents from (doc_id, text, lang)."""
    more = ("x",) * 8
    full = [(i, t, lang, "s", None if t is None else len(t), *more) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def odd(sentences):
    """(doc_id, text, lang) rows of every kind."""
    base = sentences(1, 400)
    near = base[:200] + ["changed"] + base[201:]
    passage = sentences(2, 60)
    return [
        (0, " ".join(base), "en"),
        (1, "\n".join(base), "en"),  # the same words
        (2, " ".join(near), "fr"),
        (2, " ".join(near), "fr"),  # a repeated row
        (3, None, "en"),
        (4, "", None),
        (5, " \t\n", "de"),
        (6, "one two", "de"),
        (7, "ONE two", "de"),
        (8, " ".join(sentences(3, 70) + passage + sentences(4, 30)), "en"),
        (9, " ".join(sentences(5, 20) + passage + sentences(6, 90)), "en"),
        (10, " ".join(sentences(7, 30_000)), "en"),
        (11, "x" * 100_000, "en"),
        (12, "123 456 ... 789", "en"),
        (13, "É́ça Σίσυφος İstanbul | a|b <|endoftext|> can't 日本語\u00a0x", "fr"),
        (None, " ".join(base), "en"),
        (None, "no id", None),
    ]
