"""Small tables with the hard cases, stored as operators read them."""

import uuid

LONG = "Mit word " * 30_000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, row long, rep string, size string, name string, content string, block string")


def text_rows():
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties, repeated rows."""
    prose = " ".join(f"word{i} and{i % 7} more" for i in range(60))
    near = prose.replace("word30 ", "wordx ")
    return [
        (1, prose, "en", "a"), (2, prose.upper(), "en", "a"), (3, near, "en", "b"), (3, near, "en", "b"),
        (4, None, None, None), (5, "", "en", None), (6, " \t\n\r\x0b\x0c ", None, "a"), (7, LONG, "en", "a"),
        (None, "lone words without an id, all rights reserved", "de", "b"), (None, None, None, None),
        (8, "CC BY 4.0. All rights reserved. cc by cc-by", "en", "c"),
        (9, "one\x00two é́   𝔘nicode Σίσυφος ΣΑΣ <|endoftext|> it's 42", "el", "c"),
        (10, "licensed under the Apache Licence, Version 2.0", "en", "c"),
    ]


def store(spark, rows, schema=SCHEMA):
    """The rows as a stored table with extra columns whose names operators use inside."""
    from flightlake.session import scratch_path
    width = len(schema.split(", "))
    rows = [tuple(r) + (None,) * (width - len(r)) for r in rows]
    path = scratch_path(spark, f"fixture-{uuid.uuid4().hex[:6]}")
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def messy(spark):
    return store(spark, text_rows())


def empty(spark):
    return store(spark, [])


# Columns named like those that operators add to whole rows or use beside them.
CLASHING = SCHEMA + (", mix_shard int, mix_order long, Mix_Source string, p_block int, p_draws string, d_key long, quality string, "
                     "quality_kept string, l_limits string, l_lang string, pii string, tried string, h_row long, done string, "
                     "row_number_ long, dropped_row long, `a.b` string")


def clashing(spark):
    return store(spark, [r + (None,) * 8 + tuple(range(2)) + ("c", 3, "d", 4, "q", "k", "l", "m", "p", "t", 5, "e", 6, 7, "dot") for r in text_rows()], CLASHING)
