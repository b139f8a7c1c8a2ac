"""Documents with everything an operator must stand, under columns with names of its own."""

import random

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 8000 + "x" * 30_000 + " 1" * 9000
TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "one two three four",
    "The quick brown fox jumps over the lazy dog and runs away from all of them.",
    "The quick brown fox jumps over the lazy dog and runs away from all of them.",
    "  leading and   inner\n\n\nblanks \r\n\tand trailing  \n",
    "naïve café größer – 日本語 🙂🙂 end.\nNext line, it's we'll they've 'quoted'",
    "special <|endoftext|> inside<|endoftext|>\n<|endoftext|> and <s> ▁marks▁ <0x41>",
    "mail ann.lee@mail.example.com or +1 (441) 555-3597, host 10.0.0.256 and 10.0.0.25.7",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, a@b.c_d@e.f @@ 1.2.3",
    "line one here\nline one here\nline one here\nshort\n",
    "\x1c odd \x85 spaces \xa0 and   separators ​ here",
    "a b c d e " * 40,
    LONG,
]
CLASHING = "words text_crc32 size shard kept base spans fp path key tie copies mix_size _id n_words ids"


def documents(spark, texts=TEXTS, repeats=1):
    """doc_id, text, lang, source, n_chars and columns with clashing names.

    The first row has a null id, some sources are null, and the last row is there twice.
    """
    rows = [
        (None if i == 0 else i, text, "en", None if i % 5 == 0 else f"s{i % 3}", len(text or ""))
        for i, text in enumerate(texts)
    ]
    rows += rows[-1:] * repeats
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING.split()})


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def random_texts(alphabet, count, longest, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, longest))) for _ in range(count)]


def by_id(df):
    """Collected rows by doc_id; equal rows of one id must agree."""
    found = {}
    for row in df.collect():
        assert found.setdefault(row.doc_id, row) == row
    return found
