"""Small documents with every odd case, and what the tests share."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile("[^\x20\x09-\x0d]+")
SYLLABLES = "ba co di fu ge ha io ki lu ma né ço ße ri".split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def altered(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w + "x" if rng.random() < share else w for w in text.split(" "))


def documents():
    """Rows (doc_id, text): plain, repeated, alike, sharing passages, odd."""
    base, passage = prose(1, 120), prose(2, 60)
    rows = [(i, prose(100 + i, 20 + 13 * i % 150)) for i in range(12)]
    rows += [(20, base), (21, base), (22, base.upper()), (23, altered(base, 3, 0.02)), (24, altered(base, 4, 0.03))]
    rows += [(30 + i, prose(200 + i, 40) + " " + passage + " " + prose(300 + i, 30)) for i in range(4)]
    rows += [(40, passage + " " + passage), (41, "aaaa " * 100), (42, "aaaa " * 60), (43, "a" * 300), (44, "a" * 200)]
    rows += [(50, None), (51, ""), (52, " \t\n\r\x0b\x0c "), (53, "one two"), (54, "ONE  two"), (55, "one"), (56, "é ß 　x")]
    rows += [(60, "first line of the text that is long\nshort\n  FIRST line of the text that is long \n\nlast"),
             (61, "x\nFirst Line of the text that is long\r\ny"), (62, "first line of the text that is long"),
             (63, "first line of the text that is long\nand the end\n")]
    rows += [(70, prose(7, 6000)), (71, prose(8, 30) + " " + prose(7, 6000)[:4000])]
    rows += [(80, base), (80, base), (80, prose(9, 50)), (None, base), (None, None)]
    return rows


def frame(spark, rows, parts=3):
    full = [(i, t, "en", f"s{n % 3}", None) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def clashing(docs):
    """The same table with columns that bear the names operators use inside or put out."""
    names = ["key", "part", "blob", "node", "kept", "n_words", "n_removed", "n_lines", "_key", "_places", "judged",
             "readable", "P", "_source", "_topic", "topic", "n_tokens", "component", "component_id", "ref", "d", "gone"]
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))


def collected(df):
    """Rows as a sorted list, for tables with repeated and null keys."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
