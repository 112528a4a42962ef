"""Quality rules where words are long (scripts of few ASCII spaces)."""

import random

from adlytics.llm import mcd


def test_outliers_among_long_words_do_not_mask_themselves(spark):
    rng, rows = random.Random(6), []
    for i in range(600):
        size = 60 if i % 10 else 400             # a tenth has words of 400 code points
        texts = ("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(rng.randrange(size * 9 // 10, size * 11 // 10)))
                 for _ in range(60))
        rows.append((i, " ".join(texts), "zh", "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mcd.judge(docs).collect()
    assert len(got) == 600 and not any(r.base_failed for r in got)
    assert all(r.kept == (r.doc_id % 10 > 0) for r in got)
