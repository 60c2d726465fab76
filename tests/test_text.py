import random

import pytest
from pyspark.sql import functions as F

from stayvalue.functions.text import misread_text, repair_text


def python_repair(s):
    return s.encode("latin1", "ignore").decode("utf-8", "ignore")


def repaired(spark, texts, mode):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    out = df.select("i", repair_text(F.col("s"), mode).alias("s")).orderBy("i")
    return [r["s"] for r in out.collect()]


def test_known_cases(spark):
    texts = ["BÃ©arn", "Béarn", "日本", "plain", "", None, "ï¿½", "a\nÃ©\r\nb"]
    assert repaired(spark, texts, "always") == [
        "Béarn", "Barn", "", "plain", "", None, "�", "a\né\r\nb",
    ]


def test_always_equals_python_on_random_text(spark):
    rng = random.Random(5)
    pools = [
        [chr(c) for c in range(0x20, 0x7F)],
        [chr(c) for c in range(0x80, 0x100)],
        list("éèçñ€’日\n\U0001f600Āſ"),
    ]
    texts = []
    for _ in range(400):
        s = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 60)))
        texts += [s, s.encode("utf-8").decode("latin1")]
    assert repaired(spark, texts, "always") == [python_repair(t) for t in texts]


def test_detect_changes_only_what_it_can_restore(spark):
    originals = ["Béarn", "l’été à 30 €", "plain", "日本", "naïve"]
    damaged = [s.encode("utf-8").decode("latin1") for s in originals]
    assert repaired(spark, damaged, "detect") == originals
    untouched = ["Béarn", "日本", "Ã", "BÃ©arn – è", "", None]
    assert repaired(spark, untouched, "detect") == untouched


def test_long_texts_do_not_exhaust_the_stack(spark):
    original = "é" * 200_000 + "x" * 200_000
    damaged = original.encode("utf-8").decode("latin1")
    assert repaired(spark, [damaged], "detect") == [original]


def test_misread_is_the_inverse(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = documents.filter(repair_text(misread_text(F.col("text"))) != F.col("text"))
    assert changed.count() == 0


def test_unknown_mode():
    with pytest.raises(ValueError, match="mode"):
        repair_text(None, "sometimes")
