"""Documents for the tests of this folder."""
import sys

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed: int, words: int) -> str:
    """Words that hardly repeat, by a fixed rule."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 999983:x}" for i in range(words))


def make(spark, texts, extra=False):
    """Documents of the given texts; with ``extra``, columns whose names operators use inside."""
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, COLUMNS)
    if extra:
        from pyspark.sql import functions as F
        for name in ("row", "size", "term", "bucket", "k1", "kept", "node", "shard", "bands", "tokens", "score",
                     "__k1", "text_hash", "copies", "guest"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def hard_texts():
    """Nulls, empty texts, ties, repeated and near copies, shared passages and one very long text."""
    passage = sentence(1, 80)
    near = sentence(2, 120)
    out = [None, "", " \n\t ", "a", "MIT License", passage, passage, sentence(3, 60) + " " + passage,
           passage + " " + sentence(4, 50), near, near.replace("w", "v", 1), near.upper(), "é" * 500, "é" * 500,
           "ab" * 700, "x " * 400, sentence(5, 4), sentence(5, 4) + " ", sentence(6, 9000),
           sentence(7, 30) + "\n" + sentence(6, 9000)[2000:9000], "<|endoftext|> GNU General Public License, 3",
           "\x00\x0b\x85\xa0 word " + sentence(8, 40), "all " * 50 + sentence(9, 40)]
    return out + [sentence(100 + i, 20 + i) for i in range(30)]


from pyspark import cloudpickle  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])
