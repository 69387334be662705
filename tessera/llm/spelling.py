"""Spelling variants: words one edit apart, found by pivotal bigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows
from tessera.session import cut_lineage

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Index entries of one gram, place and length beyond which they are told apart by what is left of the word.
HOT_ENTRIES = 500
#: (difference in length, in place) of an untouched bigram in a word one edit away.
SHIFTS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def without(word: Column, at: Column) -> Column:
    """A word without its code point ``at`` (from 0)."""
    return F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + F.lit(2)))


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5,
                drop_every: int | None = None) -> DataFrame:
    """``word, n`` of the words of all texts with so many code points and occurrences.

    Words are maximal runs of Latin letters, A-Z in lower case. With ``drop_every`` a run of a document loses
    one code point where that number divides the checksum of ``<doc_id>:<run>`` (a null id counts as empty).
    Counts are combined before the shuffle, so a frequent word sends one row a task.
    """
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", UPPER, LOWER))
    word = F.col("run")
    if drop_every:
        mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        runs = runs.withColumn("mark", mark)
        at = F.pmod("mark", F.char_length("run")).cast("int")
        word = F.when(F.col("mark") % drop_every == 0, without(F.col("run"), at)).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _pivots(grams: Column) -> Column:
    """Two bigrams that share no code point, of least sum of frequencies, from bigrams in order of place.

    Dynamic programme: the best single one that ended before the last bigram, the last one, the best pair.
    """
    none = F.lit(None).cast("struct<n:bigint,pos:int,rank:bigint>")
    far = F.lit(1 << 62)

    def lighter(a, b):
        return F.when(a.isNull() | (b["n"] < a["n"]), b).otherwise(a)

    def step(s, g):
        free = F.when(s["last"].isNull(), none).when(s["last"]["pos"] + 1 < g["pos"], lighter(s["one"], s["last"])
                                                     ).otherwise(s["one"])
        total = F.coalesce(free["n"] + g["n"], far)
        better = total < s["total"]
        return F.struct(F.when(s["last"].isNull(), none).otherwise(lighter(s["one"], s["last"])).alias("one"),
                        g.alias("last"), F.when(better, total).otherwise(s["total"]).alias("total"),
                        F.when(better, F.array(free, g)).otherwise(s["pair"]).alias("pair"))

    start = F.struct(none.alias("one"), none.alias("last"), far.alias("total"), F.array(none, none).alias("pair"))
    return F.aggregate(grams, start, step, lambda s: s["pair"])


def signatures(words: DataFrame) -> DataFrame:
    """``word, n, size, last, prefix, pivots``: a word's rarest bigrams.

    Bigrams are ranked by frequency over the words. The prefix holds every bigram up to the rank of the third
    rarest place, ``last``; among them are always two without a common code point, the pivots.
    """
    placed = words.withColumn("pos", F.explode(F.sequence(F.lit(0), F.char_length("word") - 2)))
    placed = placed.withColumn("gram", F.substr("word", F.col("pos") + 1, F.lit(2)))
    ranks = cut_lineage(number_rows(placed.groupBy("gram").agg(F.count(F.lit(1)).alias("many")), [],
                                    ["many", "gram"], "rank"))
    held = (placed.join(ranks, "gram").groupBy("word").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(
        F.struct(F.col("many").alias("n"), "pos", "rank"))).alias("grams")))
    third = F.sort_array(F.transform("grams", lambda g: g["rank"]))[2]
    held = held.withColumn("last", third)
    held = held.withColumn("prefix", F.array_sort(F.filter("grams", lambda g: g["rank"] <= F.col("last")),
                                                  lambda a, b: a["pos"] - b["pos"]))
    return held.select("word", "n", F.char_length("word").alias("size"), "last", "prefix",
                       _pivots(F.col("prefix")).alias("pivots"))


def _rests(word: Column, way: Column) -> Column:
    """Keys of a word: itself, or what is left without each code point, so that words one edit apart share one.

    ``way`` is 0 for words of equal size (the place counts), 1 for the shorter of two, -1 for the longer one.
    """
    places = F.sequence(F.lit(0), F.char_length(word) - 1)
    cut = F.transform(places, lambda i: without(word, i))
    placed = F.transform(places, lambda i: F.concat(i.cast("string"), F.lit(":"), without(word, i)))
    return F.when(way == 0, placed).when(way == 1, F.array(word)).otherwise(cut)


def near_pairs(words: DataFrame, hot_entries: int | None = None) -> DataFrame:
    """``a, n_a, b, n_b``: all pairs of words that differ by one inserted, deleted or replaced code point, once each.

    Method: of two such words, the one whose prefix ends at the lower rank has a pivot that the edit leaves
    alone, and it stands in the other's prefix, with the same place and size or moved by one. So pivots are
    joined to the prefix bigrams by rank, place and size, and pairs are verified by their edit distance.
    An entry with more than ``hot_entries`` words is told apart by what is left of each word without one code
    point, equal for words one edit apart, so no entry gives all pairs of its words.
    """
    if words.filter(F.char_length("word") < 4).take(1):
        raise ValueError("words of at least 4 code points")
    limit = HOT_ENTRIES if hot_entries is None else hot_entries
    signed = cut_lineage(signatures(words.select("word", "n")))
    entries = signed.select("word", "n", "size", "last", F.explode("prefix").alias("g")).select(
        "word", "n", "last", "size", F.col("g.rank").alias("rank"), F.col("g.pos").alias("pos"))
    asked = (signed.select("word", "n", "size", "last", F.explode("pivots").alias("g"))
             .select("*", F.explode(F.array(*[F.struct(F.lit(a).alias("longer"), F.lit(b).alias("moved"))
                                              for a, b in SHIFTS])).alias("s"))
             .select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"),
                     (F.col("size") + F.col("s.longer")).alias("size"), F.col("g.rank").alias("rank"),
                     (F.col("g.pos") + F.col("s.moved")).alias("pos"), F.col("s.longer").alias("way")))
    place = ["rank", "pos", "size"]
    hot = cut_lineage(entries.groupBy(*place).agg(F.count(F.lit(1)).alias("many"))
                      .filter(F.col("many") > limit).select(*place))
    ordered = (F.col("last_a") < F.col("last")) | ((F.col("last_a") == F.col("last")) & (F.col("a") < F.col("word")))
    found = asked.join(hot, place, "left_anti").join(entries.join(hot, place, "left_anti"), place)
    if hot.take(1):
        ways = F.explode(F.array(F.lit(0), F.lit(1), F.lit(-1)))
        left = asked.join(hot, place).withColumn("rest", F.explode(_rests(F.col("a"), F.col("way"))))
        right = (entries.join(hot, place).withColumn("way", ways)
                 .withColumn("rest", F.explode(_rests(F.col("word"), -F.col("way")))))
        found = found.drop("way").unionByName(left.join(right, [*place, "way", "rest"]).drop("way", "rest"))
    near = found.filter(ordered).filter(F.levenshtein("a", "word", 1) == 1)
    first = F.col("a") < F.col("word")
    return near.select(F.least("a", "word").alias("a"), F.when(first, F.col("n_a")).otherwise(F.col("n")).alias("n_a"),
                       F.greatest("a", "word").alias("b"),
                       F.when(first, F.col("n")).otherwise(F.col("n_a")).alias("n_b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms, found by doubling the steps each round."""
    links = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut_lineage(links.join(ahead, "root", "left").select("word", "root", "next"))
        if not further.filter("next IS NOT NULL").take(1):
            return links
        links = further.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(words: DataFrame, ratio: int = 5, hot_entries: int | None = None) -> DataFrame:
    """Form and root of each of the distinct words of a table ``word, n``.

    Output: ``word, form, root, n, n_near, form_n``. ``form`` is the most frequent word one edit away (ties: the
    first in code point order) if it occurs ``ratio`` times as often at least; ``root`` ends the chain of forms.
    Words need 4 code points; a word must stand in one row; an empty table gives an empty table; columns beyond
    ``word`` and ``n`` are not read.
    """
    if ratio < 2:
        raise ValueError("a ratio of at least 2, or forms could run in circles")
    words = cut_lineage(words.select("word", "n"))
    pairs = cut_lineage(near_pairs(words, hot_entries))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("many")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("many")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("many")).alias("less"), "other")).alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    formed = cut_lineage(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n")))
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                     "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, of 6 code points and 5 occurrences at least.

    Null texts have no words; a null id counts as empty; repeated rows count again.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return group_variants(word_counts(docs, drop_every=199))


OP12_SQL = """
WITH RECURSIVE z AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(0, 8),
       lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c
       FROM (SELECT unnest(range(0, 256)) AS i))),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
      SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
c AS (SELECT run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r
      WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT run, c, xor(list_reduce(range(0, len(x) // 2), lambda a, b: xor(a // 256,
        t[xor(a % 256, ('0x' || substr(x, (2 * b + 1)::INT, 2))::BIGINT) + 1]), 4294967295), 4294967295) AS h FROM c, z),
e AS (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                     ELSE run END AS word FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
v AS (SELECT word, n, length(word) AS size, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS many FROM v a JOIN v b USING (size, i, rest) WHERE a.word <> b.word
      UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.rest = w.word
      UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.rest = w.word),
b AS (SELECT word, other, many, count(*) OVER (PARTITION BY word) AS n_near,
             row_number() OVER (PARTITION BY word ORDER BY many DESC, encode(other)) AS k FROM p),
f AS (SELECT w.word, CASE WHEN many >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN many >= 5 * n THEN many END AS form_n FROM w LEFT JOIN b ON b.word = w.word AND k = 1),
o AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM f
      UNION ALL SELECT o.word, coalesce(f.form, o.root), f.form IS NULL FROM o JOIN f ON f.word = o.root WHERE NOT done)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN o ON o.word = f.word AND done"""
