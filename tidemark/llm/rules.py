"""Quality rules: repetition, length, and a hashed n-gram likelihood ratio, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, unpacked, words
from tidemark.plans.storage import store

#: Low bits of a sort key that hold a window's place; texts with more windows are sorted by (hash, place) pairs.
PLACE_BITS = 24
#: Hash buckets of the n-grams, and the orders of n-grams that the queries count.
BUCKETS = 1 << 18
ORDERS = (1, 2)
#: Bits of the table that tells most documents without trust from those with.
ID_BITS = 1 << 25


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word in them that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _hashed(found: Column) -> Column:
    return F.transform(found, lambda word: F.xxhash64(word))


def _longer(grams: Column, hashes: Column, n: int) -> Column:
    """Hashes of the n-grams at every word, from those of one word less (``grams``); past the last word nothing is added.

    ``grams`` and ``hashes`` should be columns, so that they are not made anew for each word.
    """
    return F.transform(grams, lambda gram, k: F.xxhash64(gram, F.get(hashes, k + (n - 1))))


def _with_grams(rows: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """Adds ``_gram1`` (hashes of the words in ``_words``), ``_gram2`` and so on up to the longest of the orders."""
    rows = rows.withColumn("_gram1", _hashed(F.col("_words")))
    for n in range(2, max(orders) + 1):
        rows = rows.withColumn(f"_gram{n}", _longer(F.col(f"_gram{n - 1}"), F.col("_gram1"), n))
    return rows


def _repeated_places(hashes: Column, distinct: Column) -> Column:
    """Places of the hashes that occur twice or more, in ascending order; ``distinct`` is how many different ones there are.

    The hash's high bits and the place make one number, so that equal windows are neighbours after a plain sort; neighbours count only
    if their whole hashes are equal. Where places need more bits, or different hashes share their high bits and so may stand between
    equal ones, (hash, place) pairs are sorted instead.
    """

    def same(keys: Column, one: Column, other: Column) -> Column:
        a, b = F.get(keys, one), F.get(keys, other)
        place = lambda key: key.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
        return (F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)) & (F.get(hashes, place(a)) == F.get(hashes, place(b)))

    high = F.lit(-(1 << PLACE_BITS))
    keys = F.sort_array(F.transform(hashes, lambda h, k: h.bitwiseAND(high).bitwiseOR(k.cast("long"))))
    # The sorted keys are needed whole at each of their elements: bind them once as the only element of an array.
    bound = F.transform(
        F.array(keys),
        lambda sorted_keys: F.filter(sorted_keys, lambda key, k: (k > 0) & F.coalesce(same(sorted_keys, k - 1, k), F.lit(False)) | F.coalesce(same(sorted_keys, k, k + 1), F.lit(False))),
    )
    short = F.sort_array(F.transform(F.get(bound, F.lit(0)), lambda key: key.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))

    def paired(pairs: Column, one: Column, other: Column) -> Column:
        return F.coalesce(F.get(pairs, one)["hash"] == F.get(pairs, other)["hash"], F.lit(False))

    pairs = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("hash"), k.cast("long").alias("place"))))
    kept = F.transform(F.array(pairs), lambda found: F.filter(found, lambda _, k: (k > 0) & paired(found, k - 1, k) | paired(found, k, k + 1)))
    exact = F.sort_array(F.transform(F.get(kept, F.lit(0)), lambda pair: pair["place"]))
    shared = F.size(F.array_distinct(F.transform(hashes, lambda h: h.bitwiseAND(high)))) < distinct
    return F.when((F.size(hashes) > 1 << PLACE_BITS) | shared, exact).otherwise(short)


def _covered(places: Column) -> Column:
    """How many words the windows at these ascending places cover."""
    start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(places, start, lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n")), lambda acc: acc["n"])


def n_repeat_words(hashes: Column, distinct: Column) -> Column:
    """Words in windows of three that are found twice or more in the text, the first included."""
    return F.when(distinct == F.size(hashes), F.lit(0).cast("long")).otherwise(_covered(_repeated_places(hashes, distinct)))


def measures(rows: DataFrame, orders: tuple[int, ...] = (1, 2)) -> DataFrame:
    """``rows`` (any columns and ``text``) with the base measures, ``_words`` and the grams of ``orders``; a null text has no words."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_words", words(F.col("text")))
    rows = _with_grams(rows, (2, *orders))
    windows = F.slice(_longer(F.col("_gram2"), F.col("_gram1"), 3), F.lit(1), F.greatest(F.size("_gram1") - 2, F.lit(0)))
    rows = rows.withColumn("_windows", windows).withColumn("_distinct", F.size(F.array_distinct("_windows")))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": n_symbols(F.col("text")),
            "n_dup_lines": n_dup_lines(F.col("text")),
            "n_repeat_words": n_repeat_words(F.col("_windows"), F.col("_distinct")),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("_windows", "_distinct")


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _listed(table: DataFrame, number: str, value: str, size: int, missing: Column) -> DataFrame:
    """The values of a table as one row with an array of ``size`` places by number; places without a value have ``missing``."""
    every = table.sparkSession.range(size).select(F.col("id").cast("int").alias("_at"))
    rows = every.join(table.select(F.col(number).cast("int").alias("_at"), F.col(value).alias("_value")), "_at", "left")
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_value")))
    return rows.agg(F.transform(ordered, lambda row: F.coalesce(row["_value"], missing)).alias("listed"))


def _perhaps(ids: DataFrame, key: Column) -> Column:
    """Whether a key may be among ``ids``: true for all that are, and for others by chance, the rarer the fewer ids there are.

    One bit for each of 2^25 hash values, as an array of 4 MB whatever the number of ids.
    """
    place = F.xxhash64(F.col("_id")).bitwiseAND(F.lit(ID_BITS - 1))
    words = ids.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    place = F.xxhash64(key).bitwiseAND(F.lit(ID_BITS - 1))
    table = _listed(words, "word", "bits", ID_BITS >> 6, F.lit(0).cast("long")).scalar()
    word = F.get(table, F.shiftright(place, 6).cast("int"))
    return F.bit_get(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def _counted(texts: DataFrame, orders: tuple[int, ...], name: str) -> DataFrame:
    """How often each bucket occurs in the texts; added up in the tasks, so at most all buckets leave each.

    There is an n-gram of each order at every word; those at the end of the text are shorter.
    """
    rows = _with_grams(texts.select(words(F.col("_text")).alias("_words")), orders)
    grams = F.concat(*[F.col(f"_gram{n}") for n in orders]) if len(orders) > 1 else F.col(f"_gram{orders[0]}")
    found = rows.select(F.explode(grams).alias("gram")).select(_bucket(F.col("gram")).alias("bucket"))
    return found.groupBy("bucket").agg(F.count(F.lit(1)).cast("double").alias(name))


def ratios(docs: DataFrame, trusted: DataFrame, folder: str, orders: tuple[int, ...] = ORDERS, pseudo: float = 3.0) -> Column:
    """The log likelihood ratio of each bucket between trusted target and raw corpus, as one array of ``BUCKETS`` places: a scalar
    subquery, so that plans, and whatever keeps their texts in the driver, name the array and do not hold it.

    The raw multinomial counts every n-gram of every document, in a scan without a join. The target's counts those of every
    trusted document. Each bucket has ``pseudo`` further counts in the target and as many in the raw corpus at the target's scale, so the
    ratio is (target + pseudo) / (raw x target's share + pseudo): n-grams that are rare in the corpus say little, whatever its size.
    Of the documents only the trusted ones (and the few that a bit table cannot tell from them) are shuffled, the same way at
    every size. Both counts are stored as tables of at most ``BUCKETS`` rows. Without trusted documents or n-grams all ratios are 0.
    """
    chosen = store(trusted.select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct(), folder, "trusted")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    raw = store(_counted(texts, orders, "raw"), folder, "raw")
    own = texts.where(F.col("_id").isNotNull() & _perhaps(chosen, F.col("_id")))
    target = store(_counted(own.join(chosen.hint("merge"), "_id", "left_semi"), orders, "target"), folder, "target")
    counts = raw.join(target, "bucket", "left").select("bucket", "raw", F.coalesce("target", F.lit(0.0)).alias("target"))
    n_raw, n_target = counts.agg(F.coalesce(F.sum("raw"), F.lit(0.0)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    expected = F.col("raw") * F.lit(n_target / n_raw if n_raw else 0.0)
    ratio = F.log((F.col("target") + pseudo) / (expected + pseudo))
    # Only buckets that no document has are null.
    return _listed(counts.select("bucket", F.round(ratio, 5).alias("ratio")), "bucket", "ratio", BUCKETS, F.lit(0.0)).scalar()


def judge(docs: DataFrame, trusted: DataFrame, folder: str, keep: list[str] | None = None, orders: tuple[int, ...] = ORDERS, threshold: float = -0.25) -> DataFrame:
    """The columns ``keep`` (by default all) of every row of ``docs`` (doc_id, text) as the struct ``_row``, with the base measures,
    base_failed, score and kept.

    ``trusted`` has the doc_ids of the target; null ones trust nobody. The score is the mean log likelihood ratio of a text's n-grams of
    all ``orders``; a document stays if it passes the base rules and scores ``threshold`` or more. A null text counts as empty; a text
    without words scores 0 and fails the base rules. Repeated rows are judged alike and each counts. Texts of any length are judged
    whole. Extra columns, whatever their names, stay in ``_row``. An empty table gives an empty result.
    """
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in names]).alias("_row")
    weights = ratios(docs, trusted, folder, orders)
    rows = measures(packed(docs, F.col("text").cast("string").alias("text")).select(row, "text"), orders)

    def summed(listed: Column) -> Column:
        total = F.lit(0.0)
        for n in orders:
            looked_up = F.transform(F.col(f"_gram{n}"), lambda gram: F.get(listed, _bucket(gram)))
            total = total + F.aggregate(looked_up, F.lit(0.0), lambda acc, ratio: acc + ratio)
        return total

    # Functions of array elements take no subquery as it is written. Spark moves a column that is used once into its use, but not past
    # one that depends on the partition's number: so the subquery ends in the sum, and no row carries the array.
    rows = rows.withColumn("_here", F.spark_partition_id()).withColumn("_listed", weights)
    total = F.get(F.transform(F.array("_listed"), summed), F.lit(0))
    rows = rows.withColumn("score", F.when(F.col("n_words") > 0, total / (F.col("n_words") * len(orders))).otherwise(0.0))
    # A filter on the verdict must not be moved below the measures, where each use of the words would split the text anew; it stays
    # above a column that depends on the partition's number.
    kept = ~F.col("base_failed") & (F.col("score") >= threshold) & (F.col("_here") >= 0)
    rows = rows.withColumn("kept", kept)
    return rows.select("_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def passing(docs: DataFrame, trusted: DataFrame, folder: str, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return unpacked(judge(docs, trusted, folder, **options).where("kept"), docs.columns)
